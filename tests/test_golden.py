"""Hand-worked patients (FIXTURES.md section 5), each isolating one rule.

Every case runs twice: with the default scan settings (every key is ordinary) and
with tiny thresholds that make every key hot, split into runs and chunked copies,
so both execution paths must give the same exact answers.
"""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from refillscope.operators import adherence as adh
from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from scan_helpers import hot_options
from refillscope.schema import DEMOGRAPHIC_COLUMNS, DISPENSING_SCHEMA, THERAPY_SCHEMA, product_dimension

PROD = 1480022
OTHER = 1470395

PATHS = {"ordinary": lambda _: {}, "hot": lambda deliveries: hot_options(deliveries, 1, 1)}


def d(text):
    if " " in text:
        return datetime.strptime(text, "%d/%m/%Y %H:%M")
    return datetime.strptime(text, "%d/%m/%Y")


def delivery(patient, when, qty, prod=PROD, town="ROMA", sex="F"):
    return (patient, prod, d(when), qty, sex, "1970-01-01", "NAPOLI", town, "ASL1")


def therapy(patient, when, days, prod=PROD):
    return (patient, prod, d(when), days)


DELIVERIES = [
    # A: gap divided by the earlier quantity; first gap 0 counts in the mean.
    delivery("A", "01/01/2022", 1.0),
    delivery("A", "29/01/2022", 2.0),
    delivery("A", "30/03/2022", 1.0),
    # B: mean 14.5 rounds half to even.
    delivery("B", "01/03/2022", 1.0),
    delivery("B", "30/03/2022", 1.0),
    # C and D: single delivery.
    delivery("C", "05/05/2022", 1.0),
    delivery("D", "05/05/2022", 1.0),
    # E: same-day tie ordered by quantity; adherence above 100 is kept.
    delivery("E", "10/01/2022", 3.0),
    delivery("E", "10/01/2022", 1.0),
    delivery("E", "09/02/2022", 1.0),
    # F: half-even mean 24 gives 5 late pickups.
    *[delivery("F", x, 1.0) for x in ("01/01/2022", "29/01/2022", "26/02/2022", "26/03/2022", "23/04/2022", "28/05/2022")],
    # G: whole 24-hour spans, not midnights; no therapy row.
    delivery("G", "01/01/2022 23:00", 1.0),
    delivery("G", "03/01/2022 01:00", 1.0),
    # H: a zero quantity: its gap normalises to NULL and leaves the mean.
    delivery("H", "01/01/2022", 1.0),
    delivery("H", "10/01/2022", 0.0),
    delivery("H", "20/01/2022", 1.0),
    # J: two demographic variants; the latest delivery's wins.
    delivery("J", "01/01/2022", 1.0, town="MILANO"),
    delivery("J", "01/02/2022", 1.0, town="TORINO"),
    # M: a product outside the dimension.
    delivery("M", "01/01/2022", 1.0, prod=999),
    # Another product for patient A: keys are (product, patient).
    delivery("A", "01/01/2022", 1.0, prod=OTHER),
    delivery("A", "11/01/2022", 1.0, prod=OTHER),
]

THERAPY = [
    therapy("A", "01/01/2022", 28.0),
    therapy("A", "29/01/2022", 56.0),
    therapy("A", "30/03/2022", 28.0),
    therapy("B", "01/03/2022", 28.0),
    therapy("B", "30/03/2022", 28.0),
    therapy("C", "05/05/2022", 0.0),
    therapy("D", "05/05/2022", 28.0),
    therapy("E", "10/01/2022", 30.0),
    therapy("E", "10/01/2022", 90.0),
    therapy("E", "09/02/2022", 30.0),
    therapy("F", "01/01/2022", 28.0),
    # K: two rows on the latest date: the greater therapy days counts.
    therapy("J", "01/02/2022", 28.0),
    therapy("J", "01/02/2022", 56.0),
    therapy("J", "01/01/2022", 28.0),
    therapy("A", "01/01/2022", 10.0, prod=OTHER),
]

# patient -> (normalised gaps in order, mean, deliveries, late, numerator, denominator, adherence)
EXPECTED = {
    "A": ([0.0, 28.0, 30.0], 19, 3, 2, 112.0, 116.0, 96.55),
    "B": ([0.0, 29.0], 14, 2, 1, 56.0, 57.0, 98.25),
    "C": ([0.0], 0, 1, 0, 0.0, 0.0, None),
    "D": ([0.0], 0, 1, 0, 28.0, 28.0, 100.0),
    "E": ([0.0, 0.0, 10.0], 3, 3, 1, 150.0, 60.0, 250.0),
    "F": ([0.0, 28.0, 28.0, 28.0, 28.0, 35.0], 24, 6, 5, 28.0, 175.0, 16.0),
    "G": ([0.0, 1.0], 0, 2, 0, None, None, None),
    "H": ([0.0, 9.0, None], 4, 3, 1, None, None, None),
    "J": ([0.0, 31.0], 16, 2, 1, 112.0, 87.0, 128.74),
}


@pytest.fixture(scope="module")
def frames(spark):
    disp = spark.createDataFrame(DELIVERIES, DISPENSING_SCHEMA)
    ther = spark.createDataFrame(THERAPY, THERAPY_SCHEMA)
    products = product_dimension(spark)
    keys = [p[0] for p in products.collect()]
    return adh.filter_products(disp, keys), adh.filter_products(ther, keys), products


def _by_patient(rows, prod=PROD):
    return {r["patient_id"]: r for r in rows if r["prod"] == prod}


@pytest.mark.parametrize("path", list(PATHS))
def test_intervals_and_normalised_days(frames, path):
    disp, _, _ = frames
    rows = iv.normalised_days(iv.delivery_intervals(disp, **PATHS[path](disp))).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["prod"], r["patient_id"], r["n"])):
        if r["prod"] == PROD:
            got.setdefault(r["patient_id"], []).append(r["normalised_days"])
    for patient, exp in EXPECTED.items():
        assert got[patient] == exp[0], patient
    # Case E: the same-day pair is ordered by quantity, so the 30-day gap divides by 3.
    e3 = [r for r in rows if r["patient_id"] == "E" and r["n"] == 3][0]
    assert (e3["qty"], e3["gap_days"]) == (3.0, 30)
    assert e3["base_at"] == datetime(2022, 1, 10) and e3["next_at"] == datetime(2022, 2, 9)
    first = [r for r in rows if r["patient_id"] == "A" and r["prod"] == PROD and r["n"] == 1][0]
    assert first["next_at"] is None and first["gap_days"] == 0 and first["qty"] == 1.0


@pytest.mark.parametrize("carry", [(), DEMOGRAPHIC_COLUMNS])
@pytest.mark.parametrize("path", list(PATHS))
def test_summary_measures(frames, path, carry):
    disp, _, _ = frames
    scan = iv.scan_deliveries(disp, carry=carry, **PATHS[path](disp))
    summary = _by_patient(sm.delivery_summary(disp, scan).collect())
    for patient, (_, mean, n, late, *_rest) in EXPECTED.items():
        row = summary[patient]
        assert (row["mean_days"], row["deliveries"], row["late"]) == (mean, n, late), patient
    assert summary["J"]["residence_town"] == "TORINO"  # J: latest variant
    assert summary["G"]["first_at"] == datetime(2022, 1, 1, 23) and summary["G"]["last_at"] == datetime(2022, 1, 3, 1)
    assert "M" not in summary  # M: outside the dimension
    other = _by_patient(sm.delivery_summary(disp, scan).collect(), prod=OTHER)
    assert (other["A"]["mean_days"], other["A"]["deliveries"]) == (5, 2)


@pytest.mark.parametrize("carry", [(), DEMOGRAPHIC_COLUMNS])
@pytest.mark.parametrize("path", list(PATHS))
def test_adherence(frames, path, carry):
    disp, ther, products = frames
    scan = iv.scan_deliveries(disp, carry=carry, **PATHS[path](disp))
    result = adh.adherence(sm.delivery_summary(disp, scan), ther, products)
    rows = _by_patient(result.collect())
    for patient, (*_, num, den, pct) in EXPECTED.items():
        if num is None:
            assert patient not in rows, patient  # G, H: no therapy rows, no adherence row
            continue
        row = rows[patient]
        assert (row["therapy_days_total"], row["denominator_days"], row["adherence_pct"]) == (num, den, pct), patient
    assert rows["A"]["prod_desc"] == "AIMOVIG*1PEN 70MG 1ML" and rows["A"]["aic"] == "046925018"
    assert list(result.columns[:16]) == list(adh.ADHERENCE_COLUMNS)


def test_last_therapy_tie_takes_greatest(frames):
    _, ther, _ = frames
    rows = {(r["prod"], r["patient_id"]): r for r in adh.last_therapy_days(ther).collect()}
    assert rows[(PROD, "J")]["last_therapy_days"] == 56.0  # K
    assert rows[(PROD, "E")]["last_therapy_days"] == 30.0


def test_empty_product_keeps_schema(spark, frames):
    disp, ther, products = frames
    none = disp.where(F.col("prod") == F.lit(-1))
    scan = iv.scan_deliveries(none)
    result = adh.adherence(sm.delivery_summary(none, scan), ther, products)  # L
    assert result.count() == 0
    assert list(result.columns[:16]) == list(adh.ADHERENCE_COLUMNS)
    assert iv.delivery_intervals(none).count() == 0


def test_union_of_per_product_results_equals_joint_result(frames):
    """Computing each product on its own and unioning gives the consolidated result."""
    disp, ther, products = frames

    def adherence_of(deliveries):
        scan = iv.scan_deliveries(deliveries)
        return adh.adherence(sm.delivery_summary(deliveries, scan), ther, products)

    joint = sorted(tuple(r) for r in adherence_of(disp).collect())
    parts = [adherence_of(disp.where(F.col("prod") == F.lit(p))) for p in (PROD, OTHER)]
    unioned = sorted(tuple(r) for r in adh.union_products(parts).collect())
    assert unioned == joint and len(joint) > 0
