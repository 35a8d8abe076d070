"""Days covered and the as-of join against brute force: hot keys, copies, ties, unusable rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from refillscope.operators import asof
from refillscope.operators import coverage as cov
from refillscope.operators.ordered_scan import find_hot_keys

KEYS = ["prod", "patient_id"]
DAY0 = dt.datetime(2022, 1, 1, 9, 30)


def frame(spark, rows, value):
    return spark.createDataFrame(rows, f"prod string, patient_id string, dispensed_at timestamp_ntz, {value} double")


def therapy_rows(seed, count, hot=0.34, copies=0):
    """Therapy rows of which one key holds a third, with overlaps, gaps and many equal rows."""
    rng, rows = random.Random(seed), []
    for _ in range(count):
        key = ("A", "hot") if rng.random() < hot else (rng.choice("AB"), f"p{rng.randrange(25)}")
        at = DAY0 + dt.timedelta(days=rng.randrange(900), hours=rng.choice([0, 0, 7]))
        rows.append((*key, at, rng.choice([0.0, -1.0, None, float("nan"), 1.0, 2.0, 5.0, 14.0, 28.0])))
    return rows + [("B", "copies", DAY0, 7.0)] * copies


def covered_by_day(rows):
    """Covered days and supplies by key, one set element per day."""
    days, supplied = defaultdict(set), defaultdict(list)
    for prod, patient, at, n in rows:
        if at is not None and n is not None and n > 0:
            first = at.date().toordinal()
            days[prod, patient] |= set(range(first, first + int(n)))
            supplied[prod, patient].append((first, n))
    return days, supplied


def brute_stretches(rows):
    days, supplied = covered_by_day(rows)
    out = []
    for key, own in days.items():
        last = None
        for day in sorted(own):
            if last is None or day > last + 1:
                out.append([*key, day, 0, day - last - 1 if last is not None else 0])
            out[-1][3] += 1
            last = day
    found = []
    for prod, patient, first, length, gap in out:
        inside = [n for d, n in supplied[prod, patient] if first <= d < first + length]
        found.append((prod, patient, dt.date.fromordinal(first), float(length), sum(inside), len(inside), float(gap)))
    return sorted(found, key=repr)


def options(df, rows_per_run):
    return {"hot": find_hot_keys(df, KEYS, rows_per_run), "rows_per_run": rows_per_run}


@pytest.mark.parametrize("rows_per_run", [None, 40, 7])
def test_stretches_and_totals_against_a_set_of_days(spark, rows_per_run):
    rows = therapy_rows(1, 1200, copies=300)
    therapy = frame(spark, rows, "therapy_days")
    own = options(therapy, rows_per_run) if rows_per_run else {}
    assert rows_per_run is None or own["hot"].count >= 2
    timeline = cov.supply_timeline(therapy, KEYS, **own)
    want = brute_stretches(rows)
    assert sorted((tuple(r) for r in cov.supply_stretches(timeline, KEYS).collect()), key=repr) == want
    totals = {(r["prod"], r["patient_id"]): r for r in cov.days_covered(timeline, KEYS).collect()}
    days, supplied = covered_by_day(rows)
    assert set(totals) == set(days)
    for key, r in totals.items():
        gaps = [x[6] for x in want if (x[0], x[1]) == key and x[6]]
        assert (r["covered_days"], r["supplied_days"]) == (len(days[key]), sum(n for _, n in supplied[key]))
        assert (r["gaps"], r["gap_days"], r["longest_gap"]) == (len(gaps), sum(gaps), max(gaps, default=0))
        assert r["first_day"].toordinal() == min(days[key]) and r["span_days"] == max(days[key]) + 1 - min(days[key])
        assert r["overlap_days"] == r["supplied_days"] - r["covered_days"]
        assert r["covered_pct"] == pytest.approx(100 * r["covered_days"] / r["span_days"], abs=0.006)


def test_a_long_supply_reaches_over_many_runs(spark):
    """The first supply covers all later ones, which lie in other runs of the key."""
    rows = [("A", "x", DAY0, 400.0)] + [("A", "x", DAY0 + dt.timedelta(days=k), 1.0) for k in range(1, 300)]
    rows += [("A", "x", DAY0 + dt.timedelta(days=500), 3.0)]
    therapy = frame(spark, rows, "therapy_days")
    timeline = cov.supply_timeline(therapy, KEYS, **options(therapy, 10))
    assert sorted((tuple(r) for r in cov.supply_stretches(timeline, KEYS).collect()), key=repr) == brute_stretches(rows)


def test_fractions_and_empty_supply(spark):
    rows = [("A", "x", DAY0, 1.5), ("A", "x", DAY0 + dt.timedelta(days=1), 1.0), ("A", "x", DAY0 + dt.timedelta(days=2), 0.5), ("A", None, DAY0, 2.0), ("A", "y", None, 2.0)]
    found = {r["patient_id"]: r for r in cov.days_covered(cov.supply_timeline(frame(spark, rows, "therapy_days"), KEYS), KEYS).collect()}
    assert set(found) == {"x", None} and (found["x"]["covered_days"], found["x"]["gaps"], found["x"]["overlap_days"]) == (2.5, 0, 0.5)
    empty = frame(spark, [("A", "x", DAY0, 0.0)], "therapy_days")
    assert cov.days_covered(cov.supply_timeline(empty, KEYS), KEYS).collect() == []


def brute_asof(deliveries, therapy, inclusive):
    by_key = defaultdict(list)
    for prod, patient, at, n in therapy:
        if at is not None:
            by_key[prod, patient].append((at, n))

    def rank(row):
        n = row[1]
        return (row[0], n is not None, (n != n, 0 if n != n else n) if n is not None else ())

    out = []
    for prod, patient, at, qty in deliveries:
        if at is None:
            continue
        known = [r for r in by_key[prod, patient] if r[0] < at or inclusive and r[0] == at]
        t, n = max(known, key=rank) if known else (None, None)
        since = (at - t).days if t else None
        short = max(0.0, since - n) if n is not None and n == n else None
        out.append((prod, patient, at, qty, t, n, since, short))
    return sorted(map(repr, out))


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("rows_per_run", [None, 50, 9])
def test_asof_join_against_brute_force(spark, inclusive, rows_per_run):
    rng = random.Random(3)
    therapy = [(p, i, at, n) for p, i, at, n in therapy_rows(2, 500)]
    deliveries = [(p, i, at, float(rng.randrange(1, 4))) for p, i, at, _ in therapy_rows(4, 700)]
    # The same times in both, repeated deliveries, keys of one input alone, rows without a time, a null key.
    deliveries += [(p, i, at, 2.0) for p, i, at, _ in therapy[:80]] + [("A", "hot", DAY0, 1.0)] * 60 + [("B", "only", DAY0, None)]
    deliveries += [("A", "hot", None, 1.0), (None, "n", DAY0 + dt.timedelta(days=9), 1.0)]
    therapy += [("B", "unused", DAY0, 3.0), ("A", "hot", None, 3.0), (None, "n", DAY0, 5.0)]
    tagged = asof.tagged_rows(frame(spark, deliveries, "qty"), frame(spark, therapy, "therapy_days"), KEYS, inclusive=inclusive)
    own = {**options(tagged, rows_per_run), "chunk_rows": 16} if rows_per_run else {}
    found = asof.therapy_in_force(tagged, KEYS, **own)
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute_asof(deliveries, therapy, inclusive)


def test_plans(spark):
    """One shuffle of rows each, no join of intervals, and runs rather than whole keys where one is hot."""
    import re

    from refillscope.plans import catalog
    from tables import SF_SMALL

    for name in ("days_covered", "therapy_in_force", "therapy_before_delivery"):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(prod", plan)) == 1, plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    therapy = catalog.therapy_typed(spark, SF_SMALL)
    plan = cov.supply_timeline(therapy, KEYS, **options(therapy, 5))._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan)
    assert specs and all("_run" in s for s in specs)
