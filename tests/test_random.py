"""Randomised deliveries against a plain-Python restatement of the definitions.

Hypothesis draws small delivery sets with same-day ties, sub-day times, exact
copies, zero and missing quantities, and conflicting demographic variants; Spark
must match the brute-force results on both execution paths (ordinary keys, and
every key hot with tiny runs and chunks).
"""

import math
from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from scan_helpers import hot_options
from refillscope.schema import DEMOGRAPHIC_COLUMNS, DISPENSING_SCHEMA

START = datetime(2022, 1, 1)

delivery = st.tuples(
    st.sampled_from([1480022, 1470395]),
    st.sampled_from(["A", "B", "C"]),
    st.integers(min_value=0, max_value=60 * 24 * 90).map(lambda m: START + timedelta(minutes=m)),
    st.sampled_from([None, 0.0, 1.0, 2.0, 3.0, 0.5]),
    st.sampled_from([None, "F", "M"]),
    st.sampled_from([None, "BARI", "ROMA"]),
)
deliveries = st.lists(delivery, min_size=1, max_size=30).flatmap(
    # repeat some rows to create exact copies
    lambda rows: st.lists(st.sampled_from(rows), min_size=0, max_size=10).map(lambda extra: rows + extra)
)


def _nulls_first(value):
    return (0,) if value is None else (1, value)


def _latest_demographics(rows):
    """Per key: (sex, residence_town) of the latest delivery; ties to the greatest, NULL smallest."""
    best = {}
    for prod, patient, ts, _, sex, town in rows:
        rank = (ts, _nulls_first(sex), _nulls_first(town))
        if (prod, patient) not in best or rank > best[(prod, patient)][0]:
            best[(prod, patient)] = (rank, (sex, town))
    return {k: v[1] for k, v in best.items()}


def _brute(rows):
    by_key = defaultdict(list)
    for prod, patient, ts, qty, *_ in rows:
        by_key[(prod, patient)].append((ts, qty))
    intervals, measures = [], {}
    for key, items in by_key.items():
        items.sort(key=lambda r: (r[0], r[1] is not None, r[1] if r[1] is not None else 0.0))
        gaps = []
        for i, (ts, qty) in enumerate(items):
            if i == 0:
                base, nxt, q, gap = ts, None, qty, 0
            else:
                base, nxt, q = items[i - 1][0], ts, items[i - 1][1]
                gap = math.floor((ts - base).total_seconds() / 86400)
            intervals.append((*key, base, nxt, q, gap, i + 1))
            gaps.append(None if q in (None, 0.0) else gap / q)
        usable = [g for g in gaps if g is not None]
        mean = None if not usable else int(round(round(sum(usable) / len(usable), 9)))
        late = sum(1 for g in usable if mean is not None and g > mean + 3)
        measures[key] = (items[0][0], items[-1][0], mean, len(items), late)
    return sorted(intervals, key=repr), measures


def _frame(spark, rows):
    full = [(patient, prod, ts, qty, sex, None, None, town, None) for prod, patient, ts, qty, sex, town in rows]
    return spark.createDataFrame(full, DISPENSING_SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=deliveries)
def test_random_deliveries_match_brute_force(spark, rows):
    want_intervals, want_measures = _brute(rows)
    df = _frame(spark, rows)
    for options in ({}, hot_options(df, 1, 1)):
        got = iv.delivery_intervals(df, **options).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want_intervals, options
        scan = iv.scan_deliveries(df, **options)
        measures = {
            (r["prod"], r["patient_id"]): (r["first_at"], r["last_at"], r["mean_days"], r["deliveries"], r["late"])
            for r in sm.delivery_measures(scan).collect()
        }
        assert measures == want_measures, options
        carried = iv.scan_deliveries(df, carry=DEMOGRAPHIC_COLUMNS, **options)
        summary = sm.delivery_summary(df, carried).collect()
        people = {(r["prod"], r["patient_id"]): (r["sex"], r["residence_town"]) for r in summary}
        assert people == _latest_demographics(rows), options
