"""Range frames, n-tiles, top rows, the cube and bag differences on small hand-made and skewed frames."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from refillscope.operators import ranking, reconcile
from refillscope.operators.cube import adherence_cube
from refillscope.plans import catalog
from tables import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trailing_supply(spark):
    rows = [("A", "x", 1, 5.0), ("A", "x", 1, None), ("A", "x", 3, 2.0), ("A", "x", 4, float("nan")), ("A", "x", 90, 1.0), ("A", "x", 91, 1.0), ("A", None, 2, 1.0)]
    data = [(p, i, dt.datetime(2022, 1, 1, 23) + dt.timedelta(days=d - 1), n) for p, i, d, n in rows] + [("A", "x", None, 9.0)]
    df = spark.createDataFrame(data, "prod string, patient_id string, dispensed_at timestamp_ntz, therapy_days double")
    found = {(r["patient_id"], (r["day"] - dt.date(2021, 12, 31)).days): tuple(r)[3:] for r in ranking.trailing_supply(df).collect()}
    assert found == {("x", 1): (2, 5.0, 2, 5.0), ("x", 3): (1, 2.0, 3, 7.0), ("x", 4): (1, 0.0, 4, 7.0), ("x", 90): (1, 1.0, 5, 8.0), ("x", 91): (1, 1.0, 4, 4.0), (None, 2): (1, 1.0, 1, 1.0)}


@pytest.mark.parametrize("tiles", [1, 4, 7])
def test_n_tiles_of_a_product_with_most_rows(spark, tiles):
    rng = random.Random(tiles)
    rows = [("big" if k % 3 else rng.choice("abc"), rng.choice([None, 0.0, 50.0, 100.0, 100.0, 100.0, rng.random()]), k) for k in range(3_000)] + [("one", 1.0, -1)]
    df = spark.createDataFrame(rows, "prod string, pct double, id long")
    want = []
    for prod in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == prod], key=lambda r: (r[1] is not None, r[1] or 0.0, r[2]))
        size, extra = divmod(len(own), tiles)
        sizes = [size + (t < extra) for t in range(tiles)]
        tile = [t for t, n in enumerate(sizes, 1) for _ in range(n)]
        want += [(*r, k, len(own), t) for k, (r, t) in enumerate(zip(own, tile, strict=True), 1)]
    found = ranking.n_tiles(df, ["prod"], ["pct", "id"], tiles)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert ranking.n_tiles(df.limit(0), ["prod"], ["pct", "id"], tiles).collect() == []


def test_a_large_group_is_ranked_by_many_tasks(spark):
    df = spark.range(4_000).select(F.lit("big").alias("prod"), (F.col("id") % 3).alias("v"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = ranking.exact_ranks(df, ["prod"], ["v", "id"])
        assert "windowspecdefinition(prod" in _plan(dealt) and "_range" in _plan(dealt)
        assert dealt.where("rank <> v * 1333 + least(v, 1) + id div 3 + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_top_rows_are_limited_before_the_shuffle(spark):
    found = catalog.top_late_patients(spark, SF_SMALL)
    plan = _plan(found)
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert final < plan.index("Exchange hashpartitioning(prod#", final) < partial and "Partial" in plan[partial:]
    measures = [tuple(r) for r in catalog.delivery_measures(spark, SF_SMALL).select("prod", "patient_id", "late", "mean_days").collect()]
    for prod in {m[0] for m in measures}:
        own = sorted([m for m in measures if m[0] == prod], key=lambda m: (-m[2], -m[3], m[1]))[:10]
        got = sorted((r["place"], r["patient_id"]) for r in found.collect() if r["prod"] == prod)
        assert got == [(k, m[1]) for k, m in enumerate(own, 1)]


def test_cube_tells_null_members_from_totals(spark):
    rows = [("A", "u", "F", "1", 4, 1, 50.0, 100.0), ("A", None, "F", "2", 6, 2, 0.0, 0.0), ("A", None, None, "3", 10, 0, 30.0, 60.0)]
    schema = "prod string, health_unit string, sex string, patient_id string, deliveries long, late long, therapy_days_total double, denominator_days double"
    records = spark.createDataFrame(rows, schema)
    found = {(r["prod"], r["health_unit"], r["sex"], r["level"]): tuple(r)[4:] for r in adherence_cube(records).collect()}
    assert found[None, None, None, 7] == (3, 20, 3, 15.0, 50.0)
    assert found["A", None, None, 3] == (3, 20, 3, 15.0, 50.0)  # the product's total
    assert found["A", None, None, 1] == (2, 16, 2, 12.5, 50.0)  # patients without a unit
    assert found["A", None, None, 2] == (1, 10, 0, 0.0, 50.0)  # patients without a sex
    assert found["A", None, None, 0] == (1, 10, 0, 0.0, 50.0) and found["A", None, "F", 0] == (1, 6, 2, 33.33, None)
    assert adherence_cube(records.limit(0)).collect() == []
    plan = _plan(adherence_cube(records))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange") < plan.index("partial_") < plan.index("Expand")


def test_bag_differences(spark):
    schema = "patient string, day int, qty double"
    old = [("a", 1, 1.0)] * 3 + [("a", 1, 2.0), ("b", 1, None), ("b", 1, None), ("c", 1, 5.0), (None, 1, 1.0)]
    new = [("a", 1, 1.0), ("a", 1, 9.0), ("b", 1, None), ("d", 1, 5.0), (None, 1, 1.0)] + [("e", 2, 1.0)] * 2_000
    frames = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    changes = reconcile.line_changes(*frames, ["patient", "day", "qty"])
    gone, come = Counter(old) - Counter(new), Counter(new) - Counter(old)
    want = [(*k, "removed", n) for k, n in gone.items()] + [(*k, "added", n) for k, n in come.items()]
    assert sorted(map(repr, map(tuple, changes.collect()))) == sorted(map(repr, want))
    report = {r["patient"]: tuple(r)[2:] for r in reconcile.line_report(changes, ["patient", "day"]).collect()}
    assert report == {"a": (0, 2, 1), "b": (0, 1, 0), "c": (0, 1, 0), "d": (1, 0, 0), "e": (2_000, 0, 0)}
    presence = {r["patient"]: (r["old_lines"], r["new_lines"], r["presence"]) for r in reconcile.key_presence(*frames, ["patient"]).collect()}
    assert presence == {"a": (4, 2, "both"), "b": (2, 1, "both"), "c": (1, 0, "only_old"), "d": (0, 1, "only_new"), "e": (0, 2_000, "only_new"), None: (1, 1, "both")}
    plan = _plan(reconcile.line_changes(*frames, ["patient", "day", "qty"]))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "partial_sum" in plan
    assert reconcile.line_changes(frames[0], frames[0], ["patient", "day", "qty"]).collect() == []
