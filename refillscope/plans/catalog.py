"""Named queries over the test tables: each takes ``(spark, sf_dir)`` and returns a DataFrame.

These are the operators of the build plan run end to end on the TPC-H-like tables
(``refillscope.sources.testtables`` holds the mapping). Every query reads the whole
tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.operators import adherence as adh
from refillscope.operators import asof
from refillscope.operators import coverage as cov
from refillscope.operators import cube
from refillscope.operators import intervals as iv
from refillscope.operators import ranking, reconcile
from refillscope.operators import summary as sm
from refillscope.schema import DEMOGRAPHIC_COLUMNS
from refillscope.operators.ordered_scan import DEFAULT_ROWS_PER_RUN, find_hot_keys
from refillscope.sources import sinks
from refillscope.sources.extracts import type_dispensing, type_therapy
from refillscope.sources.testtables import (
    TEST_PRODUCT_TYPES,
    dispensing_as_text,
    dispensing_from_tables,
    dispensing_redelivered,
    events_as_deliveries,
    table,
    tables_product_dimension,
    therapy_as_text,
    therapy_from_tables,
    with_arrival,
    written_lines,
)
from refillscope.shared import shared_path
from refillscope.streaming import sessions

KEYS = ["prod", "patient_id"]

# Options of the ordered scan (``rows_per_run``, ``chunk_rows``). Empty means the
# library defaults; tests shrink them to force the hot-key path on small tables.
SCAN_OPTIONS: dict = {}


def scan_options(spark: SparkSession, sf_dir: str, deliveries: DataFrame, rows_of: str = "lineitem", times: int = 1) -> dict:
    """Options of a scan of ``deliveries``, with the hot keys of its input.

    No key has more rows than the table (or ``times`` it) that the deliveries are lines of. Its row count comes
    from the Parquet footers; only beyond ``rows_per_run`` are the keys themselves counted.
    """
    most = times * table(spark, sf_dir, rows_of).count()
    rows_per_run = SCAN_OPTIONS.get("rows_per_run", DEFAULT_ROWS_PER_RUN)
    return {**SCAN_OPTIONS, "hot": find_hot_keys(deliveries, KEYS, rows_per_run, most)}


def dispensing_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S3: the dispensing extract in typed canonical columns."""
    return dispensing_from_tables(spark, sf_dir)


def product_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + S4: deliveries of the four configured products only."""
    return adh.filter_products(dispensing_from_tables(spark, sf_dir), TEST_PRODUCT_TYPES)


def delivery_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + W1 + E1: one interval record per delivery."""
    deliveries = product_filter(spark, sf_dir)
    return iv.delivery_intervals(deliveries, KEYS, **scan_options(spark, sf_dir, deliveries))


def normalised_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval records with the gap normalised by the quantity."""
    return iv.normalised_days(delivery_intervals(spark, sf_dir))


def _scan(spark: SparkSession, sf_dir: str):
    deliveries = product_filter(spark, sf_dir)
    return deliveries, iv.scan_deliveries(deliveries, KEYS, **scan_options(spark, sf_dir, deliveries))


def average_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + E3: mean normalised gap per key, half-even, as an integer."""
    _, scan = _scan(spark, sf_dir)
    return sm.gap_statistics(scan, KEYS).select(*KEYS, "mean_days")


def late_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + A4a: late pickups per key."""
    _, scan = _scan(spark, sf_dir)
    return sm.late_pickups(scan, KEYS)


def delivery_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries per key."""
    return sm.delivery_count(product_filter(spark, sf_dir), KEYS)


def delivery_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + J4 + E5: mean days, deliveries and late pickups per key."""
    _, scan = _scan(spark, sf_dir)
    return sm.delivery_measures(scan, KEYS).select(*KEYS, "mean_days", "deliveries", "late")


def first_last_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2 + J1: first and last delivery per key."""
    return sm.first_last_delivery(product_filter(spark, sf_dir), KEYS)


def patient_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A0 + P1: distinct demographic variants per key."""
    return sm.patient_demographics(product_filter(spark, sf_dir), KEYS)


def demographics_one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the demographic variant of the latest delivery per key."""
    return sm.demographics_one_row(product_filter(spark, sf_dir), KEYS)


def delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + J5 + J6 + A5: the 11-column delivery summary per key (demographics carried by the scan)."""
    deliveries = product_filter(spark, sf_dir)
    scan = iv.scan_deliveries(deliveries, KEYS, carry=DEMOGRAPHIC_COLUMNS, **scan_options(spark, sf_dir, deliveries))
    return sm.delivery_summary(deliveries, scan, KEYS)


def therapy_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + F2: the therapy extract of the four products."""
    return adh.filter_products(therapy_from_tables(spark, sf_dir), TEST_PRODUCT_TYPES)


def therapy_days_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Therapy days per key."""
    return adh.therapy_days_total(therapy_typed(spark, sf_dir), KEYS)


def last_therapy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Therapy days of the latest therapy row per key."""
    return adh.last_therapy_days(therapy_typed(spark, sf_dir), KEYS).select(*KEYS, "last_therapy_days")


def adherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 + E2 + E4 + F4 + P7: adherence per key, with the product's slug and code."""
    summary = delivery_summary(spark, sf_dir)
    return adh.adherence(summary, therapy_typed(spark, sf_dir), tables_product_dimension(spark), KEYS)


def adherence_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + X4 content: every product's adherence rows in one frame (the 16 record columns)."""
    return adherence(spark, sf_dir).select(*adh.ADHERENCE_COLUMNS)


def _summary_with_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = tables_product_dimension(spark).select("prod", "slug", "aic")
    return adh.attach_products(delivery_summary(spark, sf_dir), products)


def delivery_summary_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + X2 content: the summary with export headers and dd/MM/yyyy dates, per product."""
    return sinks.summary_presentation(_summary_with_slug(spark, sf_dir))


def adherence_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + X3 content: adherence with export headers and the 0000 sentinel, per product."""
    return sinks.adherence_presentation(adherence(spark, sf_dir))


def dispensing_text_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S3: the valid rows of a dispensing extract of text columns, typed by the ingest layer."""
    return type_dispensing(dispensing_as_text(written_lines(spark, sf_dir))).valid


def therapy_text_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: the valid rows of a therapy extract of text columns with decimal commas."""
    return type_therapy(therapy_as_text(written_lines(spark, sf_dir)), decimal_comma=True).valid


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows of both text extracts, with reason and original text."""
    columns = ["raw_patient_id", "raw_prod", "raw_dispensed_at"]
    lines = written_lines(spark, sf_dir)
    disp = type_dispensing(dispensing_as_text(lines)).rejects
    ther = type_therapy(therapy_as_text(lines), decimal_comma=True).rejects
    reason = F.col("_reject_reason").alias("reason")
    return disp.select(F.lit("dispensing").alias("extract"), reason, *columns, F.col("raw_qty").alias("raw_number")).unionByName(
        ther.select(F.lit("therapy").alias("extract"), reason, *columns, F.col("raw_therapy_days").alias("raw_number"))
    )


def event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + E1 on sub-day timestamps: intervals of ``events`` per (event type, user)."""
    events = events_as_deliveries(spark, sf_dir)
    return iv.delivery_intervals(events, KEYS, **scan_options(spark, sf_dir, events, "events"))


def _supply_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    therapy = therapy_typed(spark, sf_dir)
    options = scan_options(spark, sf_dir, therapy)
    options.pop("chunk_rows", None)
    return cov.supply_timeline(therapy, KEYS, **options)


def days_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval union: days covered by overlapping supplies per key, and the gaps between them."""
    return cov.days_covered(_supply_timeline(spark, sf_dir), KEYS)


def supply_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval union: the stretches of covered days of each key."""
    return cov.supply_stretches(_supply_timeline(spark, sf_dir), KEYS)


def _in_force(spark: SparkSession, sf_dir: str, inclusive: bool) -> DataFrame:
    tagged = asof.tagged_rows(product_filter(spark, sf_dir), therapy_typed(spark, sf_dir), KEYS, inclusive=inclusive)
    return asof.therapy_in_force(tagged, KEYS, **scan_options(spark, sf_dir, tagged, times=2))


def therapy_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join: every delivery with the latest therapy row up to its time."""
    return _in_force(spark, sf_dir, inclusive=True)


def therapy_before_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join: every delivery with the latest therapy row of an earlier time, and the days its supply fell short."""
    return _in_force(spark, sf_dir, inclusive=False)


def trailing_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range frame: therapy days of the 90 days up to each delivery day, per key."""
    return ranking.trailing_supply(therapy_typed(spark, sf_dir), KEYS)


def coverage_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-tiles: each product's patients in quartiles by their share of days covered."""
    covered = days_covered(spark, sf_dir).select(*KEYS, "covered_pct")
    return ranking.n_tiles(covered, ["prod"], ["covered_pct", "patient_id"], 4, "quartile")


def top_late_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k: the ten patients of each product with the most late pickups."""
    order = [F.desc("late"), F.desc("mean_days"), F.asc("patient_id")]
    return ranking.top_rows(delivery_measures(spark, sf_dir), ["prod"], order, 10)


def adherence_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube: late pickups and adherence by product, health unit and sex, with all totals."""
    return cube.adherence_cube(adherence(spark, sf_dir))


LINE_COLUMNS = ["patient_id", "prod", "dispensed_at", "qty", "health_unit"]


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The text extract as ingested, and its second version."""
    lines = written_lines(spark, sf_dir)
    return type_dispensing(dispensing_as_text(lines)).valid.select(*LINE_COLUMNS), dispensing_redelivered(lines)


def extract_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag difference: lines that two versions of the extract hold in different numbers."""
    return reconcile.line_changes(*_versions(spark, sf_dir), LINE_COLUMNS)


def extract_change_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added, removed and changed lines of two versions by patient, product and day."""
    return reconcile.line_report(extract_changes(spark, sf_dir), LINE_COLUMNS[:3])


def extract_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients and products that both versions hold, or only one."""
    return reconcile.key_presence(*_versions(spark, sf_dir), ["prod", "patient_id"])


def _replayed(spark: SparkSession, sf_dir: str) -> str:
    """The deliveries of the four products, arrived in three batches; the folder of the streaming run."""
    work_dir = shared_path(spark, "sessions")
    sessions.replay(with_arrival(product_filter(spark, sf_dir)), "arrival", 3, work_dir, KEYS)
    return work_dir


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming sessions: supply sessions that the watermark has closed, each a refill that was due and not picked up."""
    schema = sessions.session_schema(KEYS, product_filter(spark, sf_dir))
    return sessions.closed_sessions(spark, _replayed(spark, sf_dir), schema)


def streamed_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming sessions: rows of each arrival by why they were rejected (late ones among them) or admitted."""
    found = sessions.ledger(spark, _replayed(spark, sf_dir))
    return found.select(F.col("batch").alias("arrival"), F.coalesce("reason", F.lit("admitted")).alias("outcome"), "rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dispensing_typed": dispensing_typed,
    "product_filter": product_filter,
    "delivery_intervals": delivery_intervals,
    "normalised_days": normalised_days,
    "average_days": average_days,
    "late_deliveries": late_deliveries,
    "delivery_count": delivery_count,
    "delivery_measures": delivery_measures,
    "first_last_delivery": first_last_delivery,
    "patient_demographics": patient_demographics,
    "demographics_one_row": demographics_one_row,
    "delivery_summary": delivery_summary,
    "therapy_typed": therapy_typed,
    "therapy_days_total": therapy_days_total,
    "last_therapy_days": last_therapy_days,
    "adherence": adherence,
    "adherence_consolidated": adherence_consolidated,
    "delivery_summary_export": delivery_summary_export,
    "adherence_export": adherence_export,
    "event_intervals": event_intervals,
    "dispensing_text_typed": dispensing_text_typed,
    "therapy_text_typed": therapy_text_typed,
    "ingest_rejects": ingest_rejects,
    "days_covered": days_covered,
    "supply_stretches": supply_stretches,
    "therapy_in_force": therapy_in_force,
    "therapy_before_delivery": therapy_before_delivery,
    "trailing_supply": trailing_supply,
    "coverage_quartiles": coverage_quartiles,
    "top_late_patients": top_late_patients,
    "adherence_cube": adherence_cube,
    "extract_changes": extract_changes,
    "extract_change_report": extract_change_report,
    "extract_patients": extract_patients,
    "streamed_sessions": streamed_sessions,
    "streamed_admission": streamed_admission,
}
