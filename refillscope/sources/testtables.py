"""The dispensing model mapped onto the TPC-H-like test tables.

``lineitem JOIN orders JOIN part JOIN customer JOIN nation`` plays the dispensing
extract: a part type is the product, a customer the patient, the order date the
delivery date and the line quantity the quantity handed out. The same lines form the therapy
extract, with ``quantity - 1`` therapy days. Birth dates follow from the customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.shared import materialise

# The part types kept as the four "products" on the test tables.
TEST_PRODUCT_TYPES = ("ECONOMY", "PROMO", "SMALL", "LARGE")
# Customers are born from this day on, in steps that spread over the days.
FIRST_BIRTH, BIRTH_STEP, BIRTH_DAYS = "1930-01-01", 37, 25_000

# Read schemas of the columns used, as the tables store them. Declaring them skips
# Spark's schema-inference job per read and prunes the scan to these columns.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_brand STRING, p_type STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables_product_dimension(spark: SparkSession) -> DataFrame:
    """``(prod, prod_desc, slug, aic)`` for the test tables: the part type in every role."""
    rows = [(t, t, t.lower(), t) for t in TEST_PRODUCT_TYPES]
    return spark.createDataFrame(rows, "prod string, prod_desc string, slug string, aic string")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )


def dispensing_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dispensing extract in canonical columns (all part types, no product filter)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation has 25 rows by the benchmark's definition, so broadcasting it is bounded.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (
        _lines(spark, sf_dir)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("p_type").alias("prod"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("dispensed_at"),
        F.col("l_quantity").cast("double").alias("qty"),
        F.col("c_mktsegment").alias("sex"),
        F.date_add(
            F.lit(FIRST_BIRTH).cast("date"), ((F.col("c_custkey") * BIRTH_STEP) % BIRTH_DAYS).cast("int")
        ).cast("string").alias("birth_date"),
        F.col("c_name").alias("birth_town"),
        F.col("n_name").alias("residence_town"),
        F.col("p_brand").alias("health_unit"),
    )


def therapy_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The therapy extract in canonical columns (all part types, no product filter)."""
    return _lines(spark, sf_dir).select(
        F.col("p_type").alias("prod"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("dispensed_at"),
        (F.col("l_quantity") - F.lit(1.0)).alias("therapy_days"),
    )


# Rows of a file of the written lines. Spark deals whole files to a task until their bytes, with some for opening each,
# reach its limit, so short files bound the rows of a task.
LINES_PER_FILE = 100_000


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with the columns of the text extracts, written once for all that read them.

    Tables are joined once however many extracts or versions are made of the lines. Rendering and typing cost far more
    than a joined row's bytes suggest, by which Spark deals the rows of a join to few tasks; files are short.
    """
    columns = ("l_orderkey", "l_partkey", "l_quantity", "o_custkey", "o_orderdate", "p_brand")
    return materialise(_lines(spark, sf_dir).select(*columns), "lines", maxRecordsPerFile=LINES_PER_FILE)


# Orders whose key these divide have an unusable patient, product, date or number.
BAD_PATIENT, BAD_PROD, BAD_DATE, BAD_NUMBER = 89, 79, 97, 83


def _bad(divisor: int):
    return F.col("l_orderkey") % divisor == 0


def _text_keys():
    """Patient, product (a part) and day-first date as text; odd orders have no leading zeros."""
    day, month, year = (part("o_orderdate").cast("string") for part in (F.dayofmonth, F.month, F.year))
    padded = F.concat_ws("/", F.lpad(day, 2, "0"), F.lpad(month, 2, "0"), year)
    date = F.when(F.col("l_orderkey") % 2 == 0, padded).otherwise(F.concat_ws("-", day, month, year))
    return [
        F.when(_bad(BAD_PATIENT), F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(_bad(BAD_PROD), F.lit("n/a")).otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("prod"),
        F.when(_bad(BAD_DATE), F.lit("31/02/2022")).otherwise(date).alias("dispensed_at"),
    ]


def dispensing_as_text(lines: DataFrame) -> DataFrame:
    """``written_lines`` as a dispensing extract of text columns, before typing; some rows are unusable."""
    number = F.when(_bad(BAD_NUMBER), F.lit("1x")).otherwise(F.col("l_quantity").cast("string"))
    return lines.select(*_text_keys(), number.alias("qty"), F.col("p_brand").alias("health_unit"))


def therapy_as_text(lines: DataFrame) -> DataFrame:
    """``written_lines`` as a therapy extract of text columns, numbers with a decimal comma."""
    number = F.regexp_replace((F.col("l_quantity") / 2).cast("string"), "[.]", ",")
    number = F.when(_bad(BAD_NUMBER), F.lit("1,5,5")).otherwise(number)
    return lines.select(*_text_keys(), number.alias("therapy_days"))


# What the second version of the text extract withdraws and corrects.
WITHDRAWN, MOST_QUANTITY = 71, 45


def dispensing_redelivered(lines: DataFrame) -> DataFrame:
    """A second version of the text extract, typed: no row is unusable, some orders are withdrawn, large quantities corrected."""
    return lines.where(~_bad(WITHDRAWN)).select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("l_partkey").alias("prod"),
        F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("dispensed_at"),
        F.least(F.col("l_quantity"), F.lit(float(MOST_QUANTITY))).alias("qty"),
        F.col("p_brand").alias("health_unit"),
    )


# The first days of the second and third arrival; patients whose number this divides report with the last.
ARRIVALS, REPORTS_LATE = ("1997-01-01", "1999-01-01"), 97


def with_arrival(deliveries: DataFrame) -> DataFrame:
    """Deliveries with the number of the arrival (0 to 2) that brings them; some patients' all come with the last."""
    second, third = (F.lit(d).cast("timestamp_ntz") for d in ARRIVALS)
    by_day = F.when(F.col("dispensed_at") < second, 0).when(F.col("dispensed_at") < third, 1).otherwise(2)
    return deliveries.withColumn("arrival", F.when(F.col("patient_id") % REPORTS_LATE == 0, 2).otherwise(by_day))


def events_as_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the canonical delivery columns: sub-day timestamps for E1."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("prod"),
        F.col("user_id").alias("patient_id"),
        F.col("ts").cast("timestamp_ntz").alias("dispensed_at"),
        F.col("value").cast("double").alias("qty"),
    )
