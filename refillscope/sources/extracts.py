"""Typed readers for the dispensing and therapy extracts (S1-S3), with a reject split.

Extracts arrive as CSV (or Parquet) with the source headers. They are read as text by
column name (no type inference; order and further columns do not matter), renamed, typed,
and split into valid rows and rejects. A reject keeps its original text and a reason; it never reaches the
measures (the reference would abort or mis-sort on such rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import zip_longest
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refillscope.functions.temporal import day_first_steps
from refillscope.schema import (
    DEMOGRAPHIC_COLUMNS,
    DISPENSING_HEADERS,
    DISPENSING_SCHEMA,
    THERAPY_HEADERS,
    THERAPY_SCHEMA,
)


class Typed(NamedTuple):
    """``valid``: typed rows. ``rejects``: rows with a ``_reject_reason``. ``all``: both,
    the reason NULL on valid rows (what ``stage`` writes in one pass)."""

    valid: DataFrame
    rejects: DataFrame
    all: DataFrame


def csv_columns(spark: SparkSession, path: str, options: dict | None = None) -> list[str]:
    """The header of the first CSV file under ``path``."""
    return spark.read.options(**{"header": "true", "inferSchema": "false"} | (options or {})).csv(path).columns


def by_name(raw: DataFrame, headers: dict) -> DataFrame:
    """The extract's columns under our names, whatever their order; columns of other names go.

    Source headers and our own names are both accepted. A missing key, date or number column
    is an error; demographic columns may be missing.
    """
    found = {headers.get(c.strip(), c.strip()): c for c in raw.columns if headers.get(c.strip(), c.strip()) in headers.values()}
    missing = [h for h, c in headers.items() if c not in found and c not in DEMOGRAPHIC_COLUMNS]
    if missing:
        raise ValueError(f"the extract has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    return raw.select(*[F.col(f"`{c}`").alias(name) for name, c in found.items()])


def csv_reader_options(options: dict | None = None) -> dict:
    """Reader options of a CSV extract: files whose header differs from the first one's are an error, never shifted."""
    return {"header": "true", "mode": "PERMISSIVE", "enforceSchema": "false"} | (options or {})


def read_raw(
    spark: SparkSession,
    path: str,
    headers: dict,
    fmt: str = "csv",
    options: dict | None = None,
) -> DataFrame:
    """Read an extract by column name and rename to our column names.

    CSV is read as text (typing happens in ``type_*``), Parquet with its own types. ``options``
    are Spark's reader options, such as ``sep`` and ``encoding``.
    """
    if fmt == "csv":
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in csv_columns(spark, path, options)])
        return by_name(spark.read.options(**csv_reader_options(options)).schema(schema).csv(path), headers)
    return by_name(spark.read.format(fmt).options(**(options or {})).load(path), headers)


# Columns that a value is made by, one step after the other; the last step holds the value under its own name.
Steps = list[dict[str, Column]]


def _computed_once(df: DataFrame, *values: Steps) -> DataFrame:
    """``df`` with the columns of all steps, each of them computed once for each row.

    A filter or join takes the expressions of a projection that it refers to into itself, copies and all, and they
    are computed again for the output. The output of a generator is a value, here of the only element of an array.
    """
    for step in zip_longest(*values, fillvalue={}):
        columns = [column.alias(name) for found in step for name, column in found.items()]
        df = df.select("*", F.inline(F.array(F.struct(*columns))))
    return df


def _timestamp(df: DataFrame, name: str, out: str) -> Steps:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return [{out: F.col(name)}]
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return [{out: F.col(name).cast("timestamp_ntz")}]
    return day_first_steps(name, out)


def _number(df: DataFrame, name: str, decimal_comma: bool, out: str, bad: str) -> Steps:
    """A number as DOUBLE, and whether there is text that is none.

    Blank, NaN (a blank cell read by other tools) and NULL are NULL. With ``decimal_comma``
    text has a comma before its decimals and may have points between thousands.
    """
    text, value = F.col("_number_text"), F.col("_number")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return [{"_number": F.col(name).cast("double")}, {out: F.when(~F.isnan(value), value), bad: F.lit(False)}]
    trimmed = {"_number_text": F.nullif(F.trim(F.col(name)), F.lit(""))}
    if not decimal_comma:
        judged = {out: F.when(~F.isnan(value), value), bad: text.isNotNull() & value.isNull()}
        return [trimmed, {"_number": text.try_cast("double")}, judged]
    # No text of this shape is NaN.
    shape = r"^[+-]?(\d+|\d{1,3}(\.\d{3})+)(,\d+)?$"
    number = F.when(text.rlike(shape), F.translate(text, ",.", ".").try_cast("double"))
    return [trimmed, {"_number": number}, {out: value, bad: value.isNull() & text.isNotNull() & (F.lower(text) != "nan")}]


def _text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))


# Digits, with what the cast to BIGINT lets stand around them: a sign, white space and control characters.
_WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def _prod(df: DataFrame, name: str, out: str) -> Steps:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return [{out: F.col(name).cast("bigint")}]
    # "1480022" and "1480022.0" (a numeric cell exported as text) both map to 1480022.
    text, as_long, as_double = (F.col(c) for c in ("_prod_text", "_prod_long", "_prod_double"))
    return [
        {"_prod_text": F.trim(F.col(name).cast("string"))},
        # A cast that fails costs an exception, so only text that can be a whole number is cast to one.
        {"_prod_long": F.when(text.rlike(_WHOLE), text.try_cast("bigint"))},
        {"_prod_double": F.when(as_long.isNull(), text.try_cast("double"))},
        {out: F.coalesce(as_long, F.when(as_double == F.floor(as_double), as_double.cast("bigint")))},
    ]


def _split(typed: DataFrame, schema: T.StructType, reason: Column) -> Typed:
    with_reason = typed.withColumn("_reject_reason", reason).drop("_bad_number")
    valid = with_reason.where(F.col("_reject_reason").isNull()).select(*[f.name for f in schema.fields])
    rejects = with_reason.where(F.col("_reject_reason").isNotNull())
    return Typed(valid, rejects, with_reason)


def _reason(checks: list[tuple[Column, str]]) -> Column:
    expr = F.lit(None).cast("string")
    for bad, label in reversed(checks):
        expr = F.when(bad, F.lit(label)).otherwise(expr)
    return expr


def _typed(raw: DataFrame, schema: T.StructType, number: str, texts: Sequence[str], decimal_comma: bool) -> Typed:
    kept = ("patient_id", "prod", "dispensed_at", number)
    given = raw.select(*[F.col(c).alias(f"_given_{c}") for c in kept], *[_text(raw, c).alias(c) for c in texts])
    values = _computed_once(
        given,
        [{"patient_id": _text(given, "_given_patient_id")}],
        _prod(given, "_given_prod", "prod"),
        _timestamp(given, "_given_dispensed_at", "dispensed_at"),
        _number(given, f"_given_{number}", decimal_comma, number, "_bad_number"),
    )
    raws = [F.col(f"_given_{c}").cast("string").alias(f"raw_{c}") for c in kept]
    typed = values.select(*kept, *texts, *raws, "_bad_number")
    reason = _reason(
        [
            (F.col("patient_id").isNull(), "missing patient_id"),
            (F.col("prod").isNull(), "unusable prod"),
            (F.col("dispensed_at").isNull(), "unusable dispensed_at"),
            (F.col("_bad_number"), f"unusable {number}"),
        ]
    )
    return _split(typed, schema, reason)


def type_dispensing(raw: DataFrame, decimal_comma: bool = False) -> Typed:
    """Cast a renamed dispensing extract to ``DISPENSING_SCHEMA`` and split off rejects.

    Demographic columns, the birth date included, are text as given.
    """
    return _typed(raw, DISPENSING_SCHEMA, "qty", DEMOGRAPHIC_COLUMNS, decimal_comma)


def type_therapy(raw: DataFrame, decimal_comma: bool = False) -> Typed:
    """Cast a renamed therapy extract to ``THERAPY_SCHEMA`` and split off rejects."""
    return _typed(raw, THERAPY_SCHEMA, "therapy_days", (), decimal_comma)


def read_dispensing(
    spark: SparkSession, path: str, fmt: str = "csv", options: dict | None = None, decimal_comma: bool = False
) -> Typed:
    """S1 + S3: the dispensing extract, typed, with rejects."""
    return type_dispensing(read_raw(spark, path, DISPENSING_HEADERS, fmt, options), decimal_comma)


def read_therapy(
    spark: SparkSession, path: str, fmt: str = "csv", options: dict | None = None, decimal_comma: bool = False
) -> Typed:
    """S2 + S3: the therapy extract, typed, with rejects."""
    return type_therapy(read_raw(spark, path, THERAPY_HEADERS, fmt, options), decimal_comma)


def stage(typed: Typed, path: str) -> None:
    """Write every typed row once as Parquet, partitioned by ``status`` (valid / rejected).

    One pass over the source text; later steps read the typed copy instead of
    parsing the extract again.
    """
    status = F.when(F.col("_reject_reason").isNull(), F.lit("valid")).otherwise(F.lit("rejected"))
    typed.all.withColumn("status", status).write.mode("overwrite").partitionBy("status").parquet(path)


def read_staged(spark: SparkSession, path: str, typed: Typed, status: str = "valid") -> DataFrame:
    """Rows of one status from a staged extract (the partition filter prunes the folders)."""
    schema = T.StructType([*typed.all.schema.fields, T.StructField("status", T.StringType(), True)])
    rows = spark.read.schema(schema).parquet(path).where(F.col("status") == F.lit(status))
    if status == "valid":
        return rows.select(*typed.valid.columns)
    return rows.drop("status")
