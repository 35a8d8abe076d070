"""Typed schemas, the product dimension and the export header map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CANONICAL_KEYS = ("prod", "patient_id")
DEMOGRAPHIC_COLUMNS = ("sex", "birth_date", "birth_town", "residence_town", "health_unit")

# Dispensing extract as typed by the ingest layer (input 1).
DISPENSING_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType(), False),
        T.StructField("prod", T.LongType(), False),
        T.StructField("dispensed_at", T.TimestampNTZType(), False),
        T.StructField("qty", T.DoubleType(), True),
        T.StructField("sex", T.StringType(), True),
        T.StructField("birth_date", T.StringType(), True),
        T.StructField("birth_town", T.StringType(), True),
        T.StructField("residence_town", T.StringType(), True),
        T.StructField("health_unit", T.StringType(), True),
    ]
)

# Therapy-days extract (input 2).
THERAPY_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType(), False),
        T.StructField("prod", T.LongType(), False),
        T.StructField("dispensed_at", T.TimestampNTZType(), False),
        T.StructField("therapy_days", T.DoubleType(), True),
    ]
)

# Source headers of the two extracts, mapped to our column names.
# They must equal the extract headers for files to load.
DISPENSING_HEADERS = {
    "CODICE PAZIENTE UNIVOCO": "patient_id",
    "PROD": "prod",
    "DT_EROG": "dispensed_at",
    "QTA": "qty",
    "SESSO": "sex",
    "DT_NAS": "birth_date",
    "COMUNE NASCITA": "birth_town",
    "COMUNE_RESIDENZA": "residence_town",
    "ASL_APPARTENENZA": "health_unit",
}
THERAPY_HEADERS = {
    "CODICE PAZIENTE UNIVOCO": "patient_id",
    "PROD": "prod",
    "DT_EROG": "dispensed_at",
    "giorni di terapia reali (PDD)": "therapy_days",
}

# Export headers of the delivery summary and adherence files, in
# output order, keyed by our typed column names.
# The birth date is text that the extract's owner formats; it goes through as given.
SUMMARY_EXPORT_HEADERS = {
    "patient_id": "CODICE PAZIENTE UNIVOCO",
    "sex": "SESSO",
    "birth_date": "DT_NAS",
    "birth_town": "COMUNE NASCITA",
    "residence_town": "COMUNE_RESIDENZA",
    "health_unit": "ASL_APPARTENENZA",
    "first_at": "DATA PRIMA CONSEGNA",
    "last_at": "DATA ULTIMA CONSEGNA",
    "mean_days": "MEDIA GIORNI",
    "deliveries": "NUMERO CONSEGNE TOTALI",
    "late": "NUMERO RITARDI",
}
# Header of the product's AIC code, a text column of every export file.
AIC_HEADER = "AIC"
ADHERENCE_EXPORT_HEADERS = {
    "prod": "PROD",
    "prod_desc": "PROD_DESC",
    **SUMMARY_EXPORT_HEADERS,
    "adherence_pct": "ADERENZA",
    "therapy_days_total": "NUMERATORE ADERENZA(GIORNI DI TERAPIA)",
    "denominator_days": "DENOMINATORE ADERENZA(NUM GIORNI TRA PRIMA E ULTIMA CONSEGNA)",
}

# Fixed value: the zero-denominator sentinel.
ZERO_DENOMINATOR_SENTINEL = "0000"

# The four products, as (prod, prod_desc, slug, aic). The AIC code
# keeps its leading zero, so it is a string.
PRODUCTS = (
    (1480022, "AIMOVIG*1PEN 70MG 1ML", "aimovig70", "046925018"),
    (1470395, "AIMOVIG*1PEN 140MG 1ML", "aimovig140", "046925044"),
    (1480002, "EMGALITY*SC 1PEN 120MG 1ML", "emgality120", "047424015"),
    (1487505, "AJOVY*SC 1SIR 1,5ML 225MG", "ajovy", "047791013"),
)

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("prod", T.LongType(), False),
        T.StructField("prod_desc", T.StringType(), False),
        T.StructField("slug", T.StringType(), False),
        T.StructField("aic", T.StringType(), False),
    ]
)

# Grace period, in days over the rounded mean, before a pickup counts as late.
DEFAULT_GRACE_DAYS = 3


def product_dimension(spark: SparkSession, rows=PRODUCTS, schema=PRODUCT_SCHEMA) -> DataFrame:
    """The product dimension as a DataFrame (a handful of rows, broadcast when joined)."""
    return spark.createDataFrame(list(rows), schema)
