"""Typed readers (S1-S3, rejects) and the presentation layer / sinks."""

import csv
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from refillscope.functions.numeric import safe_ratio
from refillscope.functions.temporal import format_day_first, parse_day_first, whole_days
from refillscope.operators import adherence as adh
from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from refillscope.schema import DISPENSING_HEADERS, THERAPY_HEADERS, product_dimension
from refillscope.sources import sinks
from refillscope.sources.extracts import read_dispensing, read_therapy, type_dispensing, type_therapy


def _write_csv(path, headers, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        writer = csv.writer(fh)
        writer.writerow(headers)
        writer.writerows(rows)


DISP_ROWS = [
    # patient, prod, date (day first), qty, sex, birth date, birth town, residence, unit
    ["P1", "1480022", "01/02/2022", "1", "F", "03/04/1970", "NAPOLI", "ROMA", "ASL1"],
    ["P1", "1480022", "1/3/2022", "2", "F", "03/04/1970", "NAPOLI", "ROMA", "ASL1"],
    ["P1", "1480022.0", "31/03/2022 10:30", "1", "F", "03/04/1970", "NAPOLI", "ROMA", "ASL1"],
    ["P2", "1487505", "2022-05-05", "", "M", "", "BARI", "BARI", "ASL2"],
    ["", "1480022", "01/02/2022", "1", "F", "", "", "", ""],
    ["P3", "1480022", "31/02/2022", "1", "F", "", "", "", ""],
    ["P4", "abc", "01/02/2022", "1", "F", "", "", "", ""],
    ["P5", "1480022", "not a date", "1", "F", "", "", "", ""],
]


def test_dispensing_reader_types_and_rejects(spark, tmp_path):
    path = os.path.join(tmp_path, "dispensing.csv")
    _write_csv(path, list(DISPENSING_HEADERS), DISP_ROWS)
    typed = read_dispensing(spark, path)
    valid = {(r["patient_id"], r["dispensed_at"]): r for r in typed.valid.collect()}
    assert set(valid) == {
        ("P1", datetime(2022, 2, 1)),
        ("P1", datetime(2022, 3, 1)),
        ("P1", datetime(2022, 3, 31, 10, 30)),
        ("P2", datetime(2022, 5, 5)),
    }
    p1 = valid[("P1", datetime(2022, 2, 1))]
    assert p1["prod"] == 1480022 and p1["qty"] == 1.0 and p1["birth_date"] == "03/04/1970"
    assert valid[("P1", datetime(2022, 3, 31, 10, 30))]["prod"] == 1480022
    assert valid[("P2", datetime(2022, 5, 5))]["qty"] is None
    reasons = sorted(r["_reject_reason"] for r in typed.rejects.collect())
    assert reasons == ["missing patient_id", "unusable dispensed_at", "unusable dispensed_at", "unusable prod"]
    assert typed.valid.schema["dispensed_at"].dataType.simpleString() == "timestamp_ntz"


def test_therapy_reader(spark, tmp_path):
    path = os.path.join(tmp_path, "therapy.csv")
    _write_csv(
        path,
        list(THERAPY_HEADERS),
        [["P1", "1480022", "01/02/2022", "28"], ["P1", "1480022", "01/03/2022", "56.5"], [None, "1", "x", "1"]],
    )
    typed = read_therapy(spark, path)
    rows = sorted(typed.valid.collect(), key=lambda r: r["dispensed_at"])
    assert [r["therapy_days"] for r in rows] == [28.0, 56.5]
    assert typed.rejects.count() == 1


def _pipeline(spark, tmp_path):
    disp_path = os.path.join(tmp_path, "d.csv")
    ther_path = os.path.join(tmp_path, "t.csv")
    _write_csv(
        disp_path,
        list(DISPENSING_HEADERS),
        [
            ["P1", "1480022", "01/01/2022", "1", "F", "", "NAPOLI", "ROMA", "ASL1"],
            ["P1", "1480022", "29/01/2022", "1", "F", "", "NAPOLI", "ROMA", "ASL1"],
            ["P2", "1487505", "05/05/2022", "1", "M", "", "BARI", "BARI", "ASL2"],
        ],
    )
    _write_csv(
        ther_path,
        list(THERAPY_HEADERS),
        [["P1", "1480022", "01/01/2022", "28"], ["P1", "1480022", "29/01/2022", "28"], ["P2", "1487505", "05/05/2022", "0"]],
    )
    disp = read_dispensing(spark, disp_path).valid
    ther = read_therapy(spark, ther_path).valid
    products = product_dimension(spark)
    scan = iv.scan_deliveries(disp)
    summary = sm.delivery_summary(disp, scan)
    return summary, adh.adherence(summary, ther, products), products


def test_presentation_and_partitioned_sinks(spark, tmp_path):
    summary, adherence, products = _pipeline(spark, str(tmp_path))
    export = sinks.adherence_presentation(adherence)
    rows = {r["CODICE PAZIENTE UNIVOCO"]: r for r in export.collect()}
    assert rows["P1"]["DATA PRIMA CONSEGNA"] == "01/01/2022"
    assert rows["P1"]["DATA ULTIMA CONSEGNA"] == "29/01/2022"
    assert rows["P1"]["ADERENZA"] == "100.0"  # 56 / (28 + 28)
    assert rows["P2"]["ADERENZA"] == "0000"  # zero denominator
    assert rows["P1"]["PROD"] == "1480022"

    out = os.path.join(tmp_path, "adherence")
    sinks.write_per_product(export, out)
    folders = sorted(f for f in os.listdir(out) if f.startswith("slug="))
    assert folders == ["slug=aimovig70", "slug=ajovy"]
    back = spark.read.option("header", "true").csv(out)
    assert {r["slug"] for r in back.collect()} == {"aimovig70", "ajovy"}
    assert back.where("`ADERENZA` = '0000'").count() == 1

    # Per-product files carry the AIC code as text; its leading zero survives.
    out2 = os.path.join(tmp_path, "summary")
    sinks.write_per_product(sinks.summary_presentation(adh.attach_products(summary, products)), out2, slugs=["ajovy", "emgality120"])
    back = spark.read.option("header", "true").csv(out2)
    assert {r["AIC"] for r in back.collect()} == {"046925018", "047791013"}
    folder = os.path.join(out2, "slug=emgality120")  # a product without a row: headers alone
    names = [f for f in os.listdir(folder) if f.endswith(".csv")]
    with open(os.path.join(folder, names[0])) as fh:
        assert fh.read().strip().split(",") == [c for c in back.columns if c != "slug"]

    out3 = os.path.join(tmp_path, "consolidated")
    sinks.write_consolidated(export, out3)
    consolidated = spark.read.option("header", "true").csv(out3)
    assert consolidated.count() == 2 and "slug" not in consolidated.columns


def test_full_job_on_extracts(spark, tmp_path):
    from refillscope.plans.jobs import run

    disp_path = os.path.join(tmp_path, "d.csv")
    ther_path = os.path.join(tmp_path, "t.csv")
    _write_csv(disp_path, list(DISPENSING_HEADERS), DISP_ROWS)
    _write_csv(ther_path, list(THERAPY_HEADERS), [["P1", "1480022", "01/02/2022", "28"], ["P2", "1487505", "05/05/2022", "0"]])
    out = os.path.join(tmp_path, "out")
    report = run(spark, disp_path, ther_path, out)
    assert report["rejected"] == {"dispensing": 4, "therapy": 0}
    summary = spark.read.option("header", "true").csv(os.path.join(out, "summary"))
    assert sorted(r["NUMERO CONSEGNE TOTALI"] for r in summary.collect()) == ["1", "3"]
    adherence = spark.read.option("header", "true").csv(os.path.join(out, "adherence_all"))
    rows = {r["CODICE PAZIENTE UNIVOCO"]: r for r in adherence.collect()}
    assert rows["P2"]["ADERENZA"] == "0000"
    assert rows["P1"]["DATA PRIMA CONSEGNA"] == "01/02/2022" and rows["P1"]["DATA ULTIMA CONSEGNA"] == "31/03/2022"
    staged = spark.read.parquet(os.path.join(out, "staged", "dispensing"))
    assert staged.where("status = 'rejected'").count() == 4
    assert staged.where("status = 'valid'").count() == 4


def test_columns_are_read_by_name(spark, tmp_path):
    path = os.path.join(tmp_path, "t.csv")
    names = ["note", "giorni di terapia reali (PDD)", "DT_EROG", "CODICE PAZIENTE UNIVOCO", "PROD"]
    _write_csv(path, names, [["x", "28", "01/02/2022", "P1", "1480022"]])
    row = read_therapy(spark, path).valid.collect()[0]
    assert (row["patient_id"], row["prod"], row["therapy_days"], row["dispensed_at"]) == ("P1", 1480022, 28.0, datetime(2022, 2, 1))
    short = os.path.join(tmp_path, "short.csv")
    _write_csv(short, names[:4], [["x", "28", "01/02/2022", "P1"]])
    with pytest.raises(ValueError, match="PROD"):
        read_therapy(spark, short)


def test_numbers_are_never_lost_silently(spark, tmp_path):
    rows = [["P1", "1", "01/02/2022", x] for x in ("1,5", "abc", "", "nan", "2.5", "1.234,5")]
    path = os.path.join(tmp_path, "t.csv")
    _write_csv(path, list(THERAPY_HEADERS), rows)
    point, comma = read_therapy(spark, path), read_therapy(spark, path, decimal_comma=True)
    assert sorted(r["raw_therapy_days"] for r in point.rejects.collect()) == ["1,5", "1.234,5", "abc"]
    assert {r["_reject_reason"] for r in point.rejects.collect()} == {"unusable therapy_days"}
    assert sorted(r["raw_therapy_days"] for r in comma.rejects.collect()) == ["2.5", "abc"]
    assert sorted(r["therapy_days"] for r in comma.valid.collect() if r["therapy_days"] is not None) == [1.5, 1234.5]


def test_day_first_variants(spark):
    texts = {
        "01-02-2022": datetime(2022, 2, 1), "1.2.2022": datetime(2022, 2, 1), "01/02/22": datetime(2022, 2, 1), "01/02/70": datetime(1970, 2, 1),
        "2022-02-01": datetime(2022, 2, 1), "2022-02-01T10:05:06.5": datetime(2022, 2, 1, 10, 5, 6, 500000),
        "44593": None, "2022": None, "01/02-2022": None, "29/02/2023": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["d"] for r in df.select("t", parse_day_first("t").alias("d")).collect()} == texts


@pytest.mark.parametrize("zone", ["UTC", "Europe/Rome", "America/Sao_Paulo"])
def test_days_and_dates_do_not_depend_on_the_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [
            (datetime(2022, 3, 26, 2, 30), datetime(2022, 3, 27, 2, 30), 1),  # a missing hour in Rome
            (datetime(2022, 3, 27, 2, 30), datetime(2022, 3, 28, 2, 0), 0),
            (datetime(2018, 11, 3), datetime(2018, 11, 4), 1),  # a missing midnight in Sao Paulo
            (datetime(2018, 11, 4), datetime(2018, 11, 5), 1),
            (datetime(2022, 10, 29, 2, 30), datetime(2022, 10, 30, 2, 29), 0),
        ]
        df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz, want long")
        out = df.select(whole_days("a", "b").alias("days"), "want", format_day_first("b").alias("shown"), "b").collect()
        assert [r["days"] for r in out] == [r["want"] for r in out]
        assert [r["shown"] for r in out] == [r["b"].strftime("%d/%m/%Y") for r in out]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(2.0, 4.0), (float("nan"), 4.0), (2.0, float("nan")), (2.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.5, None, None, None, None]


def test_full_job_without_any_configured_product(spark, tmp_path):
    from refillscope.plans.jobs import run

    disp_path, ther_path = os.path.join(tmp_path, "d.csv"), os.path.join(tmp_path, "t.csv")
    with open(disp_path, "w") as fh:
        fh.write(";".join(DISPENSING_HEADERS) + "\nP1;5;01/02/2022;1,5;F;;;;\n")
    with open(ther_path, "w") as fh:
        fh.write(";".join(THERAPY_HEADERS) + "\nP1;5;01/02/2022;x\n")
    out = os.path.join(tmp_path, "out")
    report = run(spark, disp_path, ther_path, out, options={"sep": ";"}, decimal_comma=True)
    assert report["rejected"] == {"dispensing": 0, "therapy": 1}
    assert sorted(f for f in os.listdir(os.path.join(out, "adherence")) if f.startswith("slug=")) == [
        "slug=aimovig140", "slug=aimovig70", "slug=ajovy", "slug=emgality120",
    ]
    everything = spark.read.option("header", "true").csv(os.path.join(out, "adherence_all"))
    assert everything.count() == 0 and "AIC" in everything.columns


def test_whole_products_are_cast_only_where_they_are_whole(spark):
    rows = [("1480022",), ("1480022.0",), (" +7 ",), ("\t-7\n",), ("9007199254740993",), ("1.5",), ("n/a",), ("",), ("+",), ("1e3",), (None,)]
    raw = spark.createDataFrame(rows, "prod string").select(
        F.lit("P").alias("patient_id"), "prod", F.lit("01/02/2022").alias("dispensed_at"), F.lit("1").alias("qty")
    )
    typed = type_dispensing(raw)
    found = {r["raw_prod"]: r["prod"] for r in typed.all.collect()}
    expected = dict.fromkeys((p for p, in rows)) | {"1480022": 1480022, "1480022.0": 1480022, " +7 ": 7, "\t-7\n": -7, "9007199254740993": 9007199254740993, "1e3": 1000}
    assert found == expected
    # The cast that throws for "1480022.0" stands behind a test of the text's shape.
    plan = typed.valid._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(try_cast" not in plan


def test_parsed_parts_of_dates(spark):
    texts = {
        "01/02/2022\n": datetime(2022, 2, 1),
        " 1.2.68 7:05 ": datetime(2068, 2, 1, 7, 5),
        "1-2-69T07:05:09.25": datetime(1969, 2, 1, 7, 5, 9, 250000),
        "2022-2-1 10:00:60": datetime(2022, 2, 1, 10, 1),
        ";2022;02;01;;;;": None,
        "01/02-2022": None,
        "01/02/2022 25:00": None,
        "2022-02-01 10": None,
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_day_first("t").alias("at")).collect()
    assert {r["t"]: r["at"] for r in rows} == texts


def test_decimal_comma_keeps_nan_apart_from_bad_numbers(spark):
    numbers = {"1.234,5": 1234.5, "+2": 2.0, "-0,5\n": -0.5, "NaN": None, "": None, "1,5,5": None, "1.5": None}
    raw = spark.createDataFrame([(t,) for t in numbers], "therapy_days string").select(
        F.lit("P").alias("patient_id"), F.lit("1").alias("prod"), F.lit("01/02/2022").alias("dispensed_at"), "therapy_days"
    )
    rows = type_therapy(raw, decimal_comma=True).all.collect()
    assert {r["raw_therapy_days"]: r["therapy_days"] for r in rows} == numbers
    assert {r["raw_therapy_days"] for r in rows if r["_reject_reason"]} == {"1,5,5", "1.5"}
