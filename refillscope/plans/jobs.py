"""The full run on dispensing extracts: summary files, adherence files, consolidated file.

    python -m refillscope.plans.jobs DISPENSING THERAPY OUT [--format csv|parquet]

Layout under ``OUT``:

- ``staged/dispensing``, ``staged/therapy``: every row typed once, as Parquet partitioned by
  ``status=valid`` / ``status=rejected`` (rejects keep their text and a reason);
- ``tables/summary``: the typed delivery summary (Parquet, partitioned by product slug);
- ``summary/slug=<product>``: summary export per product (X2);
- ``adherence/slug=<product>``: adherence export per product (X3);
- ``adherence_all``: consolidated adherence export (X4).

Each extract is parsed once (the staged copy); the typed summary is written once and
read back for the adherence step, so no lineage is recomputed by the later writes.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from refillscope.operators import adherence as adh
from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from refillscope.operators.ordered_scan import find_hot_keys
from refillscope.schema import CANONICAL_KEYS, DEMOGRAPHIC_COLUMNS, PRODUCTS, product_dimension
from refillscope.sources import sinks
from refillscope.sources.extracts import read_dispensing, read_staged, read_therapy, stage


def run(
    spark: SparkSession,
    dispensing_path: str,
    therapy_path: str,
    out_dir: str,
    input_format: str = "csv",
    output_format: str = "csv",
    options: dict | None = None,
    decimal_comma: bool = False,
) -> dict:
    """Run everything; returns the output paths and the number of rejected rows of each extract.

    ``options`` are reader options of both extracts (``sep``, ``encoding``, ...). Products
    without a delivery get files of headers alone.
    """
    products = product_dimension(spark)
    product_keys = [p[0] for p in PRODUCTS]
    slugs = [p[2] for p in PRODUCTS]

    extracts, rejected = {}, {}
    for name, path, read in (("dispensing", dispensing_path, read_dispensing), ("therapy", therapy_path, read_therapy)):
        typed = read(spark, path, input_format, options, decimal_comma)
        staged = os.path.join(out_dir, "staged", name)
        stage(typed, staged)
        extracts[name] = read_staged(spark, staged, typed)
        rejected[name] = read_staged(spark, staged, typed, "rejected").count()

    deliveries = adh.filter_products(extracts["dispensing"], product_keys)
    # One pass over the key columns of the staged copy; none if the footers show too few rows.
    hot = find_hot_keys(deliveries, CANONICAL_KEYS, most_rows=extracts["dispensing"].count())
    scan = iv.scan_deliveries(deliveries, hot=hot, carry=DEMOGRAPHIC_COLUMNS)
    summary = adh.attach_products(sm.delivery_summary(deliveries, scan), products.select("prod", "slug", "aic"))
    table = os.path.join(out_dir, "tables", "summary")
    summary.write.mode("overwrite").partitionBy("slug").parquet(table)

    written = spark.read.schema(summary.schema).parquet(table)
    shown = sinks.summary_presentation(written)
    sinks.write_per_product(shown, os.path.join(out_dir, "summary"), output_format, slugs=slugs)

    doses = adh.filter_products(extracts["therapy"], product_keys)
    result = adh.adherence(written.drop("slug", "aic"), doses, products)
    export = sinks.adherence_presentation(result)
    sinks.write_per_product(export, os.path.join(out_dir, "adherence"), output_format, slugs=slugs)
    sinks.write_consolidated(export, os.path.join(out_dir, "adherence_all"), output_format)
    return {"out": out_dir, "summary_table": table, "rejected": rejected}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("dispensing")
    parser.add_argument("therapy")
    parser.add_argument("out")
    parser.add_argument("--input-format", default="csv")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option, such as sep=;")
    parser.add_argument("--decimal-comma", action="store_true", help="numbers have a comma before their decimals")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    options = dict(x.split("=", 1) for x in args.option)
    print(
        run(
            spark, args.dispensing, args.therapy, args.out, args.input_format, args.format, options, args.decimal_comma
        )
    )


if __name__ == "__main__":
    main()
