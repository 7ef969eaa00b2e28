"""Run the batch job: ``python -m daypanel LANDING OUT --case-series NAME ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from daypanel.operators.summaries import row_counts
from daypanel.plans.build import UNGATED, Landing, build
from daypanel.session import tune


def main(arguments: list[str] | None = None) -> DataFrame:
    parser = argparse.ArgumentParser(prog="daypanel", description="Build, check and publish the panel tables.")
    parser.add_argument("landing", help="folder with the text sources, and the case series in case_series/")
    parser.add_argument("out", help="folder the builds are kept in")
    parser.add_argument("--case-series", nargs="+", required=True, help="case series in their order of precedence")
    parser.add_argument("--case-series-format", default="parquet")
    parser.add_argument("--multi-line", nargs="+", default=(), help="text sources with quoted line breaks")
    parser.add_argument("--no-gates", action="store_true", help="skip the row-count and expected-value gates")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("daypanel").getOrCreate()
    tune(spark)
    landing = Landing.of_folder(spark, options.landing, options.case_series, options.case_series_format, options.multi_line)
    gates = UNGATED if options.no_gates else {}
    return row_counts(build(spark, landing, options.out, **gates))


if __name__ == "__main__":
    main().show(truncate=False)
