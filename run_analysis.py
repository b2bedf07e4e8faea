"""Command line: run the analysis over Parquet inputs, publish its tables and reports."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from waitline.plans import reports
from waitline.plans.pipeline import Inputs, Pipeline
from waitline.plans.store import Store


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("inputs", help="folder of cases, events_log, calendar_dim, staffing_schedule")
    parser.add_argument("--prefix", default="", help="of the names of the saved tables")
    parser.add_argument("--tables", help="folder for the files of the saved tables")
    parser.add_argument("--reports", help="folder for the CSV reports")
    parser.add_argument("--figures", help="folder for the JSON figures of each step")
    parser.add_argument("--zone", help="zone of the working hours, for files that hold instants")
    parser.add_argument("--zone-column", help="column of the cases with each row's zone")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("service-analysis").getOrCreate()
    zone = F.col(given.zone_column) if given.zone_column else given.zone
    store = Store(spark)
    inputs = Inputs.from_parquet(spark, given.inputs, zone, given.zone)
    pipeline = Pipeline(inputs, store)
    for name in pipeline.publish(given.prefix, given.tables):
        print(name)
    if given.reports:
        pipeline.export(given.reports)
    if given.figures:
        reports.write_figures(pipeline, given.figures)
    store.clear()


if __name__ == "__main__":
    main()
