"""Reading and writing the tables: Parquet, partitioned Parquet, saved tables, CSV, JSON."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitline import schemas

SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
OPEN_COST_SETTING = "spark.sql.files.openCostInBytes"
#: Spark then deletes the shuffle files of a query when it has ended.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The bytes of files that one task reads while a table is written.
SPLIT_BYTES = 16 << 20

#: What opening a file counts as in a split, so that a split holds many files of small days.
OPEN_COST_BYTES = 64 << 10

#: Options of written Parquet. A split reads whole row groups, so these are no larger than it is.
COMPACT = {"compression": "zstd", "parquet.block.size": str(SPLIT_BYTES)}


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Let a task read ``SPLIT_BYTES`` of files at most, or what the session is set to if less.

    What a task sorts or hashes before a shuffle is as much as it reads, and rows of the log are
    over ten times as large there as in zstd Parquet: 128 MB, Spark's default, are more than a task
    has memory for, and are spilled. A file counts ``OPEN_COST_BYTES`` besides its own, if the
    session does not set what it costs: at 4 MB, Spark's default, four small days fill a split,
    and each of the many tasks opens a file for every partition of the shuffle behind it. What is
    shuffled for the table is deleted when it is written, since nothing goes back to it; else it
    stays on disk as long as something refers to the query. The session's settings are put back at
    the end.
    """
    names = (SPLIT_SETTING, OPEN_COST_SETTING, CLEANUP_SETTING)
    before = {name: spark.conf.get(name, None) for name in names}
    now = spark.conf.get(SPLIT_SETTING)
    set_to = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)
    spark.conf.set(SPLIT_SETTING, str(min(set_to, SPLIT_BYTES)))
    spark.conf.set(CLEANUP_SETTING, "true")
    if before[OPEN_COST_SETTING] is None:
        spark.conf.set(OPEN_COST_SETTING, str(OPEN_COST_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    team_tz: str | Column | None = None,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Read a Parquet file or folder and hold it against its schema.

    A folder partitioned as ``intake_date=2025-07-01`` gives that column as a date. With
    ``days`` the folders of those days are read that are there, and no others are listed.
    Where the files have instants and the schema wall times, ``team_tz`` is the zone to
    read the clock in: a name, or a column of the files with the zone of each row. The
    zone of the session plays no part.
    """
    if days is None:
        df = spark.read.parquet(path)
    else:
        folders = [f"{path}/intake_date={day}" for day in days]
        there = [folder for folder in folders if exists(spark, folder)]
        if not there:
            return spark.createDataFrame([], schema)
        df = spark.read.option("basePath", path).parquet(*there)
    if team_tz is not None:
        zone = F.lit(team_tz) if isinstance(team_tz, str) else team_tz
        wall = {f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
        instants = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
        df = df.withColumns(
            {name: _wall_time(F.col(name), zone) for name in sorted(wall & instants)}
        )
    return schemas.require(df, schema, table)


def _wall_time(instant: Column, zone: Column) -> Column:
    """What a clock in the zone shows at an instant, by way of its microseconds since 1970."""
    micros = F.unix_micros(instant)
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)")
    )
    return F.convert_timezone(F.lit("UTC"), zone, utc)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_partitioned(
    df: DataFrame, path: str, by: str = "intake_date", only_given_days: bool = False
) -> None:
    """Write zstd Parquet in one folder per value of ``by``, replacing what is there.

    ``only_given_days`` replaces just the folders the data has rows for, so that a
    refresh of one day leaves the others alone and a rerun counts nothing twice.

    The rows of a day are brought together first, and a day much larger than the
    rest is split, in portions of the size Spark is set to.
    """
    writer = (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .options(**COMPACT)
        .option("partitionOverwriteMode", "dynamic" if only_given_days else "static")
        .partitionBy(by)
    )
    with small_splits(df.sparkSession):
        writer.parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a table in the catalog and return it; ``path`` keeps its files there."""
    writer = df.write.mode("overwrite").options(**COMPACT)
    if path is not None:
        writer = writer.option("path", path)
    with small_splits(df.sparkSession):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header line, from the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Write one JSON object per row, NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_csv(
    tables: Mapping[str, DataFrame], folder: str, order: Mapping[str, Sequence[str]]
) -> None:
    """Write every table to ``<folder>/<name>`` as CSV, sorted where an order is given."""
    for name, df in tables.items():
        write_csv(df.orderBy(*order[name]) if order.get(name) else df, f"{folder}/{name}")
