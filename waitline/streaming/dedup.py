"""The event log without copies, while it is being written.

The same event may be delivered again, with a time of its own after all, or earlier. Which
delivery is kept is known once none can come any more: when the watermark, the latest event time
so far less the lateness that is allowed, has passed the event's time. So each event is a group
that holds its best delivery, is given out once, by the timer of the watermark, and is forgotten.
Spark keeps that state by key and recovers it from the checkpoint.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waitline.functions.clock import micros_since_1970
from waitline.operators.events import DEDUPED_COLUMNS, with_canonical_time
from waitline.sources.tables import small_splits

#: The id of a row that is no event but says how late it is.
HEARTBEAT = "heartbeat"


def instant(wall_time: Column) -> Column:
    """A wall time as if it were of UTC, whatever the zone of the session; watermarks need one."""
    return F.timestamp_micros(micros_since_1970(wall_time))


def dedupe(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """One row per case, status and canonical time of a stream of events, in append mode.

    Kept is what ``operators.events.dedupe`` keeps: the row with a time of its own, then the
    earliest ingested, then the smallest id. Deliveries that come when the watermark has passed
    their time are left out, as are rows without any time. On a table that is no stream the
    result is the same as for a stream in which nothing is too late.
    """
    order = [F.col("event_ts").isNull().alias("without_time"), "ingestion_ts", "event_id"]
    rest = ["event_ts", "event_tz", "is_duplicate", "is_late_arriving", "intake_date"]
    timed = with_canonical_time(events).filter("event_ts_canonical IS NOT NULL")
    return (
        timed.withColumn("at", instant(F.col("event_ts_canonical")))
        .withWatermark("at", lateness)
        .groupBy("case_id", "status", "at")
        .agg(F.min(F.struct(*order, *rest)).alias("kept"))
        .select("case_id", "status", "kept.*")
        .filter(F.col("event_id") != HEARTBEAT)
        .withColumn("event_ts_canonical", F.coalesce("event_ts", "ingestion_ts"))
        .select(*DEDUPED_COLUMNS)
    )


def read_log(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The files of a folder as a stream, oldest first, those that are yet to come as well."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def order_files(spark: SparkSession, folder: str) -> None:
    """Let a stream read the files of a folder, which one job wrote, in the order of its tasks.

    Their times of modification become a second apart, the last one of now.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath() for status in store.listStatus(path)]
    parts = [file for file in found if file.getName().startswith("part-")]
    parts.sort(key=lambda file: int(file.getName().split("-")[1]))
    first = int(time.time()) - len(parts)
    for number, file in enumerate(parts, 1):
        store.setTimes(file, (first + number) * 1000, -1)
        if store.getFileStatus(file).getModificationTime() != (first + number) * 1000:
            raise OSError(f"{folder}: files of this store cannot be put in order")


def start(
    stream: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write a stream to Parquet, each row once; what is there now, or ``every`` so often."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
    )
    # A stream keeps the settings it was started with.
    with small_splits(stream.sparkSession):
        return writer.start()


def write_heartbeat(
    spark: SparkSession, folder: str, schema: T.StructType, at: dt.datetime
) -> None:
    """Say that it is ``at``: events older than that by the allowed lateness are all there.

    A log that nothing follows holds back its last events; a heartbeat lets them go.
    """
    known = {"event_id": HEARTBEAT, "event_ts": at, "ingestion_ts": at}
    row = spark.createDataFrame([tuple(known.get(f.name) for f in schema.fields)], schema)
    row.coalesce(1).write.mode("append").parquet(folder)
