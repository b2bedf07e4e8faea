"""How much a task reads while a table is written."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import fixture
from waitline.operators import events
from waitline.plans import observed
from waitline.plans.pipeline import Pipeline
from waitline.plans.store import Store
from waitline.sources import tables
from waitline.streaming import dedup


@pytest.fixture(scope="module")
def large(spark):
    """Some 30 MB of Parquet from one task."""
    return spark.range(0, 3_000_000, 1, 1).select("id", F.rand(1).alias("x"))


def _largest_row_group(folder: str) -> int:
    """Bytes as they lie in the file, which is what splits are cut by."""
    files = [pq.ParquetFile(file).metadata for file in Path(folder).rglob("*.parquet")]
    groups = [f.row_group(n) for f in files for n in range(f.num_row_groups)]
    return max(sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups)


def test_stored_tables_can_be_split(spark, large):
    store = Store(spark)
    store.keep("large", large)
    observed.write_observed(large, store.path("observed"), [])
    tables.write_partitioned(large.withColumn("day", F.lit(1)), store.path("days"), "day")
    tables.save_table(large, "large_to_split", store.path("saved"))
    for name in ("large-0", "observed", "days", "saved"):
        assert _largest_row_group(store.path(name)) < 1.1 * tables.SPLIT_BYTES, name
    spark.sql("DROP TABLE large_to_split")
    store.clear()


def test_tasks_read_small_splits_while_a_table_is_written(spark):
    """Each file of 100 bytes costs 16 MB here, so no two of them go to one task."""
    store, cost = Store(spark), "spark.sql.files.openCostInBytes"
    spark.range(0, 64, 1, 64).write.parquet(store.path("files"))
    spark.conf.set(cost, str(tables.SPLIT_BYTES))
    try:
        task = F.spark_partition_id().alias("task")
        kept = store.keep("tasks", spark.read.parquet(store.path("files")).select(task))
        assert kept.distinct().count() == 64
    finally:
        spark.conf.unset(cost)
        store.clear()


def test_many_small_files_are_few_tasks_while_a_table_is_written(spark):
    store = Store(spark)
    spark.range(0, 256, 1, 256).write.parquet(store.path("files"))
    task = F.spark_partition_id().alias("task")
    kept = store.keep("tasks", spark.read.parquet(store.path("files")).select(task))
    assert kept.distinct().count() <= 2 * spark.sparkContext.defaultParallelism
    assert kept.count() == 256
    store.clear()


def test_setting_is_put_back(spark):
    name = tables.SPLIT_SETTING
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), tables.small_splits(spark):
        assert int(spark.conf.get(name)) == tables.SPLIT_BYTES
        raise RuntimeError
    assert spark.conf.get(name) == before
    spark.conf.set(name, "1m")
    try:
        with tables.small_splits(spark):
            assert int(spark.conf.get(name)) == 1 << 20
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_open_cost_is_put_back(spark):
    name = tables.OPEN_COST_SETTING
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), tables.small_splits(spark):
        assert int(spark.conf.get(name)) == tables.OPEN_COST_BYTES
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_a_stream_is_started_with_small_splits(spark):
    class Writer:
        """A stream and its writer that give out the setting they are started with."""

        def __init__(self):
            self.sparkSession, self.writeStream = spark, self

        def format(self, *_, **__):
            return self

        option = outputMode = trigger = format

        def start(self):
            return int(spark.conf.get(tables.SPLIT_SETTING))

    assert dedup.start(Writer(), "out", "checkpoint") == tables.SPLIT_BYTES


def _shuffled(spark) -> int:
    """Bytes of shuffle files that lie in the session's local folders."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = (Path(folder.getPath()).rglob("shuffle_*.data") for folder in blocks.localDirs())
    return sum(file.stat().st_size for found in files for file in found)


def test_what_is_shuffled_for_a_table_is_deleted(spark):
    store, name = Store(spark), tables.CLEANUP_SETTING
    setting = spark.conf.get(name, None)
    dealt = spark.range(500_000).select("id", F.rand(2).alias("x")).repartition(5, "x")
    days = dealt.select("id", (F.col("id") % 3).alias("day"))
    before = _shuffled(spark)
    store.keep("dealt", dealt)
    tables.write_partitioned(days, store.path("days"), "day")
    tables.save_table(dealt, "dealt_out", store.path("dealt_out"))
    observed.write_observed(dealt, store.path("observed"), [])
    assert _shuffled(spark) - before < 1_000_000
    assert spark.conf.get(name, None) == setting
    assert spark.table("dealt_out").count() == 500_000
    spark.sql("DROP TABLE dealt_out")
    store.clear()


def test_the_log_without_copies_is_written_once_to_publish(spark, monkeypatch):
    store, kept, prefix = Store(spark), [], "once_"
    keep = store.keep
    monkeypatch.setattr(store, "keep", lambda name, df: kept.append(name) or keep(name, df))
    first = dt.datetime(2025, 7, 1)
    orders = [(n, 7 * n, "FOP"[n % 3], first + dt.timedelta(days=n % 9)) for n in range(60)]
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"
    made = fixture.inputs_from_orders(spark.createDataFrame(orders, columns), store)
    pipeline = Pipeline(made, store)
    names = pipeline.publish(prefix, store.path("tables"))
    try:
        assert "events_deduped" not in kept
        deduped = events.dedupe(pipeline.inputs.events_log)
        for table, want in (("events_deduped", deduped), ("events_clean", events.clean(deduped))):
            got = spark.table(f"{prefix}{table}")
            assert got.columns == want.columns and got.count() > 0
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        # Again, over the tables that are there.
        assert pipeline.publish(prefix, store.path("tables")) == names
        assert spark.table(f"{prefix}events_clean").exceptAll(events.clean(deduped)).isEmpty()
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        store.clear()
