"""Tables between two steps of an operator, in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
PREFIX = "llm-"
#: Spark then deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="waitline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in local mode if it is unset."""
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """Write a table and read it again.

    This cuts the lineage, so a lost executor costs the tasks that it ran, and everything that
    reads the table sees the same rows. Each call writes to a folder of its own. What was shuffled
    for it is deleted at once, since nothing goes back to it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{PREFIX}{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete staged tables, which nothing may read any more.

    For a table between two staged ones: once what is made of it is written, nothing goes back to
    it, also if an executor is lost.
    """
    for table in tables:
        spark = table.sparkSession
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            if path.getName().startswith(PREFIX):
                path.getFileSystem(hadoop).delete(path, True)
