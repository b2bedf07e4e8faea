"""Stored stages: tables written once to the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from waitline.sources import tables


#: The name of a file that Spark wrote: its part, and a number that no other write has.
WRITTEN_ONCE = re.compile(r"^part-\d+-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only in local mode, where the machine is the cluster, is one made if it is not set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


class Store:
    """Writes a DataFrame as Parquet under a name, and reads it back from there.

    That cuts the lineage, outlives lost executors, and lets later steps read only the
    columns they need. A table is reused only for a DataFrame of the same plan, which
    names its inputs and holds the settings, over the same files, of the same size and
    time; any other gets a table of its own, also under a name that is known. So a read
    of a folder whose days have been written again is never answered from before.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{(folder or shared_folder(spark)).rstrip('/')}/{uuid.uuid4().hex}"
        self._tables: dict[str, list[tuple[DataFrame, frozenset, DataFrame]]] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        known = self._tables.setdefault(name, [])
        files = self._files(df)
        for made_from, of_files, table in known:
            if files == of_files and made_from.sameSemantics(df):
                return table
        path = self.path(f"{name}-{len(known)}")
        with tables.small_splits(self.spark):
            df.write.options(**tables.COMPACT).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        known.append((df, files, table))
        return table

    def _files(self, df: DataFrame) -> frozenset:
        """The files that the DataFrame reads; size and time too of those that may change.

        Spark names a file once and for all. Files of other names, which may be written again in
        place, are looked up folder by folder.
        """
        found = [file.rpartition("/") for file in df.inputFiles()]
        jvm, stamps = self.spark.sparkContext._jvm, {}
        for folder in {folder for folder, _, name in found if not WRITTEN_ONCE.search(name)}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for status in files.listStatus(path):
                stamp = (status.getLen(), status.getModificationTime())
                stamps[folder, status.getPath().getName()] = stamp
        return frozenset((*file, stamps.get((file[0], unquote(file[2])))) for file in found)

    def clear(self) -> None:
        """Delete everything this store has written. Its tables cannot be read any more."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.folder)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)
        self._tables.clear()
