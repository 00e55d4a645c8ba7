"""Tables written between the steps of a run, in the cluster's shared checkpoint folder.

A written table cuts the lineage, outlives lost executors, and lets later steps read only the
columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession


_OWN = "sitetext.local.folder"
#: Rows of a file of a table that is known to be narrow and to have no more than so many rows.
ROWS_OF_A_FILE = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where it is unset, as in tests, a local session sets one of its own, once; on a cluster this
    is an error, since executors do not share local folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.conf.set(_OWN, own := spark.conf.get(_OWN, None) or tempfile.mkdtemp(prefix="sitetext-"))
    return own


class Staging:
    """The staged tables of one run, in a folder of its own."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/sitetext-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read again.

        `rows`, for narrow tables, is the most rows it can have. Such a table is written by a task
        per ROWS_OF_A_FILE of them, and by as many as run at once at least, however many partitions
        it has: each file costs folders, renames and, on local disks without Hadoop's native
        library, processes that are forked from the executor to set modes.
        """
        path = f"{self.folder}/{name}"
        if rows is not None:
            at_once = self._spark.sparkContext.defaultParallelism
            df = df.coalesce(max(at_once, -(-rows // ROWS_OF_A_FILE)))
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete the folder of this run. Tables staged in it can't be read any more."""
        if "://" in self.folder or self.folder.startswith("file:"):
            system, path = FileSystem.from_uri(self.folder)
        else:
            system, path = LocalFileSystem(), self.folder
        system.delete_dir(path)
