"""Output tables."""

from __future__ import annotations

import random
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CONFLICT = "ConcurrentAppendException"
CONFLICT_WAITS = (1.0, 2.0)


def with_schema(df: DataFrame, ddl: str) -> DataFrame:
    """The frame in exactly this schema; an unsafe difference is an error."""
    return df.to(StructType.fromDDL(ddl))


def append(
    df: DataFrame, target: str, file_format: str = "parquet", sleep=time.sleep
) -> None:
    """Append to a path if `target` has a slash, else to a table.

    A conflict with another writer is tried again, three tries in all; other errors are raised
    at once.
    """
    for wait in (*CONFLICT_WAITS, None):
        writer = df.write.format(file_format).mode("append")
        try:
            writer.save(target) if "/" in target else writer.saveAsTable(target)
            return
        except Exception as error:
            if wait is None or CONFLICT not in str(error):
                raise
            sleep(wait + random.uniform(0, 0.5))


def existing(spark: SparkSession, target: str, file_format: str = "parquet") -> DataFrame | None:
    """The rows of a target so far, None before its first append."""
    if "/" not in target:
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return spark.read.format(file_format).load(target)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_new(df: DataFrame, target: str, file_format: str = "parquet") -> None:
    """Append the rows whose id the target does not have yet.

    An append lands whole or not at all, so after a failure between two targets a repeated run
    fills up those that lack its rows.
    """
    done = existing(df.sparkSession, target, file_format)
    if done is not None:
        ids = done.selectExpr("id AS _done").distinct()
        df = df.join(ids, df["id"] == ids["_done"], "left_anti")
    append(df, target, file_format)
