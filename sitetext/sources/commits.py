"""All targets of a run seen together or not at all.

Each run appends to a folder of its own in every target, and its manifest, written last, names it.
Readers take the rows of runs that have a manifest. So a run that failed between two targets shows
nowhere, may be repeated under its id, and runs written at the same time don't meet.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sitetext.sources.sinks import append, existing

_RUN = "run_id"


def _own_folder(target: str, run_id: str) -> str:
    if "/" not in target:
        raise ValueError("targets of a grouped commit are paths")
    if not run_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a run id has letters, digits, - and _ only")
    return f"{target.rstrip('/')}/{_RUN}={run_id}"


def is_committed(spark: SparkSession, runs: str, run_id: str) -> bool:
    found = existing(spark, runs)
    return found is not None and not found.where(F.col(_RUN) == run_id).isEmpty()


def commit(
    frames: Mapping[str, DataFrame], runs: str, run_id: str, file_format: str = "parquet"
) -> bool:
    """Write every frame to its target under `run_id`, then the manifest to `runs`.

    What an earlier try of the run left in its folders is replaced. A run that has a manifest is
    not written again; then the answer is False.
    """
    spark = next(iter(frames.values())).sparkSession
    folders = {target: _own_folder(target, run_id) for target in frames}
    if is_committed(spark, runs, run_id):
        return False
    for target, frame in frames.items():
        frame.write.format(file_format).mode("overwrite").save(folders[target])
    manifest = spark.range(1).select(
        F.current_timestamp().alias("committed_at"), F.array(*map(F.lit, frames)).alias("targets")
    )
    append(manifest.coalesce(1), _own_folder(runs, run_id))
    return True


def committed(
    spark: SparkSession, target: str, runs: str, ddl: str, file_format: str = "parquet"
) -> DataFrame:
    """The rows of a target that belong to committed runs, with their run_id.

    Folders of other runs are not read where the list of runs is broadcast, since it prunes them.
    """
    schema = StructType.fromDDL(ddl).add(_RUN, "string")
    done = existing(spark, runs)
    if done is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.format(file_format).schema(schema).load(target)
    return rows.join(done.select(F.col(_RUN).cast("string")).distinct(), _RUN, "left_semi").select(
        schema.names
    )
