"""Functions of this package in the Python workers of a session."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_ROOT = str(Path(__file__).resolve().parents[2])


def importable(df: DataFrame) -> None:
    """Let the workers of a local session import this package from where it is."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *filter(None, paths)])


def map_in_workers(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """`df.mapInArrow` with a function of this package."""
    importable(df)
    return df.mapInArrow(function, schema)
