"""Markup by its place: which file a captured row lies in, and at which row.

A place is some sixty bytes and stands for a page of any size. Steps that decide which rows count
work on places alone; the rows that count are then read from their files, in tasks that get the
places of neighbouring rows, so markup is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from string import printable
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr
from pyspark.sql.types import StructType

from sitetext.plans.workers import map_in_workers

PLACE = "place struct<file: string, row: bigint>"
#: Neighbouring rows of a file that one task reads, unless the session sets it: about those of a
#: row group, since a task decodes every row group that holds one of its rows.
ROWS_OF_A_TASK, ROWS_SETTING = 2_000, "sitetext.rows.of.a.task"
#: Rows that are decoded at once.
_ROWS_AT_ONCE = 256


def with_places(captures: DataFrame) -> DataFrame:
    """Rows read from Parquet files, with the place of each; call it right after reading."""
    return captures.withColumn(
        "place", expr("struct(_metadata.file_path AS file, _metadata.row_index AS row)")
    )


def has_places(*frames: DataFrame | None) -> bool:
    return all(f is None or "place" in f.columns for f in frames)


def _partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle of places; narrow rows must not be coalesced by their bytes."""
    wide = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(wide or spark.conf.get("spark.sql.shuffle.partitions"))


class _Cursor:
    """A string column of a file, read forward; row groups without a wanted row are passed over."""

    def __init__(self, file: str, column: str) -> None:
        self.file, self._column = file, column
        # Addresses come escaped, but for letters beyond ASCII.
        system, path = FileSystem.from_uri(quote(file, safe=printable))
        self._table = pq.ParquetFile(system.open_input_file(path))
        metadata = self._table.metadata
        sizes = [metadata.row_group(g).num_rows for g in range(metadata.num_row_groups)]
        self._group_ends = np.cumsum(sizes)
        self._until = self._begin = self._end = 0

    def _advance(self, row: int) -> None:
        """Decode up to the batch that holds a row."""
        while row >= self._end:
            if row >= self._until:
                group = int(np.searchsorted(self._group_ends, row, "right"))
                self._until = int(self._group_ends[group])
                self._end = int(self._group_ends[group - 1]) if group else 0
                self._batches = self._table.iter_batches(_ROWS_AT_ONCE, [group], [self._column])
            self._values = next(self._batches).column(0)
            self._begin, self._end = self._end, self._end + len(self._values)

    def take(self, rows: np.ndarray) -> tuple[int, pa.Array]:
        """How many of these ascending rows lie in one decoded batch, and their values."""
        self._advance(int(rows[0]))
        n = int(np.searchsorted(rows, self._end))
        return n, self._values.take(pa.array(rows[:n] - self._begin)).cast(pa.string())

    def close(self) -> None:
        self._table.close(force=True)


def _read(column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cursor = None
    for batch in batches:
        place = batch.column("place")
        files = place.field("file").to_pylist()
        if place.null_count:
            files = [f if valid else None for f, valid in zip(files, place.is_valid().to_pylist(), strict=True)]
        rows = place.field("row").to_numpy(zero_copy_only=False)
        begin = 0
        while begin < len(files):
            # Rows come sorted, so those of one file follow each other.
            end = begin
            while end < len(files) and end - begin < _ROWS_AT_ONCE and files[end] == files[begin]:
                end += 1
            if files[begin] is None:
                values = pa.nulls(end - begin, pa.string())
            else:
                if cursor is None or cursor.file != files[begin]:
                    if cursor is not None:
                        cursor.close()
                    cursor = _Cursor(files[begin], column)
                n, values = cursor.take(rows[begin:end].astype(np.int64))
                end = begin + n
            part = batch.slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays([*part.columns, values], [*part.schema.names, column])
            begin = end
    if cursor is not None:
        cursor.close()


def read_at(wanted: DataFrame, column: str = "html") -> DataFrame:
    """The rows of `wanted` with a string column read from the Parquet file each `place` names.

    Only `wanted` is shuffled, by file and neighbourhood. A row without a place gets null; a place
    may occur in any number of rows. Files must be readable by address from the executors.
    """
    rows = int(wanted.sparkSession.conf.get(ROWS_SETTING, str(ROWS_OF_A_TASK)))
    near = expr(f"place.row DIV {rows}")
    in_order = wanted.repartition(
        _partitions(wanted.sparkSession), expr("place.file"), near
    ).sortWithinPartitions("place.file", "place.row")
    schema = StructType.fromJson(wanted.schema.jsonValue()).add(column, "string")
    return map_in_workers(in_order, partial(_read, column), schema)
