"""Texts of a batch as bytes, their words and lines as spans, and 64-bit hashes of spans.

Everything here works on one Arrow batch inside a task. A batch is cut into pieces of a few
megabytes at document borders, so the memory of a task does not grow with the batch; only a single
long document makes a longer piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 22
#: Rows of a batch that are copied at once.
_ROWS_AT_ONCE = 4096

_ROOT = str(Path(__file__).resolve().parents[2])
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEYS = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
#: Another key per byte, for a second hash that is independent of the first.
OTHER_KEYS = np.random.default_rng(20240301).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LOW = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, _LOW)


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """`df.mapInArrow`, with this package importable in the workers of a local session."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *filter(None, paths)])
    return df.mapInArrow(function, schema)


def free_name(df: DataFrame, name: str) -> str:
    """The name with as many underscores before it as no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    filled = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = filled.buffers()
    n = len(filled)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def as_bytes_of_binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and the offsets of its rows; null counts as empty."""
    filled = values.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = filled.buffers()
    n = len(filled)
    offsets = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    texts: pa.Array, limit: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and offsets of each piece of a string column."""
    for begin in range(0, len(texts), _ROWS_AT_ONCE):
        data, offsets = as_bytes(texts.slice(begin, _ROWS_AT_ONCE))
        first, n = 0, len(offsets) - 1
        while first < n:
            end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            end = min(n, max(first + 1, end))
            part = data[offsets[first] : offsets[end]]
            yield begin + first, begin + end, part, offsets[first : end + 1] - offsets[first]
            first = end


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def is_space(data: np.ndarray) -> np.ndarray:
    """True at space and at the bytes 9 to 13."""
    return _SPACE[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that are not white space."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each line; every row has one line more than it has newlines."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets)
    n_lines = np.diff(before) + 1
    rows = np.repeat(np.arange(len(offsets) - 1), n_lines)
    heads = np.cumsum(n_lines) - n_lines
    starts, ends = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    is_head, is_tail = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    is_head[heads] = is_tail[heads + n_lines - 1] = True
    starts[is_head], ends[is_tail] = offsets[:-1], offsets[1:]
    starts[~is_head], ends[~is_tail] = breaks + 1, breaks
    return starts, ends, rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of spans that are hashed at once; a longer span is a block of its own.
_HASHED_BYTES = 1 << 21


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray = _KEYS
) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span lies."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    some = np.flatnonzero(lengths > 0)
    until = np.cumsum(lengths[some])
    first = 0
    while first < len(some):
        before = until[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(until, before + _HASHED_BYTES, "right")))
        block = some[first:end]
        out[block] = _block_hashes(data, starts[block], lengths[block], keys)
        first = end
    with np.errstate(over="ignore"):
        return mixed(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _block_hashes(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray
) -> np.ndarray:
    heads = np.cumsum(sizes) - sizes
    within = np.arange(heads[-1] + sizes[-1]) - np.repeat(heads, sizes)
    values = keys[data[within + np.repeat(starts, sizes)]]
    with np.errstate(over="ignore"):
        values *= _POWERS[within & (_LOW - 1)]
        if sizes.max() > _LOW:
            step = pow(_BASE, _LOW, 2**64)
            values *= _powers(step, int(sizes.max() >> 16) + 1)[within >> 16]
        return np.add.reduceat(values, heads)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each distinct hash, and for each hash the number of its kind."""
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    return first, kind.reshape(-1)


def sums_by_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def pack(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of these columns in the order and types of a schema."""
    arrays = [
        x.cast(f.type) if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
