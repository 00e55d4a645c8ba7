"""Removal of lines that repeat across documents.

Three passes read the documents. The first keeps two Bloom filters of line keys, once seen and
seen in a second document. The second shuffles only lines that the twice-seen filter suspects:
digest and document, which settles exactly which keys repeat and which document is the first to
hold each. The third drops lines. A filter that is too small for the input only makes more lines
suspect; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import bloom, texts
from sitetext.operators.joins import lookup
from sitetext.plans.staging import Staging

#: Shortest key, in characters, that can lose lines.
MIN_KEY_CHARS = 10
#: Size of the filter in blocks of 8 KB: 8 MB, sent to the driver once and to every executor once.
BLOCKS = 1024
#: Rows of a digest from which a lookup splits them.
_HOT_ROWS = 2_000
#: Keys a task gathers before it sends them on.
_KEYS_AT_ONCE = 1 << 20

KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_dropped", pa.int64()),
        ("text", pa.string()),
    ]
)


def _keys(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Bytes in lower case, and the key spans, rows and long-enough flags of all lines."""
    data = texts.lowered(data)
    starts, ends, rows = texts.line_spans(data, offsets)
    words = np.flatnonzero(~texts.is_space(data))
    first, after = np.searchsorted(words, starts), np.searchsorted(words, ends)
    filled = after > first
    a, b = np.zeros_like(starts), np.zeros_like(starts)
    if len(words):
        a[filled] = words[first[filled]]
        b[filled] = words[after[filled] - 1] + 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return data, a, b, rows, chars[b] - chars[a] >= min_chars, (starts, ends)


def _per_document(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Index of the first line of each distinct key of each row."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    return order[np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]] if len(order) else order


def _filter_keys(min_chars: int, blocks: int):
    def flush(hashes: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(hashes), return_counts=True)
        return bloom.key_rows(keys[counts == 1], keys[counts > 1], blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            for _, _, data, offsets in texts.pieces(batch.column(1)):
                data, a, b, rows, long, _ = _keys(data, offsets, min_chars)
                hashes, rows = texts.span_hashes(data, a[long], b[long]), rows[long]
                gathered.append(hashes[_per_document(hashes, rows)])
                n += len(gathered[-1])
                if n >= _KEYS_AT_ONCE:
                    yield flush(gathered)
                    gathered, n = [], 0
        if n:
            yield flush(gathered)

    return run


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _suspects(min_chars: int, filter_bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        for batch in batches:
            ids = batch.column(0)
            for first, _, data, offsets in texts.pieces(batch.column(1)):
                data, a, b, rows, long, _ = _keys(data, offsets, min_chars)
                a, b, rows = a[long], b[long], rows[long]
                hashes = texts.span_hashes(data, a, b)
                some = np.flatnonzero(bloom.may_contain(bits, hashes))
                some = some[_per_document(hashes[some], rows[some])]
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows[some] + first)),
                        pa.array(
                            [_digest(raw[x:y]) for x, y in zip(a[some].tolist(), b[some].tolist())],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "digest"],
                )

    return run


def _without(
    texts_: pa.Array, drops: pa.Array, min_chars: int
) -> Iterator[tuple[int, np.ndarray, list[int], pa.Array]]:
    """First row, number of lines, dropped lines and remaining texts of each piece."""
    for first, end, data, offsets in texts.pieces(texts_):
        low, a, b, rows, long, (starts, ends) = _keys(data, offsets, min_chars)
        raw, low = data.tobytes(), low.tobytes()
        borders = np.searchsorted(rows, np.arange(end - first + 1)).tolist()
        kept, n_dropped = [], []
        for i in range(end - first):
            x, y = borders[i], borders[i + 1]
            gone = drops[first + i].as_py()
            if not gone:
                kept.append(raw[offsets[i] : offsets[i + 1]])
                n_dropped.append(0)
                continue
            gone = set(gone)
            lines = [
                raw[starts[k] : ends[k]]
                for k in range(x, y)
                if not (long[k] and _digest(low[a[k] : b[k]]) in gone)
            ]
            kept.append(b"\n".join(lines))
            n_dropped.append(y - x - len(lines))
        yield first, np.diff(borders), n_dropped, pa.array(kept, pa.binary()).cast(pa.string())


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n_lines, n_dropped, kept in _without(batch.column(1), batch.column(2), min_chars):
                ids = batch.column(0).slice(first, len(kept))
                yield texts.pack(
                    {"doc_id": ids, "n_lines": n_lines, "n_dropped": n_dropped, "text": kept}, KEPT
                )

    return run


def _replace(at: int, min_chars: int):
    """All columns of a batch but the last, with the text at `at` replaced; null texts stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, drops = batch.columns[:-1], batch.columns[-1]
            for first, n_lines, _, kept in _without(own[at], drops, min_chars):
                part = [c.slice(first, len(n_lines)) for c in own]
                part[at] = pc.if_else(pc.is_null(part[at]), None, kept.cast(part[at].type))
                yield pa.RecordBatch.from_arrays(part, names=batch.schema.names[:-1])

    return run


def _repeats(source: DataFrame, min_chars: int, blocks: int) -> DataFrame:
    """Digests of the lines that each doc_id loses, from (doc_id, text) rows."""
    spark, staging = source.sparkSession, Staging(source.sparkSession)
    known = source.where("doc_id IS NOT NULL")
    keys = texts.map_batches(known, _filter_keys(min_chars, blocks), bloom.KEY_ROWS)
    bits = spark.sparkContext.broadcast(bloom.twice_filter(keys, blocks))
    suspects = staging.stage(
        texts.map_batches(known, _suspects(min_chars, bits), "doc_id bigint, digest binary"),
        "suspects",
    )
    repeated = (
        suspects.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .select("digest", "first_id")
    )
    return staging.stage(
        lookup(suspects, repeated, ["digest"], "doc_id", suspects.count(), _HOT_ROWS)
        .where("doc_id <> first_id")
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("drops")),
        "drops",
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_KEY_CHARS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row per document: doc_id, n_lines before dropping, n_dropped, and the text that stays.

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys of
    at least `min_chars` characters that at least two doc_ids hold lose all their lines except in
    the smallest doc_id. Rows with equal doc_id are one holder and are treated alike. A document
    without doc_id holds nothing and stays as it is. A null or empty text is one empty line. An
    empty table gives none, and other columns are not read.
    """
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    drops = _repeats(source, min_chars, blocks)
    return texts.map_batches(
        source.join(drops, "doc_id", "left"),
        _drop(min_chars),
        "doc_id bigint, n_lines bigint, n_dropped bigint, text string",
    )


def without_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_KEY_CHARS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """The rows of `docs` with all their columns, their texts without repeated lines."""
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    names = {"doc_id": texts.free_name(docs, "of"), "drops": texts.free_name(docs, "gone")}
    drops = _repeats(source, min_chars, blocks).withColumnsRenamed(names)
    joined = docs.join(drops, docs[id_col].cast("bigint") == drops[names["doc_id"]], "left")
    return texts.map_batches(
        joined.drop(names["doc_id"]), _replace(docs.columns.index(text_col), min_chars), docs.schema
    )
