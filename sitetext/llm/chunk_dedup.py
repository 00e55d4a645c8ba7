"""Repeated passages found by content-defined chunks.

A gear hash rolls over the bytes of a text: each byte shifts the hash by one bit and adds a random
number, so the hash depends on the last 32 bytes only. A chunk ends where the upper bits are zero.
An insertion moves the borders near it and no others, so a passage has the same chunks wherever it
stands. Chunks are compared by digest; neighbouring chunks that other documents hold as well join
to runs. A run is a seed: both its ends are extended by comparing the text there with the text around
the same chunk in the first and the last document that hold it, so passages are reported whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sitetext.llm import bloom, texts
from sitetext.operators.joins import lookup
from sitetext.plans.staging import Staging

#: Bits that must be zero at a border: a chunk has 2 ** ZERO_BITS bytes on average.
ZERO_BITS = 5
#: Bytes the hash depends on.
GEAR_WINDOW = 32
#: A border needs this many bytes without another since the last; longer chunks than MAX are cut.
MIN_BYTES, MAX_BYTES = 12, 1024
#: Bytes of a passage before its first border that may have borders of one document only.
_HEAD_BYTES = GEAR_WINDOW + MIN_BYTES + 4
#: Fewest words of an extended run that make a passage.
MIN_WORDS = 20

#: Blocks of 8 KB of the filter of repeated digests. A fuller filter lets more chunks through.
BLOCKS = 1024
#: Rows of a digest from which a lookup splits them.
_HOT_ROWS = 2_000

_GEAR = np.random.default_rng(19937).integers(0, 2**32, 256, dtype=np.uint32)

_CHUNKS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
     ("n_words", pa.int32()), ("high", pa.int64()), ("low", pa.int64()),
     ("before", pa.string()), ("after", pa.string())]
)
_CHUNKS_DDL = (
    "doc_id bigint, start bigint, end bigint, n_words int, high bigint, low bigint, "
    "before string, after string"
)
_EDGES = pa.schema(
    [("doc_id", pa.int64()), ("run", pa.int64()), ("side", pa.int32()), ("more", pa.int64()),
     ("words", pa.int64())]
)
_EDGES_DDL = "doc_id bigint, run bigint, side int, more bigint, words bigint"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, summed in doubling steps."""
    h, step = _GEAR[data], 1
    while step < GEAR_WINDOW:
        with np.errstate(over="ignore"):
            h[step:] += h[:-step].copy() << np.uint32(step)
        step *= 2
    return h


def _to_characters(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Cuts moved on to the next first byte of a character, at most three bytes."""
    for _ in range(3):
        cuts = cuts + ((data[np.minimum(cuts, len(data) - 1)] & 0xC0) == 0x80)
    return cuts


def chunk_starts(data: np.ndarray, offsets: np.ndarray, zero_bits: int = ZERO_BITS) -> np.ndarray:
    """Where chunks begin; each ends where the next begins. Borders lie between characters."""
    if not len(data):
        return np.zeros(0, np.int64)
    cuts = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - zero_bits) == 0) + 1
    cuts = cuts[np.diff(cuts, prepend=-MIN_BYTES) >= MIN_BYTES]
    cuts = cuts[cuts < len(data)]
    # The hash has seen other rows before the first GEAR_WINDOW bytes of a row.
    cuts = cuts[cuts - offsets[np.searchsorted(offsets, cuts, "right") - 1] >= GEAR_WINDOW]
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], _to_characters(data, cuts)]))
    starts = starts[starts < len(data)]
    sizes = np.diff(starts, append=len(data))
    parts = -(-sizes // MAX_BYTES)
    if parts.max() > 1:
        heads = np.cumsum(parts) - parts
        within = np.arange(parts.sum()) - np.repeat(heads, parts)
        starts = np.unique(_to_characters(data, np.repeat(starts, parts) + within * MAX_BYTES))
        starts = starts[starts < len(data)]
    return starts


def _chunk_rows(data: np.ndarray, offsets: np.ndarray, zero_bits: int):
    starts = chunk_starts(data, offsets, zero_bits)
    ends = np.r_[starts[1:], len(data)].astype(np.int64)[: len(starts)]
    rows = np.searchsorted(offsets, starts, "right") - 1
    return (
        starts,
        ends,
        rows,
        texts.span_hashes(data, starts, ends),
        texts.span_hashes(data, starts, ends, texts.OTHER_KEYS),
    )


def _digests(zero_bits: int):
    """Digests of each document's chunks, each once per document of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, _, data, offsets in texts.pieces(batch.column(1)):
                _, _, rows, high, low = _chunk_rows(data, offsets, zero_bits)
                # The first and the last document of the piece that hold a digest, by number.
                doc_ids = ids.take(pa.array(rows + first)).to_numpy(zero_copy_only=False)
                order = np.lexsort((doc_ids, low, high))
                h, l, d = high[order], low[order], doc_ids[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (l[1:] != l[:-1])][: len(h)]
                heads = np.flatnonzero(new)
                tails = np.r_[heads[1:], len(h)][: len(heads)] - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x)
                        for x in (h[heads].view(np.int64), l[heads].view(np.int64), d[heads], d[tails])
                    ],
                    names=["high", "low", "first_id", "last_id"],
                )

    return run


def _filter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy().view(np.uint64)
        yield bloom.key_rows(keys[:0], keys, BLOCKS)


def _suspects(zero_bits: int, filter_bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        for batch in batches:
            ids = batch.column(0)
            for first, _, data, offsets in texts.pieces(batch.column(1)):
                starts, ends, rows, high, low = _chunk_rows(data, offsets, zero_bits)
                some = np.flatnonzero(bloom.may_contain(bits, high))
                # A passage begins in the chunk before its first one or less than _HEAD_BYTES
                # before that chunk, and ends in the chunk after its last one.
                heads, tails = offsets[rows], offsets[rows + 1]
                lows = np.maximum(heads, np.r_[0, starts[:-1]][: len(starts)] - _HEAD_BYTES)
                highs = np.minimum(tails, np.r_[ends[1:], len(data)][: len(ends)])
                raw = data.tobytes()
                before = [raw[a:b].decode(errors="ignore") for a, b in zip(lows[some].tolist(), starts[some].tolist())]
                # The last character of the chunk tells whether a word begins after it.
                lasts = ends[some] - 1
                for _ in range(3):
                    lasts = lasts - ((data[lasts] & 0xC0) == 0x80)
                after = [raw[a:b].decode() for a, b in zip(lasts.tolist(), highs[some].tolist())]
                starts, ends, rows = starts[some], ends[some], rows[some]
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                word_starts = texts.word_spans(data, offsets)[0]
                words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
                skipped = chars[offsets[rows]]
                yield texts.pack(
                    {
                        "doc_id": ids.take(pa.array(rows + first)),
                        "start": chars[starts] - skipped,
                        "end": chars[ends] - skipped,
                        "n_words": words,
                        "high": high[some].view(np.int64),
                        "low": low[some].view(np.int64),
                        "before": before,
                        "after": after,
                    },
                    _CHUNKS,
                )

    return run


def _n_words(text: str, previous: str) -> int:
    """Words that begin in a text after this character; none is the beginning of a document."""
    n, space = 0, not previous or previous in _BLANKS
    for c in text:
        blank = c in _BLANKS
        n += space and not blank
        space = blank
    return n


_BLANKS = frozenset(" \t\n\x0b\x0c\r")


def _extensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How far the text at the edge of each run is that of another document, and its words.

    Side 0 is before the run, side 1 after it; the latter's texts begin with the last character of
    the run.
    """
    for batch in batches:
        found = []
        columns = (batch.column(n).to_pylist() for n in ("side", "own", "others"))
        for side, own, others in zip(*columns, strict=True):
            if side == 0:
                back = own[::-1]
                more = max(len(commonprefix([back, x[::-1]])) for x in others)
                at = len(own) - more
                found.append((more, _n_words(own[at:], own[at - 1 : at] if at else "")))
            else:
                more = max(len(commonprefix([own, x])) for x in others)
                found.append((more - 1, _n_words(own[1:more], own[0])))
        given = {n: batch.column(n) for n in ("doc_id", "run", "side")}
        yield texts.pack(given | {n: [x[i] for x in found] for i, n in enumerate(("more", "words"))}, _EDGES)


def _place_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _hashed_places(batch)
        yield bloom.key_rows(keys[:0], keys, BLOCKS)


def _hashed_places(batch: pa.RecordBatch) -> np.ndarray:
    doc_ids, starts = (batch.column(c).to_numpy().view(np.uint64) for c in ("doc_id", "start"))
    with np.errstate(over="ignore"):
        return texts.mixed(texts.mixed(doc_ids) + starts)


def _at_places(filter_bits):
    """The rows whose place may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        for batch in batches:
            yield batch.filter(pa.array(bloom.may_contain(bits, _hashed_places(batch))))

    return run


def _edge_extensions(
    runs: DataFrame, suspects: DataFrame, staging: Staging, later_only: bool
) -> DataFrame:
    """For each run and side, how far it goes on as in the first or the last holder of its last
    chunk on that side; `later_only` looks at the first. Texts are read at the places of such
    chunks only."""
    spark = runs.sparkSession
    refs = staging.stage(
        runs.selectExpr("doc_id", "run", "posexplode(array(head.chunk, tail.chunk)) AS (side, c)")
        .selectExpr(
            "doc_id AS of", "run", "side",
            "inline(array(struct(0 AS role, doc_id, c.start AS start), "
            "struct(1 AS role, c.a.doc_id AS doc_id, c.a.start AS start), "
            "struct(2 AS role, c.b.doc_id AS doc_id, c.b.start AS start)))",
        )
        .where("role = 0 OR doc_id <> of")
        .where(f"role < {2 if later_only else 3}"),
        "refs",
    )
    wanted = staging.stage(refs.select("doc_id", "start").distinct(), "places")
    keys = texts.map_batches(wanted, _place_keys, bloom.KEY_ROWS)
    bits = spark.sparkContext.broadcast(bloom.twice_filter(keys, BLOCKS))
    columns = "doc_id", "start", "before", "after"
    near = texts.map_batches(
        suspects.select(*columns), _at_places(bits),
        "doc_id bigint, start bigint, before string, after string",
    )
    # Rows with equal doc_id are one document; of their texts at a place one is taken.
    edges = staging.stage(
        near.join(wanted, ["doc_id", "start"], "left_semi")
        .groupBy("doc_id", "start")
        .agg(F.min(F.struct("before", "after")).alias("t"))
        .select("doc_id", "start", "t.before", "t.after"),
        "edges",
    )
    found = (
        lookup(refs, edges, ["doc_id", "start"], "struct(of, run, side)", refs.count(), _HOT_ROWS)
        .selectExpr("of AS doc_id", "run", "side", "role", "if(side = 0, before, after) AS text")
        .groupBy("doc_id", "run", "side")
        .agg(
            F.expr("max(text) FILTER (WHERE role = 0)").alias("own"),
            F.expr("collect_list(text) FILTER (WHERE role > 0)").alias("others"),
        )
    )
    return texts.map_batches(found, _extensions, _EDGES_DDL)


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    zero_bits: int = ZERO_BITS,
    later_only: bool = False,
) -> DataFrame:
    """One row per passage that other documents hold as well: doc_id, start, end (code points,
    end exclusive), n_words, n_chunks and first_id, the smallest doc_id that holds a chunk of it.

    A passage is a run of neighbouring chunks that at least two doc_ids hold, extended at both ends
    as far as the text is that of the first or the last other doc_id that holds the chunk there,
    with at least `min_words` words that begin in it. The document with first_id gets a row too. With
    `later_only`, passages are made of chunks that a smaller doc_id holds, and extended as in the
    smallest, so that all of them can go and every text stays somewhere. Rows with equal doc_id are one document. Null, empty and short
    texts have no passages; a document without doc_id is left out. An empty table gives none, and
    other columns are not read.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    source = docs.selectExpr(
        f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text"
    ).where("doc_id IS NOT NULL")
    digests = texts.map_batches(
        source, _digests(zero_bits), "high bigint, low bigint, first_id bigint, last_id bigint"
    )
    repeated = staging.stage(
        digests.groupBy("high", "low")
        .agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
        .where("first_id < last_id")
        .select("high", "low"),
        "repeated",
    )
    keys = texts.map_batches(repeated.select("high"), _filter_rows, bloom.KEY_ROWS)
    bits = spark.sparkContext.broadcast(bloom.twice_filter(keys, BLOCKS))
    suspects = staging.stage(
        texts.map_batches(source, _suspects(zero_bits, bits), _CHUNKS_DDL), "suspects"
    )
    narrow = suspects.drop("before", "after")
    place = F.struct("doc_id", "start")
    holders = staging.stage(
        narrow.groupBy("high", "low")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where("a.doc_id < b.doc_id"),
        "holders",
    )
    held = (
        lookup(narrow, holders, ["high", "low"], "doc_id", suspects.count(), _HOT_ROWS)
        .where("a IS NOT NULL")
        .groupBy("doc_id", "start", "end", "n_words")
        .agg(F.min("a.doc_id").alias("first_id"), F.min(F.struct("a", "b")).alias("c"))
    )
    if later_only:
        held = held.where("first_id < doc_id")
    along = Window.partitionBy("doc_id").orderBy("start", "end")
    parts = held.withColumn(
        "begins", F.expr("start <> lag(end, 1, -1) OVER (PARTITION BY doc_id ORDER BY start, end)")
    ).withColumn("run", F.sum(F.col("begins").cast("bigint")).over(along))
    chunk = F.struct("start", "c.a", "c.b").alias("chunk")
    runs = staging.stage(
        parts.groupBy("doc_id", "run").agg(
            F.min(F.struct("start", chunk)).alias("head"),
            F.max(F.struct("end", chunk)).alias("tail"),
            F.sum("n_words").cast("bigint").alias("n_words"),
            F.count("*").alias("n_chunks"),
            F.min("first_id").alias("first_id"),
        ),
        "runs",
    )
    sides = _edge_extensions(runs, suspects, staging, later_only).groupBy("doc_id", "run").agg(
        *(
            F.expr(f"max({value}) FILTER (WHERE side = {side})").alias(f"{value}_{side}")
            for side in (0, 1)
            for value in ("more", "words")
        )
    )
    return (
        runs.join(sides, ["doc_id", "run"])
        .selectExpr(
            "doc_id",
            "head.start - more_0 AS start",
            "tail.end + more_1 AS end",
            "n_words + words_0 + words_1 AS n_words",
            "n_chunks",
            "first_id",
        )
        .where(f"n_words >= {min_words}")
    )


def without_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    zero_bits: int = ZERO_BITS,
) -> DataFrame:
    """The rows of `docs` with all their columns, their texts without passages that a smaller doc_id
    holds. Rows with equal doc_id lose the same places; rows without doc_id or text stay."""
    of, gone = texts.free_name(docs, "of"), texts.free_name(docs, "gone")
    spans = (
        repeated_passages(docs, id_col, text_col, min_words, zero_bits, later_only=True)
        .groupBy(F.col("doc_id").alias(of))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(gone))
    )
    text = f"`{text_col}`"
    upto = f"substring({text}, CAST(k.at AS int) + 1, CAST(greatest(s.start - k.at, 0) AS int))"
    kept = (
        f"aggregate({gone}, named_struct('at', 0L, 'parts', CAST(array() AS array<string>)), "
        f"(k, s) -> named_struct('at', greatest(k.at, s.end), 'parts', concat(k.parts, array({upto}))), "
        f"k -> concat(array_join(k.parts, ''), substring({text}, CAST(k.at AS int) + 1)))"
    )
    joined = docs.join(spans, docs[id_col].cast("bigint") == spans[of], "left")
    changed = joined.withColumn(text_col, F.expr(f"if({gone} IS NULL, {text}, {kept})"))
    return changed.select(*[f"`{c}`" for c in docs.columns])
