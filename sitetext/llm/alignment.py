"""Which tokens of two vocabularies share text, by merging their borders in lockstep.

Vocabulary A is a byte-level one for the tokenizers library, B a piece vocabulary with byte
fallback; both encode a blank and the text. Tokens become byte ranges. One pair of pointers per
document walks over the ends of A and B tokens: each step links the two tokens under the pointers
and moves the pointer whose token ends first, or both at a common end, which closes a group. All
documents of a piece of text step together as one vector, finished ones are taken out, and long
documents enter as several lanes, cut between A tokens.

The first pass encodes, aligns, counts id pairs in the task, and stages the ids. The second pass
aligns the staged ids again and adds up the corpus-wide counts of the links: those of the most
frequent pairs are broadcast, all others are joined.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sitetext.llm import texts
from sitetext.llm.bpe import _byte_characters
from sitetext.llm.span_ids import Ids, SpanIds, gathered
from sitetext.plans.staging import Staging

#: Bytes of text that are aligned at once.
PIECE_BYTES = 1 << 20
#: A tokens of a lane.
LANE_TOKENS = 64
#: At most this many id pairs are broadcast with their counts, 17 bytes each.
BROADCAST_PAIRS = 500_000
#: Distinct pairs that a task counts before it hands them on.
TASK_PAIRS = 2_000_000
#: Ids that are written out as text at once.
_WRITTEN_IDS = 1 << 18
#: Counts of pairs are told apart by this many steps per power of two when the broadcast is chosen.
_STEPS = 8

_DOC = (
    "doc_id {key}, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string"
)
_STAGED = _DOC + ", a binary, b binary, pair bigint, n bigint"
_SUMMED = _DOC + ", n_best bigint, count_sum bigint, rare array<bigint>, rare_n array<bigint>"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Vocabularies:
    """Both vocabularies: ids of spans of text, and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._a = Tokenizer.from_file(path_a)
        self._a.no_truncation()
        self._a.no_padding()
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_char = {c: b for b, c in enumerate(_byte_characters())}
        self.n_a, self.n_b = self._a.get_vocab_size(), len(self._b)
        bytes_a = [
            bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
            for token in map(self._a.id_to_token, range(self.n_a))
        ]
        pieces = [self._b.id_to_piece(i) for i in range(self.n_b)]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a, self.b = _Strings(bytes_a), _Strings(bytes_b)
        self.written = _Strings([str(i).encode() for i in range(max(self.n_a, self.n_b))])
        self._break_a = self._a.encode("\n", add_special_tokens=False).ids
        self._break_b = self._b.encode("\n")[1:]
        with open(path_a, encoding="utf-8") as f:
            cuts = json.load(f)["pre_tokenizer"]
        #: Whether both encode the spans of `spans` independently.
        self.splits = (
            cuts["type"] == "ByteLevel"
            and cuts["use_regex"]
            and len(self._break_a) == len(self._break_b) == 1
            and not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        )
        self.spans = SpanIds(self._encode)

    def _encode(self, spans: list[bytes]) -> tuple[Ids, Ids]:
        """Ids of all spans, in one call per vocabulary with a newline between spans."""
        plain = _plain(spans) if self.splits else np.zeros(len(spans), bool)
        place = np.argsort(~plain, kind="stable")
        joined = [spans[i] for i in place[: plain.sum()].tolist()]
        rest = [spans[i].decode() for i in place[plain.sum() :].tolist()]
        joined = b"\n".join([b"", *joined]).decode() if joined else ""
        out = []
        for encode, mark, before, alone in (
            (self._ids_a, self._break_a, 0, self._ids_a),
            (self._b.encode, self._break_b, 1, self._ids_b),
        ):
            flat = np.array(encode(joined), np.uint32)[before:]
            marks = np.flatnonzero(flat == mark[0])
            sizes = np.diff(np.append(marks, len(flat))) - 1
            lists = [alone(s) for s in rest]
            flat = np.concatenate([np.delete(flat, marks), *(np.array(x, np.uint32) for x in lists)])
            sizes = np.concatenate([sizes, [len(x) for x in lists]]).astype(np.int64)
            lengths, heads = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
            lengths[place], heads[place] = sizes, np.cumsum(sizes) - sizes
            out.append((gathered(flat, heads, lengths), lengths))
        return out[0], out[1]

    def _ids_a(self, text: str) -> list[int]:
        return self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _ids_b(self, span: str) -> list[int]:
        """Ids of a span within a text, or of a whole text after the blank that the model adds."""
        return self._b.encode("\n" + span)[2:] if self.splits else self._b.encode(span[1:])


class _Strings:
    """Byte strings by number, flat."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def _plain(spans: list[bytes]) -> np.ndarray:
    """Whether spans hold no white space and no control marks but, at most, one blank at the start."""
    if not spans:
        return np.zeros(0, bool)
    data = np.frombuffer(b"".join(spans), np.uint8)
    sizes = np.array([len(s) for s in spans])
    heads = np.cumsum(sizes) - sizes
    blank = data[heads] == 32
    plain = np.add.reduceat((data <= 32) | (data == 127), heads, dtype=np.int64) == blank
    plain &= sizes > blank
    wide = np.logical_or.reduceat((data == 0xC2) | (data >= 0xE1), heads)
    for i in np.flatnonzero(plain & wide).tolist():
        plain[i] = len(spans[i].decode().split()) == 1 and spans[i].decode().strip() == (
            spans[i].decode().removeprefix(" ")
        )
    return plain


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of parts that both vocabularies encode independently.

    A part starts at a blank after a mark that is no white space, and round a newline that stands
    between two visible ASCII characters.
    """
    visible = (data > 32) & (data < 127)
    after = visible.copy()
    after |= data >= 128
    c2 = np.flatnonzero(data == 0xC2) + 1
    c2 = c2[c2 < len(data)]
    after[c2[(data[c2] == 0x85) | (data[c2] == 0xA0)]] = False
    for lead, second in ((0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        at = np.flatnonzero(data == lead) + 2
        at = at[at < len(data)]
        after[at[np.isin(data[at - 1], second)]] = False
    first = np.zeros(len(data), bool)
    first[1:] = (data[1:] == 32) & after[:-1]
    lines = np.flatnonzero((data[1:-1] == 10) & visible[:-2] & visible[2:]) + 1
    first[lines] = first[lines + 1] = True
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(data))


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, lane: int = LANE_TOKENS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of all documents of a piece.

    The ends of tokens are offsets in the piece, `first_a` has the first A token of each document.
    Returns the A and B tokens of each link, and whether each A token and each B token ends a
    group.
    """
    n_a = len(ends_a)
    cut_a, cut_b = np.zeros(n_a, bool), np.zeros(len(ends_b), bool)
    if not n_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), cut_a, cut_b
    until = np.append(first_a[1:], n_a)
    lanes = -(-(until - first_a) // lane)
    within = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = np.repeat(first_a, lanes) + lane * within
    stop = np.minimum(a + lane, np.repeat(until, lanes))
    b = np.searchsorted(ends_b, np.where(a > 0, ends_a[a - 1], 0), "right")
    links_a, links_b = [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a[a[both]] = cut_b[b[both]] = True
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


def _group_digests(
    words: Vocabularies, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray,
    docs_a: np.ndarray, docs_b: np.ndarray,
) -> list[str]:
    """SHA-256 of the written groups of each document; docs_a, docs_b count its tokens."""
    n = len(a) + len(b)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    n_groups = int(cut_a.sum())
    of_a = np.cumsum(np.bincount(group_a, minlength=n_groups))
    of_b = np.cumsum(np.bincount(group_b, minlength=n_groups))
    ids, marks = np.empty(n, np.int64), np.empty(n, np.uint8)
    at_a = np.arange(len(a)) + np.concatenate([[0], of_b])[group_a]
    at_b = np.arange(len(b)) + of_a[group_b]
    ids[at_a], ids[at_b] = a, b
    marks[at_a], marks[at_b] = np.where(cut_a, 124, 44), np.where(cut_b, 59, 44)
    ends = np.cumsum(docs_a + docs_b)
    digests, doc = [hashlib.sha256() for _ in ends], 0
    for begin in range(0, n, _WRITTEN_IDS):
        end = min(n, begin + _WRITTEN_IDS)
        part = ids[begin:end]
        sizes = words.written.sizes[part] + 1
        stops = np.cumsum(sizes)
        text = np.empty(int(stops[-1]), np.uint8)
        is_digit = np.ones(len(text), bool)
        is_digit[stops - 1] = False
        text[~is_digit] = marks[begin:end]
        text[is_digit] = gathered(words.written.data, words.written.starts[part], sizes - 1)
        raw, at = memoryview(text), 0
        while at < len(raw):
            done = ends[doc] <= end
            stop = int(stops[ends[doc] - begin - 1]) if done else len(raw)
            digests[doc].update(raw[at : stop - 1 if done else stop])
            at = stop
            doc += done
    return [d.hexdigest() for d in digests]


class _Pairs:
    """Counts of id pairs in a task."""

    def __init__(self) -> None:
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, pairs: np.ndarray) -> None:
        kind, found = pd.factorize(pairs)
        self._parts.append((found, np.bincount(kind)))
        self.size += len(found)
        if len(self._parts) > 1 and self.size > 2 * len(self._parts[0][0]) + 100_000:
            self._parts = [self.total()]
            self.size = len(self._parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self._parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind, found = pd.factorize(np.concatenate([p for p, _ in self._parts]))
        counts = np.concatenate([c for _, c in self._parts])
        return found, np.bincount(kind, weights=counts).astype(np.int64)


class _Aligned:
    """The documents of a piece that both vocabularies write as they are, aligned."""

    def __init__(
        self, words: Vocabularies, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
    ) -> None:
        self.words, self.a, self.b, self.n_a, self.n_b = words, a, b, n_a, n_b
        some = n_a > 0
        first_a = (np.cumsum(n_a) - n_a)[some]
        ends_a, ends_b = np.cumsum(words.a.sizes[a]), np.cumsum(words.b.sizes[b])
        self.link_a, link_b, self.cut_a, self.cut_b = lockstep(ends_a, ends_b, first_a)
        self.pairs = a[self.link_a].astype(np.int64) * words.n_b + b[link_b]
        self.doc_of_a = np.repeat(np.arange(len(n_a)), n_a)

    def per_doc(self, tokens_a: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        got = np.bincount(self.doc_of_a[tokens_a], weights, len(self.n_a))
        return got.astype(np.int64)

    def digests(self) -> list[str]:
        some = self.n_a > 0
        found = iter(
            _group_digests(
                self.words, self.a, self.b, self.cut_a, self.cut_b, self.n_a[some], self.n_b[some]
            )
        )
        return [next(found) if x else "" for x in some.tolist()]


def _written(data: np.ndarray, ids: np.ndarray, strings: _Strings) -> np.ndarray:
    return data == gathered(strings.data, strings.starts[ids], strings.sizes[ids])


def _encoded(words: Vocabularies, data: np.ndarray, offsets: np.ndarray) -> _Aligned:
    starts, ends = spans(data, offsets) if words.splits else (offsets[:-1], offsets[1:])
    starts, ends = starts[ends > starts], ends[ends > starts]
    rows = np.searchsorted(offsets, starts, "right") - 1
    n = len(offsets) - 1
    both = words.spans.of(data.tobytes(), starts, ends, texts.span_hashes(data, starts, ends))
    good = np.ones(n, bool)
    sizes = np.diff(offsets)
    per_doc = []
    for (ids, lengths), strings in zip(both, (words.a, words.b), strict=True):
        counts = np.bincount(rows, lengths, n).astype(np.int64)
        doc = np.repeat(np.arange(n), counts)
        good &= np.bincount(doc, strings.sizes[ids], n) == sizes
        per_doc.append((ids, counts, doc))
    for (ids, _, doc), strings in zip(per_doc, (words.a, words.b), strict=True):
        inside = np.repeat(good, sizes)
        equal = np.zeros(len(data), bool)
        equal[inside] = _written(data[inside], ids[good[doc]], strings)
        wrong = np.searchsorted(offsets, np.flatnonzero(inside & ~equal), "right") - 1
        good[wrong] = False
    (a, n_a, doc_a), (b, n_b, doc_b) = per_doc
    return _Aligned(words, a[good[doc_a]], b[good[doc_b]], n_a * good, n_b * good)


def _slices(ids: np.ndarray, counts: np.ndarray, kind: str) -> list[bytes]:
    raw, size = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
    ends = (np.cumsum(counts) * size).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _id_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


def _align(
    paths: tuple[str, str], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    words = vocabularies(*paths)
    counted, row, schema = _Pairs(), TaskContext.get().partitionId() << 36, None
    for batch in batches:
        key = batch.schema.field(0).type
        for first, end, data, offsets in texts.pieces(batch.column(1), PIECE_BYTES):
            n = end - first
            found = _encoded(words, data, offsets)
            counted.add(found.pairs)
            columns = {
                "doc_id": batch.column(0).slice(first, n),
                "row": np.arange(row, row + n),
                "n_a": found.n_a,
                "n_b": found.n_b,
                "n_groups": found.per_doc(np.flatnonzero(found.cut_a)),
                "n_links": found.per_doc(found.link_a),
                "groups_sha256": found.digests(),
                "a": _slices(found.a, found.n_a, _id_type(words.n_a)),
                "b": _slices(found.b, found.n_b, _id_type(words.n_b)),
                "pair": pa.nulls(n, pa.int64()),
                "n": pa.nulls(n, pa.int64()),
            }
            schema = _schema(_STAGED, key)
            yield texts.pack(columns, schema)
            row += n
            if counted.size > TASK_PAIRS:
                yield from _count_rows(counted, schema)
                counted = _Pairs()
    if schema is not None:
        yield from _count_rows(counted, schema)
    words.spans.forget()


def _schema(ddl: str, key: pa.DataType) -> pa.Schema:
    of = {
        "{key}": key, "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, of[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _count_rows(counted: _Pairs, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    pairs, counts = counted.total()
    for begin in range(0, len(pairs), 1 << 17):
        part = slice(begin, begin + (1 << 17))
        n = len(pairs[part])
        columns = {f.name: pa.nulls(n, f.type) for f in schema}
        yield texts.pack(columns | {"pair": pairs[part], "n": counts[part]}, schema)


def _sum_up(
    paths: tuple[str, str], head, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    words = vocabularies(*paths)
    known, counts, best = head.value
    known = pd.Index(known)
    for batch in batches:
        schema = _schema(_SUMMED, batch.schema.field(0).type)
        a, b = batch.column("a"), batch.column("b")
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        bounds = np.cumsum(n_a)
        first = 0
        while first < len(batch):
            before = bounds[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(bounds, before + PIECE_BYTES // 2, "right")))
            rows = slice(first, end)
            ids_a = np.frombuffer(b"".join(a[rows].to_pylist()), _id_type(words.n_a))
            ids_b = np.frombuffer(b"".join(b[rows].to_pylist()), _id_type(words.n_b))
            found = _Aligned(words, ids_a, ids_b, n_a[rows], n_b[rows])
            kind, pairs = pd.factorize(found.pairs)
            at = known.get_indexer(pairs)
            of_kind = np.where(at < 0, 0, counts[at]) if len(counts) else 0 * at
            is_best = (at >= 0) & best[at] if len(best) else at >= 0
            rest = np.flatnonzero((at < 0)[kind])
            doc = found.doc_of_a[found.link_a[rest]]
            # The links of rarer pairs, each pair of a document once.
            rare = pd.DataFrame({"doc": doc, "pair": pairs[kind[rest]]}).value_counts(sort=False)
            rare = rare.sort_index()
            docs = rare.index.get_level_values(0).to_numpy()
            offsets = pa.array(np.searchsorted(docs, np.arange(end - first + 1)), pa.int32())
            kept = batch.select([f.name for f in schema][:7]).slice(first, end - first)
            yield texts.pack(
                dict(zip(kept.schema.names, kept.columns, strict=True))
                | {
                    "n_best": found.per_doc(found.link_a, is_best[kind]),
                    "count_sum": _exact_sums(found, of_kind[kind]),
                    "rare": pa.ListArray.from_arrays(
                        offsets, pa.array(rare.index.get_level_values(1).to_numpy(), pa.int64())
                    ),
                    "rare_n": pa.ListArray.from_arrays(offsets, pa.array(rare.to_numpy())),
                },
                schema,
            )
            first = end


def _exact_sums(found: _Aligned, counts: np.ndarray) -> np.ndarray:
    """Sums of whole numbers per document, without rounding."""
    doc = found.doc_of_a[found.link_a]
    low, high = counts & 0xFFFFF, counts >> 20
    n = len(found.n_a)
    sums = [np.bincount(doc, part, n).astype(np.int64) for part in (low, high)]
    return sums[0] + (sums[1] << 20)


def _head(pairs: DataFrame, limit: int) -> tuple[int, int]:
    """From which step of counts on there are at most `limit` pairs; how many pairs lie below."""
    step = f"CAST(floor({_STEPS} * log2(n)) AS int)"
    sizes = dict(map(tuple, pairs.groupBy(pairs.n.alias("n")).count().selectExpr(
        f"{step} AS step", "count").groupBy("step").sum("count").collect()))
    total, least = 0, math.inf
    for at in sorted(sizes, reverse=True):
        if total + sizes[at] > limit:
            break
        total, least = total + sizes[at], at
    return least, sum(sizes.values()) - total


def aligned_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    paths: tuple[str, str] | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """How the tokens of two vocabularies share the text of each document.

    One row per row of `docs`: doc_id, n_a and n_b (tokens), n_groups (runs between places where
    tokens of both end), n_links (pairs of tokens with bytes in common), groups_sha256, n_best (links
    whose id pair is the most frequent of its B id in all of `docs`, ties included) and count_sum
    (the corpus-wide counts of the pairs of all links). groups_sha256 is of the groups in the form
    `a1,a2|b1;a3|b2,b3`.

    `paths` names a tokenizers file and a sentencepiece model that the executors can read, by
    default the public ones. A null or empty text, and one that the joined bytes of either side's
    tokens don't give back, has no tokens: zeros and an empty groups_sha256. Rows are independent
    but for the counts, to which repeated rows add again; a null id stays null, an empty table gives
    none, and other columns are not read. `broadcast_pairs` bounds the pairs whose counts are
    broadcast; the others are joined, with the same result.
    """
    paths = paths or default_paths()
    spark = docs.sparkSession
    key = docs.schema[id_col].dataType.simpleString()
    staging = Staging(spark)
    source = docs.selectExpr(
        f"`{id_col}` AS doc_id",
        f"CASE WHEN `{text_col}` <> '' THEN concat(' ', `{text_col}`) END AS text",
    )
    schema = _STAGED.format(key=key)
    both = staging.stage(texts.map_batches(source, partial(_align, paths), schema), "aligned")
    pairs = staging.stage(
        both.where("pair IS NOT NULL").groupBy("pair").agg({"n": "sum"}).toDF("pair", "n"), "pairs"
    )
    n_b = vocabularies(*paths).n_b
    highest = pairs.groupBy((pairs.pair % n_b).alias("of")).agg({"n": "max"}).toDF("of", "most")
    # One row per B id, so the vocabulary bounds what is broadcast.
    marked = pairs.join(highest.hint("broadcast"), pairs.pair % n_b == highest.of).selectExpr(
        "pair", "n", "n = most AS best", f"CAST(floor({_STEPS} * log2(n)) AS int) AS step"
    )
    least, n_below = _head(pairs, broadcast_pairs)
    top = marked.where(f"step >= {least}" if least < math.inf else "false")
    top = top.select("pair", "n", "best").toArrow()
    head = spark.sparkContext.broadcast(tuple(top.column(i).to_numpy() for i in range(3)))
    summed = texts.map_batches(
        both.where("pair IS NULL").drop("pair", "n"),
        partial(_sum_up, paths, head),
        _SUMMED.format(key=key),
    )
    columns = [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum",
    ]
    if not n_below:
        return summed.select(*columns)
    summed = staging.stage(summed, "summed")
    rest = marked.where(f"step < {least}" if least < math.inf else "true")
    rare = summed.selectExpr("row", "explode(arrays_zip(rare, rare_n)) AS x").selectExpr(
        "row", "x.rare AS pair", "x.rare_n AS links"
    )
    more = (
        rare.join(rest, "pair")
        .selectExpr("row", "links * n AS more_sum", "IF(best, links, 0L) AS more_best")
        .groupBy("row")
        .agg({"more_sum": "sum", "more_best": "sum"})
        .select("row", "sum(more_sum)", "sum(more_best)")
        .toDF("row", "more_sum", "more_best")
    )
    return summed.join(more, "row", "left").selectExpr(
        *columns[:6],
        "n_best + coalesce(more_best, 0L) AS n_best",
        "count_sum + coalesce(more_sum, 0L) AS count_sum",
    )
