"""Order-preserving packing of token ids by dynamic programming.

The ids of a run of documents, one after the other, are cut into sequences. A cut may stand at the
end of a document, at the end of a sentence, or, in stretches without either, between any tokens at
regular steps; near the end of a run every place is a candidate. Among all choices the one with the
least total cost is taken, where a sequence costs a constant and its padding, and a cut inside a
document its penalty. Padding is linear in the place of the cut before, so the best earlier cut
within a window is the head of a monotone queue; lengths that are powers of two need no padding and
are tried apart.

A run holds about RUN_TOKENS ids of neighbouring rows of one task, so nothing is shuffled and
memory follows the longest document.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from sitetext.llm import texts
from sitetext.llm.bpe import _byte_characters, default_path
from sitetext.llm.span_ids import Ids, SpanIds, gathered, parts_of_words

#: Tokens of a full sequence.
WINDOW = 2048
#: Ids that are packed at once.
RUN_TOKENS = 1 << 20
#: What a sequence costs besides padding, and a cut at the end of a sentence and anywhere else,
#: in tokens of padding.
SEQUENCE_COST, SENTENCE_COST, PLAIN_COST = 8, 2, 32
#: Candidates between tokens stand this far apart, or a window if that is less, where no sentence
#: ends.
PLAIN_STEP = 64
#: The id after each document.
END_ID = 1

#: Marks that end a sentence, and marks that may follow them.
_ENDS = ".!?…。！？"
_CLOSING = "\"')]}»”’"
_WORD_END = "</w>"
#: How the tokenizer file cuts words, and the newline that is put between words here.
_ASCII_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|\n|[^\n a-z0-9]+")
_LATIN_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|\n|[^\s\p{L}\p{N}]+")

_FIELDS = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint"
)


class WordTokens:
    """Ids of whitespace-separated words under the tokenizer file with word ends.

    Words of plain letters are lowered and cut by pattern, many at once, and the library encodes
    what is cut; it also normalizes and cuts all other words itself.
    """

    def __init__(self, path: str) -> None:
        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._special = [t["content"] for t in spec["added_tokens"]]
        self._mark, self._mark_id = self._special[0], spec["added_tokens"][0]["id"]
        self._cut_words = Tokenizer.from_file(path)
        self._cut_words.no_truncation()
        self._cut_words.no_padding()
        self._cut_words.normalizer = None
        self._cut_words.pre_tokenizer = WhitespaceSplit()
        self.words = SpanIds(self._encode)
        chars = _byte_characters()
        self._visible = np.array([ord(c) for c in chars], "<u4")
        self._visible[[10, 32]] = 10, 32
        self.ends_sentence = np.zeros(self._whole.get_vocab_size() + 1, bool)
        of_char = {c: b for b, c in enumerate(chars)}
        for token, i in spec["model"]["vocab"].items():
            body = bytes(of_char[c] for c in token.removesuffix(_WORD_END) if c in of_char)
            text = body.decode("utf-8", "replace").rstrip(_CLOSING)
            self.ends_sentence[i] = text.endswith(tuple(_ENDS))

    def _ids_of_cut(self, pattern, words: list[str]) -> Ids:
        """Ids of all words from one call, with a special token between neighbours."""
        text = " ".join(pattern.findall("\n".join(words).lower()))
        if not text.isascii():
            text = self._visible[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        text = text.replace("\n", self._mark)
        flat = self._cut_words.encode_batch_fast([text], add_special_tokens=False)[0].ids
        flat = np.array(flat, np.uint32)
        marks = np.flatnonzero(flat == self._mark_id)
        lengths = np.diff(np.concatenate([[-1], marks, [len(flat)]])) - 1
        return np.delete(flat, marks), lengths

    def _encode(self, words: list[bytes]) -> tuple[Ids]:
        if not words:
            return ((np.zeros(0, np.uint32), np.zeros(0, np.int64)),)
        joined = b"\n".join(words)
        strings = joined.decode().split("\n")
        kinds = self._kinds(joined, strings)
        found = []
        for kind, pattern in ((0, _ASCII_CUT), (1, _LATIN_CUT)):
            of = np.flatnonzero(kinds == kind)
            if len(of):
                found.append((of, *self._ids_of_cut(pattern, [strings[i] for i in of.tolist()])))
        of = np.flatnonzero(kinds == 2)
        if len(of):
            rest = [strings[i] for i in of.tolist()]
            lists = [x.ids for x in self._whole.encode_batch_fast(rest, add_special_tokens=False)]
            flat = np.fromiter((i for x in lists for i in x), np.uint32)
            found.append((of, flat, np.array([len(x) for x in lists], np.int64)))
        lengths, heads, before = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for of, flat, sizes in found:
            lengths[of], heads[of] = sizes, np.cumsum(sizes) - sizes + before
            before += len(flat)
        return ((gathered(np.concatenate([x[1] for x in found]), heads, lengths), lengths),)

    def _kinds(self, joined: bytes, words: list[str]) -> np.ndarray:
        """Per word 0: visible ASCII, 1: letters that need no composing, 2: any other."""
        data = np.frombuffer(joined, np.uint8)
        heads = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
        visible = data + (data == 10) * np.uint8(56)
        highest, lowest = np.maximum.reduceat(visible, heads), np.minimum.reduceat(visible, heads)
        kinds = np.where(highest < 0x7F, 0, np.where(highest < 0xC9, 1, 2)).astype(np.int8)
        kinds[lowest < 0x21] = 2
        for i in np.flatnonzero(kinds == 1).tolist():
            if not words[i].isprintable():
                kinds[i] = 2
        if b"<|" in joined:
            for i, word in enumerate(words):
                if "<|" in word and any(t in word for t in self._special):
                    kinds[i] = 2
        return kinds


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def candidates(
    doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run may be cut, from 0 to its end, and what a cut costs there."""
    total = int(doc_ends[-1])
    cost = np.full(total + 1, -1, np.int64)
    tail = max(0, total - window)
    cost[tail:] = PLAIN_COST
    cost[sentence_ends] = SENTENCE_COST
    cost[doc_ends] = cost[0] = 0
    given = np.flatnonzero(cost >= 0)
    gaps, step = np.diff(given), min(PLAIN_STEP, window)
    wide = np.flatnonzero(gaps > step)
    for a, gap in zip(given[wide].tolist(), gaps[wide].tolist(), strict=True):
        cost[a + step : a + gap : step] = PLAIN_COST
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The ends of the sequences with the least total cost; `window` is a power of two."""
    n = len(places)
    index = np.full(int(places[-1]) + 1, -1, np.int64)
    index[places] = np.arange(n)
    came, went = [], []
    for power in range(max(1, window.bit_length() - 1)):
        size = 1 << power
        ends = np.flatnonzero(places >= size)
        starts = index[places[ends] - size]
        came.append(starts[starts >= 0])
        went.append(ends[starts >= 0])
    order = np.argsort(went := np.concatenate(went), kind="stable")
    exact = np.concatenate(came)[order].tolist()
    until = np.searchsorted(went[order], np.arange(n), "right").tolist()
    at, cost = places.tolist(), costs.tolist()
    least, back = [0] * n, [0] * n
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])
    push, pop, drop = queue.append, queue.pop, queue.popleft
    seen = until[0]
    for j in range(1, n):
        here = at[j]
        while here - queue[0][1] > window:
            drop()
        key, _, i = queue[0]
        best = key + window - here
        for k in exact[seen : until[j]]:
            if least[k] < best:
                best, i = least[k], k
        seen = until[j]
        best += SEQUENCE_COST + cost[j]
        least[j], back[j] = best, i
        best += here
        while queue and queue[-1][0] >= best:
            pop()
        push((best, here, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return np.array(cuts[::-1], np.int64)


class _Run:
    """Documents that are packed together."""

    def __init__(self, ends_sentence: np.ndarray, window: int, first_id: int) -> None:
        self._ends_sentence, self._window, self._next_id = ends_sentence, window, first_id
        self._clear()

    def _clear(self) -> None:
        self._keys, self._ids, self._sizes, self.tokens = [], [], [], 0

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self._keys.append(keys)
        self._ids.append(ids)
        self._sizes.append(sizes)
        self.tokens += len(ids)

    def packed(self, schema: pa.Schema) -> pa.RecordBatch:
        ids, sizes = np.concatenate(self._ids), np.concatenate(self._sizes)
        keys = pa.concat_arrays(self._keys)
        doc_ends = np.cumsum(sizes)
        sentence_ends = np.flatnonzero(self._ends_sentence[ids]) + 1
        cuts = best_cuts(*candidates(doc_ends, sentence_ends, self._window), self._window)
        ends = np.union1d(doc_ends, cuts)
        starts = np.concatenate([[0], ends[:-1]])
        doc = np.searchsorted(doc_ends, starts, "right")
        sequence = np.searchsorted(cuts, starts, "right")
        raw = memoryview(ids.astype("<u4").tobytes())
        spans = zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)
        out = {
            "doc_id": keys.take(pa.array(doc)),
            "start": starts - (doc_ends - sizes)[doc],
            "length": ends - starts,
            "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in spans],
            "doc_tokens": sizes[doc],
            "sequence_id": sequence + self._next_id,
            "offset": starts - np.concatenate([[0], cuts[:-1]])[sequence],
            "ids": ids,
        }
        self._next_id += len(cuts)
        self._clear()
        if "ids" in schema.names:
            offsets = np.concatenate([starts, ends[-1:]])
            values = pa.array(ids.astype(np.int64), pa.int32())
            out["ids"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
        return texts.pack(out, schema)


def _pack(
    path: str | None, window: int, run_tokens: int, with_ids: bool,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokens = word_tokens(path or default_path())
    run = _Run(tokens.ends_sentence, window, TaskContext.get().partitionId() << 36)
    schema = None
    for batch in batches:
        if schema is None:
            fields = [batch.schema.field(0).with_name("doc_id")]
            fields += [(f.split()[0], pa.int64()) for f in _FIELDS.split(", ")]
            schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)
        for first, end, data, offsets in texts.pieces(batch.column(1)):
            starts, ends, rows = parts_of_words(data, *texts.word_spans(data, offsets))
            hashes = texts.span_hashes(data, starts, ends)
            [(flat, lengths)] = tokens.words.of(data.tobytes(), starts, ends, hashes)
            sizes = np.bincount(rows, weights=lengths, minlength=end - first).astype(np.int64) + 1
            ids = np.full(len(flat) + end - first, END_ID, np.uint32)
            inside = np.ones(len(ids), bool)
            inside[np.cumsum(sizes) - 1] = False
            ids[inside] = flat
            run.add(batch.column(0).slice(first, end - first), ids, sizes)
            if run.tokens >= run_tokens:
                yield run.packed(schema)
    if run.tokens:
        yield run.packed(schema)
    tokens.words.forget()


def packed_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    window: int = WINDOW,
    run_tokens: int = RUN_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most `window` tokens.

    One row per piece: doc_id, start (ids of the document before it), length, ids_crc32 (of its
    ids as little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset (in the
    sequence) and, with `with_ids`, ids. Every id of a document, and END_ID after it, lies in
    exactly one piece, and the documents of a task keep their order. A sequence whose length is
    not a power of two is to be padded to `window`, which is a power of two itself.

    `path` names a tokenizer file that the executors can read; by default the public one with word
    ends. A null, empty or white text is one piece of one id, END_ID. Every row is packed on its
    own: repeated rows and null ids give pieces of their own. An empty table gives no rows, other
    columns are not read. sequence_id grows along a task and starts at its partition number times
    2^36, so it depends on how the table is split.
    """
    if window < 1 or window & window - 1:
        raise ValueError("window must be a power of two")
    key = docs.schema[id_col].dataType.simpleString()
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    schema = f"doc_id {key}, {_FIELDS}" + ", ids array<int>" * with_ids
    run = partial(_pack, path, window, run_tokens, with_ids)
    return texts.map_batches(source, run, schema)
