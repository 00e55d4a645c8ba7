"""BPE encoding by dynamic programming over prefixes.

For every prefix of a word exactly one vocabulary token can be the last token of its encoding. An
automaton over the vocabulary lists the tokens that end at each place; the one that is compatible
with the last token of the prefix before it is stored, and following the stored tokens back from
the end of the word gives the ids. Two adjacent tokens are compatible if no merge across their
border comes before the merges that build them, so no merge loop runs over the text.

Normalizing and cutting into words follow the tokenizer file. Words and marks repeat, so each is
encoded once per piece of text, and the ids of recent ones are kept in the worker. The matches of
the automaton come from a library for sets of words (Aho-Corasick).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sitetext.llm import texts
from sitetext.llm.span_ids import Ids, SpanIds, gathered, parts_of_words

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
        ("decoded", pa.string()),
    ]
)
WORD_END = "</w>"
#: A symbol that ends a word is written this far above the plain one.
_END_SHIFT = 0x1000
_CACHED_WORDS = 60_000
_CACHED_PAIRS = 300_000
#: Bytes of text that are encoded at once.
_PIECE_BYTES = 1 << 21
_NEVER = 1 << 60
#: Words up to this character need no composing, and lower case by character is lower case.
_LAST_SIMPLE = "\u024f"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
_SIMPLE_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x20\x09-\x0D\x85\xA0\p{L}\p{N}]+"
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_characters() -> str:
    """The character that stands for each byte: itself if it is visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(i if i in visible else next(hidden)) for i in range(256))


class PrefixEncoder:
    """Ids of a word by the table of last tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._cut = library.pre_tokenizer.pre_tokenize_str
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._added = added
        self._added_pattern = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        vocabulary = spec["model"]["vocab"]
        self.strings = {i: t for t, i in vocabulary.items()} | {i: t for t, i in added.items()}
        symbols = {i: self._symbols(t) for t, i in vocabulary.items()}
        by_symbols = {s: i for i, s in symbols.items()}
        self._length = {i: len(s) for i, s in symbols.items()}
        self._merge: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self._merge[pair] = rank
            parts[by_symbols[symbols[pair[0]] + symbols[pair[1]]]] = (*pair, rank)
        self._parts = parts
        automaton = ahocorasick.Automaton()
        for i, s in symbols.items():
            if len(s) == 1 or i in parts:
                automaton.add_word(s, i)
        automaton.make_automaton()
        self._matches = automaton.iter
        self._fits: dict[int, bool] = {}
        self._recent: dict[str, list[int]] = {}
        self._byte_chars = _byte_characters()

    @staticmethod
    def _symbols(token: str) -> str:
        if not token.endswith(WORD_END):
            return token
        body = token[: -len(WORD_END)]
        return body[:-1] + chr(ord(body[-1]) + _END_SHIFT)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token, each with the rank of the merge that ends it."""
        out, until = [(token, _NEVER)], _NEVER
        while token in self._parts:
            until = self._parts[token][2]
            token = self._parts[token][side]
            out.append((token, until))
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens, written one after the other, are encoded as just these two."""
        merge = self._merge
        return all(
            (rank := merge.get((x, y))) is None or rank >= x_until or rank > y_until
            for x, x_until in self._edge(a, 1)
            for y, y_until in self._edge(b, 0)
        )

    def _encode(self, word: str) -> list[int]:
        """Ids of one word in byte characters."""
        symbols = word[:-1] + chr(ord(word[-1]) + _END_SHIFT)
        last = [-1] * (len(symbols) + 1)
        length, fits = self._length, self._fits
        for end, token in self._matches(symbols):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start:
                before = last[start]
                if before < 0:
                    continue
                pair = before << 32 | token
                known = fits.get(pair)
                if known is None:
                    known = fits[pair] = self.compatible(before, token)
                if not known:
                    continue
            last[end] = token
        out, at = [], len(symbols)
        while at:
            token = last[at]
            out.append(token)
            at -= length[token]
        out.reverse()
        if len(fits) > _CACHED_PAIRS:
            fits.clear()
        return out

    def word(self, word: str) -> list[int]:
        """Ids of one word, from those met lately if it is among them."""
        got = self._recent.get(word)
        if got is None:
            got = self._encode(word)
            if len(word) < 64:
                if len(self._recent) >= _CACHED_WORDS:
                    self._recent.clear()
                self._recent[word] = got
        return got

    def forget(self) -> None:
        """Empty what is kept of words met lately."""
        self._recent, self._fits = {}, {}

    def encode(self, text: str) -> list[int]:
        """Ids of any text."""
        if "<|" not in text:
            return self._plain(text)
        out: list[int] = []
        at = 0
        for found in self._added_pattern.finditer(text):
            out += self._plain(text[at : found.start()])
            out.append(self._added[found.group()])
            at = found.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return self._encode(text)
            words = _ASCII_WORDS.findall(text)
            if not text.isprintable():
                words = [w.encode().decode("latin-1").translate(self._byte_chars) for w in words]
        elif max(text) <= _LAST_SIMPLE:
            words = [
                w.encode().decode("latin-1").translate(self._byte_chars)
                for w in _SIMPLE_WORDS.findall(text.lower())
            ]
        else:
            words = [w for w, _ in self._cut(self._normalize(text))]
        if len(words) == 1:
            return self.word(words[0])
        return [i for w in words for i in self.word(w)]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, as a tokenizer file without a decoder has it."""
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


class _Codec:
    """Ids of the spans met lately, and the strings of all ids for decoding."""

    def __init__(self, path: str) -> None:
        self._bpe = encoder(path)
        self.spans = SpanIds(self._encode)
        strings = self._bpe.strings
        written = [strings.get(i, "").encode() + b" " for i in range(max(strings) + 1)]
        self.data = np.frombuffer(b"".join(written), np.uint8)
        self.sizes = np.array([len(w) for w in written], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _encode(self, spans: list[bytes]) -> tuple[Ids]:
        encode = self._bpe.encode
        found = [encode(s.decode()) for s in spans]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        return ((flat, lengths),)

    def forget(self) -> None:
        """Give the memory back; a worker may go on with quite other tasks."""
        self.spans.forget()
        self._bpe.forget()


@lru_cache(maxsize=2)
def _codec(path: str) -> _Codec:
    return _Codec(path)


def _decoded(codec: _Codec, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Decoded text of each document, which is the strings of its ids with blanks between them."""
    sizes = codec.sizes[ids]
    written = gathered(codec.data, codec.starts[ids], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
    # The blank after the last id of a document goes.
    inside = np.ones(len(written), bool)
    some = counts > 0
    inside[ends[some] - 1] = False
    offsets = np.concatenate([[0], ends - np.cumsum(some)]).astype(np.int64)
    data = pa.py_buffer(written[inside])
    text = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets), data)
    return text.cast(pa.string())


def _encoded(path: str | None, decode: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path or default_path())
        for batch in batches:
            doc_ids = batch.column(0)
            for first, end, data, offsets in texts.pieces(batch.column(1), _PIECE_BYTES):
                starts, ends, rows = parts_of_words(data, *texts.word_spans(data, offsets))
                hashes = texts.span_hashes(data, starts, ends)
                [(ids, lengths)] = codec.spans.of(data.tobytes(), starts, ends, hashes)
                counts = np.bincount(rows, lengths, end - first).astype(np.int64)
                packed = pa.py_buffer(ids.astype("<u4"))
                bounds = np.concatenate([[0], np.cumsum(4 * counts)]).astype(np.int32)
                yield texts.pack(
                    {
                        "doc_id": doc_ids.slice(first, end - first),
                        "n_tokens": counts,
                        "ids": pa.BinaryArray.from_buffers(
                            pa.binary(), len(counts), [None, pa.py_buffer(bounds), packed]
                        ),
                        "decoded": _decoded(codec, ids, counts)
                        if decode
                        else pa.nulls(end - first, pa.string()),
                    },
                    SCHEMA,
                )
        codec.forget()

    return run


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    decode: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids and decoded.

    `ids` holds the ids as little-endian unsigned 32-bit integers, `decoded` the decoded text, null
    unless `decode`.
    `path` names a tokenizer file that the executors can read; by default the public one with word
    ends. A null or empty text, or one of white space only, has no ids and decodes to an empty
    text. Rows are independent: repeated rows give equal results, a null id stays null, an empty
    table gives none, and other columns are not read.
    """
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return texts.map_batches(
        source, _encoded(path, decode), "doc_id bigint, n_tokens bigint, ids binary, decoded string"
    )
