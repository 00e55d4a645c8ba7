"""Quality rules: word and line counts, and the fertility of a public vocabulary.

The vocabulary was made for ordinary text, so what it does to a text says how ordinary the text
is: characters per token fall in shouting, tables and symbol noise, bytes that no token covers are
written one by one, and the token entropy falls where a few tokens are repeated. Each language, or
else each script, has a band for each measure, and a text outside a band is rejected. How low the
entropy of ordinary text goes depends on the corpus, so its limit is taken from the quartiles of all
documents of the language.

A word is encoded once per piece of text with the blank before it, as it stands inside a text.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import texts
from sitetext.plans.staging import Staging

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Band:
    """What is accepted. Entropy is in bits per token, as a share of the most that so many tokens
    could have, where tokens beyond `full_at` don't raise the most any further."""

    min_chars_per_token: float = 0.3
    max_chars_per_token: float = 12.0
    max_byte_share: float = 1.0
    min_entropy_share: float = 0.3
    full_at: int = 512


#: By language, and by script for other languages. Entropy limits are floors, which
#: `learned_bands` raises.
BANDS: dict[str, Band] = {
    "en": Band(1.2, 8.0, 0.1, 0.5),
    "de": Band(1.2, 8.0, 0.1, 0.5),
    "fr": Band(1.2, 8.0, 0.1, 0.5),
    "es": Band(1.2, 8.0, 0.1, 0.5),
    "latin": Band(1.0, 10.0, 0.2, 0.5),
    "alphabetic": Band(0.8, 10.0, 0.6, 0.35),
    "other": Band(),
}

#: An entropy share so many times the distance of the quartiles below the lower one is an outlier.
FENCE = 1.5
#: Quartiles are taken of at least so many documents, to steps of a share of one in this many.
LEARN_FROM, STEPS = 100, 1000

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_tokens", pa.int64()),
        ("chars_per_token", pa.float64()),
        ("byte_share", pa.float64()),
        ("token_entropy", pa.float64()),
        ("entropy_share", pa.float64()),
        ("band", pa.string()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_tokens bigint, chars_per_token double, byte_share double, "
    "token_entropy double, entropy_share double, band string, base_failed boolean, kept boolean"
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
    return model, is_byte


def _in_rows(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(words: np.ndarray, rows: np.ndarray, n: int, width: int) -> np.ndarray:
    """Words of each row that lie in a window of `width` words found twice or more in the row."""
    size = len(words) - width + 1
    if size <= 0:
        return np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        key = rows[:size].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        for i in range(width):
            key = texts.mixed(key + words[i : i + size])
    whole = np.flatnonzero(rows[:size] == rows[width - 1 :])
    _, kind, counts = np.unique(key[whole], return_inverse=True, return_counts=True)
    twice = whole[counts[kind.reshape(-1)] > 1]
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + width, -1)
    return np.bincount(rows[np.cumsum(steps[:-1]) > 0], minlength=n)


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Lines of each row that hold a word and equal an earlier line."""
    starts, ends, rows = texts.line_spans(data, offsets)
    total = np.concatenate([[0], np.cumsum(~texts.is_space(data))])
    filled = total[ends] > total[starts]
    starts, ends, rows = starts[filled], ends[filled], rows[filled]
    with np.errstate(over="ignore"):
        key = texts.mixed(
            texts.span_hashes(data, starts, ends)
            + rows.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        )
    first = np.unique(key, return_index=True)[1]
    return np.bincount(rows, minlength=n) - np.bincount(rows[first], minlength=n)


def _token_counts(data, starts, ends, words, rows, n, vocabulary):
    """Tokens, byte tokens and token entropy of each row."""
    model, is_byte = vocabulary
    some, kind = texts.distinct(words)
    raw = data.tobytes()
    encoded = model.encode(
        [raw[a:b].decode() for a, b in zip(starts[some].tolist(), ends[some].tolist())],
        num_threads=1,
    )
    sizes = np.array([len(x) for x in encoded] or [0], np.int64)
    flat = np.fromiter((i for x in encoded for i in x), np.int64, int(sizes.sum()))
    heads = np.cumsum(sizes) - sizes
    of_word = sizes[kind]
    ends_at = np.cumsum(of_word)
    n_all = int(ends_at[-1]) if len(ends_at) else 0
    at = np.arange(n_all) - np.repeat(ends_at - of_word, of_word) + np.repeat(heads[kind], of_word)
    tokens, of_row = flat[at], np.repeat(rows, of_word)
    n_tokens = np.bincount(of_row, minlength=n)
    n_bytes = np.bincount(of_row, weights=is_byte[tokens], minlength=n)
    pairs, counts = np.unique(of_row * len(is_byte) + tokens, return_counts=True)
    spread = np.bincount(pairs // len(is_byte), weights=counts * np.log2(counts), minlength=n)
    size = np.maximum(n_tokens, 1)
    return n_tokens, n_bytes / size, np.maximum(np.log2(size) - spread / size, 0.0)


def _scripts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Script of most letters of each row, from the first bytes of characters: 0 Latin, 1 other
    alphabets, 2 anything else."""
    latin = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 0xC3) & (data <= 0xC9)
    alphabets = (data >= 0xCE) & (data <= 0xDF)
    rest = data >= 0xE0
    return np.argmax([_in_rows(x, offsets) for x in (latin, alphabets, rest)], axis=0)


def measure(
    texts_: pa.Array, langs: list[str | None], vocabulary, bands: Mapping[str, Band]
) -> Iterator[tuple[int, dict[str, object]]]:
    """First row and measures of each piece of a column of texts."""
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    for first, end, data, offsets in texts.pieces(texts_):
        n = end - first
        starts, ends, rows = texts.word_spans(data, offsets)
        words = texts.span_hashes(data, starts, ends)
        n_words = np.bincount(rows, minlength=n)
        chars = _in_rows(((data & 0xC0) != 0x80) & ~texts.is_space(data), offsets)
        repeated = _repeated_words(words, rows, n, WINDOW)
        n_tokens, byte_share, entropy = _token_counts(data, starts, ends, words, rows, n, vocabulary)
        per_token = chars / np.maximum(n_tokens, 1)
        failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
        names = [
            lang if lang in bands else ("latin", "alphabetic", "other")[script]
            for lang, script in zip(langs[first:end], _scripts(data, offsets))
        ]
        limits = [bands[name] for name in names]
        of = lambda field: np.array([getattr(b, field) for b in limits])
        most = np.log2(np.clip(n_tokens, 2, of("full_at")))
        yield (
            first,
            {
                "n_words": n_words,
                "word_chars": chars,
                "n_symbols": _in_rows(symbol[data], offsets),
                "n_dup_lines": _duplicate_lines(data, offsets, n),
                "n_repeat_words": repeated,
                "n_tokens": n_tokens,
                "chars_per_token": per_token,
                "byte_share": byte_share,
                "token_entropy": entropy,
                "entropy_share": entropy / most,
                "band": names,
                "base_failed": failed,
                "kept": ~failed
                & (per_token >= of("min_chars_per_token"))
                & (per_token <= of("max_chars_per_token"))
                & (byte_share <= of("max_byte_share"))
                & (entropy / most >= of("min_entropy_share")),
            },
        )


def _measured(path: str | None, bands: Mapping[str, Band]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path or default_path())
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for first, found in measure(batch.column(1), langs, vocabulary, bands):
                ids = batch.column(0).slice(first, len(found["kept"]))
                yield texts.pack({"doc_id": ids} | found, SCHEMA)

    return run


def _filtered(at: int, lang_at: int | None, path: str | None, bands: Mapping[str, Band]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path or default_path())
        for batch in batches:
            n = batch.num_rows
            langs = [None] * n if lang_at is None else batch.column(lang_at).to_pylist()
            for first, found in measure(batch.column(at), langs, vocabulary, bands):
                yield batch.slice(first, len(found["kept"])).filter(pa.array(found["kept"]))

    return run


def learned_bands(measured: DataFrame, bands: Mapping[str, Band]) -> dict[str, Band]:
    """The bands with entropy limits raised to where outliers begin among all documents.

    `measured` has band, entropy_share and base_failed. For each band with at least LEARN_FROM
    documents that don't fail, the limit is the lower quartile of their shares less FENCE times the
    distance of the quartiles, unless the given one is higher. Documents are counted by steps of
    the share, so what comes to the driver is at most STEPS + 1 rows a band.
    """
    step = F.expr(f"CAST(floor(entropy_share * {STEPS}) AS int)").alias("step")
    counts = measured.where("NOT base_failed").groupBy("band", step).count().collect()
    out = dict(bands)
    for name in {r.band for r in counts}:
        steps, sizes = zip(*sorted((r.step, r["count"]) for r in counts if r.band == name))
        upto = np.cumsum(sizes)
        if upto[-1] >= LEARN_FROM:
            low, high = (steps[int(np.searchsorted(upto, q * upto[-1]))] / STEPS for q in (0.25, 0.75))
            limit = max(bands[name].min_entropy_share, low - FENCE * (high - low))
            out[name] = replace(bands[name], min_entropy_share=limit)
    return out


def _source(docs: DataFrame, id_col: str | None, text_col: str, lang_col: str | None) -> DataFrame:
    doc_id = f"CAST(`{id_col}` AS BIGINT)" if id_col else "CAST(NULL AS BIGINT)"
    lang = f"`{lang_col}`" if lang_col else "CAST(NULL AS STRING)"
    return docs.selectExpr(f"{doc_id} AS doc_id", f"`{text_col}` AS text", f"{lang} AS lang")


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
    path: str | None = None,
    bands: Mapping[str, Band] = BANDS,
    learn: bool = True,
) -> DataFrame:
    """The rows that `quality_rules` keeps, with all their columns and without a shuffle of text.

    With `learn` the documents are read twice: for the limits, and to filter them.
    """
    if learn:
        source = _source(docs, None, text_col, lang_col)
        bands = learned_bands(texts.map_batches(source, _measured(path, dict(bands)), _DDL), bands)
    lang_at = docs.columns.index(lang_col) if lang_col else None
    return texts.map_batches(
        docs, _filtered(docs.columns.index(text_col), lang_at, path, dict(bands)), docs.schema
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    path: str | None = None,
    bands: Mapping[str, Band] = BANDS,
    learn: bool = True,
) -> DataFrame:
    """One row per document: doc_id, counts, the vocabulary's measures, base_failed and kept.

    base_failed is true below MIN_WORDS words or if over MAX_REPEATED_PERCENT of the words lie in
    repeated windows of WINDOW words. kept is false if base_failed, or if a measure is outside the
    band of the document's language or, without one, of its script; `bands` needs the keys latin,
    alphabetic and other. With `learn`, entropy limits come from all documents (`learned_bands`).
    `path` names a sentencepiece model that the executors can read.

    A null or empty text, or one of white space only, has no words and fails. Rows are independent
    but for the learned limits, to which repeated rows add again; a null id or language stays null,
    an empty table gives none, and other columns are not read.
    """
    source = _source(docs, id_col, text_col, lang_col)
    measured = texts.map_batches(source, _measured(path, dict(bands)), _DDL)
    if not learn:
        return measured
    measured = Staging(docs.sparkSession).stage(measured, "measured")
    limits = learned_bands(measured, bands)
    limit = " ".join(f"WHEN '{name}' THEN {b.min_entropy_share!r}D" for name, b in limits.items())
    return measured.withColumn("kept", F.expr(f"kept AND entropy_share >= CASE band {limit} END"))
