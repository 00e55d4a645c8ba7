"""The pipeline against the same stages in plain Python, on the awkward rows of the operators."""

from __future__ import annotations

from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import ITEMS, ascii_lower, bench_words, components, prose, sha, shingles, texts, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows() -> list[tuple]:
    out = [(i, t, ("en", "de", None)[i % 3], "src", len(t or "")) for i, t in enumerate(texts())]
    return [*out, out[3], (None, prose(31, 60), "en", None, None), (None, None, "en", None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows(), ddl).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def good(text: str | None, lang: str | None) -> bool:
    import sentencepiece
    from sitetext.llm import fertility as f

    model = sentencepiece.SentencePieceProcessor(model_file=f.default_path())
    ws = words(text)
    grams = Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4))
    hit = {k + j for k in range(len(ws) - 4) if grams[tuple(ws[k : k + 5])] > 1 for j in range(5)}
    if len(ws) < 10 or 100 * len(hit) > 20 * len(ws):
        return False
    latin = sum(c.isascii() and c.isalpha() or "\xc0" <= c < "ʀ" for c in text)
    band = f.BANDS[lang if lang in f.BANDS else "latin" if 2 * latin > len("".join(ws)) else "other"]
    ids = [t for w in ws for t in model.encode(w)]
    entropy = sum(-c / len(ids) * log2(c / len(ids)) for c in Counter(ids).values())
    per_token = sum(map(len, ws)) / len(ids)
    share = sum(model.is_byte(t) for t in ids) / len(ids)
    return (
        band.min_chars_per_token <= per_token <= band.max_chars_per_token
        and share <= band.max_byte_share
        and entropy >= band.min_entropy_share * log2(min(max(len(ids), 2), band.full_at))
    )


def plain(docs: list[tuple]) -> dict[str, list[tuple]]:
    """(doc_id, text) rows after each stage but the last."""
    out = {}
    docs = [(i, t) for i, t, lang, *_ in docs if good(t, lang)]
    out["quality rules"] = docs
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in docs:
        for line in t.split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders[key(line)].add(i)
    gone = lambda i, x: i is not None and len(holders[key(x)]) > 1 and min(holders[key(x)]) != i
    docs = [(i, "\n".join(x for x in t.split("\n") if not gone(i, x))) for i, t in docs]
    out["line dedup"] = docs
    found = components({i: shingles(t, 5) for i, t in docs if i is not None}, 80)
    docs = [*{i: t for i, t in docs if i is not None and found[i] == i}.items()] + [
        (i, t) for i, t in docs if i is None
    ]
    out["near dedup"] = docs
    wins = set()
    for item, body in ITEMS:
        iw = bench_words(body)
        size = min(13, len(iw))
        if item is not None and iw:
            wins |= {tuple(iw[k : k + size]) for k in range(len(iw) - size + 1)}

    def contaminated(text: str) -> bool:
        ws, hit = bench_words(text), set()
        for size in {len(w) for w in wins}:
            for k in range(len(ws) - size + 1):
                if tuple(ws[k : k + size]) in wins:
                    hit |= set(range(k, k + size))
        return len(hit) > 0 and 20 * len(hit) >= len(ws)

    out["decontamination"] = [(i, t) for i, t in docs if not contaminated(t)]
    return out


def comparable(found) -> list:
    return sorted(((-1 if i is None else i, t) for i, t in found), key=str)


def test_stages_match_plain_python(spark, folder):
    import corpus_pipeline
    from sitetext.llm.bpe import default_path
    from tokenizers import Tokenizer

    wanted = plain(rows())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == COLUMNS
        got = docs.collect()
        assert comparable((r.doc_id, r.text) for r in got) == comparable(wanted[name])
        docs = spark.createDataFrame(got, docs.schema)
    assert len(wanted["decontamination"]) < len(wanted["near dedup"]) < len(wanted["line dedup"])
    assert wanted["line dedup"] != wanted["quality rules"]
    library = Tokenizer.from_file(default_path())
    last = [(i, library.encode(t, add_special_tokens=False).ids) for i, t in wanted["decontamination"]]
    got = corpus_pipeline.run(spark, folder).collect()
    assert comparable((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == comparable(last)
    decoded = [(i, sha(library.decode(ids, skip_special_tokens=False))) for i, ids in last]
    assert comparable((r.doc_id, r.decoded_sha256) for r in got) == comparable(decoded)


def test_empty_documents(spark, folder, tmp_path):
    import corpus_pipeline

    spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < -1").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_extra_columns(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "doc_id", "text", "lang", "source", "n_chars", "doc_id AS node", "text AS label",
        "lang AS text_key", "n_chars AS drops", "source AS `a b`",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert out.where(F.col("doc_id") == 0).first()["label"] == texts()[0]
