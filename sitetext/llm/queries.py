"""The queries of the operators in this package. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitetext.llm.alignment import aligned_tokens
from sitetext.llm.attention import language_model_scores
from sitetext.llm.bpe import encode_documents
from sitetext.llm.chunk_dedup import repeated_passages
from sitetext.llm.contextual_pii import personal_data
from sitetext.llm.decontamination import contamination
from sitetext.llm.fertility import quality_rules
from sitetext.llm.guess_cost import secret_spans
from sitetext.llm.line_dedup import drop_repeated_lines
from sitetext.llm.nbsvm import quality_scores
from sitetext.llm.packing import packed_pieces
from sitetext.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_beginnings
from sitetext.llm.superminhash import near_duplicates


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents")


def op1_guess_cost_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets by pattern, and costly values after credential words."""
    written = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = written.format("filter(spans, s -> s.kind <> 'guess')")
    count = "CAST(size(filter(spans, s -> s.kind = '{}')) AS bigint)"
    return secret_spans(_documents(spark, folder)).selectExpr(
        "doc_id",
        *(f"{count.format(kind)} AS n_{kind}" for kind in ("assign", "access", "hex")),
        f"sha2(CAST(array_join({base}, ',') AS BINARY), 256) AS base_sha256",
        f"array_join({written.format('spans')}, ',') AS spans",
        f"{count.format('guess')} AS n_guess",
    )


def op2_tokenizer_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, the vocabulary's measures and the verdict for every text."""
    return quality_rules(_documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "chars_per_token", "byte_share", "token_entropy",
    )


def op3_attention_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and attention-model scores of every text."""
    return language_model_scores(_documents(spark, folder))


def op4_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = contamination(_documents(spark, folder), _table(spark, folder, "benchmark"))
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "sha2(CAST(array_join(items, ',') AS BINARY), 256) AS items_sha256",
        "contaminated",
    )


def op5_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text and the text decoded from them, as digests."""
    return encode_documents(_documents(spark, folder)).selectExpr(
        "doc_id",
        "n_tokens",
        "sha2(ids, 256) AS ids_sha256",
        "sha2(CAST(decoded AS BINARY), 256) AS decoded_sha256",
    )


def op6_nbsvm_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every text."""
    return quality_scores(_documents(spark, folder), _table(spark, folder, "labels"))


def op7_superminhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are at least 85 percent alike."""
    return near_duplicates(_documents(spark, folder), width=3, percent=85)


def op8_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data by pattern, and identifiers in the same contexts."""
    written = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = written.format("filter(spans, s -> s.rank < 4)")
    return personal_data(_documents(spark, folder)).selectExpr(
        "doc_id",
        *(
            f"CAST(size(filter(spans, s -> s.rank = {rank})) AS bigint) AS n_{kind}"
            for rank, kind in enumerate(("email", "ip", "card", "phone"))
        ),
        f"sha2(CAST(array_join({base}, ',') AS BINARY), 256) AS base_sha256",
        f"array_join({written.format('spans')}, ',') AS spans",
        "CAST(size(filter(spans, s -> s.rank >= 4)) AS bigint) AS n_found",
    )


def op9_bloom_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per document before and after repeated lines are dropped, and what stays."""
    return drop_repeated_lines(_documents(spark, folder)).selectExpr(
        "doc_id",
        "n_lines",
        "n_dropped",
        "sha2(CAST(text AS BINARY), 256) AS kept_sha256",
    )


def op10_gear_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Passages that several documents hold."""
    return repeated_passages(_documents(spark, folder))


def op11_lockstep_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies in every text."""
    return aligned_tokens(_documents(spark, folder))


def op12_range_minimum_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt to share beginnings."""
    turns = turn_sequences(_table(spark, folder, "conversations"))
    return prefix_trie(with_shared_beginnings(turns))


def op13_monotone_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packed_pieces(_documents(spark, folder))


QUERIES = {
    "op1_guess_cost_secrets": op1_guess_cost_secrets,
    "op2_tokenizer_fertility": op2_tokenizer_fertility,
    "op3_attention_scores": op3_attention_scores,
    "op4_positional_index": op4_positional_index,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_nbsvm_quality": op6_nbsvm_quality,
    "op7_superminhash_groups": op7_superminhash_groups,
    "op8_contextual_pii": op8_contextual_pii,
    "op9_bloom_line_dedup": op9_bloom_line_dedup,
    "op10_gear_chunks": op10_gear_chunks,
    "op11_lockstep_alignment": op11_lockstep_alignment,
    "op12_range_minimum_trie": op12_range_minimum_trie,
    "op13_monotone_packing": op13_monotone_packing,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The bits of crc32 of a decimal number, one character after the other.
_CRC32 = """xor(list_reduce(
  list_prepend(4294967295, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLES: dict[str, str] = {
    "op12_range_minimum_trie": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  WHERE conv_id IS NOT NULL
), original AS (
  SELECT conv_id, list(sha256(length(r) || ':' || r || x) ORDER BY turn NULLS FIRST,
      sha256(length(r) || ':' || r || x)) AS s,
    list(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) ORDER BY turn NULLS FIRST,
      sha256(length(r) || ':' || r || x)) AS w
  FROM t GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, coalesce(b.s, [])[1:c.h] || c.s[c.h + 1:] AS s,
    coalesce(b.w, [])[1:c.h] || c.w[c.h + 1:] AS w
  FROM (SELECT *, CAST({_CRC32.format("conv_id")} % 4 AS INT) AS h FROM original) c
  LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20
), member AS (
  SELECT conv_id, unnest(range(0, len(s) + 1)) AS d, s, w FROM rebuilt
), node AS (
  SELECT s[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE any_value(w[d]) END AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '') AS ends
  FROM member GROUP BY s[1:d], d
), child AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
under AS (
  SELECT a.p, sum((b.n_convs - 1) * b.words) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM node) b JOIN node a ON a.p = b.p[1:k]
  LEFT JOIN child c ON c.p = b.p GROUP BY a.p
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs,
  coalesce(c.n, 0) AS n_children, u.leaves AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM node n JOIN under u ON u.p = n.p LEFT JOIN child c ON c.p = n.p
LEFT JOIN node q ON n.depth > 0 AND q.p = n.p[1:n.depth - 1]
""",
    "op4_positional_index": rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
), sizes AS (SELECT DISTINCT k FROM windows), places AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, sizes WHERE len(w) >= k
), found AS (
  SELECT doc_id, item_id, i, p.k FROM places p
  JOIN windows x ON p.k = x.k AND array_to_string(w[i:i + p.k - 1], ' ') = x.p
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS q FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_superminhash_groups": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])
    END AS g
  FROM d
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(b) AS component_id,
  min(b) = s.doc_id AS kept
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, g
""",
    "op9_bloom_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), k AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.*, first_id IS NOT NULL AND doc_id <> first_id AS gone FROM k LEFT JOIN r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
}
