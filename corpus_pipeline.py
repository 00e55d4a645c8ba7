"""From raw documents to token ids in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitetext.llm.bpe import encode_documents
from sitetext.llm.decontamination import without_contaminated
from sitetext.llm.fertility import keep_good
from sitetext.llm.line_dedup import without_repeated_lines
from sitetext.llm.superminhash import without_near_duplicates
from sitetext.plans.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds."""
    texts = without_repeated_lines(docs)
    return texts.withColumn("n_chars", F.length("text").cast(texts.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of the benchmark in them."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as little-endian unsigned 32-bit integers, and the digest of the
    text decoded from them."""
    return encode_documents(docs).selectExpr(
        "doc_id", "n_tokens", "ids", "sha2(CAST(decoded AS BINARY), 256) AS decoded_sha256"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe encoding", encoding),
]

#: Vocabularies decide the first and the last stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
