"""Input tables: companies, captured pages, results already written."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sitetext.functions.sql import Sql, bind
from sitetext.functions.urls import clean_reference, normalize_url
from sitetext.sources.places import has_places, with_places


def read_table(spark: SparkSession, source: str, file_format: str = "parquet") -> DataFrame:
    """A path if `source` has a slash, else a table name."""
    return spark.read.format(file_format).load(source) if "/" in source else spark.table(source)


def read_captures(
    spark: SparkSession, source: str, file_format: str = "parquet",
    partitions: int | None = None, places: bool = False,
) -> DataFrame:
    """Captured pages, as the files are split; with `places`, Parquet rows name their place.

    Reading markup is bound by the processor: set `spark.sql.files.maxPartitionBytes` low.
    `partitions` deals the rows out anew, for a few files of one row group each; it shuffles the
    markup once for every use of the frame.
    """
    rows = read_table(spark, source, file_format)
    rows = with_places(rows) if places else rows
    return rows if partitions is None else rows.repartition(partitions)


def company_rows(companies: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """Any table with an id and a url column as id, url, home.

    `home` is the normalized address, null where there is none.
    """

    def home(address: Sql) -> Sql:
        return f"if({address} = '', NULL, {normalize_url(address)})"

    return companies.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("string").alias("url")
    ).selectExpr("id", "url", f"{bind(clean_reference('url'), home)} AS home")


#: Copies of one input row that are numbered at once.
_COPIES_AT_ONCE = 10_000


def with_company_key(companies: DataFrame) -> DataFrame:
    """id, url, home and a key per input row, so that equal rows stay apart.

    The key is a digest of id and url, and a number among rows that have both in common. It does
    not depend on how the input is split or ordered. Equal rows are counted, which tasks do before
    the shuffle, and written out again, so any share of the input may be copies of one row.
    """
    given = "concat(coalesce(concat(length(id), ':', id), ''), '/', coalesce(concat('=', url), ''))"
    return (
        companies.groupBy("id", "url", "home")
        .count()
        .selectExpr("*", f"explode(sequence(0L, (count - 1) DIV {_COPIES_AT_ONCE})) AS _block")
        .selectExpr(
            "*",
            f"explode(sequence(_block * {_COPIES_AT_ONCE}, "
            f"least(count, (_block + 1) * {_COPIES_AT_ONCE}) - 1)) AS _copy",
        )
        .selectExpr("id", "url", "home", f"concat(md5({given}), '-', _copy) AS company_key")
    )


def captured_attempts(captures: DataFrame, keys: Sequence[str] = ("page_url",)) -> DataFrame:
    """Captured pages (page_url, html, fetched_at; status if known) as first attempts.

    `keys`, page_url among them, are the columns that tell pages apart; they stay.
    """
    status = F.col("status") if "status" in captures.columns else F.lit(200)
    return captures.select(
        *keys,
        F.lit(0).alias("attempt"),
        status.cast("int").alias("status"),
        "html",
        "fetched_at",
        *(["place"] if has_places(captures) else []),
    )


def pending(companies: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Companies whose id is not in the results yet."""
    finished = done.select(F.col("id").alias("_done")).distinct()
    return companies.join(
        finished, F.col(id_col).cast("string") == F.col("_done"), "left_anti"
    )


def shard(companies: DataFrame, count: int, index: int, key: str) -> DataFrame:
    """Part `index` of `count`, by hash of a column whose values differ from row to row."""
    return companies.where(F.pmod(F.xxhash64(key), F.lit(count)) == index)


#: Keys are summed up in so many parts.
_SUMMED_PARTS = 4096


def balanced_shards(companies: DataFrame, key: str, weight: str, count: int) -> DataFrame:
    """The companies with a column `shard` from 0 to `count` - 1, of about equal sums of `weight`.

    `weight`, such as captured bytes, is a number of at least 0 per row; null counts as 0. `key`
    differs from row to row. Rows lie in the order of the hash of their key; the sum up to each row
    decides its shard. The sum is taken in two steps: over parts, of which there are a fixed
    number, and within each part. A shard is larger than the others by one row at most. If all
    weights are 0, rows count.
    """
    parted = companies.withColumns(
        {
            "_part": F.expr(f"CAST(pmod(xxhash64({key}), {_SUMMED_PARTS}) AS int)"),
            "_weight": F.expr(f"CAST(coalesce({weight}, 0) AS double)"),
        }
    )
    sums = parted.groupBy("_part").agg(F.sum("_weight").alias("_sum"), F.count("*").alias("_rows"))
    # As many rows as there are parts.
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.select(
        "_part",
        F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(everything).alias("_total"),
        F.sum("_rows").over(everything).alias("_all_rows"),
    )
    within = Window.partitionBy("_part").orderBy(F.xxhash64(key), key)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The middle of a row decides, so a heavy row falls to the shard that holds most of it.
    share = (
        "if(_total > 0, (_before + _upto - _weight / 2) / _total, "
        "(_rows_before + _number - 0.5D) / _all_rows)"
    )
    return (
        parted.withColumn("_upto", F.sum("_weight").over(upto))
        .withColumn("_number", F.row_number().over(within))
        .join(F.broadcast(placed), "_part")
        .withColumn("shard", F.expr(f"CAST(least({count} - 1, floor({count} * {share})) AS int)"))
        .select(*companies.columns, "shard")
    )


def union_shards(shards: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, shards)
