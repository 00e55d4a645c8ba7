"""Removal of text that the pages of a host repeat: menus, notices and slogans left in the prose."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import broadcast, expr

from sitetext.functions.sql import Sql
from sitetext.functions.urls import bare_host

#: Most bytes of repeated blocks that are broadcast; beyond them places are joined instead.
BROADCAST_BYTES = 64 << 20
_BYTES_PER_BLOCK = 16
#: Parts that the pages of a hot line are dealt over.
_PARTS = 32


def _blocks(text: Sql) -> Sql:
    return rf"split({text}, '\n')"


def repeated_blocks(
    pages: DataFrame, min_pages: int, key: str = "page_url", page: str | None = None
) -> DataFrame:
    """host, block (hash of a line) and n_pages of lines that `min_pages` pages of a host hold.

    `page` is the column that tells pages apart where several have one address in `key`.

    Only hashes are shuffled. A line is counted once per page, whatever it holds of the line and
    however often the page occurs. Rows are made distinct by page first, which spreads the lines
    of a hot host over all tasks, and each task then sends one count per line.
    """
    lines = f"array_distinct(transform(filter({_blocks('text')}, l -> l <> ''), l -> xxhash64(l)))"
    return (
        pages.selectExpr(f"{bare_host(key)} AS host", f"xxhash64({page or key}) AS page", f"explode({lines}) AS block")
        .distinct()
        .groupBy("host", "block")
        .agg(F.count("*").alias("n_pages"))
        .where(f"n_pages >= {min_pages}")
    )


def without_boilerplate(
    pages: DataFrame,
    repeated: DataFrame,
    key: str = "page_url",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The pages without the repeated lines of their host; n_dropped counts the lines that went.

    `pages` has a text column and a page address in `key`; all other columns stay. `repeated` is
    staged or cheap, as it is read more than once. While its hashes are few enough, each task
    filters its pages by the set of their host and no text moves. Beyond that, places of lines
    are matched on narrow rows, a hot line spread by page, and only then joined with the text. A
    page without text keeps it. Rows with a null address keep all lines.
    """
    n_blocks = repeated.count()
    if n_blocks * _BYTES_PER_BLOCK <= broadcast_bytes:
        sets = repeated.groupBy(F.col("host").alias("_host")).agg(
            F.collect_set("block").alias("_repeated")
        )
        hashes = "transform(_lines, l -> xxhash64(l))"
        known = f"array_intersect({hashes}, _repeated)"
        found = (
            pages.withColumn("_host", expr(bare_host(key)))
            .join(broadcast(sets), "_host", "left")
            .withColumn("_lines", expr(_blocks("text")))
            .withColumn("_known", expr(f"if(_repeated IS NULL, NULL, {known})"))
        )
        kept = "filter(_lines, l -> NOT array_contains(_known, xxhash64(l)))"
        return _joined(found, f"if(size(_known) > 0, {kept}, _lines)").drop(
            "_host", "_lines", "_known", "_repeated"
        )
    page = f"struct({key} AS url, xxhash64(text) AS content)"
    places = pages.selectExpr(
        f"{page} AS _page", f"{bare_host(key)} AS host", f"posexplode({_blocks('text')}) AS (place, line)"
    ).selectExpr("_page", "host", "place", "xxhash64(line) AS block")
    # Many pages share a line of a host, so its rows are salted and its one row is copied.
    salted = places.withColumn("_part", expr(f"pmod(xxhash64(_page), {_PARTS})"))
    copies = repeated.selectExpr("host", "block", f"explode(sequence(0, {_PARTS} - 1)) AS _part")
    gone = (
        salted.join(copies.withColumn("_part", F.col("_part").cast("bigint")), ["host", "block", "_part"])
        .groupBy("_page")
        .agg(F.collect_set("place").alias("_gone"))
    )
    found = (
        pages.withColumn("_page", expr(page))
        .join(gone, "_page", "left")
        .withColumn("_lines", expr(_blocks("text")))
    )
    kept = "filter(_lines, (l, i) -> NOT array_contains(_gone, i))"
    return _joined(found, f"if(_gone IS NULL, _lines, {kept})").drop("_page", "_gone", "_lines")


def _joined(found: DataFrame, kept: Sql) -> DataFrame:
    return (
        found.withColumn("_kept", expr(kept))
        .withColumn("n_dropped", expr("coalesce(size(_lines) - size(_kept), 0)"))
        .withColumn("text", expr(r"array_join(_kept, '\n')"))
        .drop("_kept")
    )
