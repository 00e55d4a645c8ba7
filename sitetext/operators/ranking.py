"""Filtering and ranking links that come one per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql.functions import desc, expr, min, row_number

from sitetext.functions.links import is_site_page
from sitetext.functions.sql import Sql
from sitetext.functions.urls import path_depth, score_path, url_path


def distinct_links(rows: DataFrame, company: str, url: str, pos: str) -> DataFrame:
    """Each address of a company once, at its first position."""
    return rows.groupBy(company, url).agg(min(pos).alias(pos))


def site_link_rows(rows: DataFrame, company: str, url: str, pos: str, host: Sql) -> DataFrame:
    """Web pages of the company's site, each once."""
    return distinct_links(rows.where(is_site_page(url, host)), company, url, pos)


def cap_links(rows: DataFrame, company: str, order: Sequence[str], limit: int) -> DataFrame:
    """First `limit` rows of each company in the given order.

    Spark keeps only `limit` rows per company in each task before the shuffle, so a company
    that holds most of the rows does not gather in one task.
    """
    window = Window.partitionBy(company).orderBy(*order)
    return rows.withColumn("_n", row_number().over(window)).where(f"_n <= {limit}").drop("_n")


def top_links(
    rows: DataFrame,
    company: str,
    url: str,
    pos: str,
    high: Sequence[str],
    low: Sequence[str],
    limit: int,
) -> DataFrame:
    """Best `limit` links of each company with their `rank`, from 1. Limited as `cap_links`."""
    path = url_path(url)
    scored = rows.withColumn("score", expr(score_path(path, high, low))).withColumn(
        "depth", expr(path_depth(path))
    )
    window = Window.partitionBy(company).orderBy(desc("score"), "depth", pos, url)
    return scored.withColumn("rank", row_number().over(window)).where(f"rank <= {limit}")
