"""From page records to one row per company, and the tables made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import expr

from sitetext.config import BLOCK_TITLE, EMPTY_HOMEPAGE, EMPTY_PAGE, MISSING_URL, Options
from sitetext.functions.judgement import company_status, is_blocked
from sitetext.functions.sql import Sql
from sitetext.functions.urls import url_slug
from sitetext.operators.attempts import within_budget
from sitetext.operators.joins import lookup
from sitetext.sources.places import has_places, read_at

_RENDERED = -1  # stands for the attempt number of a rendering


def company_pages(
    selected: DataFrame, digests: DataFrame, options: Options, rows: int
) -> DataFrame:
    """The `rows` selected pages with their records; one never captured counts as no response."""
    places = ["place", "render_place"] if has_places(digests) else []
    records = digests.select(
        "page_url", "attempt", "status", "retries_used", "first_fetched", "last_fetched",
        "reason", "text", "text_len", "content", "render_content", *places,
    )
    unseen = "if(status IS NULL, 'blocked', reason)" if options.js_fallback else "reason"
    return (
        lookup(selected, records, ["page_url"], "company_key", rows)
        .withColumn("reason", expr(f"coalesce({unseen}, if(ord = 0 AND no_links, 'no_links', NULL))"))
        .selectExpr(
            "company_key",
            "ord",
            "page_url",
            f"if(ord = 0, 'home', {url_slug('page_url')}) AS page_name",
            "attempt",
            "coalesce(status, 0) AS status",
            "coalesce(retries_used, 0) AS retries_used",
            "coalesce(text, '') AS text",
            "coalesce(text_len, 0) AS text_len",
            "reason",
            "reason IS NOT NULL AS escalated_to_js",
            "first_fetched",
            "last_fetched",
            "if(reason IS NOT NULL, render_content, content) AS content",
            *(["if(reason IS NOT NULL, render_place, place) AS place"] if places else []),
        )
    )


# Message of a page without text, null for a page with text.
PAGE_ERROR: Sql = (
    "CASE WHEN text_len > 0 THEN NULL "
    f"WHEN ord = 0 THEN concat('{EMPTY_HOMEPAGE}', status) "
    f"ELSE concat('{EMPTY_PAGE}', page_url) END"
)
# Block of a page in the combined text, null for a page without text.
TEXT_BLOCK: Sql = rf"if(text = '', NULL, concat('{BLOCK_TITLE}', page_name, ']\n', text))"


def _tallies() -> list[Column]:
    tried, ok = "count(ord)", "count_if(text_len > 0)"
    seconds = "(unix_micros(max(last_fetched)) - unix_micros(min(first_fetched))) / 1e6D"
    columns = {
        "num_pages_tried": f"CAST({tried} AS int)",
        "num_pages_ok": f"CAST({ok} AS int)",
        "escalated_to_js": "bool_or(escalated_to_js)",
        "retries_used": "CAST(sum(retries_used) AS int)",
        "status": company_status(tried, ok),
        "error": f"min_by({PAGE_ERROR}, if(text_len > 0, NULL, ord))",
        "total_time_s": f"coalesce({seconds}, 0D)",
    }
    return [expr(sql).alias(name) for name, sql in columns.items()]


def tally(pages: DataFrame) -> DataFrame:
    """Counts, status and first error of each company; needs no text."""
    return pages.groupBy("company_key").agg(*_tallies())


def roll_up(pages: DataFrame) -> DataFrame:
    """The tally of each company with its combined text and page list, both in page order.

    What is gathered per company is bounded by the page budget.
    """
    blocks = f"array_sort(collect_list(struct(ord, {TEXT_BLOCK} AS block)))"
    entry = "struct(ord, page_url AS url, page_name, status, text_len, escalated_to_js)"
    listed = (
        f"transform(array_sort(collect_list({entry})), p -> "
        "struct(p.url, p.page_name, p.status, p.text_len, p.escalated_to_js))"
    )
    return pages.groupBy("company_key").agg(
        *_tallies(),
        expr(rf"array_join(transform({blocks}, p -> p.block), '\n\n')").alias("combined_text"),
        expr(listed).alias("pages"),
    )


def _for_each_input(companies: DataFrame, rolled: DataFrame) -> DataFrame:
    """One row per input row. A company without an address is a failed row of its own."""
    counts = ("num_pages_tried", "num_pages_ok", "retries_used")
    return companies.join(rolled, "company_key", "left").withColumns(
        {
            "url": expr("coalesce(home, url)"),
            "escalated_to_js": expr("coalesce(escalated_to_js, false)"),
            "status": expr("if(home IS NULL, 'failed', status)"),
            "error": expr(f"if(home IS NULL, '{MISSING_URL}', error)"),
            "total_time_s": expr("coalesce(total_time_s, 0D)"),
            **{c: expr(f"coalesce({c}, 0)") for c in counts},
        }
    )


def result_rows(companies: DataFrame, rolled: DataFrame, ts: Column) -> DataFrame:
    """The results table, from `roll_up`."""
    rows = _for_each_input(companies, rolled)
    return rows.select(
        "id",
        "url",
        expr("coalesce(combined_text, '')").alias("combined_text"),
        "num_pages_tried",
        "num_pages_ok",
        expr("coalesce(pages, array())").alias("pages"),
        "escalated_to_js",
        "retries_used",
        "status",
        "error",
        "total_time_s",
        ts.alias("ts"),
    )


def log_rows(companies: DataFrame, tallied: DataFrame, ts: Column) -> DataFrame:
    """The log table, from `tally`: the counts include the homepage."""
    return _for_each_input(companies, tallied).select(
        "id",
        "url",
        ts.alias("ts"),
        "status",
        expr("num_pages_tried AS subpages_tried"),
        expr("num_pages_ok AS subpages_ok"),
        "escalated_to_js",
        "retries_used",
        "total_time_s",
        "error",
    )


def raw_rows(
    companies: DataFrame,
    pages: DataFrame,
    attempts: DataFrame,
    renders: DataFrame | None,
    options: Options,
    rows: int,
) -> DataFrame:
    """The raw page table: the markup each of the `rows` selected pages was judged on.

    Where the pages carry the places of their markup, it is read from there and never shuffled.
    Otherwise this is the only place where html is shuffled, so it is built only on request: the
    record of a page holds the hash of the content it was judged on, and rows of html are first
    reduced to those that a page names by address, attempt and hash. Copies of one are equal.
    """
    raw = [
        "id", "home AS url", "page_url", "coalesce(html, '') AS html",
        "last_fetched AS fetched_at", "escalated_to_js",
    ]
    if has_places(pages):
        named = companies.select("company_key", "id", "home").join(
            pages.select("company_key", "page_url", "place", "escalated_to_js", "last_fetched"),
            "company_key",
        )
        return read_at(named).selectExpr(*raw)
    wanted = companies.select("company_key", "id", "home").join(
        pages.selectExpr(
            "company_key", "page_url", f"if(escalated_to_js, {_RENDERED}, attempt) AS source",
            "content", "escalated_to_js", "last_fetched",
        ),
        "company_key",
    )
    keys = ["page_url", "source", "content"]
    named = wanted.where("content IS NOT NULL").select(*keys).distinct()
    read = within_budget(attempts, options)
    if options.js_fallback:
        read = read.where(f"NOT {is_blocked('status')}")
    bodies = read.selectExpr(
        "page_url", "attempt AS source", "xxhash64(status, html) AS content", "html"
    )
    if renders is not None:
        bodies = bodies.union(
            renders.selectExpr(
                "page_url", f"{_RENDERED} AS source", "xxhash64(html) AS content", "html"
            )
        )
    one = Window.partitionBy(*keys).orderBy(F.lit(1))
    bodies = (
        bodies.join(named, keys, "left_semi")
        .withColumn("_n", F.row_number().over(one))
        .where("_n = 1")
        .drop("_n")
    )
    return lookup(wanted, bodies, keys, "company_key", rows).selectExpr(*raw)
