"""From captured markup to one judged record per page.

This is the only step that reads html, and the markup ends here: each row is reduced to its text
and links in the task that read it, and only those are shuffled. Where captures carry their places,
the rows that count are found first and only these are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.functions import expr

from sitetext.config import Options
from sitetext.functions.html import anchor_hrefs, base_href, markup_text, visible_markup
from sitetext.functions.judgement import gated_text, is_blocked, render_reason
from sitetext.functions.sitemaps import is_markup, robots_sitemaps, sitemap
from sitetext.functions.sql import head
from sitetext.functions.urls import has_binary_extension, robots_address, site_root
from sitetext.operators.attempts import (
    attempt_rank,
    first_and_last,
    times_by_attempt,
    within_budget,
)
from sitetext.operators.rejects import usable
from sitetext.sources.places import has_places, read_at


#: What tells pages apart.
ADDRESS = ("page_url",)


def _others(keys: Sequence[str]) -> list[str]:
    """The keys that `reduced_rows` doesn't give by itself."""
    return [k for k in keys if k not in ADDRESS]


def _captured_rows(
    attempts: DataFrame, renders: DataFrame | None, options: Options, keys: Sequence[str]
) -> DataFrame:
    """Attempts and renders as one table, so that both go through one scan and one shuffle."""
    rows = within_budget(usable(attempts), options).select(
        *keys, "attempt", "status", "html", "fetched_at"
    )
    if renders is None or not options.js_fallback:
        return rows
    return rows.unionByName(renders.select(*keys, "html"), allowMissingColumns=True)


def reduced_rows(rows: DataFrame, options: Options, *kept: str) -> DataFrame:
    """Text, links and sitemap content of each row, in place of its html; `kept` stay too."""
    # The body of a blocked page is replaced by its rendering, so it need not be read.
    unread = f"attempt IS NOT NULL AND {is_blocked('status')}" if options.js_fallback else "false"
    # Sitemaps and robots files are fetched once, without retries.
    document = "if(attempt = 0 AND status = 200, html, NULL)"
    own_robots = f"page_url = {robots_address(site_root('page_url'))}"
    # A sitemap at the address of a file is never a page, so no prose is read from it.
    file_sitemap = f"(size(sitemap.locs) > 0 AND {has_binary_extension('page_url')})"
    visible = f"if({unread} OR {file_sitemap}, NULL, {visible_markup('html')})"
    return (
        rows.withColumn("sitemap", expr(sitemap(document)))
        .withColumn("markup", expr(visible))
        .selectExpr(
            "page_url",
            "attempt",
            "status",
            "fetched_at",
            "xxhash64(status, html) AS content",
            "if(attempt IS NULL, struct(length(html) AS size, xxhash64(html) AS content), NULL) AS render_rank",
            f"{markup_text('markup')} AS text",
            # Resolved by discovery, and only for the homepages that need their anchors.
            f"struct({anchor_hrefs('markup')} AS hrefs, {base_href('markup')} AS base) AS anchors",
            f"{head('sitemap.locs', options.max_raw_links)} AS locs",
            "sitemap.is_index AS is_index",
            f"{is_markup(document)} AS is_markup",
            f"if({own_robots}, {robots_sitemaps(document)}, NULL) AS robots",
            *kept,
        )
    )


#: What a record keeps of the attempt and of the rendering that count, from `reduced_rows`.
CAPTURED = "attempt, status, content, text, anchors, locs, is_index, is_markup, robots"
RENDERED = "text, anchors, render_rank.content"


def _folded_rows(
    attempts: DataFrame, renders: DataFrame | None, options: Options, keys: Sequence[str]
) -> DataFrame:
    """Every row reduced, then one per page kept: for captures without places."""
    rank = f"if(attempt IS NOT NULL, {attempt_rank('content')}, NULL)"
    return (
        reduced_rows(_captured_rows(attempts, renders, options, keys), options, *_others(keys))
        .groupBy(*keys)
        .agg(
            expr(f"min_by(struct({CAPTURED}), {rank})").alias("c"),
            # Of several renderings of a page the longest is taken.
            expr(f"max_by(struct({RENDERED}), render_rank)").alias("r"),
            *times_by_attempt(options),
        )
        .selectExpr(*keys, "c", "r", *first_and_last("c.attempt"))
    )


def _folded_places(
    attempts: DataFrame, renders: DataFrame | None, options: Options, keys: Sequence[str]
) -> DataFrame:
    """The attempt and the rendering that count are found by their places, and only these are read.

    No row with text is sorted: what is folded is narrow, and texts of attempts meet those of
    renderings, one row per page each, in a hash join.
    """
    rank = attempt_rank("xxhash64(place.file, place.row)")
    named = (
        within_budget(usable(attempts), options)
        .groupBy(*keys)
        .agg(
            expr(f"min_by(struct(attempt, status, place), {rank})").alias("o"),
            *times_by_attempt(options),
        )
        .selectExpr(*keys, *first_and_last("o.attempt"), "o.*")
    )
    own = reduced_rows(
        read_at(named).withColumn("fetched_at", expr("last_fetched")), options,
        "place", "first_fetched", "last_fetched", *_others(keys),
    ).selectExpr(*keys, f"struct({CAPTURED}, place) AS c", "first_fetched", "last_fetched")
    if renders is None or not options.js_fallback:
        nothing = "struct(CAST(NULL AS string) AS text, c.anchors AS anchors, 0L AS content, c.place AS place)"
        return own.withColumn("r", expr(f"if(true, NULL, {nothing})"))
    longest = renders.groupBy(*keys).agg(
        expr("max_by(place, struct(length(html), xxhash64(html)))").alias("place")
    )
    none = "CAST(NULL AS int) AS attempt", "CAST(NULL AS int) AS status", "CAST(NULL AS timestamp) AS fetched_at"
    shown = reduced_rows(
        read_at(longest).selectExpr("*", *none), options, "place", *_others(keys)
    ).selectExpr(*keys, f"struct({RENDERED}, place) AS r")
    return own.join(shown.hint("shuffle_hash"), list(keys), "full")


def page_digests(
    attempts: DataFrame,
    renders: DataFrame | None,
    options: Options,
    keys: Sequence[str] = ADDRESS,
) -> DataFrame:
    """One record per captured address: outcome, judged text, links, sitemap content.

    `keys`, page_url among them, are columns of attempts and renders that tell pages apart, for
    tables in which several pages have one address; each gets a record with these columns.

    Columns: page_url, attempt, status, retries_used, first_fetched, last_fetched, reason,
    escalated, text, text_len, anchors, unused_anchors (of a rendering that was not needed so
    far), content and render_content (hashes of the attempt and the rendering that count), locs,
    is_index, is_markup, robots.

    Rows without an address, and with an impossible attempt number or status, take no part (see
    `operators.rejects`).

    Where attempts and renders have places (see `sources.places`), only the rows that count are
    read, and their places stay in the record, as place and render_place. Among copies of one
    attempt the hash of the content decides without places, and the hash of the place with them.
    """
    by_place = has_places(attempts, renders)
    fold = _folded_places if by_place else _folded_rows
    return judged_records(fold(attempts, renders, options, keys), options, by_place, keys)


def judged_records(
    folded: DataFrame, options: Options, places: bool, keys: Sequence[str] = ADDRESS
) -> DataFrame:
    """Records from the attempt `c` and the rendering `r` that count for each page."""
    folded = folded.withColumn("status", expr("coalesce(c.status, 0)")).withColumn(
        "own_text", expr("coalesce(c.text, '')")
    )
    reason = render_reason("status", "own_text") if options.js_fallback else "CAST(NULL AS string)"
    text = "if(escalated, coalesce(r.text, ''), own_text)"
    return (
        folded.withColumn("reason", expr(reason))
        .withColumn("escalated", expr("reason IS NOT NULL"))
        .withColumn("text", expr(gated_text(text, "escalated", options.challenge_phrases)))
        .selectExpr(
            *keys,
            "c.attempt AS attempt",
            "status",
            "coalesce(c.attempt, 0) AS retries_used",
            "first_fetched",
            "last_fetched",
            "reason",
            "escalated",
            "text",
            "length(text) AS text_len",
            "if(escalated, r.anchors, c.anchors) AS anchors",
            "if(escalated, NULL, r.anchors) AS unused_anchors",
            "c.content AS content",
            "r.content AS render_content",
            "c.locs",
            "c.is_index",
            "c.is_markup",
            "c.robots",
            *(("c.place AS place", "r.place AS render_place") if places else ()),
        )
    )


def render_queue(
    judged: DataFrame, renders: DataFrame | None = None, keys: Sequence[str] = ADDRESS
) -> DataFrame:
    """Pages that need rendering and why, each once; those with a rendering are left out.

    Companies share pages, so they are made distinct, in the tasks first, before the join. `keys`
    are the columns that tell pages apart.
    """
    wanted = judged.where("reason IS NOT NULL").select(*keys, "reason")
    if renders is None:
        return wanted.distinct()
    return wanted.distinct().join(renders.select(*keys), list(keys), "left_anti")
