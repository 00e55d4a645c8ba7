"""Expressions over a company's list of links, as SQL text.

A company's raw links are capped at 200, so the list stays in one row and filtering and ranking
it need no shuffle. Links that come one per row are ranked by `operators.ranking` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from sitetext.functions.sql import Sql, bind, each, keep
from sitetext.functions.urls import (
    bare_host,
    has_binary_extension,
    normalize_url,
    path_depth,
    score_path,
    url_path,
    url_scheme,
)


def is_site_page(url: Sql, host: Sql) -> Sql:
    """True for a web page of the site with this bare host."""
    return (
        f"({url_scheme(url)} IN ('http', 'https') AND {bare_host(url)} = {host} "
        f"AND NOT {has_binary_extension(url)})"
    )


def site_links(links: Sql, host: Sql) -> Sql:
    """Pages of the site, each address once, at its first place."""
    return bind(host, lambda h: f"array_distinct({keep(links, lambda u: is_site_page(u, h))})")


def without_homepage(links: Sql, homepage: Sql) -> Sql:
    return keep(links, lambda u: f"{normalize_url(u)} <> {homepage}")


def ranked_links(
    links: Sql, high: Sequence[str], low: Sequence[str], limit: int | None = None
) -> Sql:
    """Best links first: score, then shallow paths, then the order given."""
    keys = bind(
        url_path("link"),
        lambda path: f"struct(-{score_path(path, high, low)} AS score, "
        f"{path_depth(path)} AS depth, pos, link)",
    )
    ordered = each(f"array_sort(transform({links}, (link, pos) -> {keys}))", lambda k: f"{k}.link")
    return ordered if limit is None else f"slice({ordered}, 1, {limit})"


def link_entries(links: Sql) -> Sql:
    """Links with their normal form where it differs, so that it is worked out only once."""
    return each(
        links, lambda u: f"named_struct('url', {u}, 'normal', nullif({normalize_url(u)}, {u}))"
    )


def first_entries(entries: Sql, homepage: Sql, limit: int) -> Sql:
    """The first `limit` links other than the homepage."""
    others = keep(entries, lambda e: f"coalesce({e}.normal, {e}.url) <> {homepage}")
    return each(f"slice({others}, 1, {limit})", lambda e: f"{e}.url")
