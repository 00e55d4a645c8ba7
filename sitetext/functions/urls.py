"""URL expressions, as SQL text. Plain functions only: usable in lambdas and on streams."""

from __future__ import annotations

import re
from collections.abc import Sequence

from sitetext.config import BINARY_EXTENSIONS
from sitetext.functions.sql import Sql, bind, quoted

# scheme, authority, path, query, fragment. parse_url is not used: it raises, or gives
# null, for addresses that occur in real pages ("/a|b", "a_b.com").
_URL = quoted(
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
_SCHEME = quoted(r"^([A-Za-z][A-Za-z0-9+.\-]*):")
_AFTER_SCHEME = quoted(r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?([^?#]*)(.*)$")
# Slashes that open an authority which is empty.
_EMPTY_AUTHORITY = quoted(r"^//(?=/|$)")
_AFTER_PARAMS = quoted(r";[^/]*$")
_PARAMS = quoted(r";([^/]*)$")
_QUERY_PART = quoted(r"(?s)^[^?#]*(\?[^#]+)?")
_EXTENSION = quoted(rf"(?i)\.(?:{'|'.join(BINARY_EXTENSIONS)})$")


def url_scheme(url: Sql) -> Sql:
    return f"lower(regexp_extract({url}, {_SCHEME}, 1))"


def url_host(url: Sql) -> Sql:
    """Authority of the URL: case and port are kept."""
    return f"regexp_extract({url}, {_URL}, 2)"


def url_full_path(url: Sql) -> Sql:
    """Path with the `;params` of its last segment."""
    return f"regexp_extract({url}, {_URL}, 3)"


def url_path(url: Sql) -> Sql:
    return f"regexp_replace({url_full_path(url)}, {_AFTER_PARAMS}, '')"


def url_params(url: Sql) -> Sql:
    """Text after the first `;` of the last path segment."""
    return f"regexp_extract({url_full_path(url)}, {_PARAMS}, 1)"


def url_query(url: Sql) -> Sql:
    return f"regexp_extract({url}, {_URL}, 4)"


def url_fragment(url: Sql) -> Sql:
    return f"regexp_extract({url}, {_URL}, 5)"


def bare_host(url: Sql) -> Sql:
    """Host without one leading `www.`, the identity of a site in link filtering."""
    return f"regexp_replace({url_host(url)}, '^www[.]', '')"


def site_root(url: Sql) -> Sql:
    return f"concat({url_scheme(url)}, '://', {url_host(url)})"


def sitemap_address(root: Sql) -> Sql:
    return f"concat({root}, '/sitemap.xml')"


def robots_address(root: Sql) -> Sql:
    return f"concat({root}, '/robots.txt')"


def _params_part(url: Sql) -> Sql:
    """The parameters with their `;`, or nothing."""
    return f"regexp_extract({url_full_path(url)}, ';[^/]+$', 0)"


def _query_part(url: Sql) -> Sql:
    """The query with its `?`, or nothing."""
    return f"regexp_extract({url}, {_QUERY_PART}, 1)"


def normalize_url(url: Sql) -> Sql:
    """Add a missing scheme, lower it, drop the fragment and the path's trailing slashes."""

    def rebuilt(full: Sql) -> Sql:
        scheme, host = url_scheme(full), url_host(full)
        return (
            f"concat(if({scheme} = '', '', concat({scheme}, ':')), "
            # A web address has an authority even when it is empty.
            f"if({host} <> '' OR {scheme} IN ('http', 'https'), concat('//', {host}), ''), "
            f"trim(TRAILING '/' FROM {url_path(full)}), {_params_part(full)}, {_query_part(full)})"
        )

    return bind(f"if(contains({url}, '://'), {url}, concat('https://', {url}))", rebuilt)


def url_slug(url: Sql) -> Sql:
    """Last path segment, `home` when there is none."""
    segment = f"regexp_extract(trim(TRAILING '/' FROM {url_path(url)}), '([^/]*)$', 1)"
    return f"coalesce(nullif({segment}, ''), 'home')"


def has_binary_extension(url: Sql) -> Sql:
    """True when the last path segment ends in the extension of a file that is not a page."""
    return f"rlike({url_path(url)}, {_EXTENSION})"


def score_path(path: Sql, high: Sequence[str], low: Sequence[str]) -> Sql:
    """2 if the lower-cased path contains a high keyword, else -1 for a low one, else 0.

    Keywords are taken as given: one with capitals never matches.
    """

    def has(words: Sequence[str]) -> Sql:
        pattern = "|".join(re.escape(word) for word in words)
        return f"rlike(lower({path}), {quoted(pattern)})" if words else "false"

    return f"CASE WHEN {has(high)} THEN 2 WHEN {has(low)} THEN -1 ELSE 0 END"


def path_depth(path: Sql) -> Sql:
    return f"length(regexp_replace({path}, '[^/]+', ''))"


# --- Resolving references ---------------------------------------------------


# Space and the control characters before it, as a string literal.
_CONTROLS = "'" + "".join(f"\\u{i:04x}" for i in range(33)) + "'"


def clean_reference(ref: Sql) -> Sql:
    """Strip blanks and control characters round the reference, and line breaks inside it."""
    return rf"translate(trim(BOTH {_CONTROLS} FROM {ref}), '\t\r\n', '')"


def base_parts(base: Sql) -> Sql:
    """What `resolve_url` needs to know of a base address, to be computed once per page."""
    path = url_full_path(base)
    folder = f"coalesce(nullif(regexp_extract({path}, '(?s)^(.*/)', 1), ''), '/')"
    return (
        f"named_struct('url', {base}, 'scheme', {url_scheme(base)}, 'root', {site_root(base)}, "
        f"'path', {path}, 'folder', {folder}, 'query', {_query_part(base)})"
    )


def remove_dot_segments(path: Sql) -> Sql:
    """Resolve `.` and `..` segments of a path that starts at the root."""
    open_end = quoted(r"(^|/)(\.\.?)$")
    segments = f"split(regexp_replace({path}, {open_end}, '$1$2/'), '/')"
    kept = (
        f"aggregate({segments}, CAST(array() AS array<string>), (kept, segment) -> "
        "CASE segment WHEN '..' THEN slice(kept, 1, greatest(size(kept) - 1, 0)) "
        "WHEN '.' THEN kept ELSE concat(kept, array(segment)) END)"
    )
    without_slash = quoted("^(?!/)")
    return f"regexp_replace(array_join({kept}, '/'), {without_slash}, '/')"


def _without_empty_tail(url: Sql) -> Sql:
    """An empty query or fragment vanishes."""
    empty_query = quoted(r"\?(#|$)")
    return f"regexp_replace(regexp_replace({url}, '#$', ''), {empty_query}, '$1')"


def resolve_url(base: Sql, ref: Sql) -> Sql:
    """Absolute form of a cleaned reference; `base` is a `base_parts` struct.

    Follows RFC 3986 section 5.2, with the common leniency that a reference repeating the
    base's scheme without an authority is relative, and so is one with an empty authority.
    """
    has_dots, query_only = quoted(r"/\.\.?(/|$)"), quoted(r"^\?[^#]")

    def absolute_path(path: Sql) -> Sql:
        merged = (
            f"if(startswith({path}, '/'), {path}, "
            f"regexp_replace(concat({base}.folder, {path}), '/{{2,}}', '/'))"
        )
        return bind(
            merged,
            lambda m: f"if(contains({m}, '/.') AND rlike({m}, {has_dots}), "
            f"{remove_dot_segments(m)}, {m})",
        )

    def relative(r: Sql) -> Sql:
        return (
            f"CASE WHEN {r}.has_host "
            f"THEN concat({base}.scheme, ':', {r}.path, {r}.tail) "
            f"WHEN {r}.path <> '' THEN concat({base}.root, {absolute_path(f'{r}.path')}, {r}.tail) "
            f"WHEN rlike({r}.tail, {query_only}) THEN concat({base}.root, {base}.path, {r}.tail) "
            f"ELSE concat({base}.root, {base}.path, {base}.query, trim(LEADING '?' FROM {r}.tail)) END"
        )

    def by_scheme(r: Sql) -> Sql:
        return (
            f"CASE WHEN {r}.ref = '' THEN {base}.url "
            f"WHEN {r}.scheme NOT IN ('', {base}.scheme) THEN {r}.ref "
            f"ELSE {_without_empty_tail(relative(r))} END"
        )

    path = f"regexp_extract({ref}, {_AFTER_SCHEME}, 1)"
    parts = (
        f"named_struct('ref', {ref}, 'scheme', {url_scheme(ref)}, "
        f"'has_host', rlike({path}, '^//[^/]'), "
        f"'path', regexp_replace({path}, {_EMPTY_AUTHORITY}, ''), "
        f"'tail', regexp_extract({ref}, {_AFTER_SCHEME}, 2))"
    )
    return bind(parts, by_scheme)
