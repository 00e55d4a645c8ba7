"""Expressions over sitemap and robots bodies, as SQL text.

Malformed input gives empty lists, never an error.
"""

from __future__ import annotations

import re

from sitetext.config import SITEMAP_NAMESPACE
from sitetext.functions.html import unescape
from sitetext.functions.sql import NO_STRINGS, Sql, bind, each, fresh, keep, quoted

_NAME, _BLANK = r"[A-Za-z_][\w.\-]*", r"[ \t\r\n]"
# The first element of a document: prefix and local name. Declaration and document type may come
# before it; comments and processing instructions are taken out first.
_ROOT = quoted(rf"<(?:({_NAME}):)?({_NAME})(?=[ \t\r\n/>])")
_OUTSIDE = quoted(r"(?s)<!--.*?(?:-->|\z)|<\?.*?(?:\?>|\z)")
_SECTION = r"<!\[CDATA\[(?:[^\]]++|\](?!\]>))*+\]\]>"
_SECTIONS = quoted(_SECTION)
_BINDING = quoted(
    rf"{_BLANK}xmlns(?::({_NAME}))?{_BLANK}*={_BLANK}*[\"']{re.escape(SITEMAP_NAMESPACE)}[\"']"
)
_PREFIXED_TAG = quoted(rf"</?({_NAME}):")
# A section of character data, or a loc element up to the first tag in it.
_TOKEN = quoted(rf"{_SECTION}|<(?:{_NAME}:)?loc(?:{_BLANK}[^<>]*+)?>(?:[^<]++|{_SECTION})*+")
_LOC = quoted(rf"^<(?:({_NAME}):)?loc(?:{_BLANK}[^<>]*+)?>")
_EMPTY_LOC = quoted("^<[^<>]*/>")
_SECTION_TEXT = quoted(r"(?s)<!\[CDATA\[(.*?)\]\]>")
_INDEX_ROOT = quoted(rf"(?i)<(?:{_NAME}:)?sitemapindex[ \t\r\n/>]")
# The parser only tells whether a document is well formed; no column of it is filled.
_XML = quoted("unused string, _corrupt_record string")
_XML_OPTIONS = "map('columnNameOfCorruptRecord', '_corrupt_record')"


def strip_blanks(text: Sql) -> Sql:
    return rf"trim(BOTH ' \t\n\u000b\u000c\r' FROM {text})"


def _may_be_sitemap(body: Sql) -> Sql:
    """Cheap test that spares every other body the XML parser."""
    return f"({body} LIKE '%{SITEMAP_NAMESPACE}%' OR rlike({body}, {_INDEX_ROOT}))"


def _well_formed(body: Sql, plain: Sql) -> Sql:
    """Whether a document is well formed; `plain` is its markup without comments and sections."""
    # The parser stops after the root element and takes any prefix; text behind the root and a
    # prefix without a namespace are errors all the same.
    used, prefix = f"array_distinct(regexp_extract_all({plain}, {_PREFIXED_TAG}, 1))", fresh()
    root = f"regexp_extract({plain}, {_ROOT}, 0)"
    closing = quoted(rf"{_BLANK}*>{_BLANK}*$")
    return (
        f"(from_xml({body}, {_XML}, {_XML_OPTIONS})._corrupt_record IS NULL "
        f"AND forall({used}, {prefix} -> rlike({plain}, concat('xmlns:', {prefix}, '[ \\t\\r\\n]*='))) "
        f"AND (rlike({plain}, concat('</', substr({root}, 2), {closing})) "
        f"OR rlike({plain}, {quoted(rf'/>{_BLANK}*$')})))"
    )


def _locs(markup: Sql, plain: Sql) -> Sql:
    """Text of every loc element in the sitemap namespace, in order, trimmed."""

    def of_prefix(prefixes: Sql) -> Sql:
        tokens = keep(
            f"regexp_extract_all({markup}, {_TOKEN}, 0)",
            lambda t: f"NOT startswith({t}, '<!') AND NOT rlike({t}, {_EMPTY_LOC}) "
            f"AND array_contains({prefixes}, regexp_extract({t}, {_LOC}, 1))",
        )
        return each(tokens, lambda t: bind(f"regexp_replace({t}, {_LOC}, '')", _loc_text))

    found = bind(f"array_distinct(regexp_extract_all({plain}, {_BINDING}, 1))", of_prefix)
    return keep(found, lambda u: f"{u} <> ''")


def _loc_text(raw: Sql) -> Sql:
    sections = f"regexp_replace({raw}, {_SECTION_TEXT}, '$1')"
    return strip_blanks(f"if(contains({raw}, '<!['), {sections}, {unescape(raw)})")


def sitemap(body: Sql) -> Sql:
    """What a body is as a sitemap: locs, the addresses of its loc elements in the sitemap
    namespace at any depth, and is_index, whether its root is a sitemap index in any namespace.

    One pass of the XML parser; both are empty or false unless the document is well formed.
    """

    def read(markup: Sql) -> Sql:
        def by_plain(plain: Sql) -> Sql:
            index = f"lower(regexp_extract({plain}, {_ROOT}, 2)) = 'sitemapindex'"
            return (
                f"if({_well_formed(body, plain)}, "
                f"named_struct('locs', {_locs(markup, plain)}, 'is_index', {index}), NULL)"
            )

        return bind(f"regexp_replace({markup}, {_SECTIONS}, '')", by_plain)

    nothing = f"named_struct('locs', {NO_STRINGS}, 'is_index', false)"
    found = bind(f"regexp_replace({body}, {_OUTSIDE}, '')", read)
    return f"coalesce(if({_may_be_sitemap(body)}, {found}, NULL), {nothing})"


def is_broken_sitemap(body: Sql) -> Sql:
    """True for a body that means to be a sitemap and is not well formed; a body without any
    tag is passed over before the patterns are tried."""

    def broken(markup: Sql) -> Sql:
        return bind(
            f"regexp_replace({markup}, {_SECTIONS}, '')",
            lambda plain: f"NOT {_well_formed(body, plain)}",
        )

    found = bind(f"regexp_replace({body}, {_OUTSIDE}, '')", broken)
    is_meant = f"contains({body}, '<') AND {_may_be_sitemap(body)} AND {is_markup(body)}"
    return f"coalesce({is_meant} AND {found}, false)"


def sitemap_locs(body: Sql) -> Sql:
    """Addresses of a sitemap or of a sitemap index, in order."""
    return f"{sitemap(body)}.locs"


def is_sitemap_index(body: Sql) -> Sql:
    """True for a well-formed document whose root is a sitemap index, in any namespace."""
    return f"{sitemap(body)}.is_index"


def is_markup(body: Sql) -> Sql:
    """The acceptance test of a site's main sitemap."""
    opens = quoted(r"^\s*<")
    return f"coalesce(rlike({body}, {opens}), false)"


def robots_sitemaps(body: Sql) -> Sql:
    """Addresses of the `Sitemap:` lines of a robots file, in order."""
    line_end = quoted(r"\r\n|\n|\r")
    lines = keep(
        f"split({body}, {line_end})", lambda line: f"startswith(lower({line}), 'sitemap:')"
    )
    addresses = each(
        lines, lambda line: strip_blanks(f"regexp_replace({line}, '^[^:]*:', '')")
    )
    return f"coalesce({addresses}, {NO_STRINGS})"
