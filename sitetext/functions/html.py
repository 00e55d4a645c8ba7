"""Expressions over page markup, as SQL text: visible text, prose extraction, anchors.

Every pattern runs in time linear in the page: an element that is never closed reaches to the
end of the page, and a tag never runs past the next `<` outside a quoted value. Groups are repeated
possessively, which the regex engine does in a loop, so a long page cannot exhaust its stack.
"""

from __future__ import annotations

from html.entities import name2codepoint

from sitetext.functions.sql import NO_STRINGS, Sql, bind, each, fresh, keep, quoted
from sitetext.functions.urls import base_parts, clean_reference, resolve_url

_SPACE = r"[ \t\n\r\f]"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+')"
# A quote opens a value only behind an equals sign; elsewhere it is an ordinary character.
_IN_TAG = rf"(?:[^<>=]++|={_SPACE}*+{_VALUE}?+)*+"
_ATTRS = rf"(?:[ \t\n\r\f/]{_IN_TAG})?"


def _element(name: str) -> str:
    return rf"{name}{_ATTRS}>.*?(?:</{name}{_ATTRS}>|\z)"


def _elements(names: tuple[str, ...]) -> str:
    return "|".join(_element(n) for n in names)


# Content that is neither prose nor markup.
_HIDDEN = quoted(rf"(?is)<(?:!--.*?(?:-->|\z)|{_elements(('script', 'style'))})")
# Elements that hold no prose of the page itself.
_BOILERPLATE = (
    "title", "noscript", "template", "iframe", "svg", "nav", "footer", "aside",
)
_BOILERPLATE_PATTERN = quoted(rf"(?is)<(?:{_elements(_BOILERPLATE)})")
# Elements of these that stand inside another of their kind; they go first.
_NESTING = ("nav", "footer", "aside")
_INNERMOST_PATTERN = quoted(
    rf"(?is)<({'|'.join(_NESTING)}){_ATTRS}>(?:[^<]++|<(?!/?\1[ \t\n\r\f/>]))*+</\1{_ATTRS}>"
)
# An article or main element is a teaser if the page has so many times its text, and this much.
_TEASER_TIMES, _PAGE_CHARACTERS = 5, 400
# Tags that end a line of text.
_BLOCK_TAGS = (
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "ol",
    "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "textarea",
    "tfoot", "th", "thead", "tr", "ul",
)
_BLOCK_PATTERN = quoted(rf"(?i)</?(?:{'|'.join(_BLOCK_TAGS)}){_ATTRS}>")
_TAG_PATTERN = quoted(rf"</?[A-Za-z!?]{_IN_TAG}>")
_BLANK = r"\u00a0\t\r\f"

# The character references decoded in text and in attribute values, and what the numbers 128 to
# 159 stand for.
NAMED_CHARACTERS = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
_WINDOWS = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)}
_REFERENCE = quoted(r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")

_HEXADECIMAL = quoted("^#[xX]([0-9A-Fa-f]{1,6});")
_DECIMAL = quoted("^#([0-9]{1,7});")


def unescape(text: Sql) -> Sql:
    """Decode character references once, from left to right. Unknown ones stay."""
    listed = "\n".join(f"{name}={char}" for name, char in NAMED_CHARACTERS.items())
    names = f"str_to_map({quoted(listed)}, '\n', '=')"
    numbers = "\n".join(f"{code}={char}" for code, char in _WINDOWS.items())
    windows = f"str_to_map({quoted(numbers)}, '\n', '=')"
    piece, place = fresh(), fresh()
    # Most references are named, and reading a number takes most of the time.
    code = (
        f"if(startswith({piece}, '#'), "
        f"coalesce(CAST(conv(regexp_extract({piece}, {_HEXADECIMAL}, 1), 16, 10) AS bigint), "
        f"try_cast(regexp_extract({piece}, {_DECIMAL}, 1) AS bigint)), NULL)"
    )

    def decoded(r: Sql) -> Sql:
        character = (
            f"CASE WHEN {r}.name = '' THEN NULL "
            f"WHEN {r}.code BETWEEN 128 AND 159 THEN try_element_at({windows}, CAST({r}.code AS string)) "
            f"WHEN {r}.code BETWEEN 1 AND 55295 OR {r}.code BETWEEN 57344 AND 1114111 "
            f"THEN decode(unhex(lpad(hex({r}.code), 8, '0')), 'UTF-32') "
            f"ELSE try_element_at({names}, {r}.name) END"
        )
        rest = f"substr({piece}, length({r}.name) + 2)"
        return f"coalesce(concat({character}, {rest}), concat('&', {piece}))"

    reference = f"named_struct('name', regexp_extract({piece}, {_REFERENCE}, 1), 'code', {code})"
    return (
        f"array_join(transform(split({text}, '&'), ({piece}, {place}) -> "
        f"if({place} = 0, {piece}, {bind(reference, decoded)})), '')"
    )


def visible_markup(html: Sql) -> Sql:
    """Markup without comments, scripts and style sheets."""
    return f"regexp_replace({html}, {_HIDDEN}, '')"


def _opens(tag: str) -> Sql:
    return quoted(rf"(?i)<{tag}{_ATTRS}>")


def _inner(markup: Sql, tag: str) -> Sql:
    """From the first opening `tag` to its last closing one, to the end if never closed."""
    to_opening = quoted(rf"(?is)^.*?<{tag}{_ATTRS}>")
    to_closing = quoted(rf"(?is)^(.*)</{tag}{_ATTRS}>")
    return bind(
        f"regexp_replace({markup}, {to_opening}, '')",
        lambda tail: f"coalesce(nullif(regexp_extract({tail}, {to_closing}, 1), ''), {tail})",
    )


def _main_content(markup: Sql) -> Sql:
    """The article or main element where the page has one that is no teaser, else the page."""

    def size(part: Sql) -> Sql:
        return f"length(regexp_replace({part}, {_TAG_PATTERN}, ''))"

    def chosen(part: Sql, page: Sql) -> Sql:
        teaser = (
            f"length({part}) * {_TEASER_TIMES} < length({page}) "
            f"AND {size(page)} >= greatest({_PAGE_CHARACTERS}, {_TEASER_TIMES} * {size(part)})"
        )
        return f"if({teaser}, NULL, {part})"

    def inner(page: Sql, tag: str) -> Sql:
        part = bind(_inner(page, tag), lambda v: chosen(v, page))
        return f"if(rlike({page}, {_opens(tag)}), {part}, NULL)"

    return bind(markup, lambda m: f"coalesce({inner(m, 'article')}, {inner(m, 'main')}, {m})")


def _prose(markup: Sql) -> Sql:
    """The main part of visible markup, boilerplate elements taken out."""
    shallow = rf"regexp_replace({markup}, {_INNERMOST_PATTERN}, '\n')"
    return _main_content(rf"regexp_replace({shallow}, {_BOILERPLATE_PATTERN}, '\n')")


def _text_of(prose: Sql) -> Sql:
    """Text of markup, one block per line."""
    lines = rf"regexp_replace(replace({prose}, '\n', ' '), {_BLOCK_PATTERN}, '\n')"
    plain = unescape(f"regexp_replace({lines}, {_TAG_PATTERN}, '')")
    blanks = quoted(f"[ {_BLANK}]{{2,}}|[{_BLANK}]")
    tidy = f"regexp_replace({plain}, {blanks}, ' ')"
    for blank in (r" \n", r"\n "):
        tidy = rf"replace({tidy}, '{blank}', '\n')"
    return rf"coalesce(trim(BOTH ' \n' FROM regexp_replace({tidy}, '\n\n+', '\n')), '')"


def markup_text(markup: Sql) -> Sql:
    """Prose of visible markup, one block per line; `''` when there is none."""
    return _text_of(_prose(markup))


# Private characters that stand for the start and the end of an anchor while blocks are weighed.
_LINK, _NO_LINK = "\ue000", "\ue001"
_LINK_TEXT = quoted(f"{_LINK}[^{_NO_LINK}]*{_NO_LINK}?")
_MARKS = f"'{_LINK}{_NO_LINK}'"
# A block of this many characters is prose if links are at most this share of it.
_LONG_BLOCK, _LINK_PERCENT = 80, 50


def weighed_blocks(markup: Sql) -> Sql:
    """Blocks of visible markup in order: array of text, chars and link_chars.

    An anchor reaches over blocks up to its end, the next anchor or the end of the page, so each
    block knows how much of it is link.
    """
    prose = _prose(f"translate({markup}, {_MARKS}, '')")
    opened = f"regexp_replace({prose}, {_opens('a')}, '{_LINK}')"
    closing = quoted(rf"(?i)</a{_ATTRS}>")
    text = _text_of(f"regexp_replace({opened}, {closing}, '{_NO_LINK}')")

    def reopened(part: Sql) -> Sql:
        """A part that starts in an anchor, with the anchor opened again on every line of it."""
        inside = f"split_part({part}, '{_NO_LINK}', 1)"
        after = f"substr({part}, length({inside}) + 2)"
        return (
            rf"concat('{_LINK}', replace({inside}, '\n', '{_NO_LINK}\n{_LINK}'), '{_NO_LINK}', {after})"
        )

    part, place = fresh(), fresh()
    marked = (
        f"array_join(transform(split({text}, '{_LINK}'), ({part}, {place}) -> "
        f"if({place} = 0, {part}, {reopened(part)})), '')"
    )

    def weighed(line: Sql) -> Sql:
        plain = f"translate({line}, {_MARKS}, '')"
        outside = f"translate(regexp_replace({line}, {_LINK_TEXT}, ''), {_MARKS}, '')"
        return (
            f"named_struct('text', trim(regexp_replace({plain}, ' {{2,}}', ' ')), "
            f"'chars', length({plain}), 'link_chars', length({plain}) - length({outside}))"
        )

    return keep(each(rf"split({marked}, '\n')", weighed), lambda b: f"{b}.text <> ''")


def dense_text(html: Sql) -> Sql:
    """Prose of a page without its lists of links; `''`, never null, when there is none.

    Blocks that are mostly links go. A long block stays, and a short one, such as a heading or a
    caption, stays next to a long one; where no block is long, all that are not links stay.
    """

    def chosen(blocks: Sql) -> Sql:
        def is_prose(b: Sql) -> Sql:
            return f"100 * {b}.link_chars <= {_LINK_PERCENT} * {b}.chars"

        def is_long(b: Sql) -> Sql:
            return f"({b}.chars >= {_LONG_BLOCK} AND {is_prose(b)})"

        block, place, any_block = fresh(), fresh(), fresh()
        beside = " OR ".join(
            f"coalesce({is_long(f'get({blocks}, {place} {step} 1)')}, false)" for step in "-+"
        )
        some_long = f"exists({blocks}, {any_block} -> {is_long(any_block)})"
        kept = (
            f"filter({blocks}, ({block}, {place}) -> {is_prose(block)} AND "
            f"({is_long(block)} OR NOT {some_long} OR {beside}))"
        )
        return rf"array_join({each(kept, lambda b: f'{b}.text')}, '\n')"

    blocks = bind(visible_markup(html), weighed_blocks)
    return f"coalesce({bind(blocks, chosen)}, '')"


def extract_text(html: Sql) -> Sql:
    """Prose of a page; `''`, never null, when there is none."""
    return markup_text(visible_markup(html))


def _href(tag: str) -> Sql:
    """The tag with its first href; attributes before it are passed over whole."""
    sign = rf"{_SPACE}*+={_SPACE}*+"
    other = rf"(?!href{_SPACE}*=)[^ \t\n\r\f/<>=]++(?:{sign}(?:{_VALUE}|[^ \t\n\r\f<>\"']++)?+)?+"
    return quoted(
        rf"(?i)<{tag}(?=[ \t\n\r\f/])(?:[ \t\n\r\f/=]++|{other})*+href{sign}"
        rf"({_VALUE}|[^ \t\n\r\f\"'<>]+)"
    )


_QUOTED = quoted("(?s)^([\"'])(.*)\\1$")


def _attribute_value(raw: Sql) -> Sql:
    return clean_reference(unescape(f"regexp_replace({raw}, {_QUOTED}, '$2')"))


# An http(s) address whose authority has no bracket, or one pair of them.
_WEB_LINK = quoted(r"^https?://[^/?#\[\]]*(?:\[[^/?#\[\]]*\][^/?#\[\]]*)?(?:[/?#]|$)")


def anchor_hrefs(markup: Sql) -> Sql:
    """Addresses of the anchors of visible markup, in order, as they are written."""
    return f"regexp_extract_all({markup}, {_href('a')}, 1)"


def base_href(markup: Sql) -> Sql:
    """Address of the page's last base element as it is written, null if it has none."""
    found = f"regexp_extract_all({markup}, {_href('base')}, 1)"
    has_base = quoted(r"(?i)<base[ \t\n\r\f/]")
    last = bind(found, lambda a: f"get({a}, size({a}) - 1)")
    return f"if(rlike({markup}, {has_base}), {last}, NULL)"


def base_address(base: Sql, page_url: Sql) -> Sql:
    """Address that the links of a page are relative to, from its `base_href`."""
    own = bind(base_parts(page_url), lambda page: resolve_url(page, _attribute_value(base)))
    return f"if({base} IS NULL, {page_url}, {own})"


def absolute_links(hrefs: Sql, base: Sql) -> Sql:
    """Absolute http(s) links of a page from its `anchor_hrefs`, in order, duplicates kept.

    `base` are the `base_parts` of its `base_address`. A link whose authority has an unpaired
    bracket is dropped.
    """
    links = each(hrefs, lambda raw: bind(_attribute_value(raw), lambda ref: resolve_url(base, ref)))
    on_web = keep(links, lambda u: f"rlike({u}, {_WEB_LINK})")
    return f"coalesce({on_web}, {NO_STRINGS})"


def anchor_links(html: Sql, page_url: Sql) -> Sql:
    """Absolute http(s) links of a page's anchors, in order, duplicates kept."""

    def links(markup: Sql) -> Sql:
        base = bind(base_href(markup), lambda b: base_address(b, page_url))
        return bind(
            bind(base, base_parts), lambda parts: absolute_links(anchor_hrefs(markup), parts)
        )

    return bind(visible_markup(html), links)
