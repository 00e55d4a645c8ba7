"""Expressions that judge one page, as SQL text: blocked, in need of rendering, challenged."""

from __future__ import annotations

from collections.abc import Sequence

from sitetext.config import BLOCKING_STATUSES, MIN_TEXT_LENGTH, NO_RESPONSE
from sitetext.functions.sql import Sql, bind, contains_any

_BLOCKING = ", ".join(str(s) for s in (NO_RESPONSE, *BLOCKING_STATUSES))


def is_blocked(status: Sql) -> Sql:
    return f"({status} IN ({_BLOCKING}))"


def is_thin(text: Sql) -> Sql:
    return f"(length({text}) < {MIN_TEXT_LENGTH})"


def render_reason(status: Sql, text: Sql) -> Sql:
    """Why a page needs rendering, null if it does not. `no_links` is found by discovery."""
    return f"CASE WHEN {is_blocked(status)} THEN 'blocked' WHEN {is_thin(text)} THEN 'thin_text' END"


def is_challenge(text: Sql, phrases: Sequence[str]) -> Sql:
    return bind(f"lower({text})", lambda t: contains_any(t, phrases))


def gated_text(text: Sql, escalated: Sql, phrases: Sequence[str]) -> Sql:
    """Text of a rendered page is discarded when it is short or a challenge page."""
    return bind(
        text,
        lambda t: f"if({escalated} AND ({is_thin(t)} OR {is_challenge(t, phrases)}), '', {t})",
    )


def company_status(tried: Sql, ok: Sql) -> Sql:
    return f"CASE WHEN {ok} = 0 THEN 'failed' WHEN {ok} < {tried} THEN 'partial' ELSE 'ok' END"
