"""Fetch attempts that arrive as a stream, folded into the outcome of each page."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sitetext.config import Options
from sitetext.functions.judgement import is_blocked
from sitetext.operators.attempts import attempt_rank, within_budget
from sitetext.plans.workers import importable

_RANK = "position bigint, age bigint, content bigint"


def _fold(n_payload: int, wait_ms: int, names: list[str]):
    """The function that keeps the best attempt of a page; `names` are the columns it emits."""

    def outcome(page: str, best: tuple, final: bool) -> pd.DataFrame:
        row = (page, *best[3 : 5 + n_payload], final)
        return pd.DataFrame([row], columns=names)

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            best = state.get
            state.remove()
            yield outcome(key[0], best, True)
            return
        before = state.get if state.exists else None
        best, latest = before, before[-1] if before else 0
        for part in parts:
            latest = max(latest, int(part["seen_ms"].max()))
            for row in part.drop(columns=["page_url", "seen_ms"]).itertuples(index=False, name=None):
                row = tuple(None if x is pd.NA or x != x else x for x in row)
                if best is None or row[:3] < best[:3]:
                    best = (*map(int, row[:5]), *row[5:], 0)
        changed = before is None or best[:3] != before[:3]
        state.update((*best[:-1], latest))
        state.setTimeoutTimestamp(max(latest + wait_ms, state.getCurrentWatermarkMs() + 1))
        if changed:
            yield outcome(key[0], best, False)

    return fold


def fold_attempts_stream(
    attempts: DataFrame,
    options: Options,
    payload: Sequence[str] = ("html",),
    lateness: str = "1 hour",
) -> DataFrame:
    """Outcomes of pages as attempts arrive, in update mode, in any order.

    `attempts` is a stream with the columns of ATTEMPTS_SCHEMA. Whenever an attempt changes the outcome
    of its page, a row says so: page_url, status, retries_used, the payload columns (strings) and
    final, which is false. The last row of a page is what `fold_attempts` gives for all its
    attempts. A page is kept until the longest delay before a further attempt, and the lateness, have
    passed in event time since its latest capture; then one more row, with final true, closes it.
    Attempts behind the watermark are dropped, and so are rows without a page or a capture time.
    """
    fields = ", ".join(f"{c} string" for c in payload)
    content = f"xxhash64({', '.join(('status', *payload))})"
    ranked = (
        within_budget(attempts, options)
        .where("page_url IS NOT NULL AND fetched_at IS NOT NULL")
        .withWatermark("fetched_at", lateness)
        .selectExpr(
            "page_url", f"{attempt_rank(content)} AS r", "status", "attempt", *payload, "fetched_at",
            "unix_millis(fetched_at) AS seen_ms",
        )
        .selectExpr(
            "page_url", "CAST(r.position AS bigint) AS position", "CAST(r.age AS bigint) AS age",
            "r.content AS content", "status", "attempt", *payload, "seen_ms", "fetched_at",
        )
    )
    # The event time stays in the plan for the watermark; the function reads its milliseconds.
    names = ["page_url", "status", "retries_used", *payload, "final"]
    importable(attempts)
    longest = max((*options.retry_delays, 0.0))
    fold = _fold(len(payload), int(1000 * longest), names)

    def without_time(key, parts, state):
        return fold(key, (p.drop(columns=["fetched_at"]) for p in parts), state)

    return ranked.groupBy("page_url").applyInPandasWithState(
        without_time,
        f"page_url string, status int, retries_used int, {fields}, final boolean",
        f"{_RANK}, status int, attempt int, {fields}, latest bigint",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def due_attempts(outcomes: DataFrame, options: Options) -> DataFrame:
    """Pages to fetch again and the seconds to wait, from rows of `fold_attempts_stream`."""
    delays = ", ".join(f"{x}D" for x in options.retry_delays)
    return outcomes.where(
        f"NOT final AND {is_blocked('status')} AND retries_used + 1 < {options.attempt_budget}"
    ).selectExpr(
        "page_url", "status", "retries_used + 1 AS attempt", f"array({delays})[retries_used + 1] AS delay_s"
    )
