"""Helpers for composing Spark SQL expressions.

The functions of this package take and return SQL text; `pyspark.sql.functions.expr` makes a
column of it. Text composes without a call into the JVM for every node, which matters for
expressions of a thousand nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import count

Sql = str

NO_STRINGS: Sql = "CAST(array() AS array<string>)"

_numbers = count()


def quoted(text: str) -> Sql:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def fresh() -> str:
    """A name for a lambda variable that no column or other variable has."""
    return f"v{next(_numbers)}"


def each(array: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """The array with `body` applied to every element."""
    name = fresh()
    return f"transform({array}, {name} -> {body(name)})"


def keep(array: Sql, condition: Callable[[Sql], Sql]) -> Sql:
    """The elements that meet the condition, in order."""
    name = fresh()
    return f"filter({array}, {name} -> {condition(name)})"


def head(array: Sql, limit: int | None) -> Sql:
    """The first `limit` elements, all if there is no limit."""
    return array if limit is None else f"slice({array}, 1, {limit})"


def bind(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Evaluate `value` once per row and use it many times in `body`."""
    if value.isidentifier():
        return body(value)
    return f"{each(f'array({value})', body)}[0]"


def contains_any(text: Sql, words: Iterable[str]) -> Sql:
    """True if the text contains one of the words, as they are written."""
    tests = [f"contains({text}, {quoted(word)})" for word in words]
    return f"({' OR '.join(tests)})" if tests else "false"
