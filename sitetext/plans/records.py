"""Page records that grow with the captures: a later run reads only what is new."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr

from sitetext.config import Options
from sitetext.functions.sql import Sql
from sitetext.operators.attempts import (
    attempt_rank,
    first_and_last,
    times_by_attempt,
    within_budget,
)
from sitetext.operators.pages import ADDRESS, CAPTURED, RENDERED, judged_records, reduced_rows
from sitetext.operators.rejects import usable
from sitetext.sources.places import read_at, with_places
from sitetext.sources.sinks import append, existing


class RecordStore:
    """What is known of captures, in a folder: `captures`, one narrow row per captured row, and
    `contents`, what was read from each distinct one of them.

    `add` takes the files of a source that it has not seen. Of their rows it hashes the markup, and
    it reads text and links only from those that are new by address, attempt, status and hash; a page
    captured again unchanged costs its hash. `digests` folds the narrow rows and joins what was
    read of those that count. Options that decide what is read (retry mode, rendering, raw links)
    must stay the same for a store, and so must `keys`, the columns that tell pages apart (see
    `page_digests`). One `add` runs at a time; one that failed may be repeated.
    """

    def __init__(
        self, spark: SparkSession, folder: str, options: Options, keys: Sequence[str] = ADDRESS
    ) -> None:
        self._spark, self._options, self._keys = spark, options, tuple(keys)
        self._captures, self._contents = (f"{folder.rstrip('/')}/{n}" for n in ("captures", "contents"))

    def new_files(self, source: str) -> list[str]:
        """Addresses of the files of a source whose rows are not in the store."""
        files = {_address(f): f for f in self._spark.read.parquet(source).inputFiles()}
        known = existing(self._spark, self._captures)
        if known is not None:
            for row in known.select("file").distinct().toLocalIterator():
                files.pop(_address(row.file), None)
        # File addresses come escaped, and paths to read are not.
        return sorted(map(unquote, files.values()))

    def add(self, source: str, renders: bool = False) -> int:
        """Take in the new files of a table of attempts, or of renders; gives their number."""
        files = self.new_files(source)
        if not files:
            return 0
        rows = with_places(self._spark.read.parquet(*files))
        if renders:
            none = {"attempt": "int", "status": "int", "fetched_at": "timestamp"}
            rows = rows.selectExpr("*", *(f"CAST(NULL AS {t}) AS {n}" for n, t in none.items()))
        else:
            rows = within_budget(usable(rows), self._options)
        captured = rows.selectExpr(
            *self._keys, "attempt", "status", "fetched_at", "length(html) AS chars", "place",
            f"{_key()} AS key",
        )
        # One place per content; which one makes no difference, but it must not change.
        unread = captured.groupBy("key").agg(
            expr("min_by(struct(page_url, attempt, status, fetched_at, place), struct(place.file, place.row))").alias("o")
        )
        known = existing(self._spark, self._contents)
        if known is not None:
            unread = unread.join(known.select("key"), "key", "left_anti")
        read = reduced_rows(read_at(unread.select("key", "o.*")), self._options, "key", "place")
        # Contents first: a capture whose content is missing would be a page without text, while
        # contents written twice by a repeated run are equal and made one again when joined.
        batch = uuid.uuid4().hex
        append(read.drop("page_url", "fetched_at"), f"{self._contents}/batch={batch}")
        append(captured.selectExpr("* EXCEPT (place)", "place.file AS file"), f"{self._captures}/batch={batch}")
        return len(files)

    def digests(self) -> DataFrame:
        """The records of all captures so far, as `page_digests` gives them."""
        captures = self._spark.read.parquet(self._captures)
        contents = self._spark.read.parquet(self._contents).drop("batch").dropDuplicates(["key"])
        folded = (
            captures.where("attempt IS NOT NULL")
            .groupBy(*self._keys)
            .agg(
                expr(f"min_by(struct(attempt, key), {attempt_rank('key')})").alias("o"),
                *times_by_attempt(self._options),
            )
            .selectExpr(*self._keys, "o.key AS key", *first_and_last("o.attempt"))
            .join(contents.selectExpr("key", f"struct({CAPTURED}, place) AS c"), "key")
            .drop("key")
        )
        shown = (
            captures.where("attempt IS NULL")
            .groupBy(*self._keys)
            .agg(expr("max_by(key, struct(chars, key))").alias("key"))
            .join(contents.selectExpr("key", f"struct({RENDERED}, place) AS r"), "key")
            .drop("key")
        )
        found = folded.join(shown, list(self._keys), "full")
        return judged_records(found, self._options, places=True, keys=self._keys)


def _address(file: str) -> str:
    """A file's address written one way: local ones come with one slash or with three."""
    return re.sub("^file:/+", "file:/", file)


def _key() -> Sql:
    """Digest of what a capture is read from; equal captures have one."""
    parts = "page_url, '\\n', coalesce(attempt, -1), '\\n', coalesce(status, -1), '\\n', coalesce(html, '')"
    return f"unhex(md5(concat({parts})))"
