"""Secrets in texts: fixed patterns, and values near credential words that are costly to guess.

A value that stands after a credential word is cut into words, dates, repeats, keyboard walks and
brute-force spans so that the total number of guesses is least. The cut is found by dynamic
programming over prefixes: the best cost of a prefix is the least, over the segments that end
there, of the best cost before the segment plus the segment's own cost. Costs are base-10
logarithms of guesses; another segment costs its place in the order as well. Values that cost a
guesser at least MIN_COST are reported.

Whole values are cut. Brute force and walks grow by one character at a time, with a state per set of
character classes and per length of a walk, so the time is linear in the value. A word costs its
rank: common passwords come first, then the most frequent words of all documents, counted on
Spark, then the whole words of a public vocabulary.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import texts
from sitetext.llm.bpe import default_path
from sitetext.plans.staging import Staging

#: Guesses, as a power of ten, from which a value counts as a secret.
MIN_COST = 8.0
#: Most words of the documents that are ranked and broadcast, and the letters of one.
RANKED_WORDS, WORD_LETTERS = 100_000, (3, 20)
#: Longest unit of a repeat.
UNIT_CHARS = 64
KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: A credential word, something that says "is", and a value of visible characters.
_CONTEXT = re.compile(
    r"(?<![a-z0-9])(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_ -]?key|access[_ -]?key"
    r"|private[_ -]?key|credentials?|login|auth)[\"']?\x20*(?:[:=]|=>|\bis\b)\x20*"
    r"(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"'<>|]{6,}))",
    re.IGNORECASE | re.ASCII,
)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "login", "auth")

# Common passwords and words in order of use, and the rows of a keyboard.
COMMON = (
    "password 123456 qwerty letmein admin welcome login abc123 monkey dragon master secret iloveyou "
    "sunshine princess football baseball shadow superman trustno1 hello freedom whatever starwars "
    "computer internet changeme default root test guest user pass love money summer winter spring "
    "autumn monday friday january february march april june july august september october november "
    "december orange apple banana cookie pepper ginger flower tiger lion eagle falcon hunter ranger "
    "soccer hockey tennis batman spider silver gold black white green blue purple red yellow the and "
    "for you are with this that from have not your all can will one time people good home work life "
    "world great little house night light water music happy family friend mother father sister "
    "brother dog cat house car example token key server data base system private public access "
    "company office email phone change correct horse battery staple"
).split()
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SUBSTITUTES = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "1": "i", "!": "i", "0": "o",
               "$": "s", "5": "s", "7": "t", "+": "t", "2": "z"}

_PLACE = {
    key: (x + 0.5 * y, y) for y, row in enumerate(KEYBOARD) for x, key in enumerate(row)
}
_NEAR = {
    a: {b for b, (x, y) in _PLACE.items() if b != a and abs(y - v) <= 1 and abs(x - u) <= 1}
    for a, (u, v) in _PLACE.items()
}
_KEYS, _DEGREE = len(_PLACE), sum(map(len, _NEAR.values())) / len(_PLACE)
_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:[12]\d|3[01]|0?[1-9])"
    r"|(?:[12]\d|3[01]|0?[1-9])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:0?[1-9]|1[0-2])([-/._]?)(?:[12]\d|3[01]|0?[1-9])\3(?:19|20)?\d\d"
    r"|(?:19|20)\d\d"
)
_MORE = log10(2)
#: What a step of a keyboard walk costs that goes straight on.
STEP_COST = 0.1
#: log10 of the characters in each set of classes.
_CLASS_COST = [
    log10(max(10, sum(n for bit, n in ((1, 10), (2, 26), (4, 26), (8, 33)) if mask & bit)))
    for mask in range(16)
]


class Words:
    """Words by rank: the common ones, then the given ones in their order, then a vocabulary's."""

    def __init__(self, frequent: Sequence[str] = (), vocabulary: Sequence[str] = ()) -> None:
        self.rank: dict[str, int] = {}
        for word in chain(COMMON, frequent, vocabulary):
            self.rank.setdefault(word, len(self.rank) + 1)
        self._longest = max(map(len, self.rank))
        self.cost = lru_cache(maxsize=20_000)(lambda value: self.segments(value)[0])

    def word_cost(self, piece: str, low: str, plain: str) -> float | None:
        """Rank of a word, times the ways to write it: capitals, look-alikes, backwards."""
        rank = self.rank
        changed = sum(a != b for a, b in zip(low, plain))
        ways = ((low, 0.0), (low[::-1], _MORE), (plain, _MORE * changed))
        costs = [log10(rank[word]) + cost for word, cost in ways if word in rank]
        if not costs:
            return None
        best, upper = min(costs), sum(c.isupper() for c in piece)
        if upper == 0:
            return best
        if upper == len(piece) or (upper == 1 and (piece[0].isupper() or piece[-1].isupper())):
            return best + _MORE
        return best + upper * _MORE + log10(len(piece))

    def words(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Segments that are words: start, end, cost."""
        low, rank = _lowered(value), self.rank
        plain = "".join(SUBSTITUTES.get(c, c) for c in low)
        for start in range(len(value)):
            for end in range(start + WORD_LETTERS[0], min(len(value), start + self._longest) + 1):
                x, y = low[start:end], plain[start:end]
                if x in rank or y in rank or x[::-1] in rank:
                    yield start, end, self.word_cost(value[start:end], x, y)

    def repeats(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Segments that repeat a unit: start, end, cost. The unit costs what its own cut costs.

        Of every longest stretch with a period, the segments are those that start in its first
        period and hold as many whole units as fit, at least two and three characters.
        """
        data = np.array(list(map(ord, value)), np.int32)
        known: list[tuple[int, int, int]] = []
        for period in range(1, min(UNIT_CHARS, len(value) // 2) + 1):
            same = np.flatnonzero(data[period:] != data[:-period])
            borders = np.concatenate([[-1], same, [len(value) - period]])
            for k in np.flatnonzero(np.diff(borders) > period).tolist():
                first, last = int(borders[k]) + 1, int(borders[k + 1]) + period
                if any(period % p == 0 and a <= first and last <= b for p, a, b in known):
                    continue
                known.append((period, first, last))
                for start in range(first, min(first + period, last - 2 * period + 1)):
                    times = (last - start) // period
                    if times * period >= 3:
                        unit = value[start : start + period]
                        yield start, start + times * period, self.cost(unit) + log10(times)

    def segments(self, value: str) -> tuple[float, list[tuple[str, int, int]]]:
        """Least cost of a value and its cut into (kind, start, end)."""
        n = len(value)
        ending: dict[int, list[tuple[str, int, float]]] = {}
        for kind, found in (("word", self.words(value)), ("date", _dates(value))):
            for start, end, cost in found:
                ending.setdefault(end, []).append((kind, start, cost))
        # A unit is shorter than the value, so this ends.
        for start, end, cost in self.repeats(value) if n >= 3 else ():
            ending.setdefault(end, []).append(("repeat", start, cost))
        steps = _steps(value)
        best: list[float] = [0.0] + [_NEVER] * n
        back: list[tuple[int, str]] = [(0, "")] * (n + 1)
        brute, brute_start = [_NEVER] * 16, [0] * 16
        # Walks of one, two, and more keys that end here, with their starts.
        walks = [(_NEVER, 0)] * 3
        for end in range(1, n + 1):
            before = best[end - 1] + (_MORE if end > 1 else 0.0)
            least, came = _NEVER, (0, "")
            bit = _char_class(value[end - 1])
            for mask in range(1, 16):
                if not mask & bit:
                    brute[mask] = _NEVER
                    continue
                if before < brute[mask]:
                    brute[mask], brute_start[mask] = before, end - 1
                brute[mask] += _CLASS_COST[mask]
                if brute[mask] < least:
                    least, came = brute[mask], (brute_start[mask], "brute")
            first, next_first, going = steps[end - 1]
            one, two, more = walks
            longer = min(two, more)
            walks = [
                (before + first, end - 1), (one[0] + next_first, one[1]), (longer[0] + going, longer[1]),
            ]
            if walks[2][0] < least:
                least, came = walks[2][0], (walks[2][1], "walk")
            for kind, start, cost in ending.get(end, ()):
                # Another segment after the first costs its place in the order.
                total = best[start] + cost + (_MORE if start else 0.0)
                if total < least:
                    least, came = total, (start, kind)
            best[end], back[end] = least, came
        cut, at = [], n
        while at:
            start, kind = back[at]
            cut.append((kind, start, at))
            at = start
        return best[n], cut[::-1]

    def guess_cost(self, value: str) -> float:
        """log10 of the least number of guesses."""
        return self.cost(value) if len(value) <= 128 else self.segments(value)[0]


_NEVER = float("inf")


def _lowered(value: str) -> str:
    """Lower case, character by character."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    for start in range(len(value)):
        m = _DATE.match(value, start)
        if m:
            yield start, m.end(), log10(365 * 120) if m.end() - start > 4 else log10(120)


def _steps(value: str) -> list[tuple[float, float, float]]:
    """What each character costs as the first key of a walk, as the second, and as a later one.

    Every step of a walk goes to a neighbouring key and costs STEP_COST; one that turns costs the
    choice of a way too, and the first step counts as a turn. A capital costs the shift.
    """
    low, out = _lowered(value), []
    for i, key in enumerate(low):
        shift = _MORE if value[i].isupper() else 0.0
        start = log10(_KEYS) + shift if key in _PLACE else _NEVER
        if i == 0 or key not in _NEAR.get(low[i - 1], ()):
            out.append((start, _NEVER, _NEVER))
            continue
        turn = STEP_COST + log10(_DEGREE) + shift
        straight = i > 1 and _way(low[i - 2], low[i - 1]) == _way(low[i - 1], key)
        out.append((start, turn, STEP_COST + shift if straight else turn))
    return out


def _way(a: str, b: str) -> tuple[float, float] | None:
    if b not in _NEAR.get(a, ()):
        return None
    (x, y), (u, v) = _PLACE[a], _PLACE[b]
    return u - x, v - y


def _char_class(c: str) -> int:
    """Bit of a character's class: digits, small letters, capitals, others."""
    return 1 if "0" <= c <= "9" else 2 if "a" <= c <= "z" else 4 if "A" <= c <= "Z" else 8


def find_secrets(
    text: str, words: Words, min_cost: float = MIN_COST
) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) in code points, by start and then kind as listed in KINDS."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((0, m.start(), m.end(), words.guess_cost(m.group(2))))
        for m in _CONTEXT.finditer(text):
            group = next(g for g in (1, 2, 3) if m.group(g) is not None)
            cost = words.guess_cost(m.group(group))
            if cost >= min_cost:
                found.append((3, m.start(group), m.end(group), cost))
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), None) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), None) for m in _HEX.finditer(text)]
    found.sort(key=lambda x: (x[1], x[0]))
    return [(KINDS[k], a, b, c) for k, a, b, c in found]


_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]
)
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])
_DDL = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,cost:double>>"


def frequent_words(docs: DataFrame, text_col: str, staging: Staging, limit: int) -> list[str]:
    """The most frequent words of all texts, most frequent first, at most `limit`.

    Counts are ranked by steps of an eighth of a power of two, and the last step that would pass the
    limit is left out whole, so words of about one count are taken or left together.
    """
    least, most = WORD_LETTERS
    words = docs.select(
        F.explode(F.expr(f"regexp_extract_all(lower(`{text_col}`), '(?<![a-z])[a-z]{{{least},{most}}}(?![a-z])', 0)")).alias("word")
    )
    counts = staging.stage(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    step = "CAST(floor(8 * log2(n)) AS int)"
    sizes = dict(map(tuple, counts.groupBy(F.expr(step).alias("step")).count().collect()))
    total, lowest = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > limit:
            break
        lowest = at
    if lowest is None:
        return []
    found = counts.where(f"{step} >= {lowest}").toArrow().to_pydict()
    order = sorted(zip(found["n"], found["word"], strict=True), key=lambda x: (-x[0], x[1]))
    return [word for _, word in order]


def vocabulary_words(path: str) -> list[str]:
    """Whole words of letters in a tokenizer file with word ends, in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    least, most = WORD_LETTERS
    words = ((i, t.removesuffix("</w>")) for t, i in ids.items() if t.endswith("</w>"))
    return [w for _, w in sorted(words) if least <= len(w) <= most and w.isascii() and w.isalpha()]


def _scan(frequent, path: str | None, min_cost: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in batches:
            if words is None:
                words = Words(frequent.value, vocabulary_words(path or default_path()))
            spans = [
                [
                    dict(zip(("kind", "start", "end", "cost"), s))
                    for s in find_secrets(t.as_py() or "", words, min_cost)
                ]
                for t in batch.column(1)
            ]
            yield texts.pack({"doc_id": batch.column(0), "spans": spans}, _SCHEMA)

    return run


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_cost: float = MIN_COST,
    ranked_words: int = RANKED_WORDS,
    path: str | None = None,
) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end, cost).

    Kinds are assign, access and hex by their patterns, and guess for a value after a credential
    word that costs at least `min_cost`. Start and end count code points. Spans of one kind do not
    overlap; a guess span may lie in a span of another kind. `cost` is null for kinds that need
    none. At most `ranked_words` words of the documents are broadcast with their ranks; `path` names
    a tokenizer file with word ends whose words come after them, by default the public one.

    A null or empty text has no spans. Rows are independent but for the counts of words, to which
    repeated rows add again; a null id stays null, an empty table gives none, other columns are not
    read.
    """
    spark = docs.sparkSession
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    staging = Staging(spark)
    frequent = spark.sparkContext.broadcast(frequent_words(source, "text", staging, ranked_words))
    staging.remove()
    return texts.map_batches(source, _scan(frequent, path, min_cost), _DDL)
