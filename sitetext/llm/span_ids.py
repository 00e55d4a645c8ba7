"""Token ids of the spans of a text, each distinct span encoded once.

Words repeat, so a piece of text is cut into spans that a vocabulary encodes independently of their
surroundings, and only spans not met lately go to the tokenizer, all of a piece in one call.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pandas as pd

#: Distinct spans that a worker keeps before it starts anew.
KEPT_SPANS = 400_000

#: Ids of spans one after the other, and how many each span has.
Ids = tuple[np.ndarray, np.ndarray]


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    return values[np.arange(n) + np.repeat(starts - ends + lengths, lengths)]


def kinds_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash the number of its kind, and the index of the first of each kind."""
    kind, found = pd.factorize(hashes)
    first = np.empty(len(found), np.int64)
    first[kind[::-1]] = np.arange(len(kind) - 1, -1, -1)
    return kind, first


class SpanIds:
    """Ids of distinct spans under one or more vocabularies, by the hash of the span."""

    def __init__(
        self, encode: Callable[[list[bytes]], tuple[Ids, ...]], kept: int = KEPT_SPANS
    ) -> None:
        self._encode, self._kept = encode, kept
        self.forget()

    def forget(self) -> None:
        """Give the memory back."""
        self._slots: dict[int, int] = {}
        self._known: list[Ids] = []

    def of(
        self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
    ) -> list[Ids]:
        """For each vocabulary, the ids of all spans and how many each span has."""
        kind, first = kinds_of(hashes)
        if len(self._slots) > self._kept:
            self.forget()
        keys = hashes[first].tolist()
        slots = np.fromiter(map(self._slots.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if len(new) or not self._known:
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            found = self._encode([raw[a:b] for a, b in spans])
            slots[new] = np.arange(len(new)) + len(self._slots)
            self._slots.update((keys[i], s) for i, s in zip(new.tolist(), slots[new].tolist()))
            if self._known:
                pairs = zip(self._known, found, strict=True)
                found = [tuple(map(np.concatenate, zip(a, b, strict=True))) for a, b in pairs]
            self._known = list(found)
        out = []
        for flat, sizes in self._known:
            lengths = sizes[slots][kind]
            heads = (np.cumsum(sizes) - sizes)[slots][kind]
            out.append((gathered(flat, heads, lengths), lengths))
        return out


#: Marks between ASCII letters and these never share a token; an apostrophe may.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*range(33, 127)]] = True
_MARK[[39, *range(65, 91), *range(97, 123)]] = False


def parts_of_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of words, cut where an ASCII letter meets an ASCII mark or digit.

    Such parts repeat more than words do and are encoded independently. Words with "<|" stay whole.
    """
    letter, mark = _LETTER[data], _MARK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    odd = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) else data
    for word in np.unique(np.searchsorted(starts, odd, "right") - 1).tolist():
        cut[starts[word] : ends[word]] = False
    cuts = np.flatnonzero(cut)
    if not len(cuts):
        return starts, ends, rows
    of = np.searchsorted(starts, cuts, "right") - 1
    order = np.searchsorted(cuts, starts, "left")
    at = np.arange(len(starts)) + order
    new_starts = np.empty(len(starts) + len(cuts), np.int64)
    is_word = np.zeros(len(new_starts), bool)
    is_word[at] = True
    new_starts[is_word], new_starts[~is_word] = starts, cuts
    new_rows = np.empty(len(new_starts), rows.dtype)
    new_rows[is_word], new_rows[~is_word] = rows, rows[of]
    new_ends = np.empty(len(new_starts), np.int64)
    new_ends[:-1] = new_starts[1:]
    last = np.append(is_word[1:], True)
    new_ends[last] = ends
    return new_starts, new_ends, new_rows
