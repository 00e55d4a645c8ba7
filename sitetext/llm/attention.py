"""Language-model scores: a small causal self-attention model over subword ids, in numpy.

Words, with A-Z in lower case, are cut into subword ids by a public vocabulary, each with the blank
before it; a text ends with one end id. The model predicts the next id from the ids of its window in
two steps: its class, and the id among the members of the class, both from the same hidden state.
Classes hold word beginnings or continuations of neighbouring frequency, few frequent ids or many
rare ones; inside a class ids start from their training frequency. So the probabilities of all ids
sum to one. Windows overlap: each id is scored once, in the window where it has the most ids before
it. Windows are scored in batches with one masked attention step.

Training covers all training documents: word and subword counts use every token, and the model
learns from every window, each in one of the rounds. Tasks train copies on their own windows, and
the copies are averaged, weighted by their windows, after each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from functools import lru_cache
from itertools import chain
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import texts
from sitetext.plans.staging import Staging

#: Ids of a window, and of its beginning that the window before has scored.
WINDOW, OVERLAP = 32, 8
#: Width of the model, and ids with an input vector of their own.
WIDTH, INPUTS = 16, 4096
#: Members of the classes of the most frequent ids, and how much larger each next class is.
SMALLEST, GROWTH = 8, 1.08
#: Ids without an input vector of their own share this many.
SHARED = 64
ROUNDS, BATCH, RATE = 3, 64, 0.01
#: Most words whose counts are sent to every task. Rarer words are looked up by a join.
HEAD_WORDS = 400_000
_BLOCKS = 64
_BEGIN, _END = 1, 2
_KEYS_AT_ONCE = 1 << 20
_IDS_AT_ONCE = 1 << 19
#: Rows whose class logits, about a megabyte, are worked on at once.
_ROWS_AT_ONCE = 2048


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


class Piece:
    """Words and subword ids of the rows of a piece of text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, path: str | None) -> None:
        data = texts.lowered(data)
        self.n = len(offsets) - 1
        starts, ends, self.rows = texts.word_spans(data, offsets)
        self.words = texts.span_hashes(data, starts, ends)
        first, kind = texts.distinct(self.words)
        raw = data.tobytes()
        of_word = _vocabulary(path or default_path()).encode(
            [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())],
            num_threads=1,
        )
        sizes = np.fromiter(map(len, of_word), np.int64, len(of_word))
        flat = np.fromiter(chain.from_iterable(of_word), np.int32, int(sizes.sum()))
        heads = np.cumsum(sizes) - sizes
        n_ids = sizes[kind]
        per_row = np.bincount(self.rows, weights=n_ids, minlength=self.n).astype(np.int64) + 1
        #: Where each row's ids start in `ids`; each row has its ids and the end id.
        self.borders = np.concatenate([[0], np.cumsum(per_row)])
        self.ids = np.full(int(self.borders[-1]), _END, np.int32)
        inside = np.ones(len(self.ids), bool)
        inside[self.borders[1:] - 1] = False
        until = np.cumsum(n_ids)
        total = int(until[-1]) if len(until) else 0
        self.ids[inside] = flat[np.arange(total) + np.repeat(heads[kind] - until + n_ids, n_ids)]


def windows(
    ids: np.ndarray, borders: np.ndarray, every: int = 1, share: np.ndarray | int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets of windows, and the row of each; -1 stands after the end of a row.

    Row i has ids[borders[i]:borders[i + 1]]. With `every`, the windows of each row whose number
    leaves the row's `share` when divided by it, so the shares together have every window once.
    """
    sizes = np.diff(borders)
    step = WINDOW - OVERLAP
    n = 1 + np.maximum(0, -(-(sizes - WINDOW) // step))
    rows = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    if every > 1:
        chosen = number % every == np.broadcast_to(share, len(sizes))[rows] % every
        rows, number = rows[chosen], number[chosen]
    first = np.full(len(ids) + WINDOW + 1, _BEGIN, np.int32)
    first[1 : len(ids) + 1] = ids
    taken = first[(borders[rows] + number * step)[:, None] + np.arange(WINDOW + 1)]
    inputs, targets = taken[:, :-1], taken[:, 1:].copy()
    inputs[number == 0, 0] = _BEGIN
    left = sizes[rows] - number * step
    for w in np.flatnonzero(left < WINDOW):
        targets[w, left[w] :] = -1
    return inputs, targets, rows


def _class_sizes(n: int) -> np.ndarray:
    """Sizes of the classes of n ids in order of frequency."""
    sizes, size = [], float(SMALLEST)
    while sum(sizes) < n:
        sizes.append(min(int(size), n - sum(sizes)))
        size *= GROWTH
    return np.array(sizes, np.int64)


class _MemberExponentials(NamedTuple):
    #: Exponentials, and their views by class with the rows and the touched members of each.
    e: np.ndarray
    #: Where the chosen one of each row is, its logit, and the row's sum. Rows may be scaled.
    places: np.ndarray
    chosen: np.ndarray
    sums: np.ndarray
    parts: list[tuple[slice, slice, np.ndarray]]
    #: Members of all classes that occur, and their vectors with their start.
    touched: np.ndarray
    vectors: np.ndarray


class Model:
    """Parameters and tables of a model; the tables map ids to input vectors, classes and members.

    Members are numbered class by class: class c has borders[c]:borders[c + 1].
    """

    NAMES = ("embed", "place", "query", "key", "value", "out", "classes", "bias", "members")

    def __init__(self, counts: np.ndarray, continues: np.ndarray) -> None:
        n = len(counts)
        order = np.lexsort((np.arange(n), -counts))
        self.input_of = INPUTS + np.arange(n) % SHARED
        self.input_of[order[:INPUTS]] = np.arange(min(INPUTS, n))
        kinds = [order[~continues[order]], order[continues[order]]]
        by_member = np.concatenate(kinds)
        sizes = np.concatenate([_class_sizes(len(k)) for k in kinds])
        self.sizes = sizes
        self.borders = np.concatenate([[0], np.cumsum(sizes)])
        self.narrow = np.uint16 if n <= 1 << 16 else np.int64
        self.member_of = np.empty(n, np.int64)
        self.member_of[by_member] = np.arange(n)
        self.class_of = np.empty(n, np.int16)
        self.class_of[by_member] = np.repeat(np.arange(len(sizes)), sizes)
        smoothed = counts + 0.5
        d, n_classes = WIDTH, len(sizes)
        totals = np.bincount(self.class_of, weights=smoothed, minlength=n_classes)
        #: Natural logarithm of an id's training frequency in its class, where its member starts.
        self.within = np.log(smoothed / totals[self.class_of])
        self.member_start = self.within[by_member].astype(np.float32)
        rng = np.random.default_rng(11)
        shapes = {
            "embed": (INPUTS + SHARED, d), "place": (WINDOW, d), "query": (d, d), "key": (d, d),
            "value": (d, d), "out": (d, d), "classes": (d, n_classes),
        }
        self.p = {
            k: (rng.standard_normal(s) * (0.3 if k == "embed" else 0.2)).astype(np.float32)
            for k, s in shapes.items()
        }
        self.p["bias"] = np.log(np.maximum(totals, 0.5) / totals.sum()).astype(np.float32)
        self.p["members"] = np.zeros((n, d), np.float32)
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))
        self._fast = None

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            size = self.p[k].size
            self.p[k] = flat[at : at + size].reshape(self.p[k].shape).astype(np.float32)
            at += size
        self._fast = None

    def _vectors(self, rows: np.ndarray) -> np.ndarray:
        """Input vectors of windows, with a last column of ones."""
        x = np.ones((*rows.shape, WIDTH + 1), np.float32)
        np.add(self.p["embed"].take(rows, axis=0), self.p["place"], out=x[:, :, :WIDTH])
        return x

    def _products(self) -> tuple[np.ndarray, np.ndarray]:
        """Query and key multiplied, and value and out."""
        p = self.p
        return p["query"] @ p["key"].T * np.float32(WIDTH**-0.5), p["value"] @ p["out"]

    def _attended(self, x: np.ndarray, asked: np.ndarray, through: np.ndarray, weights: np.ndarray):
        """What attention makes of the last places of windows: those of `asked`, their vectors times
        query and key. Fills in the weights; returns with it what they gather and one by their sum.

        Weights are divided by their sum, which the column of ones gives, after they are used, and
        what they gather is multiplied by value and out.
        """
        first = WINDOW - asked.shape[1]
        np.matmul(asked, x[:, :, :WIDTH].transpose(0, 2, 1), out=weights)
        if _out_of_range(weights):
            weights += self.mask[first:]
            weights -= weights.max(axis=2, keepdims=True)
        np.exp(weights, out=weights)
        weights *= self.seen[first:]
        got = np.matmul(weights, x)
        shares = 1 / got[:, :, WIDTH:]
        gathered = got[:, :, :WIDTH] * shares
        hidden = (_flat(gathered) @ through).reshape(gathered.shape)
        hidden += x[:, first:, :WIDTH]
        return hidden, gathered, shares

    def _by_member(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of ids by member, and the classes and members in this order."""
        members = self.member_of[ids]
        # 16-bit numbers are sorted by radix.
        order = np.argsort(members.astype(self.narrow), kind="stable")
        return order, self.class_of[ids[order]], members[order]

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray):
        """Natural logarithm of the probability of each scored target of a batch of windows."""
        if self._fast is None:
            self._fast = (*self._products(), np.vstack([self.p["classes"], self.p["bias"]]))
        pair, through, classes = self._fast
        x = self._vectors(self.input_of[inputs])
        # Places before the first that is scored in any window are only looked at.
        first = int(scored.any(axis=0).argmax())
        scored = scored[:, first:]
        own = x[:, first:, :WIDTH]
        asked = (own.reshape(-1, WIDTH) @ pair).reshape(own.shape)
        weights = np.empty((*own.shape[:2], WINDOW), np.float32)
        hidden, _, _ = self._attended(x, asked, through, weights)
        ids = targets[:, first:][scored]
        order, class_of, members = self._by_member(ids)
        h = np.ones((len(ids), WIDTH + 1), np.float32)
        h[:, :WIDTH] = _flat(hidden).take(np.flatnonzero(scored)[order], axis=0)
        of_members = self._member_exponentials(h, class_of, members)
        logs = of_members.chosen - np.log(of_members.sums).astype(np.float64)
        for at in range(0, len(ids), _ROWS_AT_ONCE):
            part = slice(at, at + _ROWS_AT_ONCE)
            _, _, chosen, sums = _exponentials(h[part], classes, class_of[part])
            logs[part] += chosen - np.log(sums)
        found = np.empty(len(ids))
        found[order] = logs
        return found

    def _member_exponentials(
        self, h: np.ndarray, classes: np.ndarray, members: np.ndarray
    ) -> _MemberExponentials:
        """For rows in order of class: exponentials of the logits of the members of a row's class,
        one row after the other."""
        n_rows = np.bincount(classes, minlength=len(self.sizes))
        present = np.flatnonzero(n_rows)
        n_rows, sizes = n_rows[present], self.sizes[present]
        ends, row_ends, stops = np.cumsum(sizes), np.cumsum(n_rows), np.cumsum(n_rows * sizes)
        touched = np.arange(int(sizes.sum())) + np.repeat(self.borders[present] - ends + sizes, sizes)
        vectors = np.empty((len(touched), WIDTH + 1), np.float32)
        vectors[:, :WIDTH] = self.p["members"].take(touched, axis=0)
        vectors[:, WIDTH] = self.member_start.take(touched)
        e, parts = np.empty(int((n_rows * sizes).sum()), np.float32), []
        row = lo = at = 0
        for row_end, hi, stop in zip(row_ends.tolist(), ends.tolist(), stops.tolist()):
            part = e[at:stop].reshape(row_end - row, hi - lo)
            np.dot(h[row:row_end], vectors[lo:hi].T, out=part)
            parts.append((slice(row, row_end), slice(lo, hi), part))
            row, lo, at = row_end, hi, stop
        sizes = self.sizes[classes]
        heads = np.cumsum(sizes) - sizes
        if _out_of_range(e):
            e -= np.repeat(np.maximum.reduceat(e, heads), sizes)
        places = heads + members - self.borders[classes]
        chosen = e[places]
        np.exp(e, out=e)
        sums = np.add.reduceat(e, heads)
        return _MemberExponentials(e, places, chosen, sums, parts, touched, vectors)

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean loss of a batch; targets of -1 don't count. Those of the members are
        the members they are for and the values.

        An exponential less its row's sum at the target is, divided by that sum, the gradient of a
        logit; rows are divided after they are multiplied.
        """
        p, rows = self.p, self.input_of[inputs]
        pair, through = self._products()
        x = self._vectors(rows)
        vectors = _flat(x)[:, :WIDTH]
        # Weights and, below them, the gradients of their logits; what both are multiplied by.
        stack = np.empty((len(x), 2 * WINDOW, WINDOW), np.float32)
        weights, ds = stack[:, :WINDOW], stack[:, WINDOW:]
        factors = np.empty((len(x), 2 * WINDOW, WIDTH), np.float32)
        factors[:, WINDOW:] = asked = (vectors @ pair).reshape(len(x), WINDOW, WIDTH)
        hidden, gathered, shares = self._attended(x, asked, through, weights)

        places = np.flatnonzero(targets >= 0)
        ids = targets.reshape(-1)[places]
        order, class_of, members = self._by_member(ids)
        places = places[order]
        share = np.float32(1 / max(1, len(ids)))
        own = np.ones((len(ids), WIDTH + 1), np.float32)
        own[:, :WIDTH] = _flat(hidden).take(places, axis=0)
        classes = np.vstack([p["classes"], p["bias"]])
        d_classes, back = np.zeros_like(classes.T), np.empty_like(own)
        for at in range(0, len(ids), _ROWS_AT_ONCE):
            part = slice(at, at + _ROWS_AT_ONCE)
            e, chosen, _, sums = _exponentials(own[part], classes, class_of[part])
            e.reshape(-1)[chosen] -= sums
            factor = (share / sums)[:, None]
            d_classes += e.T @ (own[part] * factor)
            np.dot(e, classes.T, out=back[part])
            back[part] *= factor
        g = {"classes": d_classes[:, :WIDTH].T, "bias": d_classes[:, WIDTH]}

        of = self._member_exponentials(own, class_of, members)
        of.e[of.places] -= of.sums
        factor = (share / of.sums)[:, None]
        scaled, added, d_members = own * factor, np.empty_like(own), np.empty_like(of.vectors)
        for at, which, part in of.parts:
            np.dot(part, of.vectors[which], out=added[at])
            np.dot(part.T, scaled[at], out=d_members[which])
        added *= factor
        back += added
        g["members"] = of.touched, d_members[:, :WIDTH]

        dh = np.zeros_like(hidden)
        _flat(dh)[places] = back[:, :WIDTH]
        d_through = _flat(gathered).T @ _flat(dh)
        d_got = np.empty_like(x)
        d_own = d_got[:, :, :WIDTH]
        np.multiply((_flat(dh) @ through.T).reshape(dh.shape), shares, out=d_own)
        np.negative(np.einsum("btd,btd->bt", d_own, gathered), out=d_got[:, :, WIDTH])
        factors[:, :WINDOW] = d_own
        np.matmul(d_got, x.transpose(0, 2, 1), out=ds)
        ds *= weights
        d_asked = _flat(np.matmul(ds, x[:, :, :WIDTH]))
        dx = np.matmul(stack.transpose(0, 2, 1), factors)
        dx += dh
        dx += (d_asked @ pair.T).reshape(dx.shape)
        d_pair = vectors.T @ d_asked * np.float32(WIDTH**-0.5)
        g["query"], g["key"] = d_pair @ p["key"], d_pair.T @ p["query"]
        g["value"], g["out"] = d_through @ p["out"].T, p["value"].T @ d_through
        g["place"] = dx.sum(axis=0)
        g["embed"] = np.zeros_like(p["embed"])
        rows = rows.reshape(-1)
        order = np.argsort(rows.astype(np.int16), kind="stable")
        in_order = rows[order]
        heads = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]])
        g["embed"][in_order[heads]] = np.add.reduceat(_flat(dx).take(order, axis=0), heads, axis=0)
        return g


def _flat(a: np.ndarray) -> np.ndarray:
    return a.reshape(-1, a.shape[-1])


def _out_of_range(logits: np.ndarray) -> bool:
    """Whether exponentials or their sums could leave the range of 32-bit floats."""
    return logits.max(initial=0) > 60 or logits.min(initial=0) < -60


def _exponentials(h: np.ndarray, classes: np.ndarray, chosen: np.ndarray):
    """Exponentials of logits; where the chosen one of each row is, its logit, and the row's sum.
    Rows may be scaled."""
    e = h @ classes
    places = np.arange(len(e)) * e.shape[1] + chosen
    logits = e.take(places)
    ones = np.ones(e.shape[1], np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(e, out=e)
        sums = e @ ones
    if not (sums.min(initial=1) > 1e-26 and sums.max(initial=1) < 1e26):
        np.matmul(h, classes, out=e)
        e -= (top := e.max(axis=1, keepdims=True))
        logits -= top[:, 0]
        np.exp(e, out=e)
        sums = e @ ones
    return e, places, logits, sums


class _Adam:
    """Steps of Adam; the members, of which a step has only some, are apart from the rest."""

    def __init__(self, model: Model, rate: float) -> None:
        self.model, self.rate, self.t = model, rate, 0
        self.names = [k for k in model.NAMES if k != "members"]
        n = sum(model.p[k].size for k in self.names)
        self.m, self.v = np.zeros(n, np.float32), np.zeros(n, np.float32)
        self.members_m = np.zeros_like(model.p["members"])
        self.members_v = np.zeros_like(model.p["members"])

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = np.float32(self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
        p = self.model.p
        change = _adam_change(
            np.concatenate([g[k].reshape(-1) for k in self.names]), self.m, self.v, scale
        )
        at = 0
        for k in self.names:
            p[k] -= change[at : at + p[k].size].reshape(p[k].shape)
            at += p[k].size
        members, x = g["members"]
        m, v = self.members_m[members], self.members_v[members]
        p["members"][members] -= _adam_change(x, m, v, scale)
        self.members_m[members], self.members_v[members] = m, v


def _adam_change(x: np.ndarray, m: np.ndarray, v: np.ndarray, scale: np.float32) -> np.ndarray:
    """What a step takes off, in place of its gradient; m and v become those after it."""
    x *= np.float32(0.1)
    m *= np.float32(0.9)
    m += x
    x *= x
    v *= np.float32(0.99)
    v += x
    np.sqrt(v, out=x)
    x += np.float32(1e-8)
    np.divide(m, x, out=x)
    x *= scale
    return x


# --- Counts ------------------------------------------------------------------

_FIRST_DDL = (
    "id_key bigint, text_key bigint, trains boolean, text_ids binary, words array<bigint>, "
    "word_counts array<bigint>, id_counts binary"
)
_FIRST = pa.schema(
    [("id_key", pa.int64()), ("text_key", pa.int64()), ("trains", pa.bool_()),
     ("text_ids", pa.binary()), ("words", pa.list_(pa.int64())),
     ("word_counts", pa.list_(pa.int64())), ("id_counts", pa.binary())]
)


def _rows_of(n: int, **columns) -> pa.RecordBatch:
    return texts.pack({f.name: columns.get(f.name, pa.nulls(n, f.type)) for f in _FIRST}, _FIRST)


def _first_pass(path: str | None):
    """Subword ids of every text, and the counts of a task's training texts."""

    def rows(parts: list[np.ndarray], ids: np.ndarray):
        words, counts = np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]), return_counts=True)
        n = max(1, ceil(len(words) / 50_000))
        for i, (w, c) in enumerate(zip(np.array_split(words, n), np.array_split(counts, n))):
            yield _rows_of(
                1,
                words=[w.view(np.int64)],
                word_counts=[c],
                id_counts=[ids.tobytes() if i == 0 else b""],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _vocabulary(path or default_path()).vocab_size()
        parts, ids, n = [], np.zeros(size, np.int64), 0
        for batch in batches:
            trains = batch.column(3).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in texts.pieces(batch.column(2)):
                piece = Piece(data, offsets, path)
                raw = piece.ids.astype(_id_type(size)).tobytes()
                at = (piece.borders * np.dtype(_id_type(size)).itemsize).tolist()
                yield _rows_of(
                    piece.n,
                    id_key=batch.column(0).slice(first, piece.n),
                    text_key=batch.column(1).slice(first, piece.n),
                    trains=batch.column(3).slice(first, piece.n),
                    text_ids=[raw[a:b] for a, b in zip(at[:-1], at[1:])],
                )
                own = trains[first:end]
                parts.append(piece.words[own[piece.rows]])
                ids += np.bincount(piece.ids[np.repeat(own, np.diff(piece.borders))], minlength=size)
                n += len(parts[-1])
                if n >= 4 * _KEYS_AT_ONCE:
                    yield from rows(parts, ids)
                    parts, ids, n = [], np.zeros(size, np.int64), 0
        if ids.any():
            yield from rows(parts, ids)

    return run


def _id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def _sum_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        for x in batch.column(0):
            if len(raw := x.as_py()):
                total = total + np.frombuffer(raw, np.int64)
    if not isinstance(total, int):
        yield pa.RecordBatch.from_pydict({"ids": [total.tobytes()]})


def _id_pieces(
    column: pa.Array, size: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, ids and borders of pieces of a column of ids as bytes."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    ids = data.view(_id_type(size)).astype(np.int32)
    borders = (offsets - offsets[0]) // np.dtype(_id_type(size)).itemsize
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(borders, borders[lo] + _IDS_AT_ONCE, "right")) - 1)
        own = borders[lo : hi + 1]
        yield lo, hi, ids[own[0] : own[-1]], own - own[0]
        lo = hi


def _trained(model_sent, turn: int, size: int):
    """A copy trained on a task's windows of this turn, as parameter sums weighted by its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The worker keeps the broadcast model for other tasks, so a copy is trained.
        model: Model = copy(model_sent.value)
        model.p = {k: v.copy() for k, v in model.p.items()}
        adam, rng, seen = _Adam(model, RATE * 0.5 ** (turn - 1)), np.random.default_rng(turn), 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for lo, hi, ids, borders in _id_pieces(batch.column(1), size):
                inputs, targets, _ = windows(ids, borders, ROUNDS, keys[lo:hi] + turn)
                order = rng.permutation(len(inputs))
                for at in range(0, len(order), BATCH):
                    part = order[at : at + BATCH]
                    adam.step(model.gradients(inputs[part], targets[part]))
                seen += len(order)
        if seen:
            sums = np.array_split(model.flat() * np.float32(seen), _BLOCKS)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(range(_BLOCKS), pa.int32()),
                    "sums": [s.tobytes() for s in sums],
                    "seen": pa.array([seen] * _BLOCKS, pa.int64()),
                }
            )

    return run


def _averaged(table: pa.Table) -> pa.Table:
    total, seen = 0, 0
    for batch in table.to_batches():
        for sums, n in zip(batch.column(1), batch.column(2)):
            total = total + np.frombuffer(sums.as_py(), np.float32).astype(np.float64)
            seen += n.as_py()
    return pa.table(
        {
            "block": pa.array([table["block"][0].as_py()], pa.int32()),
            "mean": [(total / seen).astype(np.float32).tobytes()],
        }
    )


# --- Scores -------------------------------------------------------------------

_BASE = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("id_key", pa.int64()), ("text_key", pa.int64()),
     ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
     ("rare", pa.list_(pa.int64())), ("rare_n", pa.list_(pa.int64()))]
)
_BASE_DDL = (
    "row bigint, doc_id bigint, id_key bigint, text_key bigint, n_tokens bigint, n_known bigint, "
    "base double, rare array<bigint>, rare_n array<bigint>"
)


def window_scores(
    model: Model, ids: np.ndarray, borders: np.ndarray, at_once: int = 256
) -> np.ndarray:
    """log10 of the probability of each row's ids; every id is scored in one window."""
    n = len(borders) - 1
    inputs, targets, rows = windows(ids, borders)
    first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    scored = targets >= 0
    scored[~first, :OVERLAP] = False
    out = np.zeros(n)
    # First windows are scored whole, the others behind what overlaps, so they go apart.
    for own in (np.flatnonzero(first), np.flatnonzero(~first)):
        for at in range(0, len(own), at_once):
            part = own[at : at + at_once]
            mask = scored[part]
            found = model.log_probabilities(inputs[part], targets[part], mask)
            out += np.bincount(np.repeat(rows[part], mask.sum(axis=1)), weights=found, minlength=n)
    return out / np.log(10)


def _model_scores(model_sent, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_sent.value
        for batch in batches:
            scores, n_ids = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            for lo, hi, ids, borders in _id_pieces(batch.column(2), size):
                scores[lo:hi] = window_scores(model, ids, borders)
                n_ids[lo:hi] = np.diff(borders)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array(n_ids)],
                names=["id_key", "text_key", "score", "n_subwords"],
            )

    return run


def _base_scores(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_counts, total, kinds, end_count = sent.value
        base_of = lambda c: np.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
        head_logs = base_of(head_counts) if len(head) else np.zeros(0)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, end, data, offsets in texts.pieces(batch.column(3)):
                n = end - first
                data = texts.lowered(data)
                starts, ends, rows = texts.word_spans(data, offsets)
                words = texts.span_hashes(data, starts, ends)
                at = np.minimum(np.searchsorted(head, words), max(0, len(head) - 1))
                known = head[at] == words if len(head) else np.zeros(len(words), bool)
                rare = np.flatnonzero(~known)
                order = np.lexsort((words[rare], rows[rare]))
                w, r = words[rare][order], rows[rare][order]
                new = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (r[1:] != r[:-1])][: len(w)])
                times = np.diff(new, append=len(w))
                borders = pa.array(np.searchsorted(r[new], np.arange(n + 1)), pa.int32())
                lists = lambda x: pa.ListArray.from_arrays(borders, pa.array(x, pa.int64()))
                logs = np.bincount(rows[known], weights=head_logs[at[known]], minlength=n)
                yield texts.pack(
                    {
                        "row": np.arange(row, row + n),
                        "doc_id": batch.column(0).slice(first, n),
                        "id_key": batch.column(1).slice(first, n),
                        "text_key": batch.column(2).slice(first, n),
                        "n_tokens": np.bincount(rows, minlength=n) + 1,
                        "n_known": np.bincount(rows[known], minlength=n) + int(end_count > 0),
                        "base": logs + float(base_of(np.float64(end_count))),
                        "rare": lists(w[new].view(np.int64)),
                        "rare_n": lists(times),
                    },
                    _BASE,
                )
                row += n

    return run


def language_model_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    and n_subwords.

    Tokens are the words and one end per text. Documents whose crc32 of the doc_id as text leaves
    1 when divided by 5 are held out; all others train, among them those without doc_id. base_score
    is the smoothed unigram log10 probability of the tokens, score the model's of the subword ids
    with the end id. Words are told apart by a 64-bit hash.

    A null or empty text, or one of white space only, is one end token. Rows are independent:
    repeated rows train as often as they occur and get equal scores; a null id stays null. An empty
    table gives none, and with no training document all counts are zero and the model is at its
    start. Other columns are not read.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    held_out = "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 1, false)"
    source = docs.selectExpr(
        f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text"
    ).selectExpr(
        "doc_id", "coalesce(doc_id, 0L) AS id_key", "xxhash64(doc_id IS NULL, text) AS text_key",
        "text", f"NOT {held_out} AS trains",
    )
    vocabulary = _vocabulary(path or default_path())
    size = vocabulary.vocab_size()
    first = staging.stage(
        texts.map_batches(
            source.select("id_key", "text_key", "text", "trains"), _first_pass(path), _FIRST_DDL
        ),
        "first",
    )
    counted = first.where("words IS NOT NULL")
    words = staging.stage(
        counted.select(F.explode(F.arrays_zip("words", "word_counts")).alias("w"))
        .groupBy(F.col("w.words").alias("word"))
        .agg(F.sum("w.word_counts").alias("c")),
        "words",
    )
    of_ids = texts.map_batches(
        counted.where("length(id_counts) > 0").select("id_counts"), _sum_ids, "ids binary"
    )
    id_counts = np.zeros(size, np.int64)
    for row in of_ids.toLocalIterator():
        id_counts += np.frombuffer(row["ids"], np.int64)
    end_count = int(id_counts[_END])
    n_words, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = int(n_words) + end_count, int(kinds) + (end_count > 0)

    continues = np.array([not vocabulary.id_to_piece(i).startswith("▁") for i in range(size)])
    model = Model(id_counts, continues)
    # The share of a text's windows that a round trains on follows from its keys.
    training = first.where("text_ids IS NOT NULL AND trains").selectExpr(
        f"pmod(xxhash64(id_key, text_key), {ROUNDS}) AS share", "text_ids"
    )
    for turn in range(1, ROUNDS + 1):
        means = (
            texts.map_batches(
                training, _trained(spark.sparkContext.broadcast(model), turn, size),
                "block int, sums binary, seen bigint",
            )
            .groupBy("block")
            .applyInArrow(_averaged, "block int, mean binary")
            .collect()
        )
        if means:
            means = sorted(means, key=lambda r: r["block"])
            model.load(np.concatenate([np.frombuffer(r["mean"], np.float32) for r in means]))
    scores = (
        texts.map_batches(
            first.where("text_ids IS NOT NULL").select("id_key", "text_key", "text_ids"),
            _model_scores(spark.sparkContext.broadcast(model), size),
            "id_key bigint, text_key bigint, score double, n_subwords bigint",
        )
        .groupBy("id_key", "text_key")
        .agg(F.max("score").alias("score"), F.max("n_subwords").alias("n_subwords"))
    )

    sizes = words.groupBy("c").count().orderBy(F.desc("c"))
    running, least = 0, None
    for row in sizes.toLocalIterator():
        running += row["count"]
        if running > HEAD_WORDS:
            break
        least = row["c"]
    head = words.where(F.lit(least is not None) & (F.col("c") >= (least or 0))).toPandas()
    keys = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast(
        (keys[order], head["c"].to_numpy(np.int64)[order], total, kinds, end_count)
    )
    base = staging.stage(
        texts.map_batches(
            source.select("doc_id", "id_key", "text_key", "text"), _base_scores(sent), _BASE_DDL
        ),
        "base",
    )
    rare = (
        base.where("size(rare) > 0")
        .select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
        .selectExpr("row", "w.rare AS word", "w.rare_n AS times")
        .join(words, "word", "left")
        .groupBy("row")
        .agg(
            F.expr("sum(if(c IS NULL, 0, times))").alias("more_known"),
            F.sum(
                F.expr(
                    f"times * log10((coalesce(c, 0) + 0.5D) / ({total}D + 0.5D * ({kinds}D + 1)))"
                )
            ).alias("more_base"),
        )
    )
    return (
        base.drop("rare", "rare_n")
        .join(rare, "row", "left")
        .join(scores, ["id_key", "text_key"], "left")
        .selectExpr(
            "doc_id",
            f"{held_out} AS held_out",
            "n_tokens",
            "n_known + coalesce(more_known, 0L) AS n_known",
            f"{total}L AS train_tokens",
            "base + coalesce(more_base, 0D) AS base_score",
            "score",
            "n_subwords",
        )
    )
