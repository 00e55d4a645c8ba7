"""The trie of conversations by their turns, from sorted sequences.

A conversation is the sequence of the digests of its turns. All sequences are sorted, over range
partitions, so that the members of a node, the conversations that start with its turns, are
neighbours. Each task takes its sorted block: the common prefix lengths (LCPs) of neighbours, a
sparse table of their range minima, and every prefix of every conversation as a candidate. Each
candidate finds the left and the right end of its interval by binary search in the table, for
itself; one whose left end is its own row stands for a node, and sums over the interval give the
node's columns.

A node that ends at the border of a block may go on in the next one. Such nodes, at most two per
depth and block, are merged by the key of their prefix, and what both sides of a border counted is
taken off. So a shared beginning or a repeated conversation may hold any share of all rows: ties
are ordered by conv_id, and ranges cut through them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sitetext.llm import texts
from sitetext.operators.joins import lookup
from sitetext.plans.staging import Staging

#: Turns of a sorted block, about.
BLOCK_TURNS = 500_000
#: Shared beginnings: conversations of one block of this many ids take turns of its first one.
SHARED_IDS, MOST_SHARED = 20, 4

_SIZE = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_WORD = r"[^\\x20\\x09-\\x0D]+"
_ROWS = 1 << 16

_LOCAL = (
    "key binary, depth bigint, conv_id bigint, parent_key binary, parent_conv_id bigint, "
    "parent_open boolean, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, ends string, first_end bigint, block bigint, "
    "open boolean, on_first boolean, on_last boolean, words_before bigint, words_to bigint, "
    "last_depth bigint"
)
_RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def turn_sequences(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id and its turns in order, each with digest and words.

    Text is reduced to a digest in the task that reads it. A null role or text counts as empty, a
    null turn comes first, turns of one number are ordered by digest, and rows without a
    conversation are left out.
    """
    role, text = (f"coalesce(`{c}`, '')" for c in (role_col, text_col))
    turns = conversations.where(f"`{id_col}` IS NOT NULL").selectExpr(
        f"CAST(`{id_col}` AS bigint) AS conv_id",
        f"CAST(`{turn_col}` AS bigint) AS turn",
        f"left(sha2(CAST(concat(length({role}), ':', {role}, {text}) AS binary), 256), "
        f"{2 * _SIZE}) AS digest",
        f"regexp_count({text}, '{_WORD}') AS words",
    )
    return turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns")
    )


def with_shared_beginnings(sequences: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their block.

    Conversation c takes the first h turns of conversation c - c % 20, all if there are fewer and
    none if it is absent, in place of its own first h; h is crc32 of the decimal c, modulo 4.
    """
    heads = sequences.where(f"conv_id % {SHARED_IDS} = 0").selectExpr(
        "conv_id AS of", f"slice(turns, 1, {MOST_SHARED - 1}) AS head"
    )
    h = f"CAST(crc32(CAST(CAST(conv_id AS string) AS binary)) % {MOST_SHARED} AS int)"
    return (
        sequences.withColumn("of", F.expr(f"conv_id - conv_id % {SHARED_IDS}"))
        .join(heads, "of", "left")
        .selectExpr(
            "conv_id",
            f"IF({h} = 0, turns, concat(slice(coalesce(head, slice(turns, 1, 0)), 1, {h}), "
            f"slice(turns, {h} + 1, size(turns)))) AS turns",
        )
    )


def neighbour_lcps(digests: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many first turns each sequence shares with the next one."""
    lcp = np.zeros(max(0, len(sizes) - 1), np.int64)
    active, depth = np.arange(len(lcp)), 0
    while len(active):
        active = active[np.minimum(sizes[active], sizes[active + 1]) > depth]
        here, there = digests[starts[active] + depth], digests[starts[active + 1] + depth]
        active = active[(here == there).all(axis=1)]
        lcp[active] += 1
        depth += 1
    return lcp


class RangeMinima:
    """Minima of ranges of an array in constant time."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.levels = [values] if self.n else []
        while self.n >> len(self.levels):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of values[first : last + 1]."""
        out = np.empty(len(first), self.levels[0].dtype)
        size = last - first + 1
        for k, level in enumerate(self.levels):
            of = np.flatnonzero((size >> k) == 1)
            out[of] = np.minimum(level[first[of]], level[last[of] + 1 - (1 << k)])
        return out

    def left_ends(self, rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
        """The first row from which on all values before `rows` are at least `depths`."""
        at = rows.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            to = at - (1 << k)
            ok = np.flatnonzero(to >= 0)
            ok = ok[self.levels[k][to[ok]] >= depths[ok]]
            at[ok] = to[ok]
        return at

    def right_ends(self, rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
        """The last row up to which all values from `rows` on are at least `depths`."""
        at = rows.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            ok = np.flatnonzero(at + (1 << k) <= self.n)
            ok = ok[self.levels[k][at[ok]] >= depths[ok]]
            at[ok] += 1 << k
        return at


def _keys(digests: np.ndarray, starts: np.ndarray, sizes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """A 128-bit key of every prefix, chained turn by turn over all sequences at once."""
    keys = np.zeros((int(sizes.sum()) + len(sizes), 2), np.uint64)
    active, depth = np.flatnonzero(sizes > 0), 0
    while len(active):
        before, turn = keys[heads[active] + depth], digests[starts[active] + depth]
        with np.errstate(over="ignore"):
            first = texts.mixed(before[:, 0] * np.uint64(0x9E3779B97F4A7C15) + turn[:, 0])
            second = before[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F) + turn[:, 1] + first
        keys[heads[active] + depth + 1] = np.stack([first, texts.mixed(second)], 1)
        depth += 1
        active = active[sizes[active] > depth]
    return keys


def block_nodes(ids: np.ndarray, seqs: pa.Array, words: np.ndarray, block: int) -> dict[str, object]:
    """The nodes of a sorted block of conversations, with what lies in the block."""
    data, offsets = texts.as_bytes_of_binary(seqs)
    digests = data.view("<u8").reshape(-1, 2) if len(data) else np.zeros((0, 2), np.uint64)
    n, sizes = len(ids), np.diff(offsets) // _SIZE
    starts = offsets[:-1] // _SIZE
    lcp = neighbour_lcps(digests, starts, sizes)
    table = RangeMinima(lcp)
    # Candidates: every prefix of every row, the empty one included.
    heads = starts + np.arange(n)
    row = np.repeat(np.arange(n), sizes + 1)
    depth = np.arange(len(row)) - heads[row]
    left = table.left_ends(row, depth)
    is_node = left == row
    first, at_depth = row[is_node], depth[is_node]
    last = table.right_ends(first, at_depth)
    number = np.cumsum(is_node) - 1
    parent = number[heads[left[np.flatnonzero(is_node) - (at_depth > 0)]] + at_depth - (at_depth > 0)]
    # Words of the first d turns of a row, at its candidate of depth d.
    so_far = np.zeros(len(row), np.int64)
    so_far[depth > 0] = words
    so_far = np.cumsum(so_far)
    so_far -= so_far[heads][row]
    all_words = so_far[heads + sizes]
    sums = np.concatenate([[0], np.cumsum(all_words)])
    own = all_words - np.concatenate([[0], so_far[heads[1:] + lcp]])
    owned = np.cumsum(own)
    members = last - first + 1
    before = so_far[heads[first] + np.maximum(at_depth - 1, 0)]
    texts_of_nodes = owned[last] - owned[first] + all_words[first] - before
    is_leaf = np.append(sizes[:-1] > lcp, True)
    leaves = np.concatenate([[0], np.cumsum(is_leaf)])
    key = _keys(digests, starts, sizes, heads)[is_node]
    least_id = RangeMinima(ids).least(first, last)
    on_first, on_last = first == 0, last == n - 1
    is_open = on_first | on_last
    is_child = at_depth > 0
    # Equal rows are neighbours, in order of their ids.
    goes_on = (sizes[:-1] == lcp) & (sizes[1:] == lcp)
    run_ends = np.flatnonzero(np.append(~goes_on, True))
    digests_of, lists, first_end = [], [], []
    has_ends = sizes[first] == at_depth
    run_end = run_ends[np.searchsorted(run_ends, first)].tolist()
    for i, end, some, is_cut in zip(
        first.tolist(), run_end, has_ends.tolist(), is_open.tolist(), strict=True
    ):
        written = ",".join(map(str, ids[i : end + 1].tolist())) if some else None
        lists.append(written if is_cut else None)
        first_end.append(int(ids[i]) if some and is_cut else None)
        digests_of.append(hashlib.sha256(written.encode()).hexdigest() if some else _NO_ENDS)
    raw = key.tobytes()
    keys = np.array([raw[i : i + _SIZE] for i in range(0, len(raw), _SIZE)], object)
    return {
        "key": keys,
        "depth": at_depth,
        "conv_id": least_id,
        "parent_key": np.where(is_child, keys[parent], None),
        "parent_conv_id": pa.array(least_id[parent], mask=~is_child),
        "parent_open": is_open[parent],
        "n_convs": members,
        "n_children": np.bincount(parent[is_child], minlength=len(first)),
        "n_leaves": leaves[last + 1] - leaves[first],
        "saved_tokens": sums[last + 1] - sums[first] - members * before - texts_of_nodes,
        "ends_sha256": digests_of,
        "ends": lists,
        "first_end": first_end,
        "block": np.full(len(first), block),
        "open": is_open,
        "on_first": on_first,
        "on_last": on_last,
        "words_before": before,
        "words_to": so_far[is_node],
        "last_depth": np.full(len(first), sizes[-1]),
    }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if len(b)]
    if not got:
        return
    table = pa.Table.from_batches(got).combine_chunks()
    ids = table.column("conv_id").to_numpy()
    seqs, words = (table.column(c).combine_chunks() for c in ("seq", "words"))
    words = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    found = block_nodes(ids, seqs, words, TaskContext.get().partitionId())
    types = {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    schema = pa.schema([(n, types[t]) for n, t in (f.split() for f in _LOCAL.split(", "))])
    for begin in range(0, len(found["depth"]), _ROWS):
        yield texts.pack({n: x[begin : begin + _ROWS] for n, x in found.items()}, schema)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of its lists of ids, which come one after the other."""
    key, digest = None, None
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for k, ends in zip(*(batch.column(c).to_pylist() for c in ("key", "ends")), strict=True):
            if k != key:
                done.append((key, digest))
                key, digest = k, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        done = [(k, d.hexdigest()) for k, d in done if k is not None]
        yield texts.pack({"key": [k for k, _ in done], "ends_sha256": [d for _, d in done]}, schema)
    if key is not None:
        yield texts.pack({"key": [key], "ends_sha256": [digest.hexdigest()]}, schema)


def _border_corrections(cut: DataFrame) -> DataFrame:
    """What the two sides of each border between blocks counted twice, by node."""
    # One row per block, so this window has as many rows as the sort has tasks.
    following = (
        cut.select("block")
        .distinct()
        .withColumn("next", F.lead("block").over(Window.orderBy("block")))
        .where("next IS NOT NULL")
    )
    lasts = cut.where("on_last").join(F.broadcast(following), "block").drop("block")
    firsts = cut.where("on_first").select("key", F.col("block").alias("next"))
    crossing = lasts.join(firsts, ["key", "next"])
    deepest = crossing.groupBy("next").agg(
        F.max("depth").alias("shared"), F.max("words_to").alias("shared_words")
    )
    return crossing.join(F.broadcast(deepest), "next").selectExpr(
        "key",
        "CAST(NULL AS bigint) AS depth",
        "CAST(NULL AS bigint) AS conv_id",
        "CAST(NULL AS binary) AS parent_key",
        "0L AS n_convs",
        "IF(depth < shared, -1L, 0L) AS n_children",
        "IF(last_depth <= shared, -1L, 0L) AS n_leaves",
        "shared_words - words_before AS saved_tokens",
    )


def prefix_trie(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included.

    `sequences` has conv_id and turns, as `turn_sequences` gives them. Columns: conv_id (smallest
    member), depth, parent_conv_id (smallest member of the parent; null at the root), n_convs
    (members), n_children, n_leaves (childless nodes in the subtree, which includes its top),
    saved_tokens (over the subtree, members but one times the words of the node's last text) and
    ends_sha256 (of the decimal ids of the members that end here, ascending, joined by commas).

    Conversations without turns are members of the root, repeated ones of all their nodes. An
    empty table gives no rows. A conversation is one row of 16 bytes a turn, and a task holds a
    block of about `block_turns` turns, or of one conversation if that is longer.
    """
    staging = Staging(sequences.sparkSession)
    rows = staging.stage(
        sequences.selectExpr(
            "conv_id",
            "unhex(array_join(transform(turns, t -> t.digest), '')) AS seq",
            "transform(turns, t -> t.words) AS words",
        ),
        "sequences",
    )
    turns = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    in_order = rows.repartitionByRange(turns // block_turns + 1, "seq", "conv_id")
    in_order = in_order.sortWithinPartitions("seq", "conv_id")
    nodes = staging.stage(texts.map_batches(in_order, _blocks, _LOCAL), "nodes")
    cut = nodes.where("open")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns = ["key", "depth", "conv_id", "parent_key", *sums]
    ends = texts.map_batches(
        cut.where("ends IS NOT NULL")
        .select("key", "first_end", "ends")
        .repartition("key")
        .sortWithinPartitions("key", "first_end")
        .select("key", "ends"),
        _end_digests,
        "key binary, ends_sha256 string",
    )
    merged = (
        cut.select(*columns)
        .union(_border_corrections(cut).select(*columns))
        .groupBy("key")
        .agg(
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.max("parent_key").alias("parent_key"),
            *(F.sum(c).alias(c) for c in sums),
        )
        .join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    )
    merged = staging.stage(merged, "merged")
    below = nodes.where("NOT open AND parent_open").select(*columns, "ends_sha256").unionByName(merged)
    parents = merged.selectExpr("key AS parent_key", "conv_id AS parent_conv_id")
    n_below = nodes.where("parent_open").count()
    below = lookup(below, parents, ["parent_key"], "key", n_below)
    return nodes.where("NOT open AND NOT parent_open").select(*_RESULT).unionByName(
        below.select(*_RESULT)
    )
