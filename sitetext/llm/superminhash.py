"""Near-duplicate documents by SuperMinHash signatures, banding and checked links.

Every shingle of a document visits the slots of the signature in an order of its own, a random
permutation, and offers each slot the rank of the visit plus a random fraction; a slot keeps the
smallest offer. The ranks of one shingle are correlated over the slots, which lowers the variance
against independent hashes, and a document stops as soon as the next rank can't improve any slot.

Documents with equal shingle sets are one node. Nodes that agree on a band of slots meet in a
bucket. A bucket doesn't pair all its nodes: they are compared with a centre and linked ones become one
component. Buckets that still hold several components are compared with other centres while that
links much, and what is left is settled exactly by the rarest elements of the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sitetext.llm import texts
from sitetext.llm.components import component_labels
from sitetext.operators.joins import lookup
from sitetext.plans.staging import Staging

BANDS, ROWS = 20, 5
#: Shingles whose permutations are held at once.
_AT_ONCE = 300_000
#: Bytes kept of each shingle hash in a set that is compared.
_SET_BYTES = 6
#: Most rounds with new centres, and nodes per link below which another round isn't worth it.
_CENTRE_ROUNDS, _FEW_LINKS = 6, 50
#: Rows of a key from which a lookup splits them.
_HOT_ROWS = 2_000
_MULTIPLIERS = np.array(
    [0x9FB21C651E98DF25, 0xA24BAED4963EE407, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F,
     0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB, 0xF1357AEA2E62A9C5, 0xABC98388FB8FAC03],
    np.uint64,
)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words than `width` are one shingle."""
    data = texts.lowered(data)
    starts, ends, rows = texts.word_spans(data, offsets)
    words = texts.span_hashes(data, starts, ends)
    borders = np.searchsorted(rows, np.arange(len(offsets))).tolist()
    n = max(0, len(words) - width + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n, np.uint64)
        for i in range(width):
            sums += words[i : i + n] * _MULTIPLIERS[i]
        shingles = texts.mixed(sums + np.uint64(width))
        out = []
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if b - a >= width:
                out.append(np.unique(shingles[a : b - width + 1]))
            elif b > a:
                few = (words[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64)
                out.append(texts.mixed(np.array([few + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _offer(slots: np.ndarray, items: np.ndarray, rows: np.ndarray) -> None:
    """Offer the slots of each row the ranks of these items, with early stopping."""
    m = slots.shape[1]
    flat = slots.reshape(-1)
    order = np.tile(np.arange(m, dtype=np.uint8), (len(items), 1))
    each = np.arange(len(items))
    for rank in range(m):
        with np.errstate(over="ignore"):
            x = texts.mixed(items + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
            y = texts.mixed(x + np.uint64(0xD6E8FEB86659FD93))
        swap = rank + (((y >> np.uint64(32)) * np.uint64(m - rank)) >> np.uint64(32)).astype(np.int64)
        slot = order[each, swap]
        order[each, swap] = order[:, rank][each]
        np.minimum.at(
            flat, rows * m + slot, rank + (x >> np.uint64(11)).astype(np.float64) * 2.0**-53
        )
        going = slots.max(axis=1)[rows] >= rank + 1
        if not going.all():
            items, rows, order = items[going], rows[going], order[going]
            each = np.arange(len(items))
        if not len(items):
            return


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row of m numbers per set; those of empty sets are infinite."""
    slots = np.full((len(sets), m), np.inf)
    items = np.concatenate([*sets, np.zeros(0, np.uint64)])
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for at in range(0, len(items), _AT_ONCE):
        _offer(slots, items[at : at + _AT_ONCE], rows[at : at + _AT_ONCE])
    return slots


def band_keys(slots: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    bits = np.ascontiguousarray(slots).view(np.uint64).reshape(len(slots), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(slots), bands)).copy()
    for i in range(rows):
        with np.errstate(over="ignore"):
            key = texts.mixed(key * np.uint64(0x9FB21C651E98DF25) + bits[:, :, i])
    return key


def set_key(items: np.ndarray) -> bytes:
    """128 bits that are the same for equal sets."""
    with np.errstate(over="ignore"):
        a = texts.mixed(items + np.uint64(1)).sum(dtype=np.uint64)
        b = texts.mixed(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(items))], np.uint64).tobytes()


def _signed(width: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
         ("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in texts.pieces(batch.column(1)):
                sets = shingle_sets(data, offsets, width)
                keys = band_keys(signatures(sets, bands * rows), bands, rows).view(np.int64)
                yield texts.pack(
                    {
                        "doc_id": ids.slice(first, end - first),
                        "n_shingles": [len(s) for s in sets],
                        "node": [set_key(s) if len(s) else None for s in sets],
                        "bands": [k if len(s) else None for k, s in zip(keys, sets)],
                    },
                    schema,
                )

    return run


def _sets(width: int):
    """Sets of the documents that stand for a node, six bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            for first, end, data, offsets in texts.pieces(batch.column(0)):
                found = [
                    (n, s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
                    for n, s in zip(nodes[first:end], shingle_sets(data, offsets, width))
                    if len(s) and set_key(s) == n
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)],
                    names=["node", "items"],
                )

    return run


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _SET_BYTES, 8), np.uint8)
    out[:, :_SET_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _SET_BYTES)
    return out.view("<u8").reshape(-1)


def _similar(percent: int):
    """Pairs of nodes whose sets share at least `percent` in a hundred of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_raw, last = None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.as_py(), y.as_py()
                if x != last_raw:
                    last_raw, last = x, _unpack(x)
                other = _unpack(y)
                shared = len(np.intersect1d(last, other, assume_unique=True))
                good.append(100 * shared >= percent * (len(last) + len(other) - shared))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(good), b.filter(good)], names=["a", "b"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar. The a of a pair may be a centre of very many pairs."""
    of_b = sets.withColumnsRenamed({"node": "b", "items": "b_items"})
    of_a = sets.withColumnsRenamed({"node": "a", "items": "a_items"})
    return texts.map_batches(
        pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "a_items", "b_items"),
        _similar(percent),
        "a binary, b binary",
    )


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets whose nodes are not all in one component: bucket, node, n, label.

    Of two nodes one was the centre of the other, so buckets of two are settled.
    """
    marked = members.join(labels, "node", "left").selectExpr(
        "bucket", "node", "n", "coalesce(label, node) AS label"
    )
    mixed = (
        marked.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
        .where("low <> high AND size > 2")
        .select("bucket")
    )
    return marked.join(mixed, "bucket")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per element of each set: node, label, n, element."""
    for batch in batches:
        items = [_unpack(x.as_py()).view(np.int64) for x in batch.column(3)]
        sizes = np.array([len(x) for x in items], np.int64)
        at = pa.array(np.repeat(np.arange(len(items)), sizes))
        for first in range(0, len(at), 1 << 16):
            part = at.slice(first, 1 << 16)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).take(part) for i in range(3)),
                    pa.array(np.concatenate(items)[first : first + len(part)]),
                ],
                names=["node", "label", "n", "element"],
            )


def _alike_by_prefix(left: DataFrame, sets: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """All pairs (a, b) of nodes of different labels that can be alike, by their rarest elements.

    With the elements of every set in one order, rare ones first, two sets that share enough have
    their first common element early in both: behind it there must be enough elements left for
    the overlap. Texts that share a common passage and differ elsewhere don't meet this way, for
    what they share comes late in the order.
    """
    elements = staging.stage(
        texts.map_batches(
            left.join(sets, "node").select("node", "label", "n", "items"),
            _elements,
            "node binary, label binary, n bigint, element bigint",
        ),
        "elements",
    )
    counts = elements.groupBy("element").agg(F.count("*").alias("held"))
    in_order = Window.partitionBy("node").orderBy("held", "element")
    early = staging.stage(
        elements.join(counts, "element")
        .withColumn("place", F.row_number().over(in_order) - 1)
        .where(f"held > 1 AND 100 * (n - place) >= {percent} * n")
        .select("element", "node", "label", "n", "place"),
        "early",
    )
    other = early.selectExpr(
        "element", "node AS b", "label AS b_label", "n AS b_n", "place AS b_place"
    )
    return (
        early.join(
            other,
            (early["element"] == other["element"])
            & F.expr(
                f"label < b_label AND 100 * least(n, b_n) >= {percent} * greatest(n, b_n) AND "
                f"{100 + percent} * least(n - place, b_n - b_place) >= {percent} * (n + b_n)"
            ),
        )
        .selectExpr("node AS a", "b")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Words are runs of characters other than space and the characters 9 to 13, with A-Z in lower
    case. Two documents are linked if the sets of their `width`-word shingles share at least
    `percent` of a hundred of their union; component_id is the smallest doc_id that links reach.
    A document with fewer words has one shingle. A null, empty or white text has none and is
    linked with nothing. Equal sets are linked, so repeated rows share a component, and all but
    the smallest doc_id have kept = false. A document without doc_id is linked with nothing, has
    no component_id and is kept. An empty table gives none, and other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    signed = staging.stage(
        texts.map_batches(
            source,
            _signed(width, bands, rows),
            "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>",
        ),
        "signed",
    )
    n_docs = signed.count()
    nodes = staging.stage(
        signed.where("doc_id IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "nodes",
        n_docs,
    )
    exploded = nodes.select("node", "rep", "n", F.explode("bands").alias("bucket"))
    shared = (
        exploded.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(F.struct("rep", "node")).alias("centre"))
        .where("size > 1")
        .selectExpr("bucket", "centre.node AS centre")
    )
    members = staging.stage(exploded.join(shared, "bucket"), "members")
    n_members = members.count()
    active = members.select("node", "rep").distinct()
    sets = staging.stage(
        texts.map_batches(
            source.join(active.withColumnRenamed("rep", "doc_id"), "doc_id").select("text", "node"),
            _sets(width),
            "node binary, items binary",
        ),
        "sets",
    )
    pairs = members.where("node <> centre").selectExpr("centre AS a", "node AS b").distinct()
    links = staging.stage(_links(pairs, sets, percent), "links_0")
    labels = component_labels(links, staging, "components_0")
    for turn in range(1, _CENTRE_ROUNDS + 2):
        still = staging.stage(_open_members(members, labels), f"open_{turn}", n_members)
        if still.isEmpty():
            break
        last = turn == _CENTRE_ROUNDS + 1
        if not last:
            centres = still.groupBy("bucket").agg(
                F.min(F.expr(f"struct(xxhash64(node, {turn}) AS h, node, label, n)")).alias("c")
            )
            pairs = (
                lookup(still, centres, ["bucket"], "node", n_members, _HOT_ROWS)
                .where(
                    "label <> c.label AND "
                    f"100 * least(n, c.n) >= {percent} * greatest(n, c.n)"
                )
                .selectExpr("c.node AS a", "node AS b")
                .distinct()
            )
            found = staging.stage(_links(pairs, sets, percent), f"links_{turn}")
            # Few links are left to find by centres: the rest is settled pair by pair.
            n_found = found.count()
            last = _FEW_LINKS * n_found <= still.select("node").distinct().count()
            if n_found:
                links = links.unionByName(found)
                labels = component_labels(links, staging, f"components_{turn}")
        if last:
            left = _open_members(members, labels).select("node", "label", "n").distinct()
            left = staging.stage(left, "left", n_members)
            pairs = _alike_by_prefix(left, sets, percent, staging)
            found = staging.stage(_links(pairs, sets, percent), "links_left")
            if not found.isEmpty():
                labels = component_labels(links.unionByName(found), staging, "components_left")
            break
    marked = nodes.select("node", "rep").join(labels, "node", "left").selectExpr(
        "node", "rep", "coalesce(label, node) AS label"
    )
    firsts = marked.groupBy("label").agg(F.min("rep").alias("component_id"))
    reached = staging.stage(
        marked.join(firsts, "label").select("node", "component_id"), "reached", n_docs
    )
    return lookup(
        signed.select("doc_id", "n_shingles", "node"), reached, ["node"], "doc_id", n_docs, _HOT_ROWS
    ).selectExpr(
        "doc_id",
        "n_shingles",
        "if(doc_id IS NULL, NULL, coalesce(component_id, doc_id)) AS component_id",
        "doc_id IS NULL OR doc_id = coalesce(component_id, doc_id) AS kept",
    )


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of `docs`, with all their columns, that are the first of their group.

    Of rows with equal doc_id and text one stays, chosen by the hash of the row; rows with equal
    doc_id and different texts stay or go together. Rows without doc_id stay.
    """
    kept_id, copy = texts.free_name(docs, "kept_id"), texts.free_name(docs, "copy")
    kept = (
        near_duplicates(docs, id_col, text_col, width, percent)
        .where("kept AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias(kept_id))
        .distinct()
    )
    own = docs[id_col].cast("bigint")
    same = Window.partitionBy(own, F.md5(docs[text_col])).orderBy(F.xxhash64(*docs.columns))
    firsts = (
        docs.join(kept, own == kept[kept_id], "left_semi")
        .withColumn(copy, F.row_number().over(same))
        .where(F.col(copy) == 1)
        .drop(copy)
    )
    return firsts.unionByName(docs.where(own.isNull()))
