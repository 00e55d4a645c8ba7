"""Connected components of links between keys, by union-find in tasks and joins between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitetext.llm import texts
from sitetext.plans.staging import Staging

#: Links a task folds at once.
_AT_ONCE = 500_000
_STAR = pa.schema([("node", pa.binary()), ("root", pa.binary())])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a task: each node with the smallest key it is joined to."""
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def flush() -> pa.RecordBatch:
        nodes = list(parent)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array([find(x) for x in nodes], pa.binary())],
            schema=_STAR,
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= _AT_ONCE:
            yield flush()
            parent.clear()
    if parent:
        yield flush()


def component_labels(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """The linked nodes and a label that is the same for all nodes of a component.

    `links` has two binary columns. Tasks fold their links into stars; then smallest labels are
    exchanged along the stars, and each round also passes them on to the labels themselves, so
    paths shorten as in union-find and the rounds grow with the logarithm of the longest path.
    """
    most = 2 * links.count()
    stars = staging.stage(
        texts.map_batches(links, _stars, "node binary, root binary"), f"{name}_stars", most
    )
    labels = staging.stage(
        stars.groupBy("node").agg(F.min("root").alias("label")), f"{name}_labels_0", most
    )
    step = 0
    while True:
        step += 1
        ends = (
            stars.join(labels.withColumnsRenamed({"label": "node_label"}), "node")
            .join(labels.withColumnsRenamed({"node": "root", "label": "root_label"}), "root")
            .where("node_label <> root_label")
        )
        least = F.expr("least(node_label, root_label)")
        better = (
            ends.select(
                F.explode(F.expr("array(node, root, node_label, root_label)")).alias("node"),
                least.alias("least"),
            )
            .groupBy("node")
            .agg(F.min("least").alias("least"))
        )
        if better.isEmpty():
            return labels
        passed = labels.join(better, "node", "left").selectExpr(
            "node", "least(label, coalesce(least, label)) AS label"
        )
        up = passed.selectExpr("node AS label", "label AS up")
        labels = staging.stage(
            passed.join(up, "label").selectExpr("node", "least(label, up) AS label"),
            f"{name}_labels_{step}",
            most,
        )
