"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common

#: Edges (16 bytes each) that one task may hold.
ONE_TASK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node that each is connected with."""
    nodes, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = which[: len(a)], which[len(a) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return nodes, nodes[root]
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ab = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
    if ab:
        node, root = forest(np.concatenate([a for a, _ in ab]), np.concatenate([b for _, b in ab]))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) of every node of the (a, b) edges, root being the smallest node connected with it.

    Up to one_task edges go through one task. Beyond that, every round gives each node the smallest of its
    neighbours and itself, contracts the edges by it and goes on with what is left, written out each time.
    """
    edges = common.stored(edges.select("a", "b").where("a <> b"), "edges")
    if edges.count() <= one_task:
        return common.stored(edges.coalesce(1).mapInArrow(_local, "a long, b long").selectExpr("a AS node", "b AS root"), "components")
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    up = common.stored(both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a AS node", "least(a, low) AS up"), "parents")
    first, second = up.selectExpr("node AS a", "up AS ua"), up.selectExpr("node AS b", "up AS ub")
    contracted = edges.join(first, "a").join(second, "b").where("ua <> ub").selectExpr("least(ua, ub) AS a", "greatest(ua, ub) AS b").distinct()
    # A node's parent may itself have a smaller parent: these links stay as edges.
    chain = up.where("node <> up").join(up.selectExpr("node AS up", "up AS upper"), "up").where("up <> upper").selectExpr("upper AS a", "up AS b").distinct()
    higher = components(contracted.unionByName(chain).distinct(), one_task)
    found = up.join(higher.selectExpr("node AS up", "root"), "up", "left").selectExpr("node", "coalesce(root, up) AS root")
    return common.stored(found, "components")
