"""Connected components over an edge table, by alternating large and small stars.

Edges may first be contracted within each partition, in Python; the rounds are
DataFrame operations only. Each round is two
aggregations with a map-side minimum and two joins of stored tables, so a hub
with a third of all edges is summed before the shuffle and its join partition
can be split. Rounds grow with the logarithm of the diameter.
Nothing is collected; each round is cut with a table in the checkpoint folder.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fxlake.session import stage_table


def _contract(batches):
    """Edges of a partition as stars: each node with the smallest node that it reaches there."""
    parent: dict = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    kind = None
    for b in batches:
        kind = b.schema.field(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 1 << 16):
        part = nodes[at: at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["u", "v"])


def _star(edges: DataFrame, at: str) -> DataFrame:
    """``edges`` (u, v) with the smallest of u and its neighbours as m."""
    return edges.join(stage_table(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), at), "u")


def _is_done(edges: DataFrame) -> bool:
    """Whether the edges are stars: a node with a parent has one, and is no parent itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", contract: bool = True) -> DataFrame:
    """(node, label) for every node of ``edges``; the label is the smallest node that it reaches.

    Null ends and loops are left out; repeated edges count once; no edges give
    no rows. ``contract`` spares rounds where many edges of a partition meet.
    """
    pairs = (edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
             .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")))
    # Contracting each partition first leaves at most one edge a node and task.
    now = stage_table(pairs.mapInArrow(_contract, pairs.schema) if contract else pairs.distinct(), "edges")
    while not _is_done(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.distinct(), "large")
        small = _star(large, "small")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = stage_table(moved.where("u <> v").distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
