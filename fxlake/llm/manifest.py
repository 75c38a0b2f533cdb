"""Merkle manifest of a dataset: a content-addressed tree, and proofs by descent from its root.

``build`` makes every row a leaf digest. The leaves of a group stand in order
of their ids; runs of ``FANOUT`` consecutive nodes become the digest of their
digests until one node, the group's subroot, remains. The subroots in order of
the groups give the root in the same way. Leaves are numbered by a
range-partitioned sort, so a group with a third of all rows is spread over many
tasks. A level is one aggregation of at most ``FANOUT`` rows a key and is stored
as (digest, children) records by height.

``prove`` answers leaf requests with those records only. A request starts at
the root. The digits of its rank, base ``FANOUT``, choose a child in each record
that is looked up by digest; the record's children stay on the path together
with the chosen place. Requests with the same digits so far read the same
records, so they travel as one row until they part; a height's records meet
only the nodes of that height. At the leaf the path is reversed, and the
unselected children are the proof from the leaf upwards.

Cases: a null value counts as ``-``; rows with equal ids are ordered by their
leaf digests, a null id comes first; rows that are equal throughout are leaves
of their own with equal digests and share the records above them; null groups
come first; a lone leaf is its group's subroot, and a lone subroot the root;
an empty table gives no leaves, no records and no proofs; columns that are not
named take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from fxlake.session import drop_table, release, stage_table

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

SEGMENT = "struct<pos:int,children:array<string>>"


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the byte length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(v) for v in values]), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


@dataclass
class Manifest:
    """``leaves`` (the rows' kept columns, group, idx, n, leaf), the records of each height, the subroots and the tree over them."""

    leaves: DataFrame
    records: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: DataFrame


def _levels(nodes: DataFrame, group: str, height: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records per height over ``nodes`` (group, idx, n, digest; n counts the nodes of the group), and the last node of each group with its height."""
    records, ends = [], []
    for h in range(height):
        ends.append(nodes.where("n = 1").select(group, "digest", F.lit(h).alias("height")))
        members = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        above = (nodes.where("n > 1").groupBy(group, F.expr(f"idx div {FANOUT}").alias("idx"))
                 .agg(members.alias("m"), F.first("n").alias("n"))
                 .select(group, "idx", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("m.digest").alias("children")))
        level = stage_table(above.select(group, "idx", "n", "children", node_digest(F.col("children")).alias("digest")), f"{name}-{h + 1}")
        records.append(level.select("digest", "children"))
        nodes = level.select(group, "idx", "n", "digest")
    ends.append(nodes.select(group, "digest", F.lit(height).alias("height")))
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return records, out


def _height(n: int) -> int:
    """Levels above ``n`` nodes."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def _ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, its place from 0 within ``group``, and ``n``, the rows of the group; written once.

    Equal rows are interchangeable; their place in the input parts them, so that they spread over partitions too.
    """
    keys = [group, *order, "_at"]
    # Written before the sort, whose sampling would compute the digests once more.
    placed = stage_table(df.withColumn("_at", F.monotonically_increasing_id()), "manifest-rows")
    local = (placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at")
             .withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id()))
    local = stage_table(local, "manifest-sorted")
    drop_table(placed)
    # At most one row a partition and one more a group.
    held = local.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_mono").alias("_first"))
    w = Window.partitionBy(group).orderBy("_pid")
    before = F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stage_table(held.select("_pid", group, (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy(group)).alias("n")),
                          "manifest-offsets")
    return local.join(offsets, ["_pid", group]).withColumn("idx", F.col("_mono") + F.col("_shift")).drop("_pid", "_mono", "_shift")


def build(documents: DataFrame, fields: list[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
          keep: dict[str, Column] | None = None) -> Manifest:
    """The tree over ``documents``; ``keep`` adds columns to the leaves (digests, not texts: they are sorted along)."""
    # "0" for null, else "1" and the value: nulls come first and can be joined.
    group = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group_col}`").cast("string")), F.lit("0"))
    narrow = documents.select(F.col(f"`{id_col}`").alias("id"), group.alias("grp"), leaf_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"),
                              *[c.alias(k) for k, c in (keep or {}).items()])
    leaves = stage_table(_ranked(narrow, "grp", ["id", "leaf"]), "manifest-leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    records, subroots = _levels(leaves.select("grp", "idx", "n", F.col("leaf").alias("digest")), "grp", _height(most), "manifest")
    over = _ranked(subroots.select("grp", F.col("digest").alias("subroot"), "height", F.lit(0).alias("all")), "all", ["grp"])
    over = stage_table(over.select("grp", "subroot", "height", F.col("idx").alias("top_idx"), "n"), "manifest-subroots")
    groups = over.agg(F.max("n")).first()[0] or 0
    nodes = over.select(F.lit(0).alias("all"), F.col("top_idx").alias("idx"), "n", F.col("subroot").alias("digest"))
    top, root = _levels(nodes, "all", _height(groups), "manifest-top")
    return Manifest(leaves, records, over.drop("n"), top, root.select(F.col("digest").alias("root")))


def _open(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The nodes of ``frontier`` with the children that their digests stand for."""
    return frontier.join(records.dropDuplicates(["digest"]), "digest")


def _step(frontier: DataFrame, records: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The children of every node of ``frontier`` (keys, at, digest, path) with the path to them."""
    opened = _open(frontier, records).select(*keys, F.col(at).alias("_at"), "path", "children", F.posexplode("children").alias("pos", "digest"))
    segment = F.struct(F.col("pos").cast("int").alias("pos"), "children").cast(SEGMENT)
    return opened.select(*keys, (F.col("_at") * FANOUT + F.col("pos")).alias(at), "digest", F.concat("path", F.array(segment)).alias("path"))


def prove(tree: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per requested leaf: the columns of ``tree.leaves``, subroot, root, ``node`` (the digest met at its place) and ``path``
    from the leaf upwards: (pos, children) of each level, the subroots' included.

    ``requests`` (grp, idx) names leaves; all are proved without it.
    """
    leaves, wanted = tree.leaves, None
    if requests is not None:
        wanted = requests.select("grp", F.col("idx").cast("long").alias("idx")).distinct()
        leaves = leaves.join(wanted, ["grp", "idx"], "left_semi")

    def asked(frontier: DataFrame, height: int) -> DataFrame:
        """The nodes at ``height`` over some requested leaf."""
        if wanted is None:
            return frontier
        return frontier.join(wanted.select("grp", F.expr(f"idx div {FANOUT ** height}").alias("idx")).distinct(), ["grp", "idx"], "left_semi")

    none = F.array().cast(f"array<{SEGMENT}>")
    frontier = tree.root.select(F.col("root").alias("digest"), F.lit(0).cast("long").alias("top_idx"), none.alias("path"), "root")
    for h in range(len(tree.top), 0, -1):
        frontier = _step(frontier, tree.top[h - 1], ["root"], "top_idx")
    starts = stage_table(tree.subroots.join(frontier, "top_idx").select("grp", "height", "subroot", "root", "digest", "path"), "manifest-starts")
    keys = ["grp", "subroot", "root"]

    def entry(height: int) -> DataFrame:
        return starts.where(F.col("height") == height).select(*keys, F.lit(0).cast("long").alias("idx"), "digest", "path")

    lone = entry(0).select(F.col("grp").alias("_grp"), "subroot", "root", F.col("digest").alias("node"), F.reverse("path").alias("path"))
    out = leaves.where("n = 1").join(lone, F.col("grp") == F.col("_grp")).select(*leaves.columns, "subroot", "root", "node", "path")
    height = len(tree.records)
    if height:
        frontier = asked(entry(height), height)
        for h in range(height, 1, -1):
            # A table a height: one plan over all heights, made anew after each of its stages, is what a driver holds most of.
            frontier = stage_table(asked(_step(frontier, tree.records[h - 1], keys, "idx").unionByName(entry(h - 1)), h - 1), "manifest-frontier")
        release(tree.leaves.sparkSession)
        # The last digit is taken where the leaves meet their parent: paths travel once a run, not once a leaf.
        parents = _open(frontier, tree.records[0]).select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), "subroot", "root", "path", "children")
        pos = (F.col("idx") % FANOUT).cast("int")
        segment = F.array(F.struct(pos.alias("pos"), F.col("children").alias("children")).cast(SEGMENT))
        met = leaves.where("n > 1").join(parents, (F.col("grp") == F.col("_grp")) & (F.expr(f"idx div {FANOUT}") == F.col("_idx")))
        out = out.unionByName(met.select(*leaves.columns, "subroot", "root", F.get("children", pos).alias("node"),
                                         F.concat(segment, F.reverse("path")).alias("path")))
    return out


def siblings(path: Column) -> Column:
    """The unselected children of a path, from the leaf upwards and left to right."""
    return F.flatten(F.transform(path, lambda s: F.concat(F.slice(s["children"], F.lit(1), s["pos"]),
                                                          F.slice(s["children"], s["pos"] + 2, F.size(s["children"])))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the unselected children of ``path`` give."""
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(
        F.array_join(F.slice(s["children"], F.lit(1), s["pos"]), ""), below,
        F.array_join(F.slice(s["children"], s["pos"] + 2, F.size(s["children"])), "")), 256))
