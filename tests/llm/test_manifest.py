import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fxlake.llm import manifest
from tests.llm.conftest import lower

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DDL = "doc_id long, source string, lang string, n_chars long, text string, leaf string, idx string, digest int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The root over ``nodes`` and the siblings of each, from the leaf upwards, with their sides."""
    paths = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at: at + 8]
            for pos, below in enumerate(under[at: at + 8]):
                for k in below:
                    paths[k].append((run[:pos], run[pos + 1:]))
            up.append(h(*run))
            over.append([k for below in under[at: at + 8] for k in below])
        nodes, under = up, over
    return (nodes[0] if nodes else None), paths


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded root of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[g] = tree([leaf(r) for r in groups[g]])
    root, tops = tree([subs[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for row, path in zip(groups[g], subs[g][1]):
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                now = (*row[:4], lower(row[4]))
            folded = leaf(now)
            for left, right in path + top:
                folded = h(*left, folded, *right)
            out.append((row[0], leaf(row), subs[g][0], root, h(*[x for left, right in path + top for x in left + right]), folded, folded == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], DDL)


def answer(spark, rows, requests=None):
    documents = frame(spark, rows)
    tampered = [F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c == "text" else F.col(c) for c in COLUMNS]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    built = manifest.build(documents, keep={"tampered": F.when(changed, manifest.leaf_digest(tampered))})
    proved = manifest.prove(built, requests)
    out = proved.select("id", "leaf", "node", "subroot", "root", F.sha2(F.array_join(manifest.siblings(F.col("path")), ""), 256).alias("proof"),
                        manifest.fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded"), manifest.fold(F.col("leaf"), F.col("path")).alias("again")).collect()
    assert all(r.node == r.leaf and r.again == r.root for r in out)
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof, r.folded, r.folded == r.root) for r in out), key=str)


def rows_of(n, lang, first=0):
    return [(first + k, f"s{k % 3}" if k % 5 else None, lang, k if k % 7 else None, f"Text {k} é" if k % 11 else None) for k in range(n)]


def test_matches_brute_force(spark):
    """Groups of 1, 8, 9, 64, 65 and 130 leaves; null and empty groups; null and repeated ids; equal rows over whole runs."""
    rows = rows_of(130, "en") + rows_of(1, "zz", 500) + rows_of(8, "de", 600) + rows_of(9, "fr", 700) + rows_of(64, None, 800) + rows_of(65, "", 900)
    rows += [(5, "s", "en", 1, "Other Five"), (None, None, "en", None, None), (None, "a", "en", 2, "B"), (3, "x", "es", 1, "A" * 200_000)]
    rows += [(2000, "same", "pt", 4, "Same Row")] * 40
    assert answer(spark, rows) == brute(rows)


def test_more_groups_than_a_run(spark):
    rows = [(k, None, f"g{k % 21:02d}", k, f"T{k}") for k in range(60)]
    assert answer(spark, rows) == brute(rows)


def test_only_requested_leaves(spark):
    rows = rows_of(100, "en") + rows_of(3, "de", 300)
    asked = spark.createDataFrame([("1en", 0), ("1en", 77), ("1en", 77), ("1de", 2), ("1xx", 5), ("1en", 100)], "grp string, idx int")
    assert answer(spark, rows, asked) == [r for r in brute(rows) if r[0] in (0, 77, 302)]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty_and_lone(spark, rows):
    assert answer(spark, rows) == (brute(rows) if rows else [])


def test_the_plan_of_the_proofs_does_not_grow_with_the_tree(spark):
    joins = []
    for n in (70, 600):
        documents = spark.range(0, n, 1, 3).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
        tree = manifest.build(documents)
        proofs = manifest.prove(tree)
        assert len(tree.records) == (3 if n == 70 else 4) and proofs.where("node <> leaf").count() == 0 and proofs.count() == n
        joins.append(proofs._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert joins[0] == joins[1]
