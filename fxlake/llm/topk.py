"""Exact top-k search over integer vectors, term at a time.

Candidates and queries are dealt over a grid: a cell holds one block of
candidates and one block of queries, both of bounded size, and every pair of a
query and a candidate meets in one cell. A task inverts its candidates: each
dimension has a posting list of the candidates that are not zero there, with
their weights. A query is a sparse row; for each of its dimensions it scatters
its weight times the postings into a dense array of scores, one a candidate. A
list that holds every candidate is added as a whole. A partition selection
takes the best k of a block, ties at the border included; the k of each block
are merged per query.

Scores are exact integers: 32-bit where the largest weights prove that they
fit, else 64-bit, and arbitrary integers beyond that (a score or weight that a
long cannot hold is an error).

Each row of one table is sent once per block of the other, so what is shuffled
grows with N * Q / ``BLOCK`` rows, as the work does with N * Q.

Cases: a vector that is null, or holds a null or a component that is not
finite, takes no part; missing components of a shorter vector count as zero,
an empty vector scores 0 everywhere; a null id takes no part, as no query names
it; rows that share an id are candidates each, and queries each with a list of
their own; a query's own id is no candidate of it; fewer candidates than k give
all; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
#: Most rows of a block (64 components of 16 bits: 16 MB), and how far blocks shrink to give every core one.
BLOCK, LEAST_BLOCK = 1 << 17, 1 << 11
SCALE = 256.0

_ANSWER = "q long, query_id long, vec_id long, score long"


def weights(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component, or null where the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = lambda x: F.when(F.abs(x * scale) < 2.0 ** 63, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for an integer weight")).cast("long"))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(wide, whole))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The lists as rows, padded with zeros."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = array.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = array.values.to_numpy(zero_copy_only=False)[offsets[0]: offsets[-1]]
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), flat.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _score_type(candidates: np.ndarray, queries: np.ndarray):
    """The narrowest type that holds every score and partial sum."""
    width = min(candidates.shape[1], queries.shape[1])
    largest = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (candidates, queries)]
    bound = largest[0] * largest[1] * width
    return np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object


class Postings:
    """Per dimension the candidates that are not zero there, and their weights."""

    def __init__(self, rows: np.ndarray, kind):
        self.n = len(rows)
        self.lists = []
        for d in range(rows.shape[1]):
            at = np.flatnonzero(rows[:, d])
            held = np.ascontiguousarray(rows[at, d]).astype(kind)
            # None: every candidate, no positions needed.
            self.lists.append((None if len(at) == self.n else at, held))
        self.kind = kind

    def scores(self, query: np.ndarray) -> np.ndarray:
        total, part = np.zeros(self.n, self.kind), np.empty(self.n, self.kind)
        for d in np.flatnonzero(query[: len(self.lists)]).tolist():
            at, held = self.lists[d]
            w = int(query[d])
            product = np.multiply(held, w, out=part[: len(held)])
            if at is None:
                total += product
            else:
                total[at] += product
        return total


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without the rows of id ``own``."""
    allowed = np.flatnonzero(ids != own)
    if len(allowed) > k:
        low = scores[allowed]
        border = np.partition(low, len(low) - k)[len(low) - k]
        allowed = allowed[low >= border]
    order = sorted(allowed.tolist(), key=lambda i: (-int(scores[i]), int(ids[i]))) if scores.dtype == object else \
        allowed[np.lexsort((ids[allowed], -scores[allowed].astype(np.int64)))].tolist()
    return np.array(order[:k], np.int64)


def _search(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    found: list[tuple[list, list, list, list]] = []
    if candidates.num_rows and queries.num_rows:
        rows, asked = _matrix(candidates["v"]), _matrix(queries["v"])
        postings = Postings(rows, _score_type(rows, asked))
        del rows
        ids = candidates["id"].to_numpy()
        for q, own, query in zip(queries["q"].to_pylist(), queries["id"].to_pylist(), asked):
            scores = postings.scores(query)
            top = best(scores, ids, own, k)
            found.append(([q] * len(top), [own] * len(top), ids[top].tolist(), [int(x) for x in scores[top]]))
    columns = [[x for f in found for x in f[c]] for c in range(4)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["q", "query_id", "vec_id", "score"])


def _blocks(n: int, cores: int, block: int, least: int) -> int:
    return max(1, -(-n // block), min(cores, -(-n // least)))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
           block: int = BLOCK, least: int = LEAST_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best candidates of ``vectors`` for each row of ``queries``.

    Rows are dealt by their place in the scan, so copies and equal ids spread over all blocks.
    """
    def ready(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), weights(F.col(vector_col)).alias("v")).where("id is not null and v is not null")
        return rows.withColumn("q", F.monotonically_increasing_id())

    def extent(df: DataFrame) -> tuple[int, int]:
        """Rows, and the greatest size of a weight."""
        most = F.max(F.array_max(F.transform("v", lambda x: F.greatest(x, -1 - x))))
        n, largest = df.agg(F.count(F.lit(1)), most).first()
        return n, largest or 0

    given, asked = ready(vectors), ready(queries)
    sizes = [extent(df) for df in (given, asked)]
    cores = spark_cores(vectors)
    # Queries are cut only by size: each further block would send all candidates once more.
    n_c, n_q = _blocks(sizes[0][0], cores, block, least), _blocks(sizes[1][0], 1, block, least)
    narrow = [f"array<{'smallint' if most < 1 << 15 else 'int' if most < 1 << 31 else 'long'}>" for _, most in sizes]
    deal = lambda n: F.pmod(F.xxhash64("q"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = given.select("id", F.col("v").cast(narrow[0]).alias("v"), deal(n_c).alias("i"), every(n_q).alias("j"))
    right = asked.select("q", "id", F.col("v").cast(narrow[1]).alias("v"), every(n_c).alias("i"), deal(n_q).alias("j"))
    cells = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(lambda x, y: _search(x, y, k), _ANSWER)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    # At most k rows a query and block of candidates.
    return (cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def spark_cores(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)
