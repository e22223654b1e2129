"""Exact top-k by integer inner product: the threshold algorithm over sorted lists, one list a dimension."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, ready

SCALE = 256
TOP = 5
#: First stretch of every list that is read; each further one is twice as long.
STRETCH = 16


# ---- the threshold algorithm, on one block of rows ------------------------------------------------------


class Lists:
    """The rows of a block, and for each dimension the list of their positions in the order of that component.

    Sorted access walks a list from its high end where the query's component is positive, else from its low end; a row
    met in any list is scored as a whole at once (random access). The threshold, the score of a row that would stand
    where every list has got to, bounds all rows not met yet.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, 0)

    def top(self, query: np.ndarray, k: int, own: np.ndarray, least: float = -math.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """(positions, scores, depth): the k best rows but those at ``own``, of equal scores the first positions.

        ``least`` is a score that k rows are known to reach elsewhere: rows below it are left out. The walk ends when
        the threshold lies below the k-th best score or below ``least``; on a tie it goes on, as a row not met may
        have an earlier position.
        """
        n = len(self.vectors)
        seen = np.zeros(n, bool)
        seen[own] = True
        at, scores, bar = np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype), least
        dims = np.flatnonzero(query)
        if not len(dims):
            at = np.flatnonzero(~seen)[:k] if 0 >= least else at
            return at, np.zeros(len(at), self.vectors.dtype), 0
        low, high = dims[query[dims] < 0], dims[query[dims] > 0]
        begin, stretch = 0, STRETCH
        while begin < n:
            end = min(n, begin + stretch)
            met = np.concatenate([self.order[begin:end, low].ravel(), self.order[n - end : n - begin, high].ravel()])
            fresh = np.unique(met[~seen[met]])
            seen[fresh] = True
            found = self.vectors[fresh] @ query
            good = found >= bar
            if good.any():
                at, scores = np.concatenate([at, fresh[good]]), np.concatenate([scores, found[good]])
                best = np.lexsort((at, -scores))[:k]
                at, scores = at[best], scores[best]
                if len(at) == k:
                    bar = max(bar, scores[-1])
            threshold = self.values[end - 1, low] @ query[low] + self.values[n - end, high] @ query[high]
            begin, stretch = end, 2 * stretch
            if threshold < bar:
                break
        return at, scores, begin


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors as doubles where all sums of products are exact in them, else as 64-bit whole numbers."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
    most = int(np.abs(flat).max(initial=0))
    return flat.astype(np.float64) if most * most * max(1, dim) < 1 << 53 else flat


# ---- all rows and all queries ---------------------------------------------------------------------------


def scaled(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, vec, dim): every component x as floor(scale * x), computed in double. Each (id, vector) comes once.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no part.
    """
    source = F.col(f"`{vector}`")

    def whole(x: Column) -> Column:
        return F.floor(F.lit(float(scale)) * x.cast("double"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))

    held = rows.select(F.col(f"`{key}`").alias("id"), source.alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    held = held.where(F.forall("vec", lambda x: F.coalesce(finite(x), F.lit(False))))
    return held.select("id", F.transform("vec", whole).alias("vec"), F.size("vec").alias("dim")).distinct()


def search(
    rows: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    scale: int = SCALE,
    row_block: int = 4096,
    query_block: int = 512,
) -> DataFrame:
    """(query_id, rank, key, score): each query's ``top`` rows of ``rows`` by inner product, exactly.

    Rows with the query's id are no candidates; ties go to the smaller id. A query meets only vectors of its own
    number of components. A repeated row counts once; an id with several vectors is a candidate with each, and asks
    with each. Scores must fit a long. Empty tables give no rows.

    Rows and queries are dealt by a hash into blocks of bounded size. A query first runs through one block; its k-th
    score there is the bar from which it starts in all others, so their walks end early. What a block hands on is at
    most ``top`` rows a query. No list, block or queue grows with the table.
    """
    ready(rows.sparkSession)
    held, asked = cut(scaled(rows, key, vector, scale)), cut(scaled(queries, key, vector, scale))
    n_rows = max(1, math.ceil(held.count() / row_block))
    n_queries = max(1, math.ceil(asked.count() / query_block))

    def dealt(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    held = held.withColumn("row_block", dealt(held, n_rows))
    asked = asked.withColumn("query_block", dealt(asked, n_queries)).withColumn("mark", F.xxhash64("vec"))
    keys = ["dim", "row_block", "query_block"]
    result = "query_id long, mark long, id long, score long"

    def walk(own: pa.Table, asking: pa.Table) -> pa.Table:
        names = ["query_id", "mark", "id", "score"]
        if not len(own) or not len(asking):
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        dim = asking.column("dim")[0].as_py()
        both = matrix(pa.chunked_array([*own.column("vec").chunks, *asking.column("vec").chunks]), dim)
        ids = own.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, lists, points = ids[order], Lists(both[: len(ids)][order]), both[len(ids) :]
        bars = asking.column("least").fill_null(np.iinfo(np.int64).min).to_numpy()
        found = []
        for who, mark, point, bar in zip(asking.column("id").to_numpy(), asking.column("mark").to_numpy(), points, bars):
            mine = np.arange(*np.searchsorted(ids, [who, who + 1]))
            at, scores, _ = lists.top(point, top, mine, bar)
            found.append((np.full(len(at), who), np.full(len(at), mark), ids[at], scores.astype(np.int64)))
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=names)

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(walk, result)

    # A first block for every query; every row block serves the queries of some query blocks.
    home = F.pmod(F.col("query_block"), F.lit(n_rows)).cast("int")
    first = F.col("row_block") == F.pmod(F.col("query_block"), F.lit(n_rows))
    grid = held.withColumn("query_block", every(n_queries))
    begun = asked.withColumn("row_block", home).withColumn("least", F.lit(None).cast("long"))
    near = cut(meet(grid.where(first), begun))
    if n_rows > 1:
        bars = near.groupBy("query_id", "mark").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= top)
        bars = bars.select(F.col("query_id").alias("id"), "mark", "least")
        rest = asked.join(bars, ["id", "mark"], "left").withColumn("row_block", every(n_rows))
        near = near.unionByName(meet(grid.where(~first), rest.where(~first).select(*begun.columns)))
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return near.select("query_id", "rank", F.col("id").alias(key), "score")
