"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a classifier that routes to it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, hashed_sample, ready

SAMPLE = 8192
TOP = 20


# ---- the index, on the sample ---------------------------------------------------------------------------


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, skip_self: bool) -> np.ndarray:
    """Positions of the k rows with the largest inner product, in no order; a block of queries at a time."""
    out = []
    for begin in range(0, len(queries), 512):
        dots = queries[begin : begin + 512] @ rows.T
        if skip_self:
            own = np.arange(len(dots))
            dots[own, begin + own] = -np.inf
        out.append(np.argpartition(-dots, min(k, dots.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def split_halves(rows: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A first balanced assignment: halves by the median along the widest direction, again and again."""
    labels, groups = np.zeros(len(rows), np.int64), [np.arange(len(rows))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            centred = rows[g] - rows[g].mean(0)
            axis = rng.normal(size=rows.shape[1])
            for _ in range(8):
                axis = centred.T @ (centred @ axis)
                axis /= np.linalg.norm(axis) + 1e-12
            order = g[np.argsort(centred @ axis, kind="stable")]
            halves += [order[: len(order) // 2], order[len(order) // 2 :]]
        groups = halves
    for i, g in enumerate(groups):
        labels[g] = i
    return labels


def balance_cut(graph: np.ndarray, labels: np.ndarray, parts: int, rounds: int = 6, slack: float = 0.05) -> np.ndarray:
    """Fewer cut edges at the same balance: nodes move to where most of their neighbours are, while there is room.

    Those who gain most move first; no part may hold more than its share and the slack.
    """
    labels = labels.copy()
    room = math.ceil(len(labels) / parts * (1 + slack))
    sizes = np.bincount(labels, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((len(labels), parts), np.int16)
        np.add.at(votes, (np.arange(len(labels))[:, None], labels[graph]), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(labels, graph.shape[1])), 1)
        gain = votes.max(1) - votes[np.arange(len(labels)), labels]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(np.argmax(np.where(sizes < room, votes[i], -1)))
            if votes[i, to] > votes[i, labels[i]]:
                sizes[labels[i]] -= 1
                sizes[to] += 1
                labels[i] = to
                moved += 1
        if not moved:
            break
    return labels


@dataclass
class Router:
    """Probabilities of the parts: a network with one hidden layer."""

    weights: list[np.ndarray]
    scale: float
    probes: int = 1

    def logits(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(rows / self.scale @ w1 + b1, 0) @ w2 + b2

    def part(self, rows: np.ndarray) -> np.ndarray:
        return self.logits(rows).argmax(1)

    def likely(self, rows: np.ndarray) -> np.ndarray:
        """The ``probes`` most probable parts of each row."""
        return np.argsort(-self.logits(rows), axis=1, kind="stable")[:, : self.probes]


def train_router(rows: np.ndarray, goals: np.ndarray, hidden: int = 128, epochs: int = 25, seed: int = 3) -> Router:
    """Cross entropy against where a row's neighbours are, by Adam."""
    rng, parts = np.random.default_rng(seed), goals.shape[1]
    scale = float(np.sqrt((rows**2).mean()) + 1e-12)
    x = rows / scale
    w = [rng.normal(0, math.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden)]
    w += [rng.normal(0, math.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v, step = [0 * a for a in w], [0 * a for a in w], 0
    total = epochs * math.ceil(len(x) / 256)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), 256):
            step += 1
            b, t = x[order[begin : begin + 256]], goals[order[begin : begin + 256]]
            h = np.maximum(b @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - t) / len(b)
            back = (d @ w[2].T) * (h > 0)
            rate = 0.003 * (1 - step / (total + 1))
            for i, g in enumerate((b.T @ back, back.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(w, scale)


def fit(sample: np.ndarray, parts: int, recall: float = 0.95, k: int = 10, seed: int = 3) -> Router:
    """The router of a sample, with as many probes as it takes to reach ``recall`` on rows it was not trained on.

    A quarter of the sample is left out; its rows are queries and candidates of the trial, as new rows would be.
    """
    dims = sample.shape[1] if sample.ndim == 2 else 1
    if len(sample) < 8 or parts < 2:
        return Router([np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    test, train = sample[order[: len(sample) // 4]], sample[order[len(sample) // 4 :]]
    graph = nearest(train, train, min(k, len(train) - 1), True)
    labels = balance_cut(graph, split_halves(train, parts, rng), parts)
    goals = np.zeros((len(train), parts))
    np.add.at(goals, (np.arange(len(train))[:, None], labels[graph]), 0.5 / graph.shape[1])
    goals[np.arange(len(train)), labels] += 0.5
    router = train_router(train, goals, seed=seed)
    tried = test[:1000]
    true = nearest(tried, test, min(TOP, len(test) - 1), True)
    place = np.argsort(np.argsort(-router.logits(tried), axis=1, kind="stable"), axis=1)
    depth = np.take_along_axis(place, router.part(test)[true], axis=1)
    found = np.cumsum(np.bincount(depth.ravel(), minlength=parts)) / depth.size
    router.probes = int(min(parts, np.argmax(found >= recall) + 1))
    return router


# ---- jobs -----------------------------------------------------------------------------------------------


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part: an id, the commonest dimension, finite components, not all zero."""
    kept = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    kept = kept.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(fine & some)
    sizes = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return kept.where(F.size("vec") == (sizes[0][0] if sizes else 0))


def classes(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(rep, vec, members): distinct vectors, each with its ``top`` + 1 smallest ids.

    No list of neighbours can hold more of one class. Spark keeps so many rows a vector in every task before it
    shuffles, so a vector that very many rows share is not gathered.
    """
    order = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("nth", order).where(F.col("nth") <= top + 1)
    lists = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("members"))
    return lists.select(F.get("members", F.lit(0)).alias("rep"), "vec", "members")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def search(
    rows: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    sample: int = SAMPLE,
    fineness: float = 14.0,
    block: int = 4096,
    recall: float = 0.95,
) -> DataFrame:
    """(query_id, rank, id, score): for each query, a part of ``rows``, its nearest rows by inner product.

    The query itself is no candidate; ties go to the smaller id. Rows without a usable vector take no part. The index is
    fitted on at most ``sample`` distinct vectors, in the order of a hash, which is what the driver holds; every row
    is put into a part, and a query is compared with all rows of the parts it is routed to. Parts and their queries
    are cut into blocks of bounded size, so that no task holds a whole part. Equal vectors are compared once.

    The number of parts grows with the root of the number of rows (divided by ``fineness``, 256 at most): every part
    that a query visits hands on a list of its own, and those lists must not outgrow the rows.
    """
    spark = ready(rows.sparkSession)
    fine = usable(rows, key, vector)
    distinct = cut(classes(fine, top))
    total = distinct.count()
    parts = 2 ** max(0, min(8, round(math.log2(math.sqrt(max(1, total)) / fineness))))
    taken = hashed_sample(distinct, total, sample, "rep").select("vec").collect()
    router = fit(np.array([r[0] for r in taken], np.float64), parts, recall)
    sent = spark.sparkContext.broadcast(router)
    element = fine.schema["vec"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = sent.value.part(_matrix(batch.column(1), np.float64)) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=["rep", "vec", "part"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likely = sent.value.likely(_matrix(batch.column(1), np.float64)) if len(batch) else np.zeros((0, 1), np.int64)
            at = pa.array(np.repeat(np.arange(len(likely)), likely.shape[1]))
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(likely.ravel().astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "vec", "part"])

    asked = usable(queries, key, vector).join(distinct.select("rep", "vec"), "vec").select("id", "rep")
    asked = cut(asked.withColumnRenamed("id", "query_id"))
    vectors = distinct.select("rep", "vec")
    placed = vectors.mapInArrow(place, f"rep long, vec {element}, part int")
    routed = vectors.join(asked.select("rep").distinct(), "rep", "left_semi").mapInArrow(route, f"rep long, vec {element}, part int")

    def blocks(df: DataFrame, size: int) -> tuple[DataFrame, dict[int, int]]:
        held = df.groupBy("part").count().collect()  # a number for each part, of which there are at most 256
        return df, {p: math.ceil(n / size) for p, n in held}

    placed, of_rows = blocks(placed, block)
    routed, of_queries = blocks(routed, block // 2)
    pairs = [(p, of_rows[p], of_queries[p]) for p in of_queries if p in of_rows]
    cuts = F.broadcast(spark.createDataFrame(pairs, "part int, n_rows int, n_queries int").coalesce(1))
    hashed = F.xxhash64("rep")
    left = placed.join(cuts, "part").select(
        "part", F.pmod(hashed, "n_rows").alias("row_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_queries") - F.lit(1).cast("long"))).alias("query_block"), "rep", "vec"
    )
    right = routed.join(cuts, "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - F.lit(1).cast("long"))).alias("row_block"), F.pmod(hashed, "n_queries").alias("query_block"), "rep", "vec"
    )
    keep = top + 1

    def compare(own: pa.Table, asking: pa.Table) -> pa.Table:
        names = ["asking", "rep", "score"]
        if not len(own) or not len(asking):
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())], names=names)
        ids = own.column("rep").to_numpy()
        order = np.argsort(ids)
        ids, rows_ = ids[order], _matrix(own.column("vec").combine_chunks(), np.float64)[order]
        who, points = asking.column("rep").to_numpy(), _matrix(asking.column("vec").combine_chunks(), np.float64)
        out = []
        for begin in range(0, len(who), 256):
            dots = points[begin : begin + 256] @ rows_.T
            k = min(keep, len(ids))
            # All that reach the k-th best score, and of equal scores the smaller ids: ids are in order.
            bar = -np.partition(-dots, k - 1, axis=1)[:, k - 1]
            for i, row in enumerate(dots):
                at = np.flatnonzero(row >= bar[i])
                at = at[np.argsort(-row[at], kind="stable")[:k]]
                out.append((np.full(len(at), who[begin + i]), ids[at], row[at]))
        return pa.table([np.concatenate(x) for x in zip(*out)], names=names)

    keys = ["part", "row_block", "query_block"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "asking long, rep long, score double")
    best = Window.partitionBy("asking").orderBy(F.desc("score"), "rep")
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep).drop("nth")
    full = near.join(distinct.select("rep", "members"), "rep").select("asking", "score", F.explode("members").alias("id"))
    lists = full.groupBy("asking").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "id"))).alias("near"))
    answer = asked.join(lists, asked.rep == lists.asking).select(
        "query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, top).alias("near")
    )
    return answer.select("query_id", F.posexplode("near").alias("nth", "x")).select(
        "query_id", (F.col("nth") + 1).alias("rank"), F.col("x.id").alias(key), (-F.col("x.less")).alias("score")
    )
