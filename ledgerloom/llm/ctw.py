"""Language-model scores by context-tree weighting over bytes, beside a smoothed unigram score of words.

A byte is eight binary decisions, each in the context of the bytes before it. At every node of the context tree (some
bytes of context, and the bits of the byte so far) a Krichevsky-Trofimov estimate is mixed with what deeper contexts
say (Willems, Shtarkov and Tjalkens, 1995). Trees are trained on whole corpora, once, and then predict as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bucket, cut, texts

DEPTH = 4
#: The scores of grams with this share of all bytes are sent to where the texts are; there are at most 1 / SHARE. Other
#: grams are joined to their scores: the share decides where a gram is looked up, never what its score is.
SHARE = 2.0**-21
#: Words with this share of the training tokens are scored where the text is; there are at most 1 / FREQUENT.
FREQUENT = 2e-6
END = ""  # the end token; no word is empty
GRAM = " "  # stands for the word of a row that has a gram; no word has white space
#: A worker takes this many bytes of text, and about this many grams with the subtrees below them, at a time.
CHUNK = 1 << 19
STRETCH = 1 << 17
_CACHE_BITS = 20


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def contexts(batch: list[bytes], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, owners) of texts, in stretches of bounded size.

    A gram is the ``depth`` bytes before a position, the nearest first, and then its byte, as one number. Before a
    text stand zero bytes. owners are the texts' places in the batch.
    """
    held: list[np.ndarray] = []
    owner: list[tuple[int, int]] = []
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(held).astype(np.uint64)
        grams = flat.copy()
        for d in range(1, depth + 1):  # the d-th byte before, into its place above the byte
            grams[d:] |= flat[:-d] << np.uint64(8 * (depth - d + 1))
        who = np.repeat([i for i, _ in owner], [n for _, n in owner])
        real = np.concatenate([np.arange(n) >= depth for _, n in owner])
        return grams[real], who[real]

    for i, raw in enumerate(batch):
        data = np.concatenate([np.zeros(depth, np.uint8), np.frombuffer(raw, np.uint8)])
        for begin in range(depth, len(data), CHUNK):
            part = data[begin - depth : begin + CHUNK]
            held.append(part)
            owner.append((i, len(part)))
            size += len(part)
            if size >= CHUNK:
                yield flush()
                held, owner, size = [], [], 0
    if held:
        yield flush()


# ---- counting -----------------------------------------------------------------------------------------


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(word, gram, n): how often each word, or else each gram, occurs; every text counts whole, with one end token.

    A task adds up what it reads before anything is shuffled and lets go when it holds too much.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        grams, many = [], 0

        def rows(word: list, gram: np.ndarray | None, n) -> pa.RecordBatch:
            size = len(n)
            left = pa.array(word, pa.string()) if gram is None else pa.nulls(size, pa.string())
            right = pa.nulls(size, pa.int64()) if gram is None else pa.array(gram.view(np.int64))
            return pa.RecordBatch.from_arrays([left, right, pa.array(n, pa.int64())], names=["word", "gram", "n"])

        def give_words() -> Iterator[pa.RecordBatch]:
            items = list(words.items())
            words.clear()
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                yield rows([w.decode("utf-8", "replace") for w, _ in part], None, [n for _, n in part])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every, n = (np.concatenate(x) for x in zip(*grams))
            unique, at = np.unique(every, return_inverse=True)
            return unique, np.bincount(at, weights=n, minlength=len(unique)).astype(np.int64)

        def give_grams() -> Iterator[pa.RecordBatch]:
            unique, n = merged()
            for i in range(0, len(unique), 200_000):
                yield rows([], unique[i : i + 200_000], n[i : i + 200_000])

        for batch in batches:
            raw = [lowered(t) for t in batch.column(1).to_pylist()]
            for r in raw:
                words.update(r.split())
                if len(words) > 200_000:
                    yield from give_words()
            words[b""] += len(raw)
            for part, _ in contexts(raw, depth):
                unique, n = np.unique(part, return_counts=True)
                grams.append((unique, n))
                many += len(unique)
                if many > 2_000_000:
                    grams = [merged()]
                    many = len(grams[0][0])
                    if many > 1_500_000:
                        yield from give_grams()
                        grams, many = [], 0
        if words:
            yield from give_words()
        if grams:
            yield from give_grams()

    parts = texts(docs, key, text).mapInArrow(run, "word string, gram long, n long")
    return parts.groupBy("word", "gram").agg(F.sum("n").alias("n"))


# ---- the tree -----------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, brought back; good to 1e-12 for x > 0."""
    low = np.zeros_like(x)
    for i in range(8):
        low += np.log(x + i)
    y = x + 8
    tail = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - low


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - math.log(math.pi) - _log_gamma(n0 + n1 + 1.0)


def binary_nodes(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones) of sorted (context, byte) counts: a node is a context and the bits so far after a 1."""
    out = []
    byte, high = keys & np.uint64(255), keys & ~np.uint64(255)
    for j in range(8):
        node = high | ((np.uint64(256) | byte) >> np.uint64(8 - j))
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        bit = ((byte >> np.uint64(7 - j)) & np.uint64(1)).astype(np.float64)
        all_, ones = np.add.reduceat(n, first), np.add.reduceat(n * bit, first)
        out.append((node[first], all_ - ones, ones))
    node, n0, n1 = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(node)
    return node[order], n0[order], n1[order]


def mix(log_own: np.ndarray, log_deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the weighted probability, share of the node's own estimate in it)."""
    both = np.logaddexp(log_own, log_deeper)
    return both - math.log(2), np.exp(log_own - both)


def subtrees(grams: np.ndarray, n: np.ndarray, depth: int, top: int):
    """For depths from ``depth`` up to ``top``: (depth, node, zeros, ones, log weighted probability, own share)."""
    order = np.argsort(grams)
    keys, n = grams[order], n[order].astype(np.float64)
    below = None
    for d in range(depth, top - 1, -1):
        if d < depth:  # drop the farthest byte of the context
            keys = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
            keys, at = np.unique(keys, return_inverse=True)
            n = np.bincount(at, weights=n, minlength=len(keys))
        node, n0, n1 = binary_nodes(keys, n)
        own = log_kt(n0, n1)
        if below is None:
            weighted, share = own, np.ones(len(own))
        else:
            parent = ((below[0] >> np.uint64(16)) << np.uint64(8)) | (below[0] & np.uint64(255))
            deeper = np.bincount(np.searchsorted(node, parent), weights=below[1], minlength=len(node))
            weighted, share = mix(own, deeper)
        below = (node, weighted)
        yield d, node, n0, n1, weighted, share


def whole_subtrees(
    grams: np.ndarray, depth: int, top: int, *values: np.ndarray, most: int | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Grams and their values in stretches of ``most`` or more, each with all grams that share their ``top`` nearest bytes."""
    most = STRETCH if most is None else most
    order = np.argsort(grams)
    grams = grams[order]
    root = grams >> np.uint64(8 * (depth - top) + 8)
    begins = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
    del root
    begin = 0
    for end in [*begins[1:].tolist(), len(grams)]:
        if end - begin >= most or end == len(grams):
            yield grams[begin:end], *(v[order[begin:end]] for v in values)
            begin = end


class Cached:
    """Keeps what this worker has looked up by ``log10_of`` in a table of fixed size."""

    cache: tuple[np.ndarray, np.ndarray] | None = None

    def log10_of(self, grams: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def cached(self, grams: np.ndarray) -> np.ndarray:
        """As ``log10_of``."""
        if self.cache is None:
            self.cache = (np.full(1 << _CACHE_BITS, 2**64 - 1, np.uint64), np.zeros(1 << _CACHE_BITS))
        keys, values = self.cache
        slot = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        out = values[slot]
        missing = np.flatnonzero(keys[slot] != grams)
        if len(missing):
            unique, at = np.unique(grams[missing], return_inverse=True)
            known = self.log10_of(unique)
            out[missing] = known[at]
            where = slot[missing]
            keys[where], values[where] = grams[missing], known[at]
        return out


@dataclass
class Table(Cached):
    """Scores of some grams, sorted."""

    grams: np.ndarray
    scores: np.ndarray

    def log10_of(self, grams: np.ndarray) -> np.ndarray:
        """The grams' scores; NaN for those not in the table."""
        if not len(self.grams):
            return np.full(len(grams), np.nan)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.scores[at], np.nan)


@dataclass
class Tree(Cached):
    """Estimates of a one and own shares by depth: sorted node keys, and their values."""

    depth: int
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def log10_of(self, grams: np.ndarray) -> np.ndarray:
        """Log10 of the probability of each gram's byte after its context."""
        byte, total = grams & np.uint64(255), np.zeros(len(grams))
        for j in range(8):
            so_far = (np.uint64(256) | byte) >> np.uint64(8 - j)
            alive, found = np.arange(len(grams)), []
            for d in range(self.depth + 1):
                nodes, ones, share = self.levels[d]
                key = ((grams[alive] >> np.uint64(8 * (self.depth - d + 1))) << np.uint64(8)) | so_far[alive]
                at = np.minimum(np.searchsorted(nodes, key), max(0, len(nodes) - 1))
                hit = nodes[at] == key if len(nodes) else np.zeros(len(key), bool)
                alive, at = alive[hit], at[hit]
                found.append((alive, ones[at], share[at]))
                if not len(alive):
                    break
            p, deepest = np.full(len(grams), 0.5), np.ones(len(grams), bool)
            for alive, ones, share in reversed(found):  # from the deepest known node upwards
                own = np.where(deepest[alive], 1.0, share)
                p[alive] = own * ones + (1 - own) * p[alive]
                deepest[alive] = False
            bit = ((byte >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            total += np.log10(np.where(bit, p, 1 - p))
        return total


def level(node: np.ndarray, n0: np.ndarray, n1: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(node)
    ones = (n1 + 0.5) / (n0 + n1 + 1)
    return node[order].astype(np.uint64), ones[order].astype(np.float32), own[order].astype(np.float32)


def train_tree(counted: DataFrame, depth: int = DEPTH, share: float = 2.0) -> Tree:
    """The tree of all gram counts, with the nodes deeper than one byte that ``share`` of all bytes passes.

    By default none are kept: ``gram_scores`` makes them where the grams are. With 0 all are, on the driver. Subtrees under two bytes of context are computed where their counts are; their number of grams is bounded by the
    bytes that can stand in a gram. The two levels above are sums over at most 65,536 nodes, which the driver finishes.
    """
    width = 8 * depth + 8
    top = min(2, depth)
    grams = counted.where("gram IS NOT NULL").select("gram", "n")
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = total * share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not sum(len(g) for g, _ in every):
            return
        keys, n = (np.concatenate(x) for x in zip(*every))
        del every
        for part, uses in whole_subtrees(keys.astype(np.uint64), depth, top, n):
            for d, node, n0, n1, weighted, own in subtrees(part, uses, depth, top):
                keep = np.ones(len(node), bool) if d == top else n0 + n1 >= least
                columns = [np.full(keep.sum(), d, np.int32), node[keep].astype(np.int64)]
                columns += [x[keep] for x in (n0, n1, weighted, own)]
                for i in range(0, len(columns[0]), 200_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[i : i + 200_000]) for c in columns], names=["depth", "node", "n0", "n1", "weighted", "own"]
                    )

    by = F.shiftrightunsigned("gram", width - 8 * top)
    nodes = cut(
        grams.repartition(by).mapInArrow(run, "depth int, node long, n0 double, n1 double, weighted double, own double")
    )

    def arrays(df: DataFrame, names: tuple[str, ...]) -> list[np.ndarray]:
        table = df.select(*names).toArrow()
        return [table.column(c).to_numpy() for c in names]

    levels: list = [None] * (depth + 1)
    kept = nodes.where(F.col("n0") + F.col("n1") >= least)
    for d in range(top, depth + 1):
        levels[d] = level(*arrays(kept.where(F.col("depth") == d), ("node", "n0", "n1", "own")))
    above = nodes.where(F.col("depth") == top)
    one = F.shiftrightunsigned("node", 16) * 256 + F.col("node").bitwiseAND(255)
    above = above.groupBy(one.alias("node")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("weighted")
    )
    node, n0, n1, deeper = arrays(above, ("node", "n0", "n1", "weighted"))
    for d in range(top - 1, -1, -1):
        weighted, own = mix(log_kt(n0, n1), deeper)
        levels[d] = level(node, n0, n1, own)
        parent = ((node >> 16) << 8) | (node & 255)
        node, at = np.unique(parent, return_inverse=True)
        n0, n1, deeper = (np.bincount(at, weights=x, minlength=len(node)) for x in (n0, n1, weighted))
    return Tree(depth, levels)


def gram_scores(grams: DataFrame, tree: Tree) -> DataFrame:
    """(gram, uses, score) of all ``grams`` (gram, n, uses): what the whole tree says of each, also of those with n = 0.

    ``tree`` has the nodes of up to one byte of context. All deeper nodes on a gram's path belong to the subtree of its
    two nearest bytes, so they are made where the grams with these bytes are, and none is dropped.
    """
    depth, top = tree.depth, min(2, tree.depth)
    sent = grams.sparkSession.sparkContext.broadcast(tree.levels[:top])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [[b.column(i).to_numpy() for i in range(3)] for b in batches]
        if not sum(len(g) for g, _, _ in every):
            return
        every = [np.concatenate(x) for x in zip(*every)]
        for keys, n, uses in whole_subtrees(every[0].astype(np.uint64), depth, top, *every[1:]):
            trained = n > 0
            deeper = [level(*(np.zeros(0) for _ in range(4))) for _ in range(top, depth + 1)]
            if trained.any():
                for d, node, n0, n1, _, own in subtrees(keys[trained], n[trained], depth, top):
                    deeper[d - top] = level(node, n0, n1, own)
            whole = Tree(depth, [*sent.value, *deeper])
            for i in range(0, len(keys), STRETCH):
                part = keys[i : i + STRETCH]
                columns = [pa.array(part.view(np.int64)), pa.array(uses[i : i + STRETCH]), pa.array(whole.log10_of(part))]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "uses", "score"])

    by = F.shiftrightunsigned("gram", 8 * depth + 8 - 8 * top)
    return grams.select("gram", "n", "uses").repartition(by).mapInArrow(run, "gram long, uses long, score double")


# ---- scores -------------------------------------------------------------------------------------------


def held_out(key: str = "doc_id"):
    return bucket(key, 10) == 0


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    ``score`` is the tree's log10 probability of the lower-cased text, bits_per_byte its code length (0 for the empty
    text); null is the empty text. With nothing to learn from, every word is unknown and every bit even.

    Frequent words and grams are looked up where the text is. Rare ones are joined to their counts and scores, a row
    for each word and gram of each text; what they add is summed by key and text, so repeated rows share a sum, which
    the number of end tokens among them divides.
    """
    spark = docs.sparkSession
    counted = cut(counts(docs.where(~held_out(key)), key, text, depth))
    unseen = counts(docs.where(held_out(key)), key, text, depth).where("gram IS NOT NULL")
    asked = counted.where("gram IS NOT NULL").select("gram", "n", F.col("n").alias("uses"))
    asked = asked.unionByName(unseen.select("gram", F.lit(0).cast("long").alias("n"), F.col("n").alias("uses")))
    asked = asked.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))
    scored = cut(gram_scores(asked, train_tree(counted, depth)))
    least = (scored.agg(F.sum("uses")).first()[0] or 0) * SHARE
    table = scored.where(F.col("uses") >= least).select("gram", "score").toArrow()
    table = [table.column(i).to_numpy() for i in range(2)]
    order = np.argsort(table[0].astype(np.uint64))
    table_sent = spark.sparkContext.broadcast(Table(table[0].astype(np.uint64)[order], table[1][order]))
    vocabulary = counted.where("word IS NOT NULL").select("word", F.col("n").alias("c"))
    known, distinct = vocabulary.agg(F.sum("c"), F.count("*")).first()
    known = known or 0
    frequent = vocabulary.where((F.col("c") >= max(1.0, known * FREQUENT)) | (F.col("word") == END))
    frequent = {w.encode(): c for w, c in frequent.collect()}
    frequent_sent = spark.sparkContext.broadcast(frequent)
    scale = math.log10(known + 0.1 * (distinct + 1))
    kind = docs.schema[key].dataType.simpleString()
    rows = texts(docs, key, text).withColumn("hash", F.xxhash64(text))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, with what is known here, and one for each of its other words and grams."""
        common, model = frequent_sent.value, table_sent.value
        for batch in batches:
            raw = [lowered(t) for t in batch.column(1).to_pylist()]
            score = np.zeros(len(raw))
            for grams, owner in contexts(raw, depth):
                found = model.cached(grams)
                missing = np.isnan(found)
                score += np.bincount(owner, weights=np.where(missing, 0.0, found), minlength=len(raw))
                if missing.any():
                    order = np.lexsort((grams[missing], owner[missing]))
                    gram, who = grams[missing][order], owner[missing][order]
                    first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (who[1:] != who[:-1])]))
                    uses = np.diff(np.append(first, len(gram)))
                    for i in range(0, len(first), 200_000):
                        at = first[i : i + 200_000]
                        yield give(batch, who[at], [GRAM] * len(at), gram[at].view(np.int64), uses[i : i + 200_000])
            owner, word, uses, seen, base = [], [], [], [], []
            for i, r in enumerate(raw):
                own = Counter(r.split())
                hits = [(n, common[w]) for w, n in own.items() if w in common]
                hits += [(1, common[b""])] if b"" in common else []
                seen.append(sum(n for n, _ in hits))
                base.append(math.fsum(n * math.log10(c + 0.1) for n, c in hits))
                rare = [(w, n) for w, n in own.items() if w not in common]
                owner += [i] * len(rare)
                word += [w.decode("utf-8", "replace") for w, _ in rare]
                uses += [n for _, n in rare]
                if len(word) > 200_000:
                    yield give(batch, owner, word, np.zeros(len(word), np.int64), uses)
                    owner, word, uses = [], [], []
            yield give(batch, owner, word, np.zeros(len(word), np.int64), uses)
            # The end tokens have one word; their grams only spread them over the tasks of the join.
            ends, spread = [END] * len(raw), batch.column(2).to_numpy()
            yield give(batch, range(len(raw)), ends, spread, [int(b"" not in common)] * len(raw), seen, base, score)

    def give(batch: pa.RecordBatch, owner, word, gram, uses, *near) -> pa.RecordBatch:
        at = pa.array(owner, pa.int64())
        columns = [batch.column(0).take(at), batch.column(2).take(at), pa.array(word, pa.string()), pa.array(gram, pa.int64()), pa.array(uses, pa.int64())]
        kinds = {"seen": pa.int64(), "base": pa.float64(), "score": pa.float64()}
        columns += [pa.array(x, k) for x, k in zip(near, kinds.values())] or [pa.nulls(len(at), k) for k in kinds.values()]
        return pa.RecordBatch.from_arrays(columns, names=[key, "hash", "word", "gram", "uses", *kinds])

    at_once = rows.mapInArrow(
        look_up, f"{key} {kind}, hash long, word string, gram long, uses long, seen long, base double, score double"
    )
    zero = F.lit(0).cast("long")
    there = vocabulary.select("word", zero.alias("gram"), "c", F.lit(None).cast("double").alias("found"))
    rest = scored.where(F.col("uses") < least)
    there = there.unionByName(rest.select(F.lit(GRAM).alias("word"), "gram", zero.alias("c"), F.col("score").alias("found")))
    is_word = F.col("word") != GRAM
    hit = is_word & F.col("c").isNotNull()
    sums = at_once.join(there, ["word", "gram"], "left").groupBy(key, "hash").agg(
        F.sum(F.when(hit, F.col("uses")).otherwise(0)).alias("far_seen"),
        F.sum(F.when(hit, F.col("uses") * F.log10(F.col("c") + 0.1)).otherwise(0.0)).alias("far_base"),
        F.sum(F.when(is_word, F.col("uses")).otherwise(0)).alias("far_all"),
        F.sum(F.when(is_word, 0.0).otherwise(F.col("uses") * F.col("found"))).alias("far_score"),
        F.sum("seen").alias("seen"),
        F.sum("base").alias("base"),
        F.sum("score").alias("near_score"),
        F.sum(F.when(F.col("word") == END, 1).otherwise(0)).alias("copies"),
    )
    sums = sums.withColumnRenamed(key, "_key").withColumnRenamed("hash", "_hash")
    each = rows.select(key, "hash", F.octet_length(text).alias("n_bytes"))
    joined = each.join(sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("hash") == F.col("_hash")))
    joined = joined.withColumns({
        "n_tokens": ((F.col("seen") + F.col("far_all")) / F.col("copies")).cast("long"),
        "score": (F.col("near_score") + F.col("far_score")) / F.col("copies"),
    })
    unknown = (F.col("far_all") - F.col("far_seen")) / F.col("copies")
    base = (F.col("base") + F.col("far_base")) / F.col("copies") - unknown - F.col("n_tokens") * scale
    return joined.select(
        key,
        held_out(key).alias("held_out"),
        "n_tokens",
        ((F.col("seen") + F.col("far_seen")) / F.col("copies")).cast("long").alias("n_known"),
        F.lit(known).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / math.log10(2) / F.col("n_bytes")).otherwise(0.0).alias("bits_per_byte"),
    )
