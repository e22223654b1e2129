"""SimHash near-duplicates: fingerprints, links within a Hamming radius by BK-trees, and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, cut, texts

SEED = 42
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, width: int = 3) -> int:
    """Majority bits of the XXH64 of a text's word shingles; 0 without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, stops[width - 1 :])]
    lanes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    value = 0
    for lane in range(8):
        ones = np.bincount(lanes[:, lane], minlength=256) @ BITS_OF_BYTE
        value |= int(np.packbits(ones * 2 > n, bitorder="little")[0]) << (8 * lane)
    return value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, with_hash: bool = False) -> DataFrame:
    """(key, fp[, _text_hash]): the fingerprint as a signed long. Empty and null texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), pa.array(values.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "fp", "_text_hash"][: len(columns)])

    kind = docs.schema[key].dataType.simpleString()
    rows = texts(docs, key, text)
    if with_hash:
        return rows.withColumn("_text_hash", F.xxhash64(text)).mapInArrow(run, f"{key} {kind}, fp long, _text_hash long")
    return rows.mapInArrow(run, f"{key} {kind}, fp long")


class BKTree:
    """Children are keyed by their Hamming distance to the parent; a search follows edges within the radius only."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        new = len(self.codes)
        self.codes.append(code)
        self.children.append({})
        at = 0
        while new:
            d = (self.codes[at] ^ code).bit_count()
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = new
                return
            at = nxt

    def within(self, code: int, radius: int) -> Iterator[int]:
        """Positions of all codes at most ``radius`` away."""
        todo = [0] if self.codes else []
        while todo:
            at = todo.pop()
            d = (self.codes[at] ^ code).bit_count()
            if d <= radius:
                yield at
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)


def shard_links(codes: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning star of each group of codes that the radius connects: at most one link a code, never all pairs."""
    if len(codes) == 2:
        if (codes[0] ^ codes[1]).bit_count() <= radius:
            yield codes[1], codes[0]
        return
    tree, root = BKTree(), list(range(len(codes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, code in enumerate(codes):
        for j in tree.within(code, radius):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
        tree.add(code)
    for i, code in enumerate(codes):
        if (r := find(i)) != i:
            yield code, codes[r]


def masks(bits: int, radius: int, taken: int = 0) -> list[int]:
    """Bit masks of ``radius`` + 1 even blocks of the bits that are not taken."""
    free = [b for b in range(bits) if not taken >> b & 1]
    edges = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [sum(1 << b for b in free[lo:hi]) for lo, hi in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(codes: DataFrame, radius: int = 3, bits: int = 64, max_shard: int = 4096, levels: int = 3) -> DataFrame:
    """(a, b): links among the distinct codes ``fp``; their components are those of all pairs within the radius.

    Codes at most ``radius`` bits apart agree in one of ``radius`` + 1 blocks of bits, so each value of each block is
    a shard with a tree of its own. A shard of more than ``max_shard`` codes is split by the blocks of the bits that
    it does not share, which loses no link, up to ``levels`` deep. The trees are sent to where their shard's codes
    are: their number grows with the data, so none is broadcast.
    """
    key = ["shard", "value"]

    def spread(df: DataFrame, chosen: dict[int, int], nxt: dict[int, int]) -> DataFrame:
        """Each code once for each block that its shard leaves; ``chosen``: the bits a shard fixes."""
        rows = []
        for shard, taken in chosen.items():
            for j, mask in enumerate(masks(bits, radius, taken)):
                new = shard * (radius + 1) + j + 1
                nxt[new] = taken | mask
                value = F.col("fp").bitwiseAND(F.lit(_signed(taken | mask)))
                rows.append((shard, F.struct(F.lit(new).alias("shard"), value.alias("value"))))
        by_shard: dict[int, list] = {}
        for shard, row in rows:
            by_shard.setdefault(shard, []).append(row)
        options = F.array(*by_shard[0]) if 0 in by_shard else None
        if options is None:
            for shard, own in by_shard.items():
                hit = F.col("shard") == shard
                options = F.when(hit, F.array(*own)) if options is None else options.when(hit, F.array(*own))
        return df.select("fp", F.explode(options).alias("s")).select("fp", "s.*")

    done: list[DataFrame] = []
    chosen: dict[int, int] = {}
    rows = spread(codes.select("fp"), {0: 0}, chosen)
    for level in range(1, levels + 1):
        large = rows.groupBy(key).count().where(F.col("count") > max_shard).select(key) if level < levels else None
        large = cut(large) if large is not None else None
        if large is None or large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, key, "left_anti"))
        deeper: dict[int, int] = {}
        rows = spread(rows.join(large, key, "left_semi"), chosen, deeper)
        chosen = deeper
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    ordered = every.repartition(*key).sortWithinPartitions(*key, "fp").select(*key, "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        found: list[tuple[int, int]] = []

        def batch_of() -> pa.RecordBatch:
            out = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

        for batch in batches:
            shard, value, code = (batch.column(i).to_pylist() for i in range(3))
            for now in zip(shard, value, code):
                if now[:2] != at:
                    if len(held) > 1:
                        found.extend(shard_links(held, radius))
                    at, held = now[:2], []
                held.append(now[2] & (2**64 - 1))
            if len(found) > 50_000:
                yield batch_of()
        if len(held) > 1:
            found.extend(shard_links(held, radius))
        yield batch_of()

    return ordered.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3) -> DataFrame:
    """(key, fp, component_id): every row with the smallest key it reaches over links of at most ``radius`` bits.

    Rows with one fingerprint are one node; empty and null texts share fingerprint 0. Repeated rows stay repeated.
    Rows with a null key are kept, in a component by the other rows' keys; alone, their component is null.
    """
    return _classes(cut(fingerprints(docs, key, text)), key, radius).select(key, "fp", "component_id")


def _classes(prints: DataFrame, key: str, radius: int) -> DataFrame:
    nodes = prints.groupBy("fp").agg(F.min(key).alias("rep"))
    nodes = cut(nodes)
    reps_a = nodes.select(F.col("fp").alias("a"), F.col("rep").alias("rep_a"))
    reps_b = nodes.select(F.col("fp").alias("b"), F.col("rep").alias("rep_b"))
    near = links(nodes, radius).distinct().join(reps_a, "a").join(reps_b, "b")
    near = near.where("rep_a IS NOT NULL AND rep_b IS NOT NULL").select("rep_a", "rep_b")
    found = components(near, "rep_a", "rep_b")
    classes = nodes.join(found, nodes.rep == found.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    # One row a fingerprint on the right; adaptive execution splits a fingerprint with very many rows on the left.
    return prints.join(classes, "fp", "left")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3) -> DataFrame:
    """One document of each component, that with the smallest key; the columns are those of ``docs``.

    Rows are named by their key and a hash of their text. Of rows of one component that share the smallest key one
    stays, that with the smallest hash; rows that repeat a key in another component stay there. Rows with a null key
    stay: nothing names them. What goes is joined away, not what stays: that list is the shorter one, and where
    adaptive execution finds it small the texts are not shuffled.
    """
    name = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    named = docs.withColumn("_text_hash", name)
    prints = fingerprints(docs, key, text, with_hash=True)
    rows = cut(_classes(cut(prints), key, radius).where(F.col(key).isNotNull()))
    at = [F.col(key), F.col("component_id")]
    order = Window.partitionBy(*at).orderBy("_text_hash")
    chosen = rows.where(F.col(key) == F.col("component_id")).select(key, "component_id", "_text_hash").distinct()
    later = chosen.withColumn("nth", F.row_number().over(order)).where("nth > 1").select(key, "_text_hash")
    gone = rows.where(F.col(key) != F.col("component_id")).select(key, "_text_hash").distinct().unionByName(later)
    again = rows.groupBy(key, "_text_hash").count().where("count > 1").select(key, "_text_hash")
    left = named.join(gone, [key, "_text_hash"], "left_anti")
    repeated = left.join(again, [key, "_text_hash"], "left_semi").dropDuplicates([key, "_text_hash"])
    return left.join(again, [key, "_text_hash"], "left_anti").unionByName(repeated).select(docs.columns)
