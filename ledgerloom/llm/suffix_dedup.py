"""Repeated passages: every byte that lies in a string of a given length which also starts somewhere else.

Suffixes are compared where they can matter only. Each string of ``length`` bytes names one of its own positions, an
anchor, by its content alone: where the hash of the next ``gram`` bytes is least. So equal strings meet in the group of
their anchor's gram. A group's suffixes are sorted, and a scan of their common prefixes with a stack visits the
common-prefix interval tree; in each interval the texts to the left of its members decide how far a repeat reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import texts

LENGTH, GRAM = 400, 64
MAX_GROUP = 50_000
CHUNK = 1 << 20
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each position, built by doubling; ``width`` need not be a power of two."""
    power, size = _BASE, 1
    part = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    out, done = None, 0
    while True:
        if width & size:
            if out is None:
                out = part
            else:  # what is there so far, then this stretch
                n = len(data) - done - size + 1
                out = out[:n] * np.uint64(power) + part[done : done + n]
            done += size
        if size * 2 > width:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        power, size = power * power % 2**64, size * 2
    out = (out ^ (out >> np.uint64(31))) * _MIX
    return out ^ (out >> np.uint64(29))


def anchors_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of the string that starts at each position, hash of the gram at each position)."""
    hashes = _hashes(data, gram)
    window = length - gram + 1
    at = np.arange(len(hashes), dtype=np.int32)
    size = 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] < hashes[a], b, a)  # of equal ones the left

    while size * 2 <= window:
        at = lower(at[:-size], at[size:])
        size *= 2
    rest = window - size
    return (lower(at[: len(at) - rest], at[rest:]) if rest else at), hashes


def stretches(batch: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, owner, start) of several texts at once, or of part of a long one; parts overlap by length - 1 bytes.

    owner and start say of each string's first byte which text it is in and where; -1 where a string would cross texts.
    """
    held, own, at, size = [], [], [], 0
    for i, raw in enumerate(batch):
        if len(raw) < length:
            continue
        data = np.frombuffer(raw, np.uint8)
        for begin in range(0, len(data) - length + 1, CHUNK):
            part = data[begin : begin + CHUNK + length - 1]
            n = len(part) - length + 1
            held.append(part)
            own.append(np.concatenate([np.full(n, i), np.full(length - 1, -1)]))
            at.append(np.arange(begin, begin + len(part)))
            size += len(part)
            if size >= CHUNK:
                yield tuple(map(np.concatenate, (held, own, at)))
                held, own, at, size = [], [], [], 0
    if held:
        yield tuple(map(np.concatenate, (held, own, at)))


def anchor_rows(batch: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(owner, gram hash, anchor, most, least): the anchors of each text.

    The strings that an anchor stands for start from ``most`` to ``least`` bytes before it, one next to the other.
    """
    for data, owner, start in stretches(batch, length):
        at, hashes = anchors_of(data, length, gram)
        owner, start = owner[: len(at)], start[: len(at)]
        valid = owner >= 0
        shift = at - np.arange(len(at), dtype=np.int32)
        owner, start, shift, key = owner[valid], start[valid], shift[valid], hashes[at[valid]]
        anchor = start + shift
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0) | (np.diff(start, prepend=-9) != 1))
        last = np.concatenate([new[1:], [len(anchor)]]) - 1
        yield owner[new], key[new], anchor[new], shift[new], shift[last]


# ---- the tree of one group ----------------------------------------------------------------------------


def _padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts])
    width = max(1, int(sizes.max()))
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width), sizes


def common(parts: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each two neighbours."""
    rows, sizes = _padded(parts)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


class _Least:
    """Least value of any stretch of an array, by doubling."""

    def __init__(self, values: np.ndarray) -> None:
        self.tables = [values]
        while (step := 1 << (len(self.tables) - 1)) * 2 <= len(values):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-step], last[step:]))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = np.frexp(end - begin)[1] - 1
        out = np.empty(len(begin), np.int64)
        for k in np.unique(level):
            own = level == k
            table = self.tables[k]
            out[own] = np.minimum(table[begin[own]], table[end[own] - (1 << int(k))])
        return out


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of each interval of the tree with a prefix of ``least`` or more, children first."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp.tolist(), -1]):
        begin = i
        while stack and stack[-1][0] > value:
            prefix, begin = stack.pop()
            yield prefix, begin, i
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def repeats(contexts: list[bytes], lefts: list[int], length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(right, left diversity, members, left reach): the repeat groups of one anchor's distinct contexts.

    ``lefts`` is where the anchor stands in each context. Members of an interval share ``right`` bytes from the anchor
    on; a member's left reach is the longest text before the anchor that it shares with another member. Only members
    whose two sides add up to ``length`` are given. The diversity is how many of the interval's members do not go on
    to the left like their neighbour: with 0 the whole group is part of one that starts further left.
    """
    rights = [c[k:] for c, k in zip(contexts, lefts)]
    before = [c[:k][::-1] for c, k in zip(contexts, lefts)]
    order = sorted(range(len(contexts)), key=rights.__getitem__)
    left_order = sorted(range(len(contexts)), key=before.__getitem__)
    rank = np.empty(len(contexts), np.int64)
    rank[left_order] = np.arange(len(contexts))
    shared = _Least(common([before[i] for i in left_order]))
    longest = int(shared.tables[0].max())
    by_right, at_rank = np.array(order), np.array(left_order)
    for right, first, last in intervals(common([rights[i] for i in order]), max(1, length - longest)):
        ranks = np.sort(rank[by_right[first : last + 1]])
        near = shared.of(ranks[:-1], ranks[1:])
        reach = np.maximum(np.append(near, 0), np.append(0, near))
        enough = reach + right >= length
        if enough.any():
            members = at_rank[ranks]
            sizes = np.array([lefts[i] for i in members])
            diverse = int((near < np.minimum(sizes[1:], sizes[:-1])).sum())
            yield right, diverse, members[enough], reach[enough]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def covered(contexts: list[bytes], lefts: list[int], uses: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each distinct context the spans, from the anchor, that repeats of ``length`` or more bytes cover."""
    spans: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for i, n in enumerate(uses):
        if n > 1:
            spans[i].append((-lefts[i], len(contexts[i]) - lefts[i]))
    if len(contexts) > 1:
        for right, _, members, reach in repeats(contexts, lefts, length):
            for i, left in zip(members.tolist(), reach.tolist()):
                spans[i].append((-left, right))
    return [merged(s) for s in spans]


# ---- jobs ---------------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with two hashes of key and text that together name them, also where keys repeat or are null."""
    rows = texts(docs, key, text)
    return rows.select(
        F.xxhash64(key, text).alias("k1"), F.xxhash64(text, F.lit("|"), key).alias("k2"), F.col(key).alias("_key"), F.col(text).alias("_text")
    )


def contexts_of(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, anchor, gram, n, context, left, context_hash) of every anchor whose gram has another occurrence.

    n is the number of anchors with that gram. The context is all that the anchor's strings cover.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            for owner, key, anchor, most, least in anchor_rows(raw, length, gram):
                at = pa.array(owner)
                packed = (anchor.astype(np.int64) << 20) | (most.astype(np.int64) << 10) | least
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(key.view(np.int64)), pa.array(packed)]
                yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "gram", "place"])

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "anchor", "gram", "n", "context", "left"]
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, text, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode("utf-8", "surrogatepass")
                for f in found:
                    anchor, most, least = f["place"] >> 20, f["place"] >> 10 & 1023, f["place"] & 1023
                    out.append((k1, k2, anchor, f["gram"], f["n"], raw[anchor - most : anchor - least + length], most))
                if len(out) > 8000:
                    yield _batch(out, names)
                    out = []
            yield _batch(out, names)

    def _batch(out: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int32()]
        columns = zip(*out) if out else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    anchors = rows.select("k1", "k2", "_text").mapInArrow(find, "k1 long, k2 long, gram long, place long")
    again = anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    by_text = anchors.join(again, "gram").groupBy("k1", "k2").agg(F.collect_set(F.struct("place", "gram", "n")).alias("found"))
    # The key comes along unused: so this is the shuffle of the texts that the last join of ``dedup`` uses again.
    joined = rows.select("k1", "k2", "_text", "_key").join(by_text, ["k1", "k2"])
    joined = joined.select("k1", "k2", "_text", "found", "_key")
    cut = joined.mapInArrow(cut_out, "k1 long, k2 long, anchor long, gram long, n long, context binary, left int")
    return cut.withColumn("context_hash", F.xxhash64("context", "left"))


def repeated_spans(contexts: DataFrame, length: int, max_group: int = MAX_GROUP) -> DataFrame:
    """(gram, context_hash, spans): for each distinct context its covered spans, flat, from the anchor.

    Equal contexts are counted before they are shuffled, so copies in any number are one row. A gram with more than
    ``max_group`` anchors is not given to one task: its strings are hashed and counted one by one, which finds the
    same spans.
    """
    distinct = contexts.groupBy("gram", "context_hash").agg(
        F.first("context").alias("context"), F.first("left").alias("left"), F.first("n").alias("n"), F.count("*").alias("uses")
    )
    schema = "gram long, context_hash long, spans array<int>"

    def give(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
        columns = zip(*rows) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["gram", "context_hash", "spans"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group, out = None, [], []

        def close() -> None:
            if len(group) > 1 or group and group[0][3] > 1:
                _, whole, lefts, uses = zip(*group)
                for (name, *_), spans in zip(group, covered(list(whole), list(lefts), list(uses), length)):
                    if spans:
                        out.append((at, name, [x for s in spans for x in s]))

        for batch in batches:
            for gram, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if gram != at:
                    close()
                    at, group = gram, []
                group.append(row)
            if len(out) > 5000:
                yield give(out)
                out = []
        close()
        yield give(out)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "context_hash", "shift", "h1", "h2", "uses"]
        for batch in batches:
            for gram, name, context, left, uses in zip(*(batch.column(i).to_pylist() for i in range(5))):
                data = np.frombuffer(context, np.uint8)
                h1, h2 = _hashes(data, length), _hashes(data[::-1], length)[::-1]
                n = len(h1)
                fixed = [pa.array(np.full(n, x)) for x in (gram, name)]
                columns = [*fixed, pa.array(left - np.arange(n, dtype=np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.copy().view(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, uses))], names=names)

    columns = ["gram", "context_hash", "context", "left", "uses"]
    small = distinct.where(F.col("n") <= max_group).select(*columns)
    found = small.repartition("gram").sortWithinPartitions("gram").mapInArrow(scan, schema)
    large = distinct.where(F.col("n") > max_group).select(*columns)
    each = large.mapInArrow(strings, "gram long, context_hash long, shift int, h1 long, h2 long, uses long")
    more = each.groupBy("gram", "shift", "h1", "h2").agg(F.sum("uses").alias("all")).where("all > 1")
    hit = each.join(more, ["gram", "shift", "h1", "h2"]).groupBy("gram", "context_hash")
    spans = F.flatten(F.transform(F.collect_set("shift"), lambda s: F.array(-s, F.lit(length) - s)))
    return found.unionByName(hit.agg(spans.alias("spans")))


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP
) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) of every row: its removed byte spans and the bytes that stay.

    A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere, in this text or another. Null
    is the empty text; repeated rows are copies of each other. Texts are shuffled once, by their own hashes, and both
    joins on them use that shuffle.
    """
    rows = _keyed(docs, key, text)
    contexts = contexts_of(rows, length, gram)
    spans = repeated_spans(contexts, length, max_group)
    places = contexts.select("k1", "k2", "anchor", "gram", "context_hash").join(spans, ["gram", "context_hash"])
    absolute = F.transform("spans", lambda s: s + F.col("anchor")).alias("spans")
    by_text = places.select("k1", "k2", absolute).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    kind = docs.schema[key].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, out, kept = [], [], [], []
            for t, flat in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = t.encode("utf-8", "surrogatepass")
                own = merged(list(zip(flat[::2], flat[1::2]))) if flat else []
                edges = [0, *(x for s in own for x in s), len(raw)]
                sizes.append(len(raw))
                gone.append(sum(b - a for a, b in own))
                out.append([{"start": a, "end": b} for a, b in own])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, span), pa.array(kept, pa.binary())]
            names = [key, "n_bytes", "n_removed", "spans", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    whole = rows.select("k1", "k2", "_text", "_key").join(by_text, ["k1", "k2"], "left").select("_key", "_text", "spans")
    return whole.mapInArrow(
        remove, f"{key} {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    )


