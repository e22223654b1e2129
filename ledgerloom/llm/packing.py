"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, texts

CAPACITY = 2048
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
RANK = "fit_rank"


# ---- tokens -------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the others from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Spaced(dict):
    """Ids of ' ' + word as little-endian bytes, kept for words seen; emptied when full."""

    def __init__(self, encode, most: int = 300_000) -> None:
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[word] = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        return ids


class Encoder:
    """Token ids of a text as little-endian bytes, equal to those of the tokenizer file.

    No pre-token of a byte-level tokenizer reaches over the border between a character that is not white space
    and a space after it, so a text is the chain of its space-separated words, and frequent words are looked up.
    Texts with other spacing or with a special token's string are encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters, merges = _byte_letters(), spec["model"]["merges"]
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        in_order = all(vocab[a + b] == i for i, (a, b) in enumerate(pairs, 256))
        self.words = None
        if in_order and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]:
            ranks = {bytes(letters[c] for c in w): i for w, i in vocab.items()}
            own = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            self.words, self.plain = _Spaced(own.encode_ordinary), own.encode_ordinary

    def __call__(self, text: str) -> bytes:
        parts = text.split(" ")
        # Only a part that is empty or ends in white space can be torn from the space after it.
        whole = self.words is None or any(s in text for s in self.special)
        if whole or not all(parts[:-1]) or any(p[-1].isspace() for p in parts[:-1]):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first = np.array(self.plain(parts[0]), dtype="<u4").tobytes() if parts[0] else b""
        return first + b"".join(map(self.words.__getitem__, parts[1:]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): documents as runs of at most ``capacity`` token ids.

    A document is its ids and the end id. A longer one is cut into full pieces; only its first may be shorter.
    Null and empty texts are the end id alone. The tokenizer file must exist on every executor.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), END_ID.to_bytes(4, "little")
        for batch in batches:
            owner, rows, ids = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                flat = encode(t) + end
                n = len(flat) // 4
                begin, stop, piece = 0, n % capacity or capacity, 0
                while begin < n:
                    part = flat[4 * begin : 4 * stop]
                    owner.append(i)
                    rows.append((piece, begin, stop - begin, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
                    begin, stop, piece = stop, stop + capacity, piece + 1
            table = np.array(rows, dtype=np.int64).reshape(-1, 4)
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(table[:, 0].astype(np.int32))]
            columns += [pa.array(table[:, c]) for c in (1, 2, 3)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            names = [key, "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return texts(docs, key, text).mapInArrow(run, schema)


# ---- packing ------------------------------------------------------------------------------------------


class Classes:
    """How many pieces wait and how many gaps are open, by length. All that the sweep needs from the rows.

    Pieces of one length, and gaps of one width, differ in their rank only, so at most ``capacity`` counts of each
    describe any amount of data. A round's plan is a list of runs of ranks, at most twice as many as classes.
    """

    def __init__(self, waiting: dict[int, int], capacity: int) -> None:
        self.capacity, self.waiting, self.taken, self.gaps = capacity, dict(waiting), {}, {}

    def tokens(self) -> int:
        return sum(length * n for length, n in self.waiting.items())

    def open(self, least: int = 0) -> list[tuple[int, int, int, int]]:
        """New sequences for the longest pieces: as many as the tokens fill, and one for each that is over half.

        Runs (length, first rank, number, first rank among the gaps of that width).
        """
        n = max(-(-self.tokens() // self.capacity), least)
        runs = []
        for length in sorted(self.waiting, reverse=True):
            k = min(n, self.waiting[length])
            if k:
                width = self.capacity - length
                runs.append((length, self.taken.get(length, 0), k, self.gaps.get(width, 0)))
                self.gaps[width] = self.gaps.get(width, 0) + k
                self._take(length, k)
            n -= k
        return runs

    def _take(self, length: int, k: int) -> None:
        self.waiting[length] -= k
        self.taken[length] = self.taken.get(length, 0) + k

    def sweep(self) -> tuple[list[tuple], list[tuple]]:
        """One round. The longest pieces choose first, each the narrowest gap that holds it: its successor.

        From wide to narrow, gaps go on a stack and pieces take from its top. Rank settles who gets which of a class:
        a gap takes as many pieces of one length as it holds, in the order of their ranks.
        Returns fits (length, first rank, number, width, first gap rank, pieces a gap) and moves of the gaps
        (width, first rank, number, new width, new first rank), which cover every open gap.
        """
        stack: list[list[int]] = []
        fits, arrivals, used = [], [], {}
        for size in range(self.capacity, 0, -1):
            if self.gaps.get(size):
                stack.append([size, self.gaps[size], 0])
            while self.waiting.get(size) and stack:
                top = stack[-1]
                width, count, ahead = top
                each = width // size
                k = min(self.waiting[size], (count - ahead) * each)
                need = -(-k // each)
                fits.append((size, self.taken.get(size, 0), k, width, ahead, each))
                last = k - (need - 1) * each
                arrivals.append((width, ahead, need - 1, width - size * each))
                arrivals.append((width, ahead + need - 1, 1, width - size * last))
                self._take(size, k)
                top[2] = used[width] = ahead + need
                if top[2] == count:
                    stack.pop()
        left = [(w, used.get(w, 0), n - used.get(w, 0), w) for w, n in self.gaps.items()]
        moves, gaps = [], {}
        for width, first, n, new in left + arrivals:
            if n:
                moves.append((width, first, n, new, gaps.get(new, 0)))
                gaps[new] = gaps.get(new, 0) + n
        self.gaps = {w: n for w, n in gaps.items() if w}
        return fits, moves


def _ranked(waiting: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces sorted over ranges of (length, item), each with its rank within its length; pieces by length.

    A task numbers its own run of a length. What comes before it in other tasks is a sum over at most one row a task
    and length, which ranges keep to tasks + lengths; a length that fills many tasks is thus numbered by all of them.
    """
    spark = waiting.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = waiting.repartitionByRange(width, "length", "item").sortWithinPartitions("length", "item")
    names = [*waiting.columns, RANK]
    at = names.index("length")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            length = batch.column(at).to_numpy()
            if not len(length):
                continue
            new = np.flatnonzero(np.diff(length)) + 1
            begin = np.zeros(len(length), np.int64)
            begin[new] = new
            rank = np.arange(len(length)) - np.maximum.accumulate(begin)
            if length[0] == last:
                rank[: new[0] if len(new) else len(length)] += seen
            last, seen = length[-1], rank[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], names=names)

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in waiting.schema)
    local = cut(sorted_.mapInArrow(number, f"{plain}, {RANK} long").withColumn("task", F.spark_partition_id()))
    runs = sorted(map(tuple, local.groupBy("length", "task").count().collect()))
    before, total = [], {}
    for length, task, n in runs:
        before.append((length, task, total.get(length, 0)))
        total[length] = total.get(length, 0) + n
    ahead = _small(spark, before, "length long, task int, ahead long")
    ranked = local.join(ahead, ["length", "task"]).withColumn(RANK, F.col(RANK) + F.col("ahead"))
    return ranked.drop("ahead", "task"), total


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Runs of ranks: some for each length, however many rows there are, so they may be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema).coalesce(1))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset; sequences have at most ``capacity`` tokens and no holes before the last.

    Bulk-synchronous best fit. Each round matches pieces and gaps by a sweep over their lengths and ranks, and the
    gaps, one row a sequence, move to their new width and rank in a distributed step. When nothing fits any more, new
    sequences are opened. At the end one join on (round, width, rank) tells every piece its gap. All choices
    depend on counts by length, so the driver holds those alone; rows stay on the executors. A full piece is a
    sequence by itself. Sequences are named by the row number of their first piece. Repeated rows are packed each.
    """
    spark = found.sparkSession
    items = cut(found.withColumn("item", F.monotonically_increasing_id()))
    full = items.where(F.col("length") == capacity)
    ranked, counts = _ranked(items.where(F.col("length") < capacity))
    state = Classes(counts, capacity)
    seeds, offers, plan = [], [], []
    gaps: DataFrame | None = None
    fit = "length long, first long, n long, width long, gap_first long, each long, round int"

    def opened(least: int = 0) -> DataFrame:
        runs = state.open(least)
        seeds.extend(runs)
        rows = _small(spark, runs, "length long, first long, n long, gap_first long")
        new = ranked.join(rows, "length").where(f"{RANK} >= first AND {RANK} < first + n")
        return new.select(
            (F.lit(capacity) - F.col("length")).alias("width"),
            (F.col("gap_first") + F.col(RANK) - F.col("first")).alias("rank"),
            F.col("item").alias("sequence_id"),
        )

    over_half = sum(n for length, n in counts.items() if 2 * length > capacity)
    if any(counts.values()):
        gaps = cut(opened(over_half))
    step = 0
    while any(state.waiting.values()):
        fits, moves = state.sweep()
        if not fits:
            gaps = cut(gaps.unionByName(opened()))
            continue
        offers.append(gaps.withColumn("round", F.lit(step)))
        plan += [(*run, step) for run in fits]
        steps = _small(spark, moves, "width long, first long, n long, new long, new_first long")
        moved = gaps.join(steps, "width").where("rank >= first AND rank < first + n AND new > 0")
        gaps = cut(
            moved.select(
                F.col("new").alias("width"),
                (F.col("new_first") + F.col("rank") - F.col("first")).alias("rank"),
                "sequence_id",
            )
        )
        step += 1
    columns = [c for c in items.columns if c != "item"]
    first = full.select(*columns, F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not seeds:
        return first
    runs = _small(spark, [s[:3] for s in seeds], "length long, first long, n long")
    own = ranked.join(runs, "length").where(f"{RANK} >= first AND {RANK} < first + n")
    out = first.unionByName(
        own.select(*columns, F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )
    if not plan:
        return out
    offered = offers[0]
    for more in offers[1:]:
        offered = offered.unionByName(more)
    wanted = ranked.join(_small(spark, plan, fit), "length").where(f"{RANK} >= first AND {RANK} < first + n")
    nth = F.col(RANK) - F.col("first")
    wanted = wanted.select(
        *columns,
        "round",
        "width",
        (F.col("gap_first") + F.floor(nth / F.col("each"))).alias("rank"),
        (nth % F.col("each")).alias("place"),
    )
    offset = F.lit(capacity) - F.col("width") + F.col("place") * F.col("length")
    matched = wanted.join(offered, ["round", "width", "rank"])
    return out.unionByName(matched.select(*columns, "sequence_id", offset.cast("long").alias("offset")))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from pieces made ``with_ids``; a group is one sequence's tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
