"""Two tokenizers over the same bytes: where both end a token, which tokens overlap, and how often corpus-wide."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, texts

BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Texts of more characters are tokenized and aligned in pieces, by several tasks.
LONG = 65_536
#: Bytes of one fragment of a long text, and fragments that one step of the reduction joins.
CHUNK, FAN = 16_384, 8
#: Pairs of ids that are looked up without a shuffle, at most.
FREQUENT = 1 << 19
#: A link of ids a and b as one number; the piece model has fewer ids.
STEP = 32_768
_UNITS = re.compile(r"[ \n]+[^ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


# ---- fragments ------------------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Tokens that end in some range of bytes: ids and ends of either tokenizer, ends counted in the whole text."""

    a: list[int] = field(default_factory=list)
    a_ends: list[int] = field(default_factory=list)
    b: list[int] = field(default_factory=list)
    b_ends: list[int] = field(default_factory=list)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(self.a + other.a, self.a_ends + other.a_ends, self.b + other.b, self.b_ends + other.b_ends)

    def __bool__(self) -> bool:
        return bool(self.a or self.b)


def spelled(a: Iterable[int], b: Iterable[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def linked(group: Tokens) -> list[int]:
    """Links of a group: its tokens of A and B whose bytes overlap. Both begin at one byte and end at one."""
    i = j = 0
    links = []
    while i < len(group.a) and j < len(group.b):
        links.append(group.a[i] * STEP + group.b[j])
        left, right = group.a_ends[i], group.b_ends[j]
        i, j = i + (left <= right), j + (right <= left)
    return links


def links_of(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, links) of tokens that begin at one byte: each stretch between two ends is what one pair shares."""
    ends = np.union1d(a_ends, b_ends)
    ends = ends[ends <= min(a_ends[-1], b_ends[-1])]
    return ends, a[np.searchsorted(a_ends, ends)] * STEP + b[np.searchsorted(b_ends, ends)]


def words(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The ids of both in the order of their groups, each spelled with the mark that follows it."""
    of_a, of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
    out = np.empty(len(a) + len(b), object)
    comma, bar, semicolon = _spellings()
    out[np.arange(len(a)) + np.searchsorted(of_b, of_a, "left")] = np.where(last_a[: len(a)], bar[a], comma[a])
    out[np.arange(len(b)) + np.searchsorted(of_a, of_b, "right")] = np.where(last_b[: len(b)], semicolon[b], comma[b])
    return out


@cache
def _spellings() -> tuple[np.ndarray, ...]:
    return tuple(np.array([f"{i}{mark}" for i in range(1 << 16)], object) for mark in ",|;")


@dataclass
class Fragment:
    """A range of bytes, as far as it can be aligned without its neighbours.

    Tokens belong to the range that they end in. ``head``: those up to the first byte where both tokenizers end one,
    or all if there is none (``closed`` is None then). ``closed``: the ``n`` groups after it, spelled one by one or in
    runs, and their links.
    ``tail``: the tokens after the last such byte. Fragments of adjoining ranges compose, ``a + b``; composition is
    associative, and the fragment of no tokens is its neutral element.
    """

    head: Tokens = field(default_factory=Tokens)
    closed: list[str] | None = None
    n: int = 0
    links: list[np.ndarray] = field(default_factory=list)
    tail: Tokens = field(default_factory=Tokens)

    @staticmethod
    def of(tokens: Tokens) -> Fragment:
        a, a_ends, b, b_ends = (np.array(x, np.int64) for x in (tokens.a, tokens.a_ends, tokens.b, tokens.b_ends))
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(cuts):
            return Fragment(tokens)
        ends, links = links_of(a, a_ends, b, b_ends)
        first_a, first_b, last_a, last_b = (int(np.searchsorted(e, c, "right")) for c in (cuts[0], cuts[-1]) for e in (a_ends, b_ends))
        head = Tokens(tokens.a[:first_a], tokens.a_ends[:first_a], tokens.b[:first_b], tokens.b_ends[:first_b])
        tail = Tokens(tokens.a[last_a:], tokens.a_ends[last_a:], tokens.b[last_b:], tokens.b_ends[last_b:])
        inside = words(*(x[p:q] for x, p, q in ((a, first_a, last_a), (a_ends, first_a, last_a), (b, first_b, last_b), (b_ends, first_b, last_b))), cuts)
        closed = ["".join(inside)[:-1]] if len(inside) else []
        return Fragment(head, closed, len(cuts) - 1, [links[(ends > cuts[0]) & (ends <= cuts[-1])]], tail)

    def __add__(self, other: Fragment) -> Fragment:
        if self.closed is None:
            return Fragment(self.head + other.head, other.closed, other.n, other.links, other.tail)
        if other.closed is None:
            return Fragment(self.head, self.closed, self.n, self.links, self.tail + other.head)
        middle = self.tail + other.head
        links = [*self.links, np.array(linked(middle), np.int64), *other.links]
        groups = [*self.closed, spelled(middle.a, middle.b), *other.closed]
        return Fragment(self.head, groups, self.n + 1 + other.n, links, other.tail)

    def groups(self) -> tuple[list[str], int, np.ndarray]:
        """All groups, their number, and the links of a whole text, whose first byte begins a token of both and whose last ends one."""
        if self.closed is None:
            assert not self.head, "the tokenizers end at different bytes"
            return [], 0, np.zeros(0, np.int64)
        assert not self.tail, "the tokenizers end at different bytes"
        links = np.concatenate([np.array(linked(self.head), np.int64), *self.links])
        return [spelled(self.head.a, self.head.b), *self.closed], self.n + 1, links


def composed(fragments: Iterable[Fragment]) -> Fragment:
    """Neighbours joined in pairs, again and again, so that lists are copied once a level."""
    row = list(fragments) or [Fragment()]
    while len(row) > 1:
        row = [row[i] + row[i + 1] if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0]


# ---- tokens ---------------------------------------------------------------------------------------------


class Pair:
    """Both tokenizers, and the aligned tokens of units met before.

    A unit is white space and what follows it up to the next: neither tokenizer has a token that reaches over the
    border of two, so each unit is aligned once, and a text is the chain of its units. Texts with other white space
    than spaces and line ends, or with some at their end, are taken as a whole. The table of units is emptied when
    it holds ``most``.
    """

    def __init__(self, byte_model: str, piece_model: str, most: int = 200_000) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_model, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.a_bytes[list(ranks.values())] = list(map(len, ranks))
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.model = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        assert len(pieces) <= STEP
        self.spelling = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.b_bytes = np.array(list(map(len, self.spelling)))
        self.by_unit, self.most = not [p for p in pieces if "\n" in p or "▁" in p.lstrip("▁")], most
        self.forget()

    def forget(self) -> None:
        #: By the number of a unit: (tokens of A, of B, groups), -1 where they do not spell it; groups; where links begin.
        self.number: dict[str, int] = {}
        self.sizes, self.groups, self.begins = np.zeros((0, 3), np.int64), [], np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)

    def pieces(self, text: str) -> list[int]:
        """Ids of B for text that begins with the space that B adds by itself, or with a line end."""
        if text == " ":  # B adds no space to an empty text
            return self.model.encode("\n")[:1]
        return self.model.encode(text[1:]) if text[0] == " " else self.model.encode(text)[1:]

    def tokens(self, text: str, at: int = 0) -> Tokens | None:
        """The tokens of a text with its leading space or line end; None if B's bytes are not its bytes."""
        a, b, raw = self.encode(text), self.pieces(text), text.encode()
        if b"".join(map(self.spelling.__getitem__, b)) != raw:
            return None
        a_ends = (np.cumsum(self.a_bytes[a]) + at).tolist()
        assert a_ends[-1] == at + len(raw)
        return Tokens(a, a_ends, b, (np.cumsum(self.b_bytes[b]) + at).tolist())

    def units(self, text: str) -> list[str] | None:
        found = _UNITS.findall(text)
        whole = self.by_unit and sum(map(len, found)) == len(text) and not _OTHER_SPACE.search(text)
        return found if whole else None

    def learn(self, units: list[str], size: int = 4096) -> None:
        """Align new units: many at once, as one text, and one by one where that text is not spelled by B."""
        sizes, links, counts = [self.sizes], [self.links], []
        for begin in range(0, len(units), size):
            some = units[begin : begin + size]
            for part in [some] if (whole := self.tokens("".join(some))) else [[u] for u in some]:
                found = whole or self.tokens(part[0])
                if found is None:
                    sizes.append(np.array([[-1, -1, -1]]))
                    self.groups.append("")
                    counts.append(np.zeros(1, np.int64))
                    continue
                a, a_ends, b, b_ends = (np.array(x, np.int64) for x in (found.a, found.a_ends, found.b, found.b_ends))
                ends = np.cumsum([len(u.encode()) for u in part])
                cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
                assert np.isin(ends, cuts).all()
                upto = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, cuts)]
                sizes.append(np.diff(np.stack(upto, 1), axis=0, prepend=0))
                spelled_, to = words(a, a_ends, b, b_ends, cuts).tolist(), (upto[0] + upto[1]).tolist()
                self.groups += ["".join(spelled_[p:q])[:-1] for p, q in zip([0, *to], to)]
                link_ends, own = links_of(a, a_ends, b, b_ends)
                links.append(own)
                counts.append(np.diff(np.searchsorted(link_ends, ends, "right"), prepend=0))
        self.number |= zip(units, range(len(self.number), len(self.number) + len(units)))
        self.sizes, self.links = np.concatenate(sizes), np.concatenate(links)
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.concatenate(counts))])

    def aligned(self, texts_: list[str | None]) -> list[tuple | None]:
        """(tokens of A, of B, groups, groups spelled, codes of links, their counts) of whole texts; None: no tokens."""
        out: list[tuple | None] = [None] * len(texts_)
        units = {i: u for i, t in enumerate(texts_) if t and (u := self.units(" " + t)) is not None}
        if len(self.number) > self.most:
            self.forget()
        if new := [u for u in dict.fromkeys(chain.from_iterable(units.values())) if u not in self.number]:
            self.learn(new)
        if units:
            lengths = np.array(list(map(len, units.values())))
            at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(units.values())), np.int64, lengths.sum())
            begins = np.cumsum(lengths) - lengths
            sizes, least = (f.reduceat(self.sizes[at], begins, axis=0) for f in (np.add, np.minimum))
            n = self.begins[at + 1] - self.begins[at]
            links = self.links[np.repeat(self.begins[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            owner = np.repeat(np.repeat(np.arange(len(lengths)), lengths), n)
            keys, counts = np.unique(owner << 32 | links, return_counts=True)
            codes, counts = (keys & (1 << 32) - 1).astype(np.int32), counts.astype(np.int32)
            to = np.searchsorted(keys >> 32, np.arange(len(lengths) + 1)).tolist()
            for k, (i, begin, length) in enumerate(zip(units, begins.tolist(), lengths.tolist())):
                if least[k, 2] >= 0:
                    groups = ";".join(map(self.groups.__getitem__, at[begin : begin + length].tolist()))
                    own = slice(to[k], to[k + 1])
                    out[i] = (*sizes[k].tolist(), groups, codes[own], counts[own])
        for i, t in enumerate(texts_):
            if t and out[i] is None and (tokens := self.tokens(" " + t)):
                groups, n_groups, links = Fragment.of(tokens).groups()
                out[i] = len(tokens.a), len(tokens.b), n_groups, ";".join(groups), *_counted(links)
        return out


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair(byte_model: str, piece_model: str) -> Pair:
    at = (byte_model, piece_model)
    if at not in _PAIRS:
        _PAIRS[at] = Pair(*at)
    return _PAIRS[at]


# ---- documents ------------------------------------------------------------------------------------------

_SUMS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<int>, counts array<int>"
_OPEN = "{0}_a array<int>, {0}_a_ends array<long>, {0}_b array<int>, {0}_b_ends array<long>"
_FRAGMENT = f"row long, cell long, at long, good boolean, n_a long, n_b long, {_OPEN.format('head')}, {_OPEN.format('tail')}, closed boolean, groups string, n_closed long, codes array<int>, counts array<int>"
_NO_LINKS = np.zeros(0, np.int32)


def _counted(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = np.unique(links, return_counts=True)
    return codes.astype(np.int32), counts.astype(np.int32)


def _sums(n_a: int, n_b: int, n_groups: int, groups: str, codes: np.ndarray, counts: np.ndarray) -> tuple:
    return n_a, n_b, n_groups, int(counts.sum()), hashlib.sha256(groups.encode()).hexdigest(), codes, counts


_NOTHING = (0, 0, 0, 0, "", _NO_LINKS, _NO_LINKS)
_SUM_TYPES = [*[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 2]
_FRAGMENT_TYPES = [
    *[pa.int64()] * 3, pa.bool_(), *[pa.int64()] * 2, *[pa.list_(pa.int32()), pa.list_(pa.int64())] * 4,
    pa.bool_(), pa.string(), pa.int64(), *[pa.list_(pa.int32())] * 2,
]


def _columns(rows: list[tuple], types: list[pa.DataType]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]


def _packed(row: int, cell: int, at: int, good: bool, n_a: int, n_b: int, f: Fragment) -> tuple:
    """A fragment as a row; its links are counted."""
    heads = [x for t in (f.head, f.tail) for x in (t.a, t.a_ends, t.b, t.b_ends)]
    closed = f.closed is not None
    return row, cell, at, good, n_a, n_b, *heads, closed, ";".join(f.closed or ()), f.n, *_counted(np.concatenate([_NO_LINKS, *f.links]))


def _unpacked(x: dict) -> Fragment:
    head, tail = (Tokens(*(x[f"{side}_{c}"] for c in ("a", "a_ends", "b", "b_ends"))) for side in ("head", "tail"))
    groups = ([x["groups"]] if x["n_closed"] else []) if x["closed"] else None
    return Fragment(head, groups, x["n_closed"], [np.repeat(x["codes"], x["counts"]).astype(np.int64)], tail)


def short_texts(rows: DataFrame, key: str, models: tuple[str, str], some: int = 2_000_000) -> DataFrame:
    """(key, sums) of texts that one task aligns as a whole; about ``some`` characters at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*models)
        for batch in batches:
            held, out = batch.column(1).to_pylist(), []
            while len(out) < len(held):
                upto = np.searchsorted(np.cumsum([len(t or "") for t in held[len(out) :]]), some) + 1
                out += [_sums(*f) if f else _NOTHING for f in both.aligned(held[len(out) : len(out) + upto])]
            names = [key, *(x.split()[0] for x in _SUMS.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(out, _SUM_TYPES)], names=names)

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {_SUMS}")


def pieces_of(text: str, size: int) -> list[str]:
    """A text with its leading space, cut before units, into pieces of ``size`` characters or little more."""
    out, begin = [], 0
    while not _OTHER_SPACE.search(text) and len(text) - begin > size:
        cut_at = re.compile(r"(?<=[^ \n])[ \n]").search(text, begin + size)
        if not cut_at:
            break
        out.append(text[begin : cut_at.start()])
        begin = cut_at.start()
    return [*out, text[begin:]]


def fragments(texts_: DataFrame, models: tuple[str, str], size: int, chunk: int) -> DataFrame:
    """Rows (row, text) as fragments of ``chunk`` bytes; a text's pieces are dealt to the tasks one by one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_unit = pair(*models).by_unit
        for batch in batches:
            for row, text in zip(*(c.to_pylist() for c in batch.columns)):
                cuts = pieces_of(" " + text, size) if by_unit else [" " + text]
                ends = np.cumsum([0, *(len(p.encode()) for p in cuts)])[:-1]
                columns = [pa.repeat(pa.scalar(row, pa.int64()), len(cuts)), pa.array(ends, pa.int64()), pa.array(cuts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "at", "text"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*models)
        for batch in batches:
            for row, at, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = both.tokens(text, at)
                if found is None:
                    out = [_packed(row, at // chunk, at, False, 0, 0, Fragment())]
                else:
                    out = []
                    a_cells, b_cells = ((np.array(e) - 1) // chunk for e in (found.a_ends, found.b_ends))
                    for cell in np.union1d(a_cells, b_cells).tolist():
                        (p, q), (r, s) = (np.searchsorted(c, [cell, cell + 1]) for c in (a_cells, b_cells))
                        own = Tokens(found.a[p:q], found.a_ends[p:q], found.b[r:s], found.b_ends[r:s])
                        out.append(_packed(row, cell, max(at, cell * chunk), True, len(own.a), len(own.b), Fragment.of(own)))
                yield pa.RecordBatch.from_arrays(_columns(out, _FRAGMENT_TYPES), names=[x.split()[0] for x in _FRAGMENT.split(", ")])

    dealt = texts_.mapInArrow(split, "row long, at long, text string").repartition("row", "at")
    return dealt.mapInArrow(align, _FRAGMENT)


def reduced(found: DataFrame, fan: int) -> DataFrame:
    """One fragment a row: neighbours are joined ``fan`` at a time, level by level, each level a shuffle of its own."""

    def join(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda x: x["at"])
        whole = composed(map(_unpacked, rows)) if all(x["good"] for x in rows) else Fragment()
        first = rows[0]
        out = _packed(first["row"], first["cell"] // fan, first["at"], all(x["good"] for x in rows), sum(x["n_a"] for x in rows), sum(x["n_b"] for x in rows), whole)
        return pa.table(_columns([out], _FRAGMENT_TYPES), names=group.column_names)

    found = cut(found)
    while True:
        found = cut(found.groupBy("row", F.floor(F.col("cell") / fan)).applyInArrow(join, _FRAGMENT))
        if not found.agg(F.max("cell")).first()[0]:
            return found


def finished(found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                if x["good"]:
                    groups, n, links = _unpacked(x).groups()
                    out.append(_sums(x["n_a"], x["n_b"], n, ";".join(groups), *_counted(links)))
                else:
                    out.append(_NOTHING)
            names = ["row", *(x.split()[0] for x in _SUMS.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(out, _SUM_TYPES)], names=names)

    return found.mapInArrow(run, f"row long, {_SUMS}")


def aligned(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    byte_model: str = BYTE_MODEL,
    piece_model: str = PIECE_MODEL,
    long_text: int = LONG,
    chunk: int = CHUNK,
    fan: int = FAN,
) -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, codes, counts): every document's alignment.

    A: the byte model's tokens of a space and the text; B: the piece model's of the text. Groups are cut where both
    end a token; links are pairs of tokens that share bytes, as ``codes`` (A's id * STEP + B's) with their ``counts``.
    Texts that are null or empty, or whose tokens do not spell their bytes, have zeros, '' and no links. Rows with
    one key, and repeated rows, stay apart. The model files must exist on every executor.
    """
    rows, models = texts(docs, key, text), (byte_model, piece_model)
    found = short_texts(rows.where(F.length(text) <= long_text), key, models)
    large = cut(rows.where(F.length(text) > long_text).withColumn("row", F.monotonically_increasing_id()))
    if not large.isEmpty():
        whole = reduced(fragments(large.select("row", F.col(text).alias("text")), models, long_text, chunk), fan)
        found = found.unionByName(finished(whole).join(large.select("row", key), "row").drop("row"))
    return cut(found.withColumn("row", F.monotonically_increasing_id()))


def alignment(docs: DataFrame, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT, **options) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): ``aligned``, weighed by the corpus.

    A pair's count is how many links of all documents hold it; ``n_best``: a document's links whose count is the
    highest of their B id, ties included; ``count_sum``: the counts of all its links together. At most ``frequent``
    pairs, those with the highest counts, are broadcast; links of all others meet their counts in a shuffle, in
    which no pair has many rows. ``options`` are those of ``aligned``.
    """
    found = aligned(docs, key, text, **options)
    links = found.selectExpr("row", "inline(arrays_zip(codes, counts))").withColumnsRenamed({"codes": "code", "counts": "n"})
    totals = cut(links.groupBy("code").agg(F.sum("n").alias("total")))
    best = totals.groupBy((F.col("code") % STEP).alias("b")).agg(F.max("total").alias("most"))  # a row for each id of B
    totals = totals.withColumn("b", F.col("code") % STEP).join(F.broadcast(best), "b")
    totals = totals.select("code", "total", (F.col("total") == F.col("most")).alias("top"))
    sizes = totals.groupBy(F.floor(F.log2("total")).cast("int").alias("magnitude")).count().collect()  # 63 rows at most
    held, bar = 0, 64
    for r in sorted(sizes, reverse=True):
        if held + r["count"] > frequent:
            break
        held, bar = held + r["count"], r["magnitude"]
    common = F.floor(F.log2("total")) >= bar
    hot, cold = F.broadcast(totals.where(common)), totals.where(~common)

    def weighed(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("row").agg(
            F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
        )

    sums = weighed(links.join(hot, "code"))
    if len(sizes) and bar > min(r["magnitude"] for r in sizes):
        rest = links.join(F.broadcast(totals.where(common).select("code")), "code", "left_anti")
        sums = sums.unionByName(weighed(rest.join(cold, "code")))
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    found = found.drop("codes", "counts").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return found.select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
