"""Benchmark decontamination: items are found again in documents also where numbers, names and units were changed.

Texts become templates in which typed placeholders stand for slots. Windows of a template are hashed and joined, and
what the slots hold must map consistently from the item to the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, named, texts, without

WIDTH = 5
SLOT_BITS = 22
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*%?")
_GLUED = re.compile(r"([+-]?[$€£]?\d+(?:[.,]\d+)*)([^\W\d_]+)")
_DIGIT_LETTER = re.compile(r"\d[^\W\d_]")
_EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
#: Units that are a slot after a number.
UNITS = frozenset(
    """mm cm m km inch inches in ft feet foot yard yards yd mile miles mi g kg mg lb lbs oz ton tons tonnes grams gram
    kilograms litre litres liter liters l ml gallon gallons s sec second seconds min minute minutes h hr hour hours day
    days week weeks month months year years dollar dollars euro euros cent cents pound pounds usd eur percent degree
    degrees mph kmh""".split()
)
TEXT, NUMBER, UNIT, NAME = range(4)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


class Words(dict):
    """A number for each word, and by it the word's hash and marks: its possible kind, and 4 if a sentence ends there."""

    def __init__(self, most: int = 400_000) -> None:
        self.most = most
        self.hashes, self.marks = np.zeros(1024, np.uint64), np.zeros(1024, np.uint8)

    def __missing__(self, word: str) -> int:
        bare = word if word.isalpha() else word[:-1]
        if bare.isalpha() and (bare is word or word[-1] in ".,;:!?"):
            low = bare.casefold()
            kind = UNIT if low in UNITS else NAME if bare[0].isupper() and not bare[1:].isupper() else TEXT
        else:
            bare = _EDGE.sub("", word)
            low = bare.casefold()
            if _NUMBER.fullmatch(bare):
                kind = NUMBER
            elif low in UNITS:
                kind = UNIT
            else:
                kind = NAME if bare[:1].isupper() and not bare[1:].isupper() else TEXT
        at = self[word] = len(self)
        if at == len(self.hashes):
            self.hashes, self.marks = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hashes, self.marks))
        self.hashes[at] = _hash(low)
        self.marks[at] = kind + 4 * (word[-1:] in ".!?:")
        return at

    def look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.hashes[at], self.marks[at]


_PLACEHOLDER = np.array([0, _hash("<number>"), _hash("<unit>"), _hash("<name>")], dtype=np.uint64)


def tokens_of(text: str) -> list[str]:
    """Words, with a unit that is glued to its number as a word of its own."""
    words = text.split()
    if _DIGIT_LETTER.search(text):
        words = [part for w in words for part in _unglue(w)]
    return words


def _unglue(word: str) -> tuple[str, ...]:
    found = _GLUED.fullmatch(_EDGE.sub("", word))
    if found and found[2].casefold() in UNITS:
        end = word[len(word.rstrip(".,;:!?)")) :]
        return found[1], found[2] + end
    return (word,)


def template(words: list[str], book: Words) -> tuple[np.ndarray, np.ndarray]:
    """Template hashes of words, and their kinds.

    A capitalised word is a name unless it begins a sentence or the text; a unit word is a unit after a number only.
    """
    hashes, marks = book.look(words)
    kinds = marks & 3
    before = np.concatenate([[True], marks[:-1] >= 4])
    kinds[(kinds == NAME) & before] = TEXT
    after_number = np.concatenate([[False], kinds[:-1] == NUMBER])
    kinds[(kinds == UNIT) & ~after_number] = TEXT
    return np.where(kinds == TEXT, hashes, _PLACEHOLDER[kinds]), kinds


def window_hashes(codes: np.ndarray, kinds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each window, whether it holds enough plain words to say anything)."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total, plain = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for j in range(width):
        total = total * _STEP + codes[j : j + n]
        plain += kinds[j : j + n] == TEXT
    total = (total ^ (total >> np.uint64(32))) * _MIX
    return total ^ (total >> np.uint64(29)), plain >= (width + 1) // 2


def windows(
    rows: DataFrame,
    key: str,
    text: str = "text",
    width: int = WIDTH,
    bits: bytes | None = None,
    short: Sequence[int] = (),
) -> DataFrame:
    """(key, width, pos, hash, slots, exact): the windows of each whole text and the words in their slots.

    Without ``bits``, those that stand for a text: its windows of ``width`` words that hold enough plain words, all of
    them if none does, and the text as one window if it is shorter; the first window a second time with its first word
    as a name where that is capitalised, as it is read within a sentence. exact: the text has fewer than three plain words,
    so its template alone says nothing. With ``bits``, all windows of ``width`` and of the ``short`` widths whose hash
    has its bit set: all that can join. Texts without words have none.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Words()
        wanted = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        mask = np.uint64(2**SLOT_BITS - 1)
        for batch in batches:
            owner, wide, pos, hashes, slots, exact = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                words = tokens_of(t)
                sizes = {w for w in (width, *short) if w <= len(words)} if bits is not None else {min(width, len(words))} - {0}
                if not sizes:
                    continue
                codes, kinds = template(words, book)
                few = int((kinds == TEXT).sum()) < 3

                def add(p: int, size: int, value: np.uint64, kinds: np.ndarray) -> None:
                    owner.append(i)
                    wide.append(size)
                    pos.append(p)
                    hashes.append(value)
                    slots.append([_EDGE.sub("", words[j]).casefold() for j in range(p, p + size) if kinds[j] != TEXT])
                    exact.append(few)

                for size in sizes:
                    found, enough = window_hashes(codes, kinds, size)
                    if wanted is None:
                        keep = enough if enough.any() else ~enough
                        if keep[0] and book.look(words[:1])[1][0] & 3 == NAME:
                            shown, named_kinds = codes[:size].copy(), kinds[:size].copy()
                            shown[0], named_kinds[0] = _PLACEHOLDER[NAME], NAME
                            add(0, size, window_hashes(shown, named_kinds, size)[0][0], named_kinds)
                    else:
                        keep = wanted[(found & mask).astype(np.int64)] == 1
                    for p in np.flatnonzero(keep).tolist():
                        add(p, size, found[p], kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(wide, pa.int32()),
                    pa.array(pos, pa.int32()),
                    pa.array(np.array(hashes, np.uint64).view(np.int64)),
                    pa.array(slots, pa.list_(pa.string())),
                    pa.array(exact, pa.bool_()),
                ],
                names=[key, "width", "pos", "hash", "slots", "exact"],
            )

    schema = f"{key} {kind}, width int, pos int, hash long, slots array<string>, exact boolean"
    return texts(rows, key, text).mapInArrow(run, schema)


def bitmap(hashes: DataFrame) -> bytes:
    """One bit for each value of the low bits of the hashes: always half a megabyte, however many there are."""
    slot = F.col("hash").bitwiseAND(2**SLOT_BITS - 1) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(slot).alias("b"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    whole = bytearray(2**SLOT_BITS // 8)
    for b, bits in parts:
        whole[4096 * (b - 1) : 4096 * b] = bits
    return bytes(whole)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    width: int = WIDTH,
    least: float = 0.8,
) -> DataFrame:
    """(key, item, matched, windows, coverage, verbatim) of every document and item found in it.

    An item is found if at least ``least`` of its distinct windows are in the document and every value in an item's
    slot goes with one value in the document: a changed number changes wherever it stands. This must hold along one
    alignment, or over all of them together for passages with insertions. Rows that repeat a key are looked at as one
    text; null and empty texts match nothing. An item shorter than a window is one window of its own length. An item
    with fewer than three plain words is found only with its own words in its slots, since its template fits too much.

    A filter of fixed size goes to the scan of the documents and drops windows that no item has; what passes is
    hash-joined. An item's window counts once, at its first place, so a repetitive item does not multiply matches.
    """
    own = windows(items.where(F.col(item).isNotNull()), item, text, width)
    first = F.min_by(F.struct("pos", "slots", "width"), "pos").alias("at")
    own = own.groupBy(item, "hash").agg(first, F.bool_and("exact").alias("exact"))
    own = cut(own.select(F.col(item).alias("item"), "hash", "exact", "at.*"))
    sizes = own.groupBy("item").agg(F.count_distinct("pos").alias("windows"), F.bool_and("exact").alias("exact"))
    short = [r[0] for r in own.select("width").distinct().collect()]  # at most ``width`` numbers
    own = own.select("item", "hash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    hits = windows(docs, key, text, width, bitmap(own), short).drop("width", "exact")
    pair = F.arrays_zip("item_slots", "slots")
    joined = hits.join(own, "hash").select(
        F.col(key).alias("doc"), "item", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), pair.alias("pairs")
    )

    def summed(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.collect_set("item_pos").alias("found"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
        )

    def consistent(pairs: str) -> Column:
        return F.size(F.array_distinct(F.col(f"{pairs}.item_slots"))) == F.size(pairs)

    def same(pairs: str) -> Column:
        return F.forall(pairs, lambda p: p["item_slots"] == p["slots"])

    def whole(pairs: str) -> Column:
        return consistent(pairs) & (F.size("found") >= least * F.col("windows")) & (~F.col("exact") | same(pairs))

    lines = summed(joined, ["doc", "item", "shift"]).join(sizes, "item")
    lines = lines.withColumn("good", whole("pairs"))
    spread = lines.groupBy("doc", "item").agg(
        F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
        F.first("windows").alias("windows"),
        F.first("exact").alias("exact"),
        F.max("good").alias("good"),
    )
    spread = spread.where(F.col("good") | whole("pairs"))
    return spread.select(
        F.col("doc").alias(key),
        F.col("item").alias(item),
        F.size("found").alias("matched"),
        F.col("windows").cast("int").alias("windows"),
        (F.size("found") / F.col("windows")).alias("coverage"),
        same("pairs").alias("verbatim"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows in which no item is found, each judged by its own text; rows without a key stay.

    The columns are those of ``docs``.
    """
    return without(docs, contaminated(named(docs, key, text), items, "row", text=text), key, text)
