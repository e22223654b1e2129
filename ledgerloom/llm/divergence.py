"""How sources differ in their words: every pair of sources of a language over one count matrix, held as quadtrees."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, ready

UNIT = 1_000_000_000
LEAST_DOCS = 3
TOP_TERMS = 200
#: Bytes of a text as words: letters lower-cased, other ASCII a space, all beyond ASCII as it is.
_SPACED = bytes(ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(128)) + bytes(range(128, 256))


# ---- counts of terms ------------------------------------------------------------------------------------


def terms(text: str) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_SPACED).split()


def term_counts(docs: DataFrame, most: int = 250_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, in parts.

    A task adds up what it reads. Where it holds ``most`` sums after a text, it hands on those of terms seen once, and
    all of them if more than half would stay; the rest goes at its end. So a frequent term or source sends a few rows
    a task, and a task's memory does not follow the number of terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def sums(least: int = 1, below: float = float("inf")) -> pa.RecordBatch:
            """Take out the sums from ``least`` to under ``below``."""
            parts = []
            for (lang, source), (n, docs_with) in list(held.items()):
                gone = {t: c for t, c in n.items() if least <= c < below}
                columns = [pa.repeat(pa.scalar(x, pa.string()), len(gone)) for x in (lang, source)]
                columns += [pa.array(gone.keys(), pa.binary()).cast(pa.string()), pa.array(gone.values(), pa.int64())]
                parts.append([*columns, pa.array([docs_with[t] for t in gone], pa.int64())])
                stay = Counter({t: c for t, c in n.items() if t not in gone}), Counter({t: c for t, c in docs_with.items() if t not in gone})
                if stay[0]:
                    held[lang, source] = stay
                else:
                    del held[lang, source]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*parts)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*batch.columns):
                n, docs_with = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                size -= len(n)
                words = terms(text.as_py())
                n.update(words)
                docs_with.update(set(words))
                size += len(n)
                if size >= most:
                    yield sums(1, 2)
                    size = sum(len(n) for n, _ in held.values())
                    if size > most // 2:
                        yield sums()
                        size = 0
        if held:
            yield sums()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_cells(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, of_lang, first): counts of the terms that a language keeps; one row of a term is first.

    One shuffle, by language and term: the sums of each group and the totals of the language need no other.
    """
    cells = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    cells = cells.withColumns({"of_lang": F.sum("n").over(term), "docs": F.sum("docs").over(term), "nth": F.row_number().over(term.orderBy("source"))})
    return cells.where(F.col("docs") >= least_docs).select("lang", "source", "term", "n", "of_lang", (F.col("nth") == 1).alias("first"))


# ---- the quadtree ---------------------------------------------------------------------------------------


def per_unit(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * count / total) in 64 bits: UNIT is 31250 * 32000, divided one factor at a time."""
    first, rest = np.divmod(count * 31250, total)
    return 1 + first * 32000 + rest * 32000 // total


#: Up to this many cells a level of a tree is a table of its quadrants, beyond that a sorted list.
TABLE = 1 << 21


class Quadtree:
    """Which quadrants of a group-term matrix hold a count, and the share that each leaf has in its row's ``totals``.

    Each level is a table with a flag for each quadrant, or where that is too large the sorted codes of those held.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, totals: np.ndarray, width: int, levels: int, most: int = TABLE) -> None:
        self.zero = per_unit(np.ones(len(totals), np.int64), totals)
        shares = per_unit(counts + 1, totals[rows])
        self.flags: list[np.ndarray | None] = []
        self.nodes: list[np.ndarray | None] = []
        for s in range(levels + 1):
            shape = (len(totals) - 1 >> s) + 1, (width - 1 >> s) + 1
            small = shape[0] * shape[1] <= most
            self.nodes.append(None if small else np.unique((rows >> s) << 32 | (cols >> s)))
            self.flags.append(np.zeros(shape, bool) if small else None)
            if small:
                self.flags[s][rows >> s, cols >> s] = True
        if self.flags[0] is None:
            self.shares = shares[np.argsort(rows << 32 | cols)]
        else:
            self.shares = np.repeat(self.zero[:, None], width, axis=1)
            self.shares[rows, cols] = shares

    def holds(self, level: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        if (flags := self.flags[level]) is not None:
            return flags[row, col]
        nodes, code = self.nodes[level], row << 32 | col
        at = np.minimum(np.searchsorted(nodes, code), max(0, len(nodes) - 1))
        return nodes[at] == code if len(nodes) else np.zeros(len(code), bool)

    def share(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Shares at leaves, those without a count included."""
        if self.flags[0] is not None:
            return self.shares[row, col]
        if not len(self.nodes[0]):
            return self.zero[row]
        at = np.minimum(np.searchsorted(self.nodes[0], row << 32 | col), len(self.nodes[0]) - 1)
        return np.where(self.nodes[0][at] == row << 32 | col, self.shares[at], self.zero[row])


def divergences(
    rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, totals: np.ndarray, width: int, split: int | None = None, most: int = 1 << 18
) -> np.ndarray:
    """Sum of floor((p-q)^2/q) over ``width`` columns, for every ordered pair of rows; p of the row, q of the column.

    ``totals`` is each row's denominator. The tree is walked jointly for row pairs: a triple (row node, row node,
    column node) whose two quadrants are empty is priced at once, its columns times the value at count 0; else it
    is split in eight, down to single cells. ``split``: only pairs of one row before and one row from that position
    on are asked for. Strips of columns are walked one after another, so that ``most`` triples are held at a time.
    """
    n = len(totals)
    levels = max(1, int(max(n, width) - 1).bit_length())
    tree, value = Quadtree(rows, cols, counts, totals, width, levels), np.zeros((n, n), np.int64)
    empty = [np.zeros((-(-n // (1 << s)),) * 2, np.int64) for s in range(levels + 1)]
    first = min(levels, max(0, (most // (n * n)).bit_length() - 1))
    top = np.arange(-(-n // (1 << first)))
    halves = np.array([(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)])

    def span(node: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        return node << level, np.minimum((node + 1) << level, n)

    for strip in range(-(-width // (1 << first))):
        i, j = (x.ravel() for x in np.meshgrid(top, top, indexing="ij"))
        c = np.full(len(i), strip)
        for level in range(first, -1, -1):
            if split is not None:
                (a, b), (d, e) = span(i, level), span(j, level)
                wanted = ~(((b <= split) & (e <= split)) | ((a >= split) & (d >= split)))
                i, j, c = i[wanted], j[wanted], c[wanted]
            some = tree.holds(level, i, c) | tree.holds(level, j, c)
            none = ~some
            here = i[none] * len(empty[level]) + j[none]
            np.add.at(empty[level].reshape(-1), here, np.minimum((c[none] + 1) << level, width) - (c[none] << level))
            i, j, c = i[some], j[some], c[some]
            if level:
                i, j, c = (np.add.outer(2 * x, halves[:, k]).ravel() for k, x in enumerate((i, j, c)))
                real = (i << (level - 1) < n) & (j << (level - 1) < n) & (c << (level - 1) < width)
                i, j, c = i[real], j[real], c[real]
        p, q = tree.share(i, c), tree.share(j, c)
        np.add.at(value.reshape(-1), i * n + j, (p - q) * (p - q) // q)
    zero = tree.zero
    columns = sum(e[np.ix_(np.arange(n) >> s, np.arange(n) >> s)] for s, e in enumerate(empty))
    gap = zero[:, None] - zero[None, :]
    return value + columns * (gap * gap // zero[None, :])


# ---- all groups -----------------------------------------------------------------------------------------


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    group_block: int = 128,
    term_block: int = 4096,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others, and which words it favours.

    Nulls in text, lang and source read as ''. A language keeps the terms in at least ``least_docs`` of its rows;
    repeated rows count as often as they come. A source without terms is compared like any other; where a language
    keeps no term, values are 0. Ties go to the smaller item. An empty table gives no rows.

    Groups and terms are dealt by hashes into blocks, and a task walks one pair of group blocks over one term block,
    so no source, language or term meets in one place with all its rows. ``part`` 'pair' holds every other source of
    the language, as asked for; 'term' only ranks to ``top_terms``.
    """
    ready(docs.sparkSession)
    columns = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))]
    read = docs.select(*columns)
    cells = cut(kept_cells(term_counts(read), least_docs))
    kept = cells.where("first").select("lang", "term", "of_lang")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("of_lang").alias("lang_n"))
    groups = read.select("lang", "source").distinct()
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("own_n")), ["lang", "source"], "left")
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_groups"))
    groups = groups.join(langs.join(sizes, "lang", "right"), "lang").fillna(0, ["own_n", "v", "lang_n"])
    groups = cut(groups.withColumn("row_blocks", F.ceil(F.col("n_groups") / group_block)))
    found = _terms(cells, groups, top_terms).unionByName(_pairs(cells, kept, groups, group_block, term_block))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _ranked(df: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    df = df.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
    return df if most is None else df.where(F.col("rank") <= most)


def _per_unit(count: str, total: str, v: str) -> Column:
    return F.expr(f"1 + CAST(({count} + 1) * 1000000000BD AS DECIMAL(38, 0)) div ({total} + {v})")


def _terms(cells: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    priced = cells.join(groups, ["lang", "source"])
    priced = priced.withColumn("p", _per_unit("n", "own_n", "v")).withColumn("q", _per_unit("of_lang", "lang_n", "v"))
    priced = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    return _ranked(priced, "term", most)


def _pairs(cells: DataFrame, kept: DataFrame, groups: DataFrame, group_block: int, term_block: int) -> DataFrame:
    row_block = F.pmod(F.xxhash64("source"), "row_blocks")
    term_blocks = F.ceil(F.col("v") / term_block)
    langs = groups.select("lang", "row_blocks", "v").distinct()
    col_block = F.pmod(F.xxhash64("term"), term_blocks)

    def paired(df: DataFrame) -> DataFrame:
        """Every pair of blocks that a row's own block is in."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1))
        df = df.withColumn("row_block", row_block).withColumn("other", other)
        return df.withColumn("low", F.least("row_block", "other")).withColumn("high", F.greatest("row_block", "other"))

    widths = kept.join(langs, "lang").select("lang", col_block.alias("col_block")).groupBy("lang", "col_block")
    widths = widths.agg(F.count("*").alias("width"))
    left = paired(cells.join(langs, "lang").withColumn("col_block", col_block))
    left = left.select("lang", "low", "high", "col_block", "source", "term", "n")
    right = paired(groups.join(widths, "lang"))
    right = right.select("lang", "low", "high", "col_block", "row_block", "source", (F.col("own_n") + F.col("v")).alias("total"), "width")

    def price(own: pa.Table, of: pa.Table) -> pa.Table:
        names = ["lang", "source", "item", "value"]
        low, high = of.column("low")[0].as_py(), of.column("high")[0].as_py()
        order = np.argsort(of.column("row_block").to_numpy(), kind="stable")
        of = of.take(pa.array(order))
        sources = of.column("source").combine_chunks()
        split = None if low == high else int((of.column("row_block").to_numpy() == low).sum())
        rows = pc.index_in(own.column("source"), sources).to_numpy().astype(np.int64)
        cols = own.column("term").combine_chunks().dictionary_encode()
        cols = cols.indices.to_numpy().astype(np.int64) if len(own) else np.zeros(0, np.int64)
        value = divergences(rows, cols, own.column("n").to_numpy(), of.column("total").to_numpy(), of.column("width")[0].as_py(), split)
        i, j = (x.ravel() for x in np.meshgrid(*[np.arange(len(of))] * 2, indexing="ij"))
        real = i != j if split is None else (i < split) != (j < split)
        i, j = i[real], j[real]
        langs_ = pa.repeat(of.column("lang")[0], len(i))
        return pa.table([langs_, sources.take(pa.array(i)), sources.take(pa.array(j)), pa.array(value[i, j])], names=names)

    keys = ["lang", "low", "high", "col_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(price, "lang string, source string, item string, value long")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.where("v = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item").withColumn("value", F.lit(0).cast("long"))
    return _ranked(found.unionByName(none), "pair")
