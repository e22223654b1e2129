"""Secret scans in SQL functions alone: known forms, and strings that a battery of randomness tests takes for keys.

All that concerns one text is computed in its own row, without a shuffle. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Body, cut, let, texts

#: The known forms. Group 2 of an assignment is its value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: What may be a key: a whole run of its letters.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from narrow to wide: pattern, alphabet, and the share of an ordinary identifier's letters that are in it.
ENCODINGS = (
    ("^[0-9]+$", DIGITS, 0.15),
    ("^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.35),
    ("^[A-Z2-7]+$", LOWER + "234567", 0.8),
    ("^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER, 0.95),
    ("^[0-9A-Za-z]+$", DIGITS + LOWER + LOWER.upper(), 1.0),
    ("", DIGITS + LOWER + LOWER.upper() + "+/", 1.0),
)
#: How often two letters of ordinary identifiers agree, and three.
AGREE_TWO, AGREE_THREE = 0.065, 0.0065
TENTHS = 400  # bins of the evidence, in tenths of a decimal power

SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def matches(text: Column, pattern: str, rank: int, keep: Body | None = None) -> Column:
    """Leftmost non-overlapping matches as spans; ``keep`` says which of the matched strings count.

    A match begins where the text between matches, and the matches before it, end. These sums are taken over blocks
    of about the root of the number of matches, so a long text full of matches does not cost its square.
    """

    def spans(s: Column) -> Column:
        n = F.size(s["m"])
        steps = F.zip_with(F.slice(s["g"], F.lit(1), n), F.transform(s["m"], F.length), lambda a, b: a + b)
        block = F.ceil(F.sqrt(n)).cast("int")
        return let(F.struct(steps.alias("d"), block.alias("c"), s["m"].alias("m"), s["g"].alias("g")), with_blocks)

    def with_blocks(s: Column) -> Column:
        c, d = s["c"], s["d"]
        blocks = F.sequence(F.lit(0), (F.floor((F.size(d) - 1) / c)).cast("int"))
        sums = F.transform(blocks, lambda k: total(F.slice(d, k * c + 1, c)))
        bases = F.aggregate(
            sums, F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x)
        )
        bound = F.struct(bases.alias("b"), c.alias("c"), d.alias("d"), s["m"].alias("m"), s["g"].alias("g"))
        return let(bound, placed)

    def placed(s: Column) -> Column:
        def one(i: Column) -> Column:
            k = F.floor(i / s["c"]).cast("int")
            inside = F.slice(s["d"], k * s["c"] + 1, F.pmod(i, s["c"]))
            begin = F.get(s["b"], k) + total(inside) + F.get(s["g"], i)
            return let(
                F.struct(begin.alias("start"), F.get(s["m"], i).alias("value")),
                lambda x: F.struct(
                    x["start"].alias("start"),
                    F.lit(rank).alias("rank"),
                    (x["start"] + F.length(x["value"])).alias("end"),
                    x["value"].alias("value"),
                ),
            )

        return F.transform(F.sequence(F.lit(0), F.size(s["m"]) - 1), one)

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.transform(F.split(text, pattern, -1), F.length).alias("g"),
    )
    out = F.when(text.rlike(pattern), let(found, spans)).otherwise(F.expr(f"CAST(array() AS {SPAN})"))
    return F.filter(out, lambda x: keep(x["value"])) if keep else out


def base_spans(text: Column) -> Column:
    """Spans of the known forms: assignments with a value of 8 characters or more, access keys, long hex strings."""
    return F.concat(
        matches(text, ASSIGN, 0, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 8),
        matches(text, ACCESS, 1),
        matches(text, HEX, 2),
    )


# ---- the battery --------------------------------------------------------------------------------------


def upper_tail(z: Column) -> Column:
    """Share of the normal distribution above z (Abramowitz and Stegun 26.2.17), for z of either sign."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * F.abs(z))
    poly = F.lit(0.0)
    for a in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = (poly + F.lit(a)) * t
    above = poly * F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return F.when(z >= 0, above).otherwise(1.0 - above)


def battery(value: Column) -> Column:
    """The tests of one string under the narrowest encoding that fits it.

    chi: letters against a uniform alphabet, as a normal deviate (Wilson and Hilferty, 1931). runs: stretches of low
    and high letters (Wald and Wolfowitz, 1940). serial: correlation of neighbours. ``random`` is the chance that a
    random string does no better on the three together. ``evidence`` is minus the decimal logarithm of the chance
    that an ordinary identifier of this length stays within the alphabet and repeats its letters so seldom, so it
    grows with length.
    """
    choice = None
    for pattern, alphabet, share in ENCODINGS:
        k = len(alphabet)
        enc = F.struct(
            F.lit(alphabet).alias("alphabet"), F.lit("0" * (k // 2) + "1" * (k - k // 2)).alias("halves"),
            F.lit(float(k)).alias("k"), F.lit(-math.log10(share)).alias("narrow"),
        )
        if not pattern:
            choice = choice.otherwise(enc)
        else:
            choice = F.when(value.rlike(pattern), enc) if choice is None else choice.when(value.rlike(pattern), enc)
    folded = F.translate(F.rtrim(value, F.lit("=")), "-_", "+/")

    def coded(s: Column) -> Column:
        c, e = s["c"], s["e"]
        n = F.length(c).cast("double")
        uses = F.transform(F.split(e["alphabet"], ""), lambda a: n - F.length(F.replace(c, a, F.lit(""))))
        squares = F.aggregate(uses, F.lit(0.0), lambda a, x: a + x * x)
        codes = F.transform(F.split(c, ""), lambda x: F.position(x, e["alphabet"]).cast("double"))
        halves = s["h"]
        bound = F.struct(
            n.alias("n"), e["k"].alias("k"), e["narrow"].alias("narrow"), squares.alias("squares"), codes.alias("v"),
            (F.length(halves) - F.length(F.replace(halves, F.lit("1"), F.lit("")))).cast("double").alias("high"),
            ((2 * F.length(halves) - F.length(F.replace(halves, F.lit("01"), F.lit(""))) - F.length(F.replace(halves, F.lit("10"), F.lit("")))) / 2 + 1).alias("runs"),
        )
        return let(bound, with_mean)

    def with_mean(s: Column) -> Column:
        mean = F.aggregate(s["v"], F.lit(0.0), lambda a, x: a + x) / s["n"]
        keep = [s[c].alias(c) for c in ("n", "k", "narrow", "squares", "high", "runs")]
        return let(F.struct(*keep, F.transform(s["v"], lambda x: x - mean).alias("v")), tested)

    def tested(s: Column) -> Column:
        n, k, free = s["n"], s["k"], s["k"] - 1
        chi2 = k * s["squares"] / n - n
        chi = (F.pow(F.greatest(chi2, F.lit(0.0)) / free, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        mean_runs = 1 + 2 * s["high"] * (n - s["high"]) / n
        spread = F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9))
        runs = F.when(s["high"] * (n - s["high"]) > 0, (s["runs"] - mean_runs) / F.sqrt(spread)).otherwise(9.0)
        own = F.aggregate(s["v"], F.lit(0.0), lambda a, x: a + x * x)
        next_ = F.zip_with(F.slice(s["v"], F.lit(2), n.cast("int") - 1), s["v"], lambda a, b: F.coalesce(a * b, F.lit(0.0)))
        serial = F.when(own > 0, (F.aggregate(next_, F.lit(0.0), lambda a, x: a + x) / own + 1 / n) * F.sqrt(n))
        agree = (s["squares"] - n) / (n * (n - 1))
        doubt = 2 * AGREE_TWO * (1 - AGREE_TWO) / (n * (n - 1)) + 4 * (AGREE_THREE - AGREE_TWO**2) / n
        seldom = F.least((AGREE_TWO - agree) / F.sqrt(doubt), F.lit(12.0))
        bound = F.struct(
            n.alias("n"), chi.alias("chi"), runs.alias("runs"), F.coalesce(serial, F.lit(9.0)).alias("serial"),
            (n * s["narrow"] - F.log10(upper_tail(seldom))).alias("evidence"),
        )
        return let(bound, judged)

    def judged(s: Column) -> Column:
        squares = s["chi"] * s["chi"] + s["runs"] * s["runs"] + s["serial"] * s["serial"]
        three = (F.pow(squares / 3, 1 / 3) - (1 - 2 / 27)) / math.sqrt(2 / 27)
        names = ("chi", "runs", "serial", "evidence")
        group = F.floor(F.log2(s["n"])).cast("int").alias("group")
        return F.struct(*[s[c].alias(c) for c in names], upper_tail(three).alias("random"), group)

    def with_encoding(e: Column) -> Column:
        c = F.when(e["k"] <= 36, F.lower(folded)).otherwise(folded)
        return let(F.struct(c.alias("c"), e.alias("e")), coded_with)

    def coded_with(s: Column) -> Column:
        halves = F.call_function("translate", s["c"], s["e"]["alphabet"], s["e"]["halves"])
        return let(F.struct(s["c"].alias("c"), s["e"].alias("e"), halves.alias("h")), coded)

    return let(choice, with_encoding)


def found_in(text: Column) -> Column:
    """A struct of one text's ``base`` spans and its tested ``runs`` that lie in no such span as a whole."""

    def tested(s: Column) -> Column:
        apart = F.filter(
            s["runs"], lambda r: ~F.exists(s["base"], lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"]))
        )

        def with_test(r: Column) -> Column:
            return F.struct(*_fields(r), battery(r["value"]).alias("test"))

        return F.struct(F.array_sort(s["base"]).alias("base"), F.transform(apart, with_test).alias("runs"))

    return let(F.struct(base_spans(text).alias("base"), matches(text, RUN, 3).alias("runs")), tested)


def _fields(r: Column) -> list[Column]:
    return [r[c].alias(c) for c in ("start", "rank", "end", "value")]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, runs) of every row."""
    return texts(docs, key, text).select(key, found_in(F.col(text)).alias("found")).select(key, "found.*")


def thresholds(found: DataFrame, rate: float = 0.01) -> dict[int, float]:
    """Least evidence by length group (powers of two) that holds false discoveries to ``rate`` of those reported.

    Benjamini and Hochberg (1995) within a group, over all tested runs of the corpus. Evidence is counted in bins of a
    tenth, rounded down, so that the windows see at most 401 rows a group and the driver gets one number for each of
    some thirty groups.
    """
    tests = found.select(F.explode("runs.test").alias("t")).select("t.*")
    bins = F.least(F.floor(F.col("evidence") * 10), F.lit(TENTHS)).cast("int")
    counted = tests.groupBy("group", bins.alias("bin")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("group")
    ranked = counted.select(
        "group", "bin", F.sum("n").over(own.orderBy(F.desc("bin"))).alias("above"), F.sum("n").over(own).alias("tests")
    )
    held = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= rate * F.col("above") / F.col("tests"))
    return {g: b / 10 for g, b in held.groupBy("group").agg(F.min("bin")).collect()}


def discovered(runs: Column, least: dict[int, float], alike: float = 0.001) -> Column:
    """Spans of the runs that pass for random and have the evidence that their length group asks for."""

    def passes(r: Column) -> Column:
        bar = F.lit(float("inf"))
        for group, value in least.items():
            bar = F.when(r["test"]["group"] == group, F.lit(float(value))).otherwise(bar)
        return (r["test"]["random"] >= alike) & (r["test"]["evidence"] >= bar)

    return F.transform(F.filter(runs, passes), lambda r: F.struct(*_fields(r)))


def spelled(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """(key, base, added) of every row; null and empty texts have no spans. Repeated rows are scanned each."""
    found = cut(scan(docs, key, text))
    return found.select(key, "base", discovered(F.col("runs"), thresholds(found, rate)).alias("added"))


def redact(docs: DataFrame, text: str = "text", rate: float = 0.01, mark: str = "[secret]") -> DataFrame:
    """The rows with every span replaced by a mark; a null text stays null, and so do other columns as they are.

    Spans that overlap become one mark. A first pass tests the runs, for the thresholds; the second finds them again
    beside the text, which so is never shuffled.
    """
    col = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    least = thresholds(docs.select(found_in(col)["runs"].alias("runs")), rate)

    def step(a: Column, s: Column) -> Column:
        gap = F.struct(a["end"].alias("start"), s["start"].alias("end"))
        gaps = F.when(s["start"] >= a["end"], F.array_append(a["gaps"], gap)).otherwise(a["gaps"])
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"), gaps.alias("gaps"))

    def kept(a: Column) -> Column:
        parts = F.transform(a["gaps"], lambda g: F.substring(col, g["start"] + 1, g["end"] - g["start"]))
        last = F.substring(col, a["end"] + 1, F.length(col))
        return F.array_join(F.concat(parts, F.array(last)), mark)

    def marked(f: Column) -> Column:
        spans = F.array_sort(F.concat(f["base"], discovered(f["runs"], least)))
        none = F.expr("named_struct('end', 0, 'gaps', CAST(array() AS array<struct<start:int,end:int>>))")
        return F.when(F.size(spans) > 0, let(F.aggregate(spans, none, step), kept)).otherwise(col)

    return docs.withColumn(text, F.when(F.col(f"`{text}`").isNotNull(), let(found_in(col), marked)))
