"""Licence scans in DataFrame functions alone: a trained paragraph classifier, confirmed by comparing with templates."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, hashed_sample, let, ready, texts

#: Notices by licence family, as their texts or their usual short forms have them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under the Creative Commons Zero 1.0 Universal dedication.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Paragraphs that speak of licences or rights without granting one of these.
OTHERS = (
    "All rights reserved.", "Copyright 2021 by the authors.", "See the license file for details.", "Terms of use apply.",
    "He lost his driving licence last year.", "The licence plate of the car was new.", "A fishing license is needed here.",
    "Permission denied by the system.", "No warranty is given for old cars.", "This work is licensed under its own terms.",
    "The public domain was debated by the house.", "Our general public was asked about the new version.",
    "The software license costs ten dollars per month.", "License fees are due in March.", "Licensed to carry passengers.",
    "The film was released under a new title.", "Version 2.0 of the program was released.", "Copyright infringement claims rose.",
    "Licensed under a commercial agreement, contact the vendor.", "Released under embargo until Monday.",
    "Redistribution of wealth was a theme of the talk.", "The license of the restaurant was revoked.",
    "Under the license of the king the town grew.", "Sublicense rights are not granted to any third party.",
)
UNKNOWN = "unknown"
#: Short headings and identifiers of the families.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License (MIT)", "Released under MIT licence.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Apache-2.0", "Apache License 2.0", "Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"),
    "GPL": ("GPLv3", "GPL-2.0-or-later", "GNU GPL v2", "GNU General Public License", "Released under GPLv2.", "SPDX-License-Identifier: GPL-3.0-only"),
    "LGPL": ("LGPLv3", "LGPL-2.1-or-later", "GNU LGPL", "GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-only"),
    "AGPL": ("AGPLv3", "AGPL-3.0-or-later", "GNU AGPL", "GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": ("BSD License", "BSD-3-Clause", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "ISC": ("ISC License", "The ISC License (ISC)", "SPDX-License-Identifier: ISC"),
    "MPL": ("MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY": ("CC-BY-4.0", "CC BY 4.0", "CC BY 3.0", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": ("CC-BY-SA-4.0", "CC BY-SA 4.0", "CC BY-SA 3.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC": ("CC-BY-NC-4.0", "CC BY-NC 4.0", "CC BY-NC 3.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC0": ("CC0", "CC0-1.0", "CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"),
    "Unlicense": ("The Unlicense", "Unlicense", "SPDX-License-Identifier: Unlicense"),
}
#: Words and word pairs of which a heading of the family has at least one.
NAMES = {
    "MIT": ("mit license", "mit licence", "identifier mit"), "Apache-2.0": ("apache 2", "apache license"),
    "GPL": ("gpl", "gplv", "gnu general"), "LGPL": ("lgpl", "lgplv", "gnu lesser"), "AGPL": ("agpl", "agplv", "gnu affero"),
    "BSD": ("bsd license", "bsd 2", "bsd 3"), "ISC": ("isc license", "identifier isc"), "MPL": ("mpl", "mozilla public"),
    "CC-BY": ("cc by",), "CC-BY-SA": ("by sa",), "CC-BY-NC": ("by nc",), "CC0": ("cc 0",), "Unlicense": ("unlicense",),
}
#: Words that a heading may have beside its family's own.
FILLER = ("the", "this", "project", "work", "is", "license", "licence", "licensed", "released", "under", "spdx", "identifier", "version", "v")
CERTAIN, CLOSE = 0.5, 0.8
LEADS = ("", "This project is free. ", "Copyright (c) 2020 The Authors. ", "Notice: ")
TAILS = ("", " All rights reserved.", " Thanks to all contributors.")


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit("[a-z]+|[0-9]+"), F.lit(0))


def ngrams(paragraph: Column, longest: int = 3) -> Column:
    """Distinct runs of one to ``longest`` words."""

    def runs_of(w: Column, n: int) -> Column:
        count = F.size(w) - (n - 1)
        starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.expr("CAST(array() AS array<int>)"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))

    def runs(w: Column) -> Column:
        return F.array_distinct(F.concat(w, *[runs_of(w, n) for n in range(2, longest + 1)]))

    return let(words(paragraph), runs)


def _strings(values: Iterable[str]) -> Column:
    return F.array(*map(F.lit, values))


def _pairs(body: str) -> list[str]:
    """Word pairs of a template, as ``ngrams`` makes them."""
    w = re.findall("[a-z]+|[0-9]+", body.lower())
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def _shortest() -> int:
    """Word pairs of the shortest template: a piece of fewer may be in any text."""
    return min(len(_pairs(b)) for bodies in TEMPLATES.values() for b in bodies)


def possible(paragraph: Column, close: float = CLOSE) -> Column:
    """Whether a paragraph can be confirmed at all: exact, since it counts what confirmation asks for at least.

    A paragraph close to a template has ``close`` of the shortest template's number of word pairs, at least; a heading
    has a name of its family. What holds for a stretch of a text holds for the whole text: more lines bring more words
    and pairs and take none away. Each word and pair is looked up in a fixed set.
    """
    known = sorted({p for bodies in TEMPLATES.values() for b in bodies for p in _pairs(b)})
    names = sorted({n for ns in NAMES.values() for n in ns})
    alone, double = [n for n in names if " " not in n], [n for n in names if " " in n]
    wanted = sorted({*known, *double})
    firsts, seconds = (sorted({p.split()[i] for p in wanted}) for i in (0, 1))

    def pair(a: Column, b: Column) -> Column:  # null where the two words are in no pair that is looked for
        return F.when(a.isin(firsts), F.when(b.isin(seconds), F.concat(a, F.lit(" "), b)))

    def judge(seen: Column) -> Column:
        template = F.size(F.filter(seen, lambda p: p.isin(known))) >= close * _shortest()
        return template | F.exists(seen, lambda p: p.isin(double))

    def test(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, 2, F.size(w)), pair)
        seen = F.array_distinct(F.filter(pairs, lambda p: p.isin(wanted)))
        return F.arrays_overlap(w, _strings(alone)) | let(seen, judge)

    return let(words(paragraph), test)


def _parts(text: str) -> Column:
    """All units of a text as (unit, paragraph, body)."""

    def numbered(parts: Column, unit: str) -> Column:
        return F.transform(parts, lambda body, i: F.struct(F.lit(unit).alias("unit"), i.alias("paragraph"), body.alias("body")))

    lines = numbered(F.split(text, "\n"), "line")
    blocks = F.filter(numbered(F.split(text, r"\n(?:[ \t\r]*\n)+"), "block"), lambda b: F.trim(b["body"]).contains("\n"))
    return F.concat(lines, blocks)


def units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, unit, paragraph, body): every line of the whole texts, and every block of several lines up to a blank one.

    Each kind is numbered from 0.
    """
    return texts(docs, key, text).select(key, F.inline(_parts(text)))


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines and blocks that can be confirmed as some licence.

    Only texts that could hold one are taken apart, and a unit that is all of its text is not tested again.
    """
    rows = texts(docs, key, text).where(possible(F.col(text)))
    parts = rows.select(key, F.length(text).alias("_whole"), F.inline(_parts(text)))
    return parts.where((F.length("body") == F.col("_whole")) | possible(F.col("body"))).drop("_whole")


# ---- training -------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Vocabulary, family classifier, and the calibration of its belief that a family is known."""

    vocabulary: CountVectorizerModel
    families: LogisticRegressionModel
    names: list[str]
    slope: float
    offset: float


def examples(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", fit_docs: int = 300
) -> DataFrame:
    """(label, body): variants of the templates and headings, and as unknown the other paragraphs and ordinary lines.

    Ordinary lines are those that no template could confirm in at most ``fit_docs`` documents, taken in the order of a hash of key
    and text: the bound on what the classifier is fitted on.
    """
    rows = []
    for label, bodies in TEMPLATES.items():
        for body in bodies:
            rows += [(label, lead + body + tail) for lead in LEADS for tail in TAILS]
            part = body.split()
            if len(part) >= 16:
                half = len(part) // 2
                rows += [(label, " ".join(part[:half])), (label, " ".join(part[half:])), (label, " ".join(part[half // 2 : -half // 2]))]
    rows += [(label, lead + body) for label, bodies in HEADINGS.items() for body in bodies for lead in ("", "This project is under ", "License: ")]
    rows += [(UNKNOWN, lead + body + tail) for body in OTHERS for lead in LEADS for tail in TAILS]
    fixed = spark.createDataFrame(rows, "label string, body string").coalesce(1)
    some = hashed_sample(texts(docs, key, text), docs.count(), fit_docs, key, text)
    lines = some.select(F.explode(F.split(text, "\n")).alias("body")).where(~possible(F.col("body")))
    return fixed.unionByName(lines.select(F.lit(UNKNOWN).alias("label"), "body"))


def train(found: DataFrame, steps: int = 60) -> Model:
    """Multinomial logistic regression on word n-grams of two thirds, calibrated on the rest.

    Calibration (Platt, 1999): a logistic function of the log odds of any family against unknown, fitted on rows that
    the classifier has not seen.
    """
    names = [UNKNOWN, *TEMPLATES]
    index = F.array_position(F.array(*map(F.lit, names)), F.col("label")) - 1
    rows = cut(found.select(index.cast("double").alias("label"), ngrams(F.col("body")).alias("grams"), (F.pmod(F.xxhash64("body"), F.lit(3)) == 0).alias("later")))
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2, vocabSize=1 << 16).fit(rows)
    vectors = vocabulary.transform(rows)
    base = LogisticRegression(maxIter=steps, regParam=0.001, family="multinomial", featuresCol="features", labelCol="label")
    trial = base.fit(vectors.where("NOT later"))
    odds = _odds(trial.transform(vectors.where("later")))
    held = odds.select(F.col("odds"), (F.col("label") > 0).cast("double").alias("known"))
    line = _platt(held)
    return Model(vocabulary, base.fit(vectors), names, *line)


def _odds(scored: DataFrame) -> DataFrame:
    """With the log odds that some family is meant."""
    p = vector_to_array("probability")
    unknown = F.greatest(F.least(F.get(p, F.lit(0)), F.lit(1 - 1e-12)), F.lit(1e-12))
    return scored.withColumns({"p": p, "odds": F.log((1 - unknown) / unknown)})


def _platt(held: DataFrame, rounds: int = 20) -> tuple[float, float]:
    """Slope and offset by Newton steps; each is one aggregate over the held rows."""
    slope, offset = 1.0, 0.0
    held = cut(held)
    for _ in range(rounds):
        q = 1 / (1 + F.exp(-(slope * F.col("odds") + offset)))
        e, w, x = q - F.col("known"), F.greatest(q * (1 - q), F.lit(1e-9)), F.col("odds")
        sums = held.agg(*[F.sum(v) for v in (e * x, e, w * x * x, w * x, w)]).first()
        if sums[0] is None:
            break
        gx, g1, hxx, hx1, h11 = (*sums[:2], sums[2] + 1e-3, sums[3], sums[4] + 1e-3)
        gx += 1e-3 * (slope - 1)
        g1 += 1e-3 * offset
        det = hxx * h11 - hx1 * hx1
        slope -= (h11 * gx - hx1 * g1) / det
        offset -= (hxx * g1 - hx1 * gx) / det
        if abs(gx) + abs(g1) < 1e-6:
            break
    return float(slope), float(offset)


# ---- scanning -------------------------------------------------------------------------------------------


def closeness(lines: DataFrame, family: str = "guess", body: str = "body") -> Column:
    """How surely a paragraph is the family's: like its nearest template, or like a heading, whichever is more.

    A template: how much of the shorter of the two is in the other, by word pairs, which count as the shortest
    template's if they are fewer. A heading: of a paragraph that has a
    name of the family, how many of its words are numbers, filler, or in the family's headings.
    """

    def nearest(grams: Column) -> Column:
        mine, own = F.filter(grams, lambda g: g.contains(" ")), F.filter(grams, lambda g: ~g.contains(" "))
        out = F.lit(0.0)
        for name, bodies in TEMPLATES.items():
            values = []
            for b in bodies:
                theirs = _strings(_pairs(b))
                both = F.size(F.array_intersect(mine, theirs))
                values.append(both / F.greatest(F.least(F.size(mine), F.size(theirs)), F.lit(_shortest())))
            allowed = sorted({w for h in HEADINGS[name] for w in re.findall("[a-z]+", h.lower())} | set(FILLER))
            fitting = F.size(F.array_intersect(own, _strings(allowed))) + F.size(F.filter(own, lambda w: w.rlike("^[0-9]")))
            values.append(F.when(F.arrays_overlap(grams, _strings(NAMES[name])), fitting / F.size(own)).otherwise(0.0))
            out = F.when(F.col(family) == name, F.greatest(*values)).otherwise(out)
        return out

    return let(ngrams(F.col(body), 2), nearest)


def classify(lines: DataFrame, model: Model, certain: float = CERTAIN, close: float = CLOSE) -> DataFrame:
    """The lines with family, guess, probability and similarity.

    guess is the likeliest family, probability the calibrated belief that any is meant. The family is the guess if
    the belief is ``certain`` and a template or heading is ``close``; else it is unknown.
    """
    scored = _odds(model.families.transform(model.vocabulary.transform(lines.withColumn("grams", ngrams(F.col("body"))))))
    families = F.slice("p", 2, len(model.names) - 1)
    best = F.array_position(families, F.array_max(families)).cast("int")
    guess = F.get(F.array(*map(F.lit, model.names)), best)
    belief = 1 / (1 + F.exp(-(model.slope * F.col("odds") + model.offset)))
    out = scored.select(*lines.columns, guess.alias("guess"), belief.alias("probability"))
    out = out.withColumn("similarity", closeness(out))
    sure = (F.col("probability") >= certain) & (F.col("similarity") >= close)
    return out.withColumn("family", F.when(sure, F.col("guess")).otherwise(UNKNOWN))


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", fit_docs: int = 300) -> DataFrame:
    """(key, unit, paragraph, body, guess, probability, similarity, family) of lines and blocks believed to be a licence.

    Every line and every block of several lines is tested; those whose belief is below one half, and those that cannot
    be confirmed at all, are left out. A notice on a line of its own within a block may be found as both. Null and empty
    texts have none; repeated rows give their paragraphs each. The classifier is trained here, on the templates and a
    bounded sample of ordinary lines.
    """
    spark = ready(docs.sparkSession)
    model = train(examples(spark, docs, key, text, fit_docs))
    return classify(paragraphs(docs, key, text), model).where(F.col("probability") >= CERTAIN)
