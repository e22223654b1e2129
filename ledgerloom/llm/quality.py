"""Quality scores by positive-unlabelled learning: trusted positives, unlabelled web text, an estimated class prior."""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bucket, cut, hashed_sample, named, texts, without

#: Classes of bytes whose shares describe the look of a text.
BYTE_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" ", "line": b"\n\r",
    "stop": b".,;:", "shout": b"!?", "bar": b"|", "sign": b"#$%&*@^~=+<>\\", "bracket": b"()[]{}", "quote": b"'\"`-_/",
    "control": [*range(9), *range(14, 32), 127], "high": range(128, 256),
}
_OF_BYTE = np.zeros((256, len(BYTE_CLASSES)))
for _i, _class in enumerate(BYTE_CLASSES.values()):
    _OF_BYTE[list(_class), _i] = 1
N_FEATURES = len(BYTE_CLASSES) + 11


def describe(text: str) -> list[float]:
    """Shares and ratios of a whole text, whatever its language. The empty text is all zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * N_FEATURES
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts[counts > 0] / len(raw)
    words = text.split()
    n = max(1, len(words))
    uses = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = Counter(w[-1] for w in uses)
    signs = sum(k for c, k in ends.items() if not c.isalnum() and c not in ".,;:")
    return [
        *np.sqrt(counts @ _OF_BYTE / len(raw)),
        math.log1p(len(raw)) / 10,
        math.log1p(len(words)) / 10,
        float(-(share * np.log2(share)).sum()) / 8,
        len(text) / n / 20,
        len(uses) / n,
        math.log1p(len(uses)) / math.log1p(n) if words else 0.0,
        max(uses.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)),
        signs / max(1, len(uses)),
        math.log1p(n / max(1, len(lines))) / 10,
    ]


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features) of every whole text; neither labels nor other columns are looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.array([describe(t) for t in batch.column(1).to_pylist()], np.float32).reshape(-1, N_FEATURES)
            ends = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * N_FEATURES)
            lists = pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "features"])

    kind = docs.schema[key].dataType.simpleString()
    return texts(docs, key, text).mapInArrow(run, f"{key} {kind}, features array<float>")


# ---- the model ----------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float = 0.5

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


def _train(p: np.ndarray, u: np.ndarray, prior: float | None, hidden: int, steps: int, seed: int) -> Model:
    """Adam on the non-negative risk; without a prior, on plain logistic loss of positives against unlabelled.

    Risk: prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]). While the second term is negative in a
    step, the step goes up on that term alone (Kiryo et al., 2017).
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    w = [rng.normal(0, 0.3, (both.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    model, m, v = Model(mean, scale, w), [0 * x for x in w], [0 * x for x in w]
    ps, us = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    for step in range(1, steps + 1):
        bp, bu = ps[rng.integers(0, len(ps), 512)], us[rng.integers(0, len(us), 512)]
        hp, hu = (np.tanh(b @ w[0] + w[1]) for b in (bp, bu))
        sp, su = (_sigmoid(h @ w[2] + w[3][0]) for h in (hp, hu))
        if prior is None:
            dp, du = (sp - 1) / len(sp), su / len(su)
        else:
            lost_u, lost_p = -np.log(1 - su + 1e-9).mean(), -np.log(1 - sp + 1e-9).mean()
            if lost_u - prior * lost_p >= 0:
                dp, du = prior * (sp - 1) / len(sp) - prior * sp / len(sp), su / len(su)
            else:
                dp, du = prior * sp / len(sp), -su / len(su)
        grads = [0 * x for x in w]
        for b, h, d in ((bp, hp, dp), (bu, hu, du)):
            back = np.outer(d, w[2]) * (1 - h * h)
            for i, g in enumerate((b.T @ back, back.sum(0), h.T @ d, np.array([d.sum()]))):
                grads[i] += g
        rate = 0.01 * (1 - step / (steps + 1))
        for i in range(4):
            g = grads[i] + 1e-4 * w[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return model


def class_prior(p_scores: np.ndarray, u_scores: np.ndarray, doubt: float = 0.1) -> float:
    """Share of positives among the unlabelled: best bin estimation (Garg et al., 2021) on scores not trained on.

    Above some score nearly all unlabelled rows are positives, so there the tails' ratio bounds the share from above.
    The bound is taken where its confidence interval is lowest.
    """
    grid = np.unique(p_scores)
    tail_p = 1 - np.searchsorted(np.sort(p_scores), grid) / len(p_scores)
    tail_u = 1 - np.searchsorted(np.sort(u_scores), grid) / len(u_scores)
    slack = math.sqrt(math.log(4 / doubt) / 2 / len(u_scores)) + math.sqrt(math.log(4 / doubt) / 2 / len(p_scores))
    best = np.argmin((tail_u + slack) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def fit(p: np.ndarray, u: np.ndarray, hidden: int = 16, steps: int = 1500, seed: int = 7) -> Model | None:
    """None without positives or without unlabelled rows: then there is nothing to tell them apart by."""
    if len(p) < 2 or len(u) < 2:
        return None
    sorter = _train(p[::2], u[::2], None, hidden, steps // 2, seed)
    prior = class_prior(sorter.logits(p[1::2]), sorter.logits(u[1::2]))
    model = _train(p, u, prior, hidden, steps, seed)
    model.prior = prior
    return model


# ---- jobs ---------------------------------------------------------------------------------------------


def held_out(key: str = "doc_id") -> Column:
    return bucket(key, 3) == 1


def samples(found: DataFrame, labels: DataFrame, key: str, fit_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of at most ``fit_rows`` trusted positives, and as many rows without a label; none is held out.

    Rows are taken in the order of a hash of their key, so the choice is the same in every run. A key with
    several labels counts as its lowest.
    """
    labels = labels.groupBy(key).agg(F.min("quality").alias("label"))
    rows = found.where(~held_out(key)).join(labels, key, "left")

    trusted, unknown = F.col("label") == 1, F.col("label").isNull()
    totals = rows.agg(F.count_if(trusted), F.count_if(unknown)).first()

    def take(which: Column, total: int) -> np.ndarray:
        taken = hashed_sample(rows.where(which), total, fit_rows, key).select("features").collect()
        return np.array([r[0] for r in taken], np.float64).reshape(-1, N_FEATURES)

    return take(trusted, totals[0]), take(unknown, totals[1])


def score(found: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, score) from features; without a model every score is one half."""
    kind = found.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)
            values = np.full(len(x), 0.5) if model is None else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=[key, "score"])

    return found.select(key, "features").mapInArrow(run, f"{key} {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", fit_rows: int = 20_000) -> DataFrame:
    """(key, held_out, score, predicted) of every row; null and empty texts are scored as the empty text.

    Texts are read once, for their features. The model is fitted on the driver, from at most ``fit_rows`` rows of
    either kind, the bound on what is gathered there. Labels of 0 are not used: the method learns from positives and
    unlabelled text.
    """
    found = cut(features(docs, key, text))
    model = fit(*samples(found, labels, key, fit_rows))
    scored = score(found, model, key).withColumn("held_out", held_out(key))
    return scored.select(key, "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", fit_rows: int = 20_000) -> DataFrame:
    """The rows that are predicted to be good, each judged by its own text; those without a key stay.

    The columns are those of ``docs``; the model is that of ``classify``.
    """
    found = cut(features(named(docs, key, text), "row", text))
    model = fit(*samples(found.select(F.col("row.key").alias(key), "features"), labels, key, fit_rows))
    return without(docs, score(found, model, "row").where("score < 0.5"), key, text)
