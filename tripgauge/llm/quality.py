"""Quality by Bradley-Terry pairwise ranking.

Of a good and a bad document the good one should score higher. Weights of text features
are fitted on such pairs by logistic loss on the difference of their features; the
score's quantile at the share of bad documents is the threshold. Features are shares and
logs of what a text is made of, each cut into bins at quantiles of the sample, so that the
sum of weights can rise and fall along a feature.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import held_out, stage
from tripgauge.llm.labels import FIT_ROWS, first_ids, known, one_text_of_each

BINS = 12
PAIRS_PER_ROW = 6
# The score that stands for the threshold.
CUT = 0.7
# The threshold's rank is off by at most one in so many rows.
ACCURACY = 100_000

_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a"):ord("z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HIGH = np.zeros(256, bool)
_HIGH[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord(",")]] = True
_SIGN = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH | _STOP)
_OWN = [np.array([ord(c)]) for c in "|!:<@/"]


def features(text: str | None) -> list[float]:
    """What the score looks at; null counts as empty."""
    data = (text or "").encode()
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, size, solid = len(words), len(data), max(1, int(count[~_SPACE].sum()))
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = max(1, int(count[_UPPER | _LOWER].sum()))
    distinct = len(set(words))
    ends = sum(w[-1] in b".!?" for w in words)
    return [
        np.log1p(n),
        size / max(1, n),
        distinct / max(1, n),
        distinct / max(1.0, n ** 0.5),
        sum(map(eq, words, words[1:])) / max(1, n),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(size / max(1, len(lines))),
        count[_UPPER].sum() / letters,
        count[_DIGIT].sum() / solid,
        count[_SIGN].sum() / solid,
        count[_HIGH].sum() / solid,
        count[_STOP].sum() / max(1, n),
        ends / max(1, n),
        sum(len(w) == 1 for w in words) / max(1, n),
        np.log1p(max(map(len, words), default=0)),
        *[float(count[c].sum()) / max(1, n) for c in _OWN],
    ]


N_FEATURES = len(features(""))


@dataclass
class Ranking:
    """``edges``: bin edges of each feature; ``weights``: of each bin; ``cut`` and ``slope``:
    the raw score at the threshold, and how steeply it maps to 0..1."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    slope: float = 1.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        return sum((self.weights[j][b[:, j]] for j in range(b.shape[1])), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_ranking(x: np.ndarray, label: np.ndarray, bins: int = BINS, seed: int = 11) -> Ranking:
    """Fit on feature rows and labels. With one kind of label only, all score alike."""
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    edges = np.quantile(x, quantiles, axis=0).T if len(x) else np.zeros((x.shape[1], bins - 1))
    model = Ranking(edges, np.zeros((x.shape[1], bins)))
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label != 1)
    if not len(good) or not len(bad):
        return model
    random = np.random.default_rng(seed)
    one_hot = (model.bins(x)[:, :, None] == np.arange(bins)).reshape(len(x), -1).astype(np.float32)
    n = PAIRS_PER_ROW * len(x)
    first, second = random.choice(good, n), random.choice(bad, n)
    w, ridge, block = np.zeros(one_hot.shape[1]), 1e-3 * n, 20_000
    for _ in range(12):  # Newton steps on the pairs, block by block
        grad, hess = -ridge * w / n * 1.0, np.eye(len(w)) * ridge / n
        for i in range(0, n, block):
            d = (one_hot[first[i:i + block]] - one_hot[second[i:i + block]]).astype(float)
            p = 1 / (1 + np.exp(-np.clip(d @ w, -50, 50)))
            grad = grad + d.T @ (1 - p) / n
            hess += d.T @ (d * (p * (1 - p))[:, None]) / n
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w.reshape(x.shape[1], bins)
    raw = model.raw(x)
    model.cut = float(np.quantile(raw, len(bad) / len(x)))
    return model


def quality_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Ranking:
    """Fit on a bounded sample of the labelled rows that aren't held out; only its features reach
    the driver. The threshold is the quantile of the scores of all of them, at the share of those
    not labelled 1."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    # Measured before they meet their labels: features and a digest move, not texts.
    text = F.coalesce("text", F.lit(""))
    learned = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    seen = learned.select("doc_id", F.xxhash64(text).alias("text_hash"), measured(text).alias("x"))
    every = stage(
        seen.join(known(labels, "quality"), "doc_id")
        .select("doc_id", "label", F.xxhash64("label", "text_hash").alias("h"), "x"),
        "quality-features",
    )
    sample = one_text_of_each(every.join(first_ids(every, rows), "doc_id", "left_semi"))
    found = sample.select("x", "label").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(len(found), N_FEATURES)
    label = found["label"].to_numpy(int)
    order = np.lexsort((*x.T, label))  # the fit doesn't depend on the order of arrival
    model = fit_ranking(x[order], label[order])

    @F.pandas_udf("double")
    def raw(xs: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.array(xs.tolist(), float).reshape(len(xs), N_FEATURES)), dtype="float64")

    bad, n = every.agg(F.count_if(F.col("label") != 1), F.count(F.lit(1))).head()
    if 0 < bad < n:
        model.cut = every.agg(F.percentile_approx(raw("x"), bad / n, ACCURACY)).head()[0]
    return model


def score_quality(docs: DataFrame, model: Ranking, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1, at least ``CUT`` above the threshold. Null and
    empty texts get one too; a column of that name is replaced."""

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), N_FEATURES)
        return pd.Series(model.score(x), dtype="float64")

    return docs.withColumn(score, quality(F.col(text)))
