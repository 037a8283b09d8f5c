"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms, look-alike letters of other scripts and
digits or signs that stand for letters become plain letters. An Aho-Corasick automaton
then finds every term of the lexicon in one pass. A hit inside an exception phrase does
not count. The weights of the others add up, are set against the length of the text, and
a logistic curve turns that into a score.

Terms are learned from labelled texts: whole words, or beginnings of words for families
of them, that occur far more often in toxic texts. Counting runs on Spark; what reaches
the driver is the list of candidates above the support, cut at ``MOST_TERMS`` best.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.labels import FIT_ROWS, fit_sample

MOST_TERMS = 5000
LEAST_SUPPORT = 4
LEAST_WEIGHT = 2.5
# Words remembered folded.
MEMORY = 200_000
STEMS = range(4, 9)
EDGES = ".,;:!?\"'()[]{}<>*#%&$-_/\\…«»„“”‘’¿¡|~`^+="

# Letters of other scripts that look like Latin ones.
LOOK_ALIKE = dict(zip(
    "аеорсухіјѕԁһкмтвнԛԝαορυνικτεγ",
    "aeopcyxijsdhkmtbhqwaopuviktey",
    strict=True,
))
# Digits and signs written for letters. i, l and 1 count as one letter.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "l": "i", "|": "i"}
INVISIBLE = "​‌‍⁠﻿­"
_LETTERS = str.maketrans({**LOOK_ALIKE, **{c: None for c in INVISIBLE}})
_SIGNS = str.maketrans(SIGNS)


class _Folded(dict):
    """Folded words by the word as written, made when first asked for."""

    def __missing__(self, word: str) -> str:
        folded = fold_word(word)
        if len(word) <= 64:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = folded
        return folded


_folded = _Folded()


def fold_word(word: str) -> str:
    """A word folded, without punctuation around it; empty where nothing is left."""
    if not word.isascii():
        word = unicodedata.normalize("NFKC", word)
    word = word.lower()
    if not word.isascii():
        word = word.translate(_LETTERS)
    word = word.strip(EDGES)
    # A number stays one; signs become letters only beside letters.
    return word if word.isdigit() else word.translate(_SIGNS)


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    return [w for w in map(_folded.__getitem__, (text or "").split()) if w]


def joined(words: list[str]) -> str:
    """Words with a space on both sides, so that a term may ask for a word's border."""
    return f" {' '.join(words)} "


@dataclass
class Lexicon:
    """``terms``: weight by folded term; one that begins and ends with a space is a
    whole word or phrase, one that only begins with it is a beginning. ``exceptions``: folded
    phrases in which terms don't count. ``curve``: constant, slope of the log of the
    weight, slope of the log of the weight per 100 words."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-3.0, 1.5, 0.5)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"terms": self.terms, "exceptions": self.exceptions, "curve": self.curve, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                found.add_word(term, (len(term), weight, False))
            for phrase in self.exceptions:
                found.add_word(phrase, (len(phrase), 0.0, True))
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def measure(self, text: str | None) -> tuple[float, int]:
        """Weight of all hits, and the number of words."""
        words = fold(text)
        automaton = self.automaton()
        if not words or not len(automaton):
            return 0.0, len(words)
        hits, spared = [], []
        for end, (size, weight, exception) in automaton.iter(joined(words)):
            (spared if exception else hits).append((end - size + 1, end, weight))
        if spared:
            # The end that any exception starting so far reaches.
            spared.sort()
            starts, reach = [s for s, _, _ in spared], np.maximum.accumulate([e for _, e, _ in spared])
            at = np.searchsorted(starts, [s for s, _, _ in hits], side="right") - 1
            hits = [h for h, i in zip(hits, at, strict=True) if i < 0 or h[1] > reach[i]]
        # Of terms that begin at one place the heaviest counts.
        best: dict[int, float] = {}
        for start, _, weight in hits:
            best[start] = max(weight, best.get(start, 0.0))
        return sum(best.values()), len(words)

    def features(self, text: str | None) -> tuple[float, float]:
        weight, words = self.measure(text)
        return math.log1p(weight), math.log1p(100.0 * weight / max(words, 1))

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, a + b * x + c * y))))


def folded_phrase(phrase: str) -> str:
    return joined(fold(phrase))


def learn_lexicon(
    sample: DataFrame,
    exceptions: tuple[str, ...] = (),
    least_support: int = LEAST_SUPPORT,
    least_weight: float = LEAST_WEIGHT,
    most_terms: int = MOST_TERMS,
) -> Lexicon:
    """Learn from ``text, label`` (1: toxic). Without toxic or without other texts the
    lexicon is empty and every score the same low value."""

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                own = set()
                for word in set(fold(text)):
                    own.add(f" {word} ")
                    own.update(f" {word[:n]}" for n in STEMS if len(word) > n)
                (toxic if label else clean).update(own)
            terms = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({
                "term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms],
            })

    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    exceptions = tuple(folded_phrase(p) for p in exceptions)
    if not n_toxic or not n_clean:
        return Lexicon({}, exceptions)
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    counted = (
        sample.mapInPandas(candidates, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("weight", weight)
    )
    found = (
        counted.filter((F.col("toxic") >= least_support) & (F.col("weight") >= least_weight))
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term")
        .limit(most_terms)
        .collect()
    )
    terms = {r["term"]: float(r["weight"]) for r in found}
    # A word needs no entry of its own where a beginning of it weighs as much.
    for term in sorted(terms, key=len, reverse=True):
        word = term.strip()
        if any(terms.get(f" {word[:n]}", -1.0) >= terms[term] for n in STEMS if n < len(word)):
            del terms[term]
    stems = [t for t in terms if not t.endswith(" ")]
    if stems:
        # Words of a family that clean texts use are its exceptions.
        begins = F.substring("term", 1, 1 + STEMS[0]).isin(sorted({t[: 1 + STEMS[0]] for t in stems}))
        benign = counted.filter(
            begins & F.col("term").endswith(" ") & (F.col("clean") >= least_support) & (F.col("weight") < 0)
        ).orderBy(F.desc("clean"), "term").limit(most_terms)
        exceptions += tuple(r["term"] for r in benign.collect())
    lexicon = Lexicon(terms, exceptions)
    lexicon.curve = _fit_curve(sample, lexicon)
    return lexicon


def _fit_curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [lexicon.features(t) for t in batch["text"]]
            yield pd.DataFrame({"x": [a for a, _ in x], "y": [b for _, b in x], "label": batch["label"]})

    rows = sample.mapInPandas(features, "x double, y double, label int").toPandas().sort_values(["x", "y", "label"])
    a = np.column_stack([np.ones(len(rows)), rows["x"], rows["y"]])
    t = (rows["label"] == 1).to_numpy(float)
    w = np.zeros(3)
    for _ in range(40):  # Newton steps for the logistic loss, with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        hess = a.T @ (a * (p * (1 - p))[:, None]) + np.diag([1e-3, 0.3, 0.3])
        w += np.linalg.solve(hess, a.T @ (t - p) - np.array([1e-3, 0.3, 0.3]) * w)
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1. Null, empty and long texts alike get one; a
    column of that name is replaced."""

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return docs.withColumn(score, toxicity(F.col(text)))


def toxicity_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Lexicon:
    return learn_lexicon(fit_sample(docs, labels, "toxic", rows))
