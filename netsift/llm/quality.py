"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score: ``P(grade <= k) = sigmoid(threshold_k - score)``. That gives the expected grade and the tail
probability ``P(grade >= tail grade)`` by which documents are selected. Features are the shares (square roots) of
a text's tokens with a word, or a shape (letters, digits and signs by kind, runs as one), and of tokens that
repeat the one before or any before, in steps. Features whose mean does not differ between the
lower and the upper grades are left out.

Labels, language, source and id are no inputs. Labels are learned from a bounded sample (``per_grade`` documents of
each grade, see ``labelled``) outside the held-out third.

Defined results: a null or empty text has only the feature of having no tokens; with one grade or none in the
sample, every document gets that grade (null without any) and is kept; rows are scored one by one, so repeats and null ids do
not matter and ties get equal scores; a very long text is one text, whose tokens are all counted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm import labelled

BITS = 20
Z = 4.0
MIN_DOCS = 5
PER_GRADE = 2000
KNOWN = 300_000
_KINDS = ((re.compile(r"[^\W\d_]+"), lambda m: _letters(m[0])), (re.compile(r"\d+"), lambda m: "0"), (re.compile(r"(\W)\1+"), lambda m: m[1] + "+"))


def hashed(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


def _letters(run: str) -> str:
    return "A" if run.isupper() else "Aa" if run[0].isupper() else "a"


def token_shape(token: str) -> str:
    if token.isalpha():
        return _letters(token)
    if token[:-1].isalpha() and not (token[-1].isalnum() or token[-1] == "_"):
        return _letters(token[:-1]) + token[-1]
    for pattern, kind in _KINDS:
        token = pattern.sub(kind, token)
    return token


def token_features(token: str) -> tuple[int, int]:
    return hashed("=" + token.lower()), hashed("~" + token_shape(token))


def document_features(tokens: list[str], counts: Counter) -> dict[int, float]:
    """Features of the text as a whole, by value."""
    n = len(tokens)
    if not n:
        return {hashed("none"): 1.0}
    again = sum(map(eq, tokens[1:], tokens)) / n
    fresh = len(counts) / n
    return {hashed("again"): again, hashed("fresh"): fresh, hashed(f"again:{math.ceil(10 * again)}"): 1.0, hashed(f"fresh:{math.ceil(10 * fresh)}"): 1.0}


def features(text: str, known: dict[str, tuple[int, int]] | None = None) -> dict[int, float]:
    """All features of a text; ``known`` keeps those of tokens between calls."""
    tokens = text.split()
    counts = Counter(tokens)
    known = {} if known is None else known
    out: dict[int, int] = {}
    for t, n in counts.items():
        if t not in known:
            known[t] = token_features(t)
        for f in known[t]:
            out[f] = out.get(f, 0) + n
    return {**{f: math.sqrt(n / len(tokens)) for f, n in out.items()}, **document_features(tokens, counts)}


def differing(feature: np.ndarray, doc: np.ndarray, value: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Features in ``MIN_DOCS`` documents and more whose mean value differs between the two classes by ``Z`` standard errors."""
    size, n, n1 = 1 << BITS, len(upper), int(upper.sum())
    total, squares = np.bincount(feature, value, size), np.bincount(feature, value**2, size)
    high = np.bincount(feature[upper[doc]], value[upper[doc]], size)
    variance = np.maximum(squares / n - (total / n) ** 2, 1e-12)
    error = np.sqrt(variance * (1 / n1 + 1 / (n - n1)))
    return (np.abs(high / n1 - (total - high) / (n - n1)) / error >= Z) & (np.bincount(feature, minlength=size) >= MIN_DOCS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(texts: list[str], y: np.ndarray, rounds: int = 150, rate: float = 0.1, shrink: float = 1e-4) -> dict[str, list]:
    """``kind, at, value``: the grades, the thresholds between them, and the weights by feature."""
    grades, grade = np.unique(y, return_inverse=True)
    out = [("grade", k, float(g)) for k, g in enumerate(grades)]
    if len(grades) > 1:
        known: dict[str, tuple[int, int]] = {}
        found = [features(t, known) for t in texts]
        del known
        feature = np.concatenate([np.fromiter(f, np.int64, len(f)) for f in found])
        value = np.concatenate([np.fromiter(f.values(), float, len(f)) for f in found])
        doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
        used = differing(feature, doc, value, grade >= (len(grades) + 1) // 2)
        keep = used[feature]
        names, feature = np.unique(feature[keep], return_inverse=True)
        value, doc = value[keep], doc[keep]
        share = np.cumsum(np.bincount(grade))[:-1] / len(grade)
        theta = np.log(share / (1 - share))
        w, gaps = np.zeros(len(names)), np.log(np.maximum(np.diff(theta), 1e-3))
        first, adam = theta[0], labelled.Adam(len(names) + len(theta), rate)
        for _ in range(rounds):
            theta = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
            score = np.bincount(doc, w[feature] * value, minlength=len(grade))
            cuts = np.r_[-np.inf, theta, np.inf]
            up, low = _sigmoid(cuts[grade + 1] - score), _sigmoid(cuts[grade] - score)
            p = np.maximum(up - low, 1e-9)
            d_up, d_low = up * (1 - up) / p / len(grade), low * (1 - low) / p / len(grade)
            slope = d_up - d_low
            d_theta = np.bincount(grade, -d_up, minlength=len(grades))[:-1] + np.bincount(grade, d_low, minlength=len(grades))[1:]
            d_gaps = np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(gaps)
            step = adam.step(np.r_[np.bincount(feature, slope[doc] * value, minlength=len(names)) + shrink * w, d_theta.sum(), d_gaps])
            w, first, gaps = w - step[: len(w)], first - step[len(w)], gaps - step[len(w) + 1 :]
        theta = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
        out += [("threshold", k, float(t)) for k, t in enumerate(theta)] + [("weight", int(f), float(x)) for f, x in zip(names, w)]
    return {c: [r[i] for r in out] for i, c in enumerate(("kind", "at", "value"))}


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", per_grade: int = PER_GRADE, id_col: str = "doc_id", text_col: str = "text"
) -> pd.DataFrame:
    sample = labelled.training_sample(docs, labels, label, per_grade, id_col, text_col)
    return labelled.fit(sample, train, "kind string, at bigint, value double")


class Grader:
    def __init__(self, model: pd.DataFrame, tail: float | None = None):
        by = {k: g.sort_values("at") for k, g in model.groupby("kind")}
        self.grades = by["grade"]["value"].to_numpy() if "grade" in by else np.zeros(0)
        self.theta = by["threshold"]["value"].to_numpy() if "threshold" in by else np.zeros(0)
        self.weight = dict(zip(by["weight"]["at"].tolist(), by["weight"]["value"].tolist())) if "weight" in by else {}
        self.tail = int(np.searchsorted(self.grades, tail)) if tail is not None else len(self.grades) - 1
        self.shape: dict[str, str] = {}  # of the tokens seen
        self.word: dict[str, int] = {}  # those of them whose word is a feature of the model

    def _learn(self, new: list[str], counts: Counter) -> None:
        if new and len(self.shape) > KNOWN:
            self.shape.clear()
            self.word.clear()
            new = list(counts)
        for t in new:
            self.shape[t] = token_shape(t)
            f = hashed("=" + t.lower())
            if f in self.weight:
                self.word[t] = f

    def score(self, text: str) -> float:
        tokens = text.split()
        counts = Counter(tokens)
        self._learn([t for t in counts if t not in self.shape], counts)
        held: Counter = Counter()
        for shape, n in Counter(map(self.shape.__getitem__, tokens)).items():
            held[hashed("~" + shape)] += n
        for t in counts.keys() & self.word.keys():
            held[self.word[t]] += counts[t]
        weight = self.weight.get
        total = sum(weight(f, 0.0) * math.sqrt(n / len(tokens)) for f, n in held.items())
        return total + sum(weight(f, 0.0) * v for f, v in document_features(tokens, counts).items())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Expected grades and tail probabilities."""
        if len(self.grades) < 2:
            return np.full(len(texts), self.grades[0] if len(self.grades) else np.nan), np.ones(len(texts))
        score = np.array([self.score(t) for t in texts])
        upto = np.concatenate([np.zeros((len(score), 1)), _sigmoid(self.theta - score[:, None]), np.ones((len(score), 1))], 1)
        return np.diff(upto, axis=1) @ self.grades, 1 - upto[:, min(self.tail, len(self.grades) - 1)] if self.tail < len(self.grades) else np.zeros(len(score))


def grade_documents(
    docs: DataFrame, model: pd.DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float | None = None, least: float = 0.5
) -> DataFrame:
    """``id, held_out, expected_grade, tail_probability, kept`` per row; kept if P(grade >= ``tail``, the highest by default) is ``least`` or more."""
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("a")).alias("o"), F.col(f"`{text_col}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grader = Grader(model, tail)
        for batch in batches:
            expected, p = grader([t.as_py() or "" for t in batch.column("t")])
            yield pa.RecordBatch.from_arrays([batch.column("o"), pa.array(expected, from_pandas=True), pa.array(p)], ["o", "expected_grade", "tail_probability"])

    shape = rows.schema["o"].dataType.simpleString()
    out = rows.mapInArrow(run, f"o {shape}, expected_grade double, tail_probability double")
    return out.select(
        F.col("o.a").alias(id_col), labelled.held_out(F.col("o.a")).alias("held_out"), "expected_grade", "tail_probability",
        (F.col("tail_probability") >= least).alias("kept"),
    )
