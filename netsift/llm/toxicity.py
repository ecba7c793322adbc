"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence's probability is logistic in its hashed words and word beginnings; a
document's is the noisy-or of its sentences, ``1 - prod(1 - p)``, and the log
loss of document labels is minimised through it. Features enter the model if the share
of documents that have them differs between the classes by ``Z`` standard errors. The
same sentence scores then show where the offence is. Sentences of over ``WORDS`` words are
cut into parts of that many.

Labels, language, source and id are no inputs of a score. Labels are learned from a bounded
sample (``per_grade`` documents a label, see ``labelled``) outside the held-out third.

Defined results: a null or empty text is one empty sentence, which gets the
model's base rate; without examples of both labels the score is the share of label 1 (0
without any). A very long text is scored whole, sentence by sentence. Rows are scored each by itself, so repeats and ties get equal scores; an
empty table gives no rows; other columns are returned by ``score_documents`` only if asked for, before its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.llm import labelled

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
WORDS = 32
BITS = 20
PREFIXES = (3, 4, 5, 6)
Z = 5.0
MIN_DOCS = 5
PER_GRADE = 3000
THRESHOLD = 0.7
KNOWN = 300_000


def word_features(word: str) -> tuple[int, ...]:
    low = word.lower()
    names = ["=" + low] + ["^" + low[:k] for k in PREFIXES if len(low) > k]
    return tuple(zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in names)


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """``start, end, words`` of each sentence, or part of one, that has words."""
    for s in SENTENCE.finditer(text):
        words = WORD.findall(s[0])
        if len(words) <= WORDS:
            if words:
                yield s.start(), s.end(), words
        else:
            at = [m.span() for m in WORD.finditer(s[0])]
            for k in range(0, len(at), WORDS):
                last = min(k + WORDS, len(at)) - 1
                yield s.start() + at[k][0], s.start() + at[last][1], words[k : k + WORDS]


def train(texts: list[str], y: np.ndarray, rounds: int = 60, rate: float = 0.2, shrink: float = 1e-6) -> dict[str, list]:
    """Weights by feature; feature -1 is the intercept, -2 the base rate used when there is only one label."""
    positive = y > 0
    if not positive.any() or positive.all():
        return {"feature": [-2], "weight": [float(positive.mean()) if len(y) else 0.0]}
    known: dict[str, tuple[int, ...]] = {}
    feature, instance, doc_of, n = [], [], [], 0
    for d, text in enumerate(texts):
        for _, _, words in sentences(text) if WORD.search(text) else [(0, 0, [])]:
            for w in set(words):
                if w not in known:
                    known[w] = word_features(w)
            f = np.fromiter(set().union(*map(known.__getitem__, words)), np.int32)
            feature.append(f)
            instance.append(np.full(len(f), n, np.int32))
            doc_of.append(d)
            n += 1
    del known
    feature, instance, doc_of = np.concatenate(feature), np.concatenate(instance), np.array(doc_of)
    used = labelled.telling(np.unique(feature.astype(np.int64) << 32 | doc_of[instance]), positive, 1 << BITS, Z, MIN_DOCS)
    keep = used[feature]
    names, feature = np.unique(feature[keep], return_inverse=True)
    instance = instance[keep]
    w, b, adam = np.zeros(len(names)), -6.0, labelled.Adam(len(names) + 1, rate)
    for _ in range(rounds):
        z = b + np.bincount(instance, w[feature], minlength=n)
        none = np.bincount(doc_of, np.logaddexp(0, z), minlength=len(y))  # -log P(no sentence offends)
        some = np.maximum(-np.expm1(-none), 1e-12)
        slope = np.where(positive, -np.exp(-none) / some, 1.0)[doc_of] / (1 + np.exp(-z)) / len(y)
        gradient = np.bincount(feature, slope[instance], minlength=len(names)) + shrink * w
        step = adam.step(np.r_[gradient, slope.sum()])
        w, b = w - step[:-1], b - step[-1]
    return {"feature": [-1, *names.tolist()], "weight": [float(b), *w.tolist()]}


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_grade: int = PER_GRADE, id_col: str = "doc_id", text_col: str = "text"
) -> pd.DataFrame:
    """The model as ``feature, weight``."""
    sample = labelled.training_sample(docs, labels, label, per_grade, id_col, text_col)
    return labelled.fit(sample, train, "feature bigint, weight double")


class Scorer:
    def __init__(self, model: dict[int, float]):
        self.constant = model.get(-2, None if -1 in model else 0.0)
        self.base = model.get(-1, 0.0)
        self.weight = {k: v for k, v in model.items() if k >= 0}
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, words: list[str]) -> None:
        for w in words:
            if w not in self.known:
                self.known[w] = tuple(f for f in word_features(w) if f in self.weight)

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and sentences of probability 0.5 and more with their places."""
        if self.constant is not None:
            return self.constant, []
        if len(self.known) > KNOWN:
            self.known.clear()
        get, none, found, parts = self.known.__getitem__, 0.0, [], 0
        plain = np.logaddexp(0, self.base)
        for start, end, words in sentences(text):
            parts += 1
            try:
                hits = set().union(*map(get, words))
            except KeyError:
                self._learn(words)
                hits = set().union(*map(get, words))
            if not hits:
                none += plain
                continue
            z = self.base + sum(self.weight[f] for f in hits)
            none += float(np.logaddexp(0, z))
            if z >= 0:
                found.append((start, end, float(1 / (1 + np.exp(-z)))))
        return float(-np.expm1(-(none if parts else plain))), found


def toxicity_score(text: Column, model: pd.DataFrame) -> Column:
    """The score of each text; only texts go to the Python workers and only scores come back."""
    weights = dict(zip(model["feature"].tolist(), model["weight"].tolist()))

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(weights)
        for part in parts:
            yield pa.array([scorer(t.as_py() or "")[0] for t in part], pa.float64())

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text)


def score_documents(
    docs: DataFrame, model: pd.DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """``id[, kept columns], held_out, score, predicted, offending`` per row; ``offending`` has places in characters and probabilities."""
    weights = dict(zip(model["feature"].tolist(), model["weight"].tolist()))
    keep = keep or [id_col]
    others = [c for c in keep if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("o"), F.col(f"`{text_col}`").alias("t"))
    text_too = text_col in keep  # the text then goes back as it came
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            found = [scorer(t.as_py() or "") for t in batch.column("t")]
            places = [[{"start": a, "end": b, "score": p} for a, b, p in x] for _, x in found]
            cols = [batch.column("o"), pa.array([s for s, _ in found], pa.float64()), pa.array(places, spans)]
            cols += [batch.column("t")] if text_too else []
            yield pa.RecordBatch.from_arrays(cols, ["o", "score", "offending", "t"][: len(cols)])

    shape = rows.schema["o"].dataType.simpleString()
    schema = f"o {shape}, score double, offending array<struct<start:int,end:int,score:double>>" + ", t string" * text_too
    out = rows.mapInArrow(run, schema)
    return out.select(
        *[(F.col("t") if c == text_col else F.col("o").getField(c)).alias(c) for c in keep],
        labelled.held_out(F.col("o").getField(id_col)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "offending",
    )
