"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is the logistic function of its words'
weights, a document's the noisy-or of its sentences': 1 - prod(1 - p). Only documents are labelled;
the weights are learnt through the noisy-or, and the sentences that make a document toxic are then
those that score high themselves. Features are words and their first letters, hashed.

Learning takes at most about SAMPLE labelled documents, chosen by a hash of the id among those
whose crc32 modulo 5 is not 0; their features go to the driver. Its size does not grow with the corpus. All
texts are scored whole, each by a task of its own partition.

Defined cases: NULL, empty and blank texts have one sentence without words. An id with several
labels is toxic if one says so; labels that are NULL, and ids that are, teach nothing. Without any
label all documents score 0. Columns named like the results are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import add_results, doc_remainder

SAMPLE = 6_000
BITS = 18
PREFIXES = (4, 5)
STEPS = 150
RATE = 0.3
SPARSITY = 2e-4
FIRST_BIAS = -6.0
CACHED_WORDS = 300_000
FLAGGED = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Places of the sentences, without their end marks; the empty text has one."""
    return [m.span() for m in _SENTENCE.finditer(text or "")] or [(0, 0)]


def features(word: str, bits: int = BITS) -> list[int]:
    names = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(n.encode()) & ((1 << bits) - 1) for n in names]


@dataclass
class Model:
    weights: np.ndarray  # one per hashed feature
    bias: float
    taught: bool = True  # without a label all scores are 0


def _bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and the sentence of each; a sentence has a feature once."""
    text = (text or "").lower()
    feats, owner = [], []
    for i, (a, b) in enumerate(sentences(text)):
        own = {f for w in set(_WORD.findall(text, a, b)) for f in features(w)}
        feats += sorted(own)
        owner += [i] * len(own)
    return np.array(feats, dtype=np.int32), np.array(owner, dtype=np.int32)


def train_bags(bags: list[tuple[np.ndarray, np.ndarray, int]], labels: np.ndarray, bits: int = BITS) -> Model:
    """``bags``: features, their sentences, and the number of sentences of each document."""
    if not len(bags):
        return Model(np.zeros(1 << bits), FIRST_BIAS, taught=False)
    counts = np.array([n for _, _, n in bags])
    offset = np.cumsum(counts) - counts
    feats = np.concatenate([f for f, _, _ in bags]).astype(np.int64)
    rows = np.concatenate([o + s for (_, o, _), s in zip(bags, offset)]).astype(np.int64)
    doc = np.repeat(np.arange(len(bags)), counts)
    total = int(counts.sum())
    weights, bias = np.zeros(1 << bits), FIRST_BIAS
    seen, seen_bias = np.full(1 << bits, 1e-8), 1e-8
    # both labels weigh the same in all
    share = labels.mean()
    value = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / len(labels)
    for _ in range(STEPS):
        z = bias + np.bincount(rows, weights=weights[feats], minlength=total)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log of the chance that no sentence is toxic
        none = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(bags))
        any_ = -np.expm1(none)
        pull = np.where(labels == 1, np.exp(none) / np.maximum(any_, 1e-9), -1.0) * value
        slope = pull[doc] * p
        grad = np.bincount(feats, weights=slope[rows], minlength=1 << bits)
        seen += grad * grad
        weights = weights + RATE * grad / np.sqrt(seen)
        # small weights vanish
        weights = np.sign(weights) * np.maximum(0.0, np.abs(weights) - RATE * SPARSITY / np.sqrt(seen))
        step = slope.sum()
        seen_bias += step * step
        bias += RATE * step / np.sqrt(seen_bias)
    return Model(weights, float(bias))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(doc_remainder(F.col("doc_id"), 5) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    )
    n = max(1, known.count())
    drawn = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # about ``sample`` rows of two numbers
    picked = F.broadcast(known.where(drawn < sample / n))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_bag(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "toxic": batch["_toxic"],
                "features": [f.tobytes() for f, _ in found], "owners": [o.tobytes() for _, o in found],
                "n": [len(sentences((t or "").lower())) for t in batch["text"]],
            })

    taught = (
        docs.select("doc_id", "text").join(picked, "doc_id")
        .mapInPandas(bags, "doc_id bigint, toxic int, features binary, owners binary, n int")
        .toPandas().sort_values(["doc_id", "n"], kind="stable")
    )
    made = [
        (np.frombuffer(f, dtype=np.int32), np.frombuffer(o, dtype=np.int32), int(k))
        for f, o, k in zip(taught["features"], taught["owners"], taught["n"])
    ]
    return train_bags(made, taught["toxic"].to_numpy(dtype=float))


class _Weights(dict):
    """Words' features that weigh anything, so far as the words have been met."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.bits = int(np.log2(len(model.weights)))

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(f for f in features(word, self.bits) if self.model.weights[f])
        return found


def score_text(known: _Weights, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """Noisy-or of the sentences, and (start, end, score) of those that are offending."""
    model = known.model
    if not model.taught:
        return 0.0, []
    low = (text or "").lower()
    if len(low) != len(text or ""):  # places must stay those of the text
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    none, found = 0.0, []
    plain = 1 / (1 + np.exp(-model.bias))
    for a, b in sentences(low):
        hits = {f for w in _WORD.findall(low, a, b) for f in known[w]}
        if hits:
            z = model.bias + sum(model.weights[f] for f in sorted(hits))
            p = float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
        else:
            p = plain
        none += np.log1p(-min(p, 1 - 1e-12))
        if p >= FLAGGED:
            found.append((a, b, p))
    return float(-np.expm1(none)), found


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``offending``: start, end and score of the
    sentences that are toxic by themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Weights(shared.value)
        for batch in texts:
            scored = [score_text(known, t) for t in batch]
            yield pd.DataFrame({
                "score": [s for s, _ in scored], "predicted": [int(s >= FLAGGED) for s, _ in scored],
                "offending": [[{"start": a, "end": b, "score": p} for a, b, p in found] for _, found in scored],
            })

    rate = F.pandas_udf(
        run, "score double, predicted int, offending array<struct<start: int, end: int, score: double>>"
    )
    return add_results(docs, rate("text"), ["score", "offending", "predicted"])
