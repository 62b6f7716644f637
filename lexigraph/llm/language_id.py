"""Language ID: words first, then ever shorter character n-grams.

Each word that the training texts know votes with its log frequency in every language, as a share
of all languages. An unseen word votes by its character n-grams of the longest length of which one
is known, weighted less the shorter they are. Votes are added up over the whole text.

Fitting takes at most about SAMPLE labelled documents and SAMPLE_CHARS characters of each language,
chosen by a hash of the id. All words and n-grams that stand LEAST times in a language's sample are
known, whatever their rank or number. The sample bounds the model's size, so it is broadcast. Texts
that are to be predicted are read whole.

Defined cases: a text that is NULL, empty or has no letter is ``und`` with score 0. Ties go to the
language that sorts first. Documents without a language teach nothing; without any labelled
document all are ``und``. Columns ``lang_pred`` and ``score`` are replaced if there already.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import add_results, doc_remainder, written

SAMPLE = 4_000
SAMPLE_CHARS = 32_000_000
#: Times that a word or n-gram must stand in a language's sample to be known there.
LEAST = 2
LONGEST = 4
SMOOTHING = 0.5
#: Weight of a vote by n-grams of 4, 3, 2, 1 characters.
BACKOFF = {4: 0.7, 3: 0.5, 2: 0.3, 1: 0.1}
CACHED_WORDS = 300_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")

GRAM_SCHEMA = "lang string, gram string, n bigint"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    edged = f"^{word}$" if n > 1 else word
    return [edged[i : i + n] for i in range(len(edged) - n + 1)]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for text, lang in zip(batch["text"], batch["lang"]):
            counts.update((lang, w) for w in words_of(text))
        yield _frame(counts)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for word, lang, n in zip(batch["gram"], batch["lang"], batch["n"]):
            for k in range(1, LONGEST + 1):
                for g in grams_of(word, k):
                    counts[lang, g] += n
        yield _frame(counts)


def _frame(counts: Counter[tuple[str, str]]) -> pd.DataFrame:
    rows = [(lang, gram, n) for (lang, gram), n in counts.items()]
    return pd.DataFrame(rows, columns=["lang", "gram", "n"]).astype({"n": "int64"})


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    votes: np.ndarray  # a row per known word, then per known n-gram: log shares of the languages


def _votes(counts: pd.DataFrame, langs: list[str], totals: dict[str, float]) -> tuple[dict[str, int], np.ndarray]:
    names = sorted(counts["gram"].unique())
    row = {g: i for i, g in enumerate(names)}
    n = np.zeros((len(names), len(langs)))
    np.add.at(n, (counts["gram"].map(row).to_numpy(dtype=int), counts["lang"].map(langs.index).to_numpy(dtype=int)), counts["n"].to_numpy())
    total = np.array([totals.get(lang, 0.0) for lang in langs])
    share = np.log((n + SMOOTHING) / (total + SMOOTHING * (len(names) + 1)))
    share -= np.logaddexp.reduce(share, axis=1, keepdims=True) if len(langs) else 0
    return row, share


def fit(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS, least: int = LEAST) -> Model:
    """Learns from the text and lang of documents whose crc32(doc_id) mod 4 is not 2."""
    taught = docs.where(F.col("lang").isNotNull() & (doc_remainder(F.col("doc_id"), 4) != 2))
    chars = F.greatest(F.coalesce(F.sum(F.char_length("text")), F.lit(0)), F.lit(1))
    share = F.least(F.lit(float(sample)) / F.count(F.lit(1)), F.lit(float(sample_chars)) / chars)
    sizes = taught.groupBy("lang").agg(share.alias("share"))
    drawn = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    bounded = (
        taught.select("doc_id", "text", "lang").join(F.broadcast(sizes), "lang")
        .where(drawn < F.col("share")).select("text", "lang")
    )
    words = written(
        bounded.mapInPandas(_count_words, GRAM_SCHEMA).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "words"
    )
    parts = written(
        words.mapInPandas(_count_grams, GRAM_SCHEMA).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams"
    )
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())

    def known_ones(counts: DataFrame) -> pd.DataFrame:
        return counts.where(F.col("n") >= least).toPandas()

    def totals(counts: DataFrame) -> dict[str, float]:
        return {r.lang: float(r.n) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}

    known, votes = _votes(known_ones(words), langs, totals(words))
    # n-grams of one length share a total, so lengths are normalised apart
    tables = []
    rows: dict[str, int] = {}
    kept = known_ones(parts)
    for k in range(1, LONGEST + 1):
        of_length = parts.where(F.char_length("gram") == k)
        row, share = _votes(kept[kept["gram"].str.len() == k], langs, totals(of_length))
        offset = len(votes) + sum(map(len, tables))
        rows |= {g: offset + i for g, i in row.items()}
        tables.append(share)
    return Model(langs, known, rows, np.vstack([votes, *tables]) if langs else np.zeros((0, 0)))


class _Voters(dict):
    """Words' rows in a matrix of votes; rows of unseen words are made as they come, and
    forgotten once there are too many."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.words)
        self.model = model
        self.table = np.vstack([model.votes, np.zeros((1024, len(model.langs)))])
        self.used = len(model.votes)

    def __missing__(self, word: str) -> int:
        if self.used == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        self.table[self.used] = self.backoff(word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def backoff(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            rows = [r for g in grams_of(word, n) if (r := self.model.grams.get(g)) is not None]
            if rows:
                return BACKOFF[n] * self.model.votes[rows].mean(axis=0)
        return np.zeros(len(self.model.langs))

    def forget(self) -> None:
        if len(self) > len(self.model.words) + CACHED_WORDS:
            self.clear()
            self.update(self.model.words)
            self.used = len(self.model.votes)


def predict_text(voters: _Voters, text: str | None) -> tuple[str, float]:
    langs = voters.model.langs
    words = words_of(text)
    if not langs or not any(c.isalpha() for w in words for c in w):
        return UNDETERMINED, 0.0
    total = np.zeros(len(langs))
    for at in range(0, len(words), 100_000):
        rows = [voters[w] for w in words[at : at + 100_000]]
        total += voters.table[rows].sum(axis=0)
        voters.forget()
    best = int(total.argmax())
    return langs[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the votes' likelihood."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        voters = _Voters(shared.value)
        for batch in texts:
            found = [predict_text(voters, t) for t in batch]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    guess = F.pandas_udf(predict, "lang_pred string, score double")
    return add_results(docs, guess("text"), ["lang_pred", "score"])
