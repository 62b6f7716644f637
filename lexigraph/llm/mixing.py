"""Mixing sources to target weights.

The words of each source are summed up. Sources in code-point order weigh WEIGHTS in turn and
share all words; a source takes MAX_EPOCHS times its own words at most, and what is above goes to
the others by weight, until none is above. A source's repetition rate is its target over its
words. Each document is emitted floor(rate) times, and once more if a number drawn from a hash of
the seed and its id is below the rest, so every run emits the same copies.

Only sums leave the workers: shares are raised round by round, from two numbers a round, while
the table of sources stays a table. Their number has no limit, and a source that holds most
documents is answered from a broadcast (``lookup``).

Defined cases: a NULL text has no words, nor has one without a word; such documents are emitted
like the others of their source and take nothing. A NULL source is a source, the last one. A
source without words has target 0 and is not emitted. Rows of equal id are drawn alike; a NULL id
is drawn by the text, NULL ids with equal texts alike. No rows give no rows. All columns stay,
whatever their names; ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` are added,
and replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.llm.common import written
from lexigraph.operators.keyed import broadcast_if_bounded, lookup
from lexigraph.operators.ordering import number_rows

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"
DIGITS = 13  # of the hash: 52 bits, as many as a double holds exactly

RESULTS = ["size", "source_size", "target", "rate", "copies"]


def text_size(text: Column) -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.sha2(F.coalesce(text, F.lit("")), 256)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(has, source, n_docs, source_size, weight, target) of (source, size) rows; ``has`` is false
    for the NULL source, whose name is empty here."""
    named = sizes.select(F.col("source").isNotNull().alias("has"), F.coalesce("source", F.lit("")).alias("source"), "size")
    sums = written(
        named.groupBy("has", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")),
        "source-sizes",
    )
    numbered = number_rows(sums, [F.desc("has"), "source"], "place")
    turn = ((F.col("place") - 1) % len(weights)).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn).cast("bigint")
    table = written(numbered.select(*sums.columns, weight.alias("weight")), "source-weights")

    def totals(rows: DataFrame) -> tuple[int, int]:
        found = rows.agg(F.sum("source_size"), F.sum("weight")).first()
        return found[0] or 0, found[1] or 0

    def share_of(words: int, weight: int) -> Column:
        return (F.col("weight") * F.lit(words)).cast("double") / F.lit(float(max(weight, 1)))

    # A source that is full stays so when the others' shares grow. Not all can be full, as that
    # would be more words than there are.
    most = (F.col("source_size") * max_epochs).cast("double")
    words, weight = totals(table)
    share = share_of(words, weight)
    while True:
        full = share > most
        full_words, full_weight = totals(table.where(full))
        again = share_of(words - max_epochs * full_words, weight - full_weight)
        if table.where((again > most) & ~full).isEmpty():
            return table.withColumn("target", F.when(full, most).otherwise(again))
        share = again


def plan_mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """``docs`` with their size, their source's size, target and rate, and the number of copies
    that the mix takes."""
    sizes = written(docs.select("source", text_size(F.col("text")).alias("size")), "sizes")
    targets = source_targets(sizes, weights, max_epochs).select(
        "has", F.col("source").alias("name"), "n_docs", "source_size", "target"
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("source").isNotNull().alias("has"), F.coalesce("source", F.lit("")).alias("name"),
    )
    listed, small = broadcast_if_bounded(targets.drop("n_docs"))
    on = ["has", "name"]
    found = packed.join(listed, on) if small else lookup(packed, targets, on, "inner", "n_docs")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor(rate).cast("bigint")
    extra = draw(F.col("doc.doc_id"), F.col("doc.text"), seed) < rate - whole
    made = F.struct(
        text_size(F.col("doc.text")).alias("size"), "source_size", "target", rate.alias("rate"),
        (whole + extra.cast("bigint")).alias("copies"),
    )
    kept = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c.lower() not in RESULTS]
    return found.select("doc", made.alias("made")).select(*kept, *[F.col(f"made.{n}").alias(n) for n in RESULTS])


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` and ``copy`` (from 1), a row per copy taken."""
    planned = plan_mix(docs, weights, max_epochs, seed)
    taken = planned.where(F.col("copies") > 0)
    return taken.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in [*RESULTS, "copy"]],
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
