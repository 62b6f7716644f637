"""Benchmark decontamination: winnowed k-gram fingerprints, joined and extended.

Texts are cut into words. A window is WINDOW consecutive words of a benchmark item; an item of
fewer words is one window. Of the k-grams of each window the one with the smallest hash is the
window's fingerprint, so two texts that share a window share its fingerprint: no shared span of
WINDOW words or more is missed. Documents are joined to the benchmark on fingerprints; hits are
then extended to the windows around them and compared word by word.

Defined cases: a NULL or empty text has no words, is never hit, and comes back with zeros.
Repeated benchmark rows count once per item_id; items without an id make hits but are not
listed. Rows of documents that repeat a doc_id are judged by their own texts. Columns other
than id and text pass through nothing here, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import let, lower_ascii, sha256_hex, split_words, text_key, written
from lexigraph.operators.keyed import broadcast_if_bounded

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5


def item_words(text: Column) -> Column:
    return split_words(lower_ascii(text), WORD_GAP)


def _starts(array: Column, n: int) -> Column:
    return F.when(F.size(array) >= n, F.sequence(F.lit(1), F.size(array) - n + 1)).otherwise(
        F.array().cast("array<int>")
    )


def _grams(words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words; empty if there are fewer words."""
    return F.transform(_starts(words, n), lambda i: F.xxhash64(F.slice(words, i, n)))


def _marks(words: Column, window: int, gram: int) -> Column:
    """The smallest hash in each window."""
    width = window - gram + 1
    return let(
        _grams(words, gram),
        lambda g: F.transform(_starts(g, width), lambda i: F.array_min(F.slice(g, i, width))),
    )


def _windows(words: Column, marks: Column, n: int) -> Column:
    """All runs of ``n`` words with place and fingerprint."""
    return F.transform(
        marks,
        lambda m, i: F.struct(
            (i + 1).alias("start"), F.lit(n).alias("n"), m.alias("mark"),
            F.array_join(F.slice(words, i + 1, n), " ").alias("run"),
        ),
    )


def benchmark_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """item_id, run, n, mark: each window of each item once."""
    words = items.select("item_id", item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    long = words.where(F.size("w") >= window)
    long = long.select(
        "item_id", F.explode(let(F.col("w"), lambda w: _windows(w, _marks(w, window, gram), window))).alias("x")
    )
    short = words.where(F.size("w") < window).select(
        "item_id",
        F.struct(
            F.lit(1).alias("start"), F.size("w").alias("n"), F.xxhash64("w").alias("mark"),
            F.array_join("w", " ").alias("run"),
        ).alias("x"),
    )
    return long.unionByName(short).select("item_id", "x.run", "x.n", "x.mark").distinct()


def _small(df: DataFrame) -> DataFrame:
    """Broadcast only if a probe has shown it to be small, else joined by shuffle."""
    return broadcast_if_bounded(df, max_rows=200_000, max_chars=16_000_000)[0]


def find_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, key, n_words`` per row of ``docs``; the places ``doc_id, key, start, n, run``
    at which a benchmark window stands; and the windows of the items.
    """
    runs = written(benchmark_windows(items, window, gram), "bench-windows")
    texts = written(runs.select("run").distinct(), "bench-texts")
    # at most window - 1 short lengths
    short = [r.n for r in runs.where(F.col("n") < window).select("n").distinct().collect()]
    marks = _small(written(runs.select("mark").distinct(), "bench-marks"))

    words = docs.select("doc_id", text_key(F.col("text")).alias("key"), item_words(F.col("text")).alias("w"))

    def prints(w: Column) -> Column:
        shorts = [_grams(w, n) for n in sorted(short)]
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.array_distinct(F.flatten(F.array(_marks(w, window, gram), *shorts))).alias("marks"),
        )

    marked = written(
        words.select("doc_id", "key", let(F.col("w"), prints).alias("p")).select("doc_id", "key", "p.*"),
        "doc-marks",
    )
    near = (
        marked.select("doc_id", "key", F.explode("marks").alias("mark"))
        .join(marks, "mark", "left_semi")
        .select("doc_id", "key").distinct()
    )
    # only the texts that share a fingerprint are cut into whole windows
    def places(w: Column) -> Column:
        shorts = [_windows(w, _grams(w, n), n) for n in sorted(short)]
        return F.flatten(F.array(_windows(w, _marks(w, window, gram), window), *shorts))

    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.key").eqNullSafe(F.col("b.key"))
    close = (
        docs.select("doc_id", text_key(F.col("text")).alias("key"), "text").alias("a")
        .join(near.alias("b"), same, "left_semi")
        .select("doc_id", "key", item_words(F.col("text")).alias("w"))
        .select("doc_id", "key", F.explode(let(F.col("w"), places)).alias("x"))
        .select("doc_id", "key", "x.*")
        .join(marks, "mark", "left_semi")
        .join(_small(texts), "run", "left_semi")
        .select("doc_id", "key", "start", "n", "run")
        .distinct()
    )
    return marked.select("doc_id", "key", "n_words"), written(close, "bench-hits"), runs


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated; a row per document."""
    all_docs, hits, windows = find_hits(docs, items, window, gram)
    doc = ["doc_id", "key"]
    end = F.col("start") + F.col("n")
    reach = F.max(end).over(
        Window.partitionBy(*doc).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = (
        hits.withColumn("_new", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(reach, F.lit(0)))))
        .groupBy(*doc).agg(F.sum("_new").cast("bigint").alias("n_hit"))
    )
    runs = windows.select("run", F.col("item_id").cast("string").alias("item"))
    found = (
        hits.select(*doc, "run").distinct().join(_small(runs), "run")
        .where(F.col("item").isNotNull()).select(*doc, "item").distinct()
        .groupBy(*doc).agg(F.array_sort(F.collect_list("item")).alias("items"))
    )

    def left(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
        on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.key").eqNullSafe(F.col("b.key"))
        return a.alias("a").join(b.alias("b"), on, "left").select("a.*", f"b.{column}")

    rows = left(left(all_docs, covered, "n_hit"), found, "items")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return rows.select(
        *doc, "n_words", n_hit.alias("n_hit"), F.size(items_).cast("bigint").alias("n_items"),
        sha256_hex(F.array_join(items_, ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window stands."""
    hits = find_hits(docs, items)[1].select("doc_id", F.col("key").alias("_key")).distinct()
    hits = _small(written(hits, "contaminated"))
    on = docs["doc_id"].eqNullSafe(hits["doc_id"]) & text_key(docs["text"]).eqNullSafe(hits["_key"])
    return docs.join(hits, on, "left_anti")
