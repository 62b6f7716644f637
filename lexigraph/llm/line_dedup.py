"""Line dedup: winnowing over line hashes.

A document is its lines (cut at ``\\n``); lines without a word are never counted or removed.
Of each shortest run of lines that holds MIN_WORDS words the line with the smallest hash is the
run's fingerprint, so all copies of a repeated run of MIN_WORDS words or more share one. Only these
minima are written, each with its place and the lines about it that a run with this fingerprint
can reach. Places are joined by fingerprint; those that stand alone go. From each place that is left
the match is extended both ways to all shortest runs with this fingerprint, which are joined by
content; all but the first in order of (doc_id, text hash, line) are repeats. The runs that end, as
well as those that start, at each line cover a repeated stretch of any length exactly, without a pair
of its copies being listed.

Defined cases: a NULL text stays NULL, an empty one empty. Rows equal in doc_id and text are one
document: both keep or lose the same lines. A NULL doc_id sorts first. A run that repeats within
its own document loses its later copies, overlapping ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.llm.common import let, text_key, written

MIN_WORDS = 50
WORDS = r"[^\x20\x09-\x0D]+"
BLOCK = 512


def _filled_lines(text: Column) -> Column:
    """Lines with words: place, two hashes and number of words."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line, i: F.struct(
            i.alias("i"), F.xxhash64(line).alias("h"), F.xxhash64(F.lit("2"), line).alias("g"),
            F.regexp_count(line, F.lit(WORDS)).alias("c"),
        ),
    )
    return F.filter(lines, lambda x: x.c > 0)


def _running(counts: Column) -> Column:
    """0 and the running sums of ``counts``, built in blocks so that time stays linear."""
    zero = F.lit(0).cast("bigint")

    def within(c: Column) -> Column:
        last = F.floor((F.greatest(F.size(c), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda b: F.aggregate(
                F.slice(c, b * BLOCK + 1, BLOCK), F.array(zero),
                lambda done, x: F.array_append(done, F.element_at(done, -1) + x),
            ),
        )

    def offsets(blocks: Column) -> Column:
        return F.aggregate(
            blocks, F.array(zero),
            lambda done, b: F.array_append(done, F.element_at(done, -1) + F.element_at(b, -1)),
        )

    def joined(blocks: Column, offset: Column) -> Column:
        shifted = F.transform(
            blocks, lambda b, k: F.transform(F.slice(b, 2, BLOCK), lambda x: x + F.get(offset, k))
        )
        return F.concat(F.array(zero), F.flatten(shifted))

    return let(counts, lambda c: let(within(c), lambda blocks: let(offsets(blocks), lambda o: joined(blocks, o))))


def _spans(sums: Column, n: Column, min_words: int) -> Column:
    """First and last line of the shortest runs of ``min_words`` words from each line and up to
    each line. Every line has a word, so a run has at most ``min_words`` lines."""
    every = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    forth = F.transform(every, lambda s: F.struct(
        s.alias("s"),
        (s + F.size(F.filter(
            F.slice(sums, s + 1, min_words), lambda x: x < F.get(sums, s - 1) + min_words
        ))).alias("e"),
    ))
    back = F.transform(every, lambda e: F.struct(
        (e - F.size(F.filter(
            F.slice(sums, F.greatest(e - min_words, F.lit(0)) + 1, F.least(e, F.lit(min_words))),
            lambda x: x > F.get(sums, e) - min_words,
        ))).alias("s"),
        e.alias("e"),
    ))
    return F.array_distinct(F.concat(F.filter(forth, lambda r: r.e <= n), F.filter(back, lambda r: r.s >= 1)))


def _first_least(hashes: Column, r: Column) -> Column:
    """Place of the first of the smallest hashes of a run."""
    own = F.slice(hashes, r.s, r.e - r.s + 1)
    return (r.s + F.array_position(own, F.array_min(own)) - 1).cast("int")


def _reach(sums: Column, n: Column, p: Column, min_words: int) -> tuple[Column, Column]:
    """First and last line that a shortest run over line ``p`` can have."""
    before = F.slice(sums, F.greatest(p - min_words, F.lit(0)) + 1, F.least(p, F.lit(min_words)))
    fewer = F.size(F.filter(before, lambda x: x > F.get(sums, p - 1) - min_words))
    more = F.size(F.filter(F.slice(sums, p + 1, min_words), lambda x: x < F.get(sums, p) + min_words))
    return F.greatest(p - fewer, F.lit(1)), F.least(p + more, n)


def _fingerprints(lines: Column, min_words: int) -> Column:
    """The window minima: hash ``mark``, place ``p``, and the lines ``near`` from place ``lo`` on that
    runs with this fingerprint can reach."""
    def about(l: Column, sums: Column, p: Column, hashes: Column) -> Column:
        lo, hi = _reach(sums, F.size(l), p, min_words)
        return F.struct(
            F.get(hashes, p - 1).alias("mark"), p.alias("p"), lo.alias("lo"), F.slice(l, lo, hi - lo + 1).alias("near")
        )

    return let(lines, lambda l: let(F.transform(l, lambda x: x.h), lambda h: let(
        _running(F.transform(l, lambda x: x.c.cast("bigint"))), lambda sums: F.transform(
            F.array_distinct(F.transform(_spans(sums, F.size(l), min_words), lambda r: _first_least(h, r))),
            lambda p: about(l, sums, p, h),
        ))))


def _extended(near: Column, at: Column, min_words: int) -> Column:
    """The shortest runs of the lines ``near`` whose fingerprint is line ``at`` of them: first line
    ``s``, content hashes and the lines' places in the document."""
    def cut(l: Column, hashes: Column, spans: Column) -> Column:
        def run(r: Column) -> Column:
            own = F.slice(l, r.s, r.e - r.s + 1)
            return F.struct(
                r.s.alias("s"), F.xxhash64(F.transform(own, lambda x: x.h)).alias("k1"),
                F.xxhash64(F.transform(own, lambda x: x.g)).alias("k2"),
                F.transform(own, lambda x: x.i).alias("places"),
            )

        over = F.filter(spans, lambda r: (r.s <= at) & (r.e >= at))
        return F.transform(F.filter(over, lambda r: _first_least(hashes, r) == at), run)

    return let(F.transform(near, lambda x: x.h), lambda h: let(
        _running(F.transform(near, lambda x: x.c.cast("bigint"))),
        lambda sums: cut(near, h, _spans(sums, F.size(near), min_words)),
    ))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, key, gone: the places (from 0) of the lines that repeat an earlier run."""
    minima = docs.select(
        "doc_id", text_key(F.col("text")).alias("key"),
        F.explode(_fingerprints(_filled_lines(F.col("text")), min_words)).alias("f"),
    )
    minima = written(minima.select("doc_id", "key", "f.*"), "line-fingerprints")
    # A mark that stands in one place only belongs to no repeated run. What is grouped by a key
    # is written before it is joined on that key, so that a hot key's partition can be split.
    line = F.struct("doc_id", "key", "p")
    marks = written(
        minima.groupBy("mark")
        .agg(F.min(line).alias("a"), F.max(line).alias("b"))
        .where(~F.col("a").eqNullSafe(F.col("b"))).select("mark"),
        "line-marks",
    )
    # what is joined here grows with the corpus, so it is merged at every size
    joined = minima.join(marks.hint("merge"), "mark", "left_semi")
    runs = joined.select(
        "doc_id", "key", "lo", F.explode(_extended(F.col("near"), F.col("p") - F.col("lo") + 1, min_words)).alias("r")
    )
    runs = written(
        runs.select("doc_id", "key", (F.col("lo") + F.col("r.s") - 1).alias("s"), "r.k1", "r.k2", "r.places"), "line-runs"
    )
    here = F.struct("doc_id", "key", "s")
    first = written(
        runs.groupBy("k1", "k2")
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last"))).select("k1", "k2", "first"),
        "first-runs",
    )
    later = runs.join(first.hint("merge"), ["k1", "k2"]).where(~here.eqNullSafe(F.col("first")))
    return (
        later.select("doc_id", "key", F.explode("places").alias("i")).distinct()
        .groupBy("doc_id", "key").agg(F.collect_list("i").alias("gone"))
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later repeats of runs of lines cut out of ``text``, and the columns
    ``lines_before`` and ``lines_removed`` (replaced if they are there already)."""
    gone = written(repeated_lines(docs, min_words), "gone-lines")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), "gone")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"),
    )
    on = F.col("id").eqNullSafe(F.col("gone_id")) & F.col("key").eqNullSafe(F.col("gone_key"))
    text = F.col("row.text")
    lines = F.split(text, "\n", -1)

    def rest(own: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(own, i)), "\n")

    made = {
        "text": F.when(F.col("gone").isNull(), text).otherwise(let(lines, rest)),
        "lines_before": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint"),
        "lines_removed": F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint"),
    }
    added = ["lines_before", "lines_removed"]
    return packed.join(gone.hint("merge"), on, "left").select(
        *[(made["text"] if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c.lower() not in added],
        *[made[c].alias(c) for c in added],
    )
