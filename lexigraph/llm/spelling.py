"""Spelling variant grouping: asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one of the other. Of
two such words the shorter (of equally long ones, either) gives two disjoint chunks of half its
length; one edit can't touch both, so one chunk stands in the other word, shifted by one place at
most. The other word gives its grams of that size at all places a chunk can have moved to; grams
further off could not join. Chunks and grams meet by length, chunk, and text, and what meets
is verified.

A chunk that very many words share, such as a common prefix, is a hot bucket. Its words are
compared by the rest of the word in the same way: the rest of the one is cut into two parts, of which
again one must stand in the other's. So hot buckets are split by content, with no cap and no
lost pair, and what is joined within one bucket stays small. Rows of buckets that are hot still are
spread over parts (``spread_join``).

A word's form is its most frequent near word, if that is RATIO times as frequent; forms are
followed to the last by pointer doubling. Frequencies grow by RATIO a step, so DOUBLINGS rounds
reach the end of any chain.

Defined cases: NULL and empty texts have no words; a NULL id is an empty one for the deletion;
repeated rows count each; long texts are split like others; ties go to the word that comes first
in code-point order; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.llm.common import lower_ascii, written
from lexigraph.operators.keyed import broadcast_if_bounded, hot_keys, spread_join

GAPS = r"[^A-Za-zÀ-ÿ]+"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
DROP_EVERY = 199

#: Buckets with this many rows on either side are cut again by the rest of the word.
HOT_BUCKET = 64
SPREAD_ROWS = 20_000
DOUBLINGS = 6


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points that occur ``min_count`` times."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(
        name.alias("name"), F.explode(F.split(lower_ascii(F.coalesce("text", F.lit(""))), GAPS)).alias("run")
    ).where(F.char_length("run") >= min_length)
    h = F.crc32(F.concat("name", "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(h % DROP_EVERY == 0, less).otherwise(F.col("run")).alias("word"))
    return (
        words.where(F.char_length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    )


BUCKET = ["len", "side", "chunk"]  # length of the word that is cut, which half, its text


def _part(word: Column, start: Column, size: Column) -> Column:
    return F.substr(word, start + 1, size)


def _chunks(words: DataFrame) -> DataFrame:
    """Both chunks of each word, and the rest of the word without the chunk."""
    size = F.char_length("word")
    q = F.floor(size / 2).cast("int")
    word, none = F.col("word"), F.lit(0)
    sides = F.array(
        F.struct(none.alias("side"), _part(word, none, q).alias("chunk"), _part(word, q, size).alias("rest")),
        F.struct(F.lit(1).alias("side"), _part(word, size - q, q).alias("chunk"), _part(word, none, size - q).alias("rest")),
    )
    return words.select("word", size.alias("len"), F.inline(sides))


def _grams(words: DataFrame) -> DataFrame:
    """The grams of each word that a chunk of a word as long, or one shorter, may have moved to.

    ``anchored`` grams are at the same end of the word as the chunk, and have a ``rest``. Every
    near pair has one of them: an edit that moves the first chunk leaves the second at the end.
    """
    size = F.char_length("word")
    lengths = words.select("word", size.alias("size"), F.explode(F.array(size, size - 1)).alias("len"))
    q = F.floor(F.col("len") / 2).cast("int")
    word, size = F.col("word"), F.col("size")
    places = F.array(*[
        F.struct(F.lit(side).alias("side"), (place + shift).alias("place"), (end + shift).alias("off"))
        for side, place, end in ((0, F.lit(0), F.lit(0)), (1, F.col("len") - q, F.col("len") - size))
        for shift in (-1, 0, 1)
    ])
    there = F.filter(places, lambda p: (p.place >= 0) & (p.place + q <= size))
    rows = lengths.select("word", "size", "len", q.alias("q"), F.inline(there))
    q, place = F.col("q"), F.col("place")
    rest = F.when(F.col("side") == 0, _part(word, q, size)).otherwise(_part(word, F.lit(0), size - q))
    anchored = F.col("off") == 0
    return rows.select(
        "word", "len", "side", _part(word, place, q).alias("chunk"), anchored.alias("anchored"),
        F.when(anchored, rest).alias("rest"),
    )


def _of_rest(rows: DataFrame, size: Column) -> DataFrame:
    """Both ends of the rest, half as long as ``size``: the chunks of a chunk's rest, or the grams that
    these may have become in another word's."""
    r = F.floor(size / 2).cast("int")
    rest = F.col("rest")
    ends = F.array(
        F.struct(F.lit(0).alias("end"), _part(rest, F.lit(0), r).alias("inner")),
        F.struct(F.lit(1).alias("end"), _part(rest, F.char_length(rest) - r, r).alias("inner")),
    )
    return rows.select("word", *BUCKET, F.inline(ends))


def near_pairs(words: DataFrame, hot_bucket: int = HOT_BUCKET, spread_rows: int = SPREAD_ROWS) -> DataFrame:
    """(a, b) of all words of ``words`` (word) that differ by one inserted, deleted or replaced code
    point, each pair once."""
    chunks, grams = _chunks(words), _grams(words)
    # Every word is among the grams of its own chunks' buckets, so a bucket has no more chunks than grams.
    large = written(
        grams.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= hot_bucket)
        .select(*BUCKET, F.lit(True).alias("hot")),
        "hot-buckets",
    )
    listed, _ = broadcast_if_bounded(large)

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = rows.join(listed, BUCKET, "left")
        return marked.where(F.col("hot").isNull()), marked.where(F.col("hot"))

    (few, many), (few_grams, many_grams) = split(chunks), split(grams)
    met = few.select(*BUCKET, F.col("word").alias("a")).join(few_grams.select(*BUCKET, F.col("word").alias("b")), BUCKET)
    q = F.floor(F.col("len") / 2).cast("int")
    inner = [*BUCKET, "end", "inner"]
    left = _of_rest(many, F.col("len") - q).withColumnRenamed("word", "a")
    right = _of_rest(many_grams.where("anchored"), F.col("len") - q).withColumnRenamed("word", "b")
    met_in_rest = spread_join(
        left, right, inner, hot_keys(left, inner, spread_rows), hot_keys(right, inner, spread_rows), ["a"], ["b"]
    )
    a, b = F.col("a"), F.col("b")
    one_way = (F.char_length(a) < F.char_length(b)) | (a < b)
    return (
        met.select("a", "b").unionByName(met_in_rest.select("a", "b"))
        .where(one_way & (F.levenshtein(a, b, 1) == 1)).distinct()
    )


def variant_forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of the words (word, n) and their near pairs (a, b)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a word has at most a few letters' worth of near words, so no group here is large
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = both.join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("m")).alias("less"), "b")).alias("best")
    )
    found = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    most = -F.col("best.less")
    taken = most >= ratio * F.col("n")
    return found.select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.b")).alias("form"), F.when(taken, most).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of the forms they lead to."""
    jumps = written(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")), "forms")
    for _ in range(DOUBLINGS):
        further = jumps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        joined = written(jumps.join(further, "to", "left"), "jumps")
        jumps = joined.select("word", F.coalesce("next", "to").alias("to"))
        if joined.where(F.col("next").isNotNull()).isEmpty():
            break
    return jumps.select("word", F.col("to").alias("root"))


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the texts of ``docs``."""
    words = written(word_counts(docs), "words")
    forms = written(variant_forms(words, near_pairs(words.select("word"))), "variants")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
