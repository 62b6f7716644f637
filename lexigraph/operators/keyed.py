"""Per-key totals, lookups and running totals that hold up when one key has most rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from ..session import scratch_dir
from ..sinks.writers import materialise

# A key with more than 1/HOT_KEYS of all rows is always among the HOT_KEYS largest, so the
# broadcast list of hot keys never has more rows than this.
HOT_KEYS = 4000
HOT_ROWS = 100_000

# Parts of a hot key's running total, at each level.
BUCKETS = 128

# More levels than any number of rows needs.
DEPTH = 9

# Places over which the rows of hot keys spread in a lookup's shuffle.
SPREAD = 1 << 20

# Rows of a table of totals that a task holds at once, of about 100 bytes each.
HASHED_ROWS = 2_000_000

BROADCAST_ROWS = 500_000
BROADCAST_CHARS = 64_000_000


def present(*columns: str) -> Column:
    """All of the columns are not NULL."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def broadcast_if_bounded(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS
) -> tuple[DataFrame, bool]:
    """Hint a broadcast only if a probe of at most ``max_rows + 1`` rows proves it small."""
    if max_rows <= 0:
        return df, False
    width = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    rows, chars = (
        df.limit(max_rows + 1)
        .select(width.alias("w"))
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0)))
        .first()
    )
    small = rows <= max_rows and chars <= max_chars
    return (F.broadcast(df), True) if small else (df, False)


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    rows: str | None = None,
    hot_rows: int = HOT_ROWS,
    table_rows: int | None = None,
) -> DataFrame:
    """Join ``table`` (one row per key) to ``df``, whatever share of ``df`` one key holds.

    One pass over ``df``: a broadcast of the keys with at least ``hot_rows`` rows, at most
    HOT_KEYS of them, flags their rows and answers them. In the one shuffle that follows flagged
    rows spread over SPREAD places of their own, where they meet nothing; all others meet the
    table. ``rows`` names the column of ``table`` that holds the number of rows of ``df`` per
    key, and is left out of the result; without it they are counted. ``table_rows`` is the number
    of rows of ``table``: if a partition's share is at most HASHED_ROWS, it is hashed and not sorted.
    """
    keys = list(keys)
    extra = [c for c in table.columns if c not in keys and c != rows]
    if rows is None:
        hot = table.join(F.broadcast(hot_keys(df, keys, hot_rows)), keys)
    else:
        hot = _largest(table, rows, keys, hot_rows)
    hot = F.broadcast(hot.select(*keys, F.struct(F.lit(1).alias("_one"), *extra).alias("_hot")))
    # Always 0, but no constant: that would be taken out of the join, and flagged rows be dealt by key.
    none = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    found = table.select(*keys, none.alias("_spread"), F.struct(F.lit(1).alias("_one"), *extra).alias("_found"))
    # keys are unique in the table, so that no partition has much more than its share
    if table_rows is not None and table_rows <= HASHED_ROWS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        found = found.hint("shuffle_hash")
    # equal rows of one partition share a place, as they have nothing else to tell them apart
    row = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    place = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.lit(SPREAD)).cast("int") + 1
    flagged = df.join(hot, keys, "left").withColumn("_spread", F.when(F.col("_hot").isNull(), 0).otherwise(place))
    out = flagged.join(found, [*keys, "_spread"], "left").withColumn("_found", F.coalesce("_hot", "_found"))
    if how != "left":
        out = out.where(F.col("_found").isNull() if how == "anti" else F.col("_found").isNotNull())
    if how == "anti":
        return out.select(*df.columns)
    return out.select(*df.columns, *[F.col(f"_found.{c}").alias(c) for c in extra])


PARTS = "_parts"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows, the HOT_KEYS largest of them, and the number of
    parts (PARTS) of about ``hot_rows`` rows that each is to be cut into."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / hot_rows).cast("int").alias(PARTS)
    return _largest(sizes, "_n", keys, hot_rows).select(*keys, parts)


def _largest(sizes: DataFrame, rows: str, keys: Sequence[str], hot_rows: int) -> DataFrame:
    return (
        sizes.where(F.col(rows) >= hot_rows).orderBy(F.desc(rows), *keys).limit(HOT_KEYS)
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_hot: DataFrame | None,
    right_hot: DataFrame | None,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
) -> DataFrame:
    """Inner join in which both sides may have many rows per key.

    ``left_hot`` and ``right_hot`` are frames of ``hot_keys`` whose columns are among ``on``.
    The rows of a key that is hot on one side are cut into its PARTS there and copied to each
    part from the other side; all other rows move once.
    """
    def salted(df: DataFrame, own: DataFrame | None, other: DataFrame | None,
               own_salt: str, other_salt: str, spread: Sequence[str]) -> DataFrame:
        for hot, flag in ((own, "_own"), (other, "_other")):
            if hot is None:
                df = df.withColumn(flag, F.lit(None).cast("int"))
            else:
                marked = F.broadcast(hot.withColumnRenamed(PARTS, flag))
                df = df.join(marked, [c for c in hot.columns if c != PARTS], "left")
        part = F.pmod(F.xxhash64(*spread), F.coalesce("_own", F.lit(1)).cast("bigint")).cast("int")
        every = F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1)
        return df.withColumn(own_salt, part).withColumn(other_salt, F.explode(every)).drop("_own", "_other")

    a = salted(left, left_hot, right_hot, "_a", "_b", left_spread)
    b = salted(right, right_hot, left_hot, "_b", "_a", right_spread)
    return a.join(b, [*on, "_a", "_b"]).drop("_a", "_b")


ROWS = "_rows"


def key_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Totals per key, and the number of rows in ROWS for ``lookup``."""
    sums = [c.alias(n) for n, c in totals.items()]
    # Always true. It keeps ROWS in every use of the totals, so that all uses have the same
    # plan and share one shuffle.
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *sums).where(F.col(ROWS) > 0)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running sum of ``value`` per key along the number ``order``, unique per key.

    The rows of a key with at least ``hot_rows`` rows are cut into BUCKETS buckets at the
    quantiles of its own order values, so sparse and dense orders are split alike; a bucket that
    still has as many is cut again, as often as it takes (``bucket_rows``). One window runs
    within a bucket. What comes before a bucket is summed up level by level, BUCKETS sums at a
    time. NULL keys are a key, and rows without an order value come first.
    """
    spark = df.sparkSession
    key = F.struct(*keys)  # never NULL itself, so that NULL keys meet in the join
    table = materialise(df.withColumn("_key", key).withColumn("_value", value), scratch_dir(spark, "running"))
    cut, levels = bucket_rows(table, "_key", order, hot_rows)
    group = ["_key", *levels]
    within = Window.partitionBy(*group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = cut.withColumn(name, F.sum("_value").over(within))
    if not levels:
        return summed.select(*df.columns, name)
    # only keys that were cut have anything before a bucket
    sums = materialise(
        cut.where(F.col(levels[0]).isNotNull()).groupBy(*group).agg(F.sum("_value").alias("_sum")),
        scratch_dir(spark, "bucket-sums"),
    )
    before = sums.select(*group, F.lit(0).alias("_before"))
    for depth in range(len(levels), 0, -1):
        parent, level = group[:depth], levels[depth - 1]
        earlier = Window.partitionBy(*parent).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        step = (
            sums.groupBy(*parent, level).agg(F.sum("_sum").alias("_sum"))
            .withColumn("_step", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        )
        same = reduce(and_, [before[c].eqNullSafe(step[c]) for c in [*parent, level]])
        before = before.join(step, same).select(
            *[before[c] for c in group], (F.col("_before") + F.col("_step")).alias("_before")
        )
    before, _ = broadcast_if_bounded(materialise(before, scratch_dir(spark, "before")))
    same = reduce(and_, [summed[c].eqNullSafe(before[c]) for c in group])
    return summed.join(before, same, "left").select(
        *[summed[c] for c in df.columns], (summed[name] + F.coalesce("_before", F.lit(0))).alias(name)
    )


def bucket_rows(df: DataFrame, key: str, order: str, hot_rows: int) -> tuple[DataFrame, list[str]]:
    """``df`` with a bucket column for every level that is needed until no group of key and
    buckets has ``hot_rows`` rows, and the names of these columns.

    A bucket is NULL where its group was small enough. Rows that the order can't tell apart
    stay together. Groups to be cut are broadcast if a probe proves their list small, else
    looked up, so their number has no limit.
    """
    levels: list[str] = []
    ends = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    spark = df.sparkSession
    for _ in range(DEPTH):
        group = F.struct(key, *levels)
        grouped = df.withColumn("_group", group)
        large = materialise(
            grouped.groupBy("_group")
            .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_low"), F.max(order).alias("_high"))
            .where((F.col("_n") >= hot_rows) & (F.col("_n") > 1) & (F.col("_low") < F.col("_high")))
            .select("_group", "_n"),
            scratch_dir(spark, "hot-groups"),
        )
        if large.isEmpty():
            break
        marked, small = broadcast_if_bounded(large.select("_group"))
        hot = grouped.join(marked, "_group") if small else lookup(grouped, large, ["_group"], "inner", "_n", hot_rows)
        bounds = materialise(
            hot.groupBy("_group").agg(F.percentile_approx(order, ends, F.lit(100 * BUCKETS)).alias("_ends")),
            scratch_dir(spark, "bounds"),
        )
        listed, small = broadcast_if_bounded(bounds)
        if small:
            cut = grouped.join(listed, "_group", "left")
        else:
            cut = lookup(grouped, bounds.join(large, "_group"), ["_group"], "left", "_n", hot_rows)
        level = f"_bucket{len(levels)}"
        bucket = F.size(F.filter("_ends", lambda e: e < F.col(order)))
        df = cut.withColumn(level, F.when(F.col("_ends").isNotNull(), bucket)).drop("_group", "_ends")
        levels.append(level)
    return df, levels
