"""Global line numbers, made without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir
from ..sinks.writers import materialise
from .keyed import broadcast_if_bounded, lookup

# Fixed value: monotonically_increasing_id has the partition above this many bits.
PART_BITS = 33

PLACE = "_place"


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str, per: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """``df`` with each row's number, from 1, in ``order`` within equal values of ``per``.

    Rows are partitioned by range of (per, order), sorted, and written with their place in the
    partition; a key with most of the rows spans many partitions. What comes before a partition
    follows from the partitions' counts, of which there are as many as shuffle partitions. NULL
    keys are a key. ``total`` names a column for the number of rows of equal ``per``. Rows
    that are equal in ``order`` are numbered in no defined order.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in per] + [F.col(c) if isinstance(c, str) else c for c in order]
    if not keys:
        raise ValueError("an order is needed")
    key = F.struct(F.lit(0).alias("_all"), *per)  # never NULL itself, so that NULL keys meet
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(
        sorted_rows.withColumn(PLACE, F.monotonically_increasing_id()), scratch_dir(spark, "ordered")
    )
    part = F.shiftright(PLACE, PART_BITS)
    counts = placed.groupBy(part.alias("_part_no")).agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as partitions, whatever the number of rows
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("_part_no", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = (
        placed.withColumn("_part_no", part).join(F.broadcast(sums), "_part_no")
        .withColumn(name, F.col("_before") + F.col(PLACE) - F.shiftleft("_part_no", PART_BITS) + 1)
        .drop("_part_no", "_before", PLACE)
    )
    if not per and total is None:
        return numbered
    groups = materialise(
        numbered.groupBy(key.alias("_key")).agg(F.min(name).alias("_first"), F.count(F.lit(1)).alias("_total")),
        scratch_dir(spark, "firsts"),
    )
    groups, small = broadcast_if_bounded(groups)
    rows = numbered.withColumn("_key", key)
    found = rows.join(groups, "_key") if small else lookup(rows, groups, ["_key"], "inner")
    extra = [] if total is None else [F.col("_total").alias(total)]
    return found.select(*df.columns, (F.col(name) - F.col("_first") + 1).alias(name), *extra)
