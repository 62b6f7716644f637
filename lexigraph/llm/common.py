"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigraph.session import scratch_dir

SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared scratch folder: read several times, made once.

    What follows does not depend on the executors that made it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), 0)


def add_results(docs: DataFrame, made: Column, names: list[str]) -> DataFrame:
    """``docs`` with the fields ``names`` of the struct ``made``, whatever columns it has;
    columns of these names are replaced."""
    taken = {n.lower() for n in names}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("row"), made.alias("made"))
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in taken]
    return packed.select(*kept, *[F.col(f"made.{n}").alias(n) for n in names])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def split_words(text: Column, between: str = SPACE) -> Column:
    """Words between matches of the pattern ``between``; none for a NULL text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def text_key(text: Column) -> Column:
    """Tells apart rows that repeat a doc_id with another text; equal for equal rows."""
    return F.xxhash64(text)


def doc_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; 0 for a NULL id."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % mod).cast("int")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)
