"""The registered query's cache lasts: a second run finds every count and encodes nothing."""

import pytest
from pyspark.sql import functions as F

from lexigraph.llm import token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
from lexigraph.llm import queries  # noqa: E402


def test_a_second_run_encodes_nothing(spark, tmp_path, rows, monkeypatch):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("cached text "), (F.col("id") % 30).cast("string")).alias("text")
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    first = rows(queries.op5_token_counts(spark, str(tmp_path)))
    folder = token_counts.cache_folder(spark, public_tokenizers.path(queries.TOKENIZER))
    before = spark.read.parquet(folder).count()
    files = set(spark.read.parquet(folder).inputFiles())

    def fail(*a):
        raise AssertionError("a stored text was encoded")

    monkeypatch.setattr(type(docs), "mapInPandas", fail)
    assert rows(queries.op5_token_counts(spark, str(tmp_path))) == first
    monkeypatch.undo()
    assert set(spark.read.parquet(folder).inputFiles()) == files
    # one new text: one count is appended
    more = docs.unionByName(spark.createDataFrame([(99, "a text not seen before")], "doc_id bigint, text string"))
    more.write.parquet(str(tmp_path / "more" / "documents.parquet"))
    queries.op5_token_counts(spark, str(tmp_path / "more")).collect()
    assert spark.read.parquet(folder).count() == before + 1
