"""Token counts through a cache of content digests.

A text's digest and the digest of the tokenizer's version find its stored count. Only one copy of
each text that the cache lacks is encoded; its count is appended to the cache. Counts are then
joined to all documents.

The cache is a Parquet folder of (version, digest, n_tokens). Appends add files; a digest that two
runs append at once is read once. Content is the text as the tokenizer gets it, NULL as empty.

Defined cases: rows that repeat a doc_id or have none are counted by their own texts. A tokenizer
file with other content or another library version is another version.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.llm.common import written
from lexigraph.session import lasting_dir

LIMIT = 1024
TEXTS_AT_ONCE = 256
CACHED_UNITS = 700_000
LONGEST_CACHED = 64
CACHE_SCHEMA = "version string, digest string, n_tokens bigint"


_CUT = re.compile(r"(?<=\w)(?=[ \n])")


def tokenizer_version(definition: str) -> str:
    import tokenizers

    return hashlib.sha256(f"{tokenizers.__version__}\n{definition}".encode()).hexdigest()


def cache_folder(spark: SparkSession, tokenizer_path: str) -> str:
    """A tokenizer version's cache in the shared folder, the same at every run."""
    with open(tokenizer_path, encoding="utf-8") as f:
        return lasting_dir(spark, f"token-cache-{tokenizer_version(f.read())}")


class Counter:
    """Counts of whole texts, each distinct unit of which is encoded once.

    Texts are cut between a word character and a blank or line end, where byte-level pre-tokenizers
    always cut as well; a tokenizer that reads more than that at once gets whole texts.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(definition)
        self.cuts = (
            parts.get("normalizer") is None
            and (parts.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
            and not parts["pre_tokenizer"].get("add_prefix_space")
            and parts["pre_tokenizer"].get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or _CUT.search(t["content"]) for t in parts.get("added_tokens", []))
        )
        self.known: dict[str, int] = {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            part = texts[at : at + TEXTS_AT_ONCE]
            out += self._cut_counts([_CUT.split(t) for t in part]) if self.cuts else self._encoded(part)
        return out

    def _cut_counts(self, texts: list[list[str]]) -> list[int]:
        known = self.known
        if len(known) > CACHED_UNITS:
            known.clear()
        unseen = list({u for units in texts for u in units if u not in known})
        known.update(zip(unseen, self._encoded(unseen)))
        found = [sum(map(known.__getitem__, units)) for units in texts]
        for unit in unseen:
            if len(unit) > LONGEST_CACHED:
                del known[unit]
        return found


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    version = tokenizer_version(definition)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache)

    def stored() -> DataFrame:
        own = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
        # written, so that a digest that many documents have can be split in the join
        return written(own.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "stored-counts")

    content = F.coalesce("text", F.lit(""))
    digested = docs.select("doc_id", content.alias("content"), F.sha2(content, 256).alias("digest"))
    marked = written(
        digested.select("doc_id", "digest", F.octet_length("content").cast("bigint").alias("n_bytes")), "digests"
    )
    missing = written(
        marked.join(stored(), "digest", "left_anti")
        .groupBy("digest").agg(F.min("doc_id").alias("one")),
        "missing",
    )
    on = (F.col("a.digest") == F.col("b.digest")) & F.col("a.doc_id").eqNullSafe(F.col("b.one"))
    texts = digested.alias("a").join(missing.alias("b"), on, "left_semi").select("digest", "content")
    shared = spark.sparkContext.broadcast(definition)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        for batch in batches:
            counts = counter.counts(batch["content"].tolist())
            yield pd.DataFrame({"version": version, "digest": batch["digest"], "n_tokens": counts})

    if not missing.isEmpty():
        texts.mapInPandas(encode, CACHE_SCHEMA).distinct().write.mode("append").parquet(cache)
    rows = marked.join(stored(), "digest", "left")
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
