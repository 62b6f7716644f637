"""Registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from lexigraph.llm import (
    ann_search, decontamination, hmm_lm, language_id, line_dedup, merkle, mixing, near_dedup, pii,
    sentencepiece_codec, spelling, token_counts, toxicity,
)
from lexigraph.llm.common import doc_remainder, read_table, sha256_hex

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
EVERY = 20


def op1_hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.search(read_table(spark, sf_dir, "embeddings"), EVERY)


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", sha256_hex(F.col("base")).alias("base_sha256"), "spans"
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(TOKENIZER)
    return token_counts.count_tokens(docs, path, token_counts.cache_folder(spark, path))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    held = doc_remainder(F.col("doc_id"), 5) == 0
    return toxicity.score_documents(docs, model).select(
        "doc_id", held.alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending")
    )


def op7_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_digests(docs)


def sentencepiece_digests(docs: DataFrame) -> DataFrame:
    coded = sentencepiece_codec.encode_decode(docs, public_tokenizers.path(PIECES))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = doc_remainder(F.col("doc_id"), 4) == 2
    return language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs)).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_dedup.near_groups(docs, shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "lines_before", "lines_removed", sha256_hex(F.col("text")).alias("text_sha256")
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).drop("key")


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    touched = F.col("doc_id").isNotNull() & (doc_remainder(F.col("doc_id"), 5) == 0)
    fields = {c: F.col(c) for c in merkle.FIELDS}
    tampered = merkle.leaf_hash((fields | {"text": merkle.tampered_text(F.col("text"))}).values())
    proved = merkle.proofs(merkle.build_manifest(docs, F.when(touched, tampered)))
    return merkle.check_proofs(proved).select(
        "doc_id", "leaf", "subroot", "root", sha256_hex(merkle.proof_text(F.col("path"))).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_hmm_language_model, op2_adaptive_dimension_scan, op3_bootstrapped_pii, op4_minhash_near_dedup,
        op5_token_counts, op6_toxicity, op7_sentencepiece_codec, op8_line_dedup, op9_language_id,
        op10_benchmark_decontamination, op11_source_mixing, op12_merkle_manifest, op13_spelling_variants,
    ]
    return {f.__name__: f for f in found}


# ---- SQL -------------------------------------------------------------------------------

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(table: str, id_column: str, gap: str) -> str:
    return (
        f"SELECT {id_column}, list_filter(string_split_regex({_LOWER}, '{gap}'), lambda x: x <> '') AS w "
        f"FROM {table}"
    )


_SPACE = r"[\x20\x09-\x0D]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_NEAR = f"""
WITH RECURSIVE d AS MATERIALIZED ({_words("documents", "doc_id", _SPACE)}),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM d),
x AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM s),
shared AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM x a JOIN x b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT shared.x, shared.y FROM shared JOIN s a ON a.doc_id = shared.x JOIN s b ON b.doc_id = shared.y
  WHERE 100 * c >= 80 * (len(a.s) + len(b.s) - c)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, b.y FROM reach JOIN both_ways b ON b.x = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN comp USING (doc_id)"""

_LINES = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
filled AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p,
         sum(c) OVER (PARTITION BY doc_id ORDER BY i) AS total
  FROM (SELECT *, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS c FROM lines) WHERE c > 0),
reaching AS MATERIALIZED (
  SELECT a.doc_id, a.p AS s, b.p AS e FROM filled a JOIN filled b
  ON a.doc_id = b.doc_id AND b.p >= a.p AND b.p < a.p + {min_words}
  AND b.total - a.total + a.c >= {min_words}),
spans AS MATERIALIZED (
  SELECT doc_id, s, min(e) AS e FROM reaching GROUP BY doc_id, s
  UNION SELECT doc_id, max(s), e FROM reaching GROUP BY doc_id, e),
runs AS MATERIALIZED (
  SELECT r.doc_id, s, e, string_agg(l, chr(10) ORDER BY p) AS run
  FROM spans r JOIN filled f ON f.doc_id = r.doc_id AND f.p BETWEEN s AND e GROUP BY ALL),
later AS (
  SELECT doc_id, s, e FROM runs
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, s) > 1),
gone AS MATERIALIZED (
  SELECT DISTINCT f.doc_id, f.i FROM later r JOIN filled f ON f.doc_id = r.doc_id AND f.p BETWEEN s AND e),
rest AS (
  SELECT l.doc_id, coalesce(string_agg(l.l, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text,
         count(*) AS n, count(g.i) AS n_gone
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS lines_before, CAST(coalesce(n_gone, 0) AS BIGINT) AS lines_removed,
       sha256(rest.text) AS text_sha256
FROM documents d LEFT JOIN rest USING (doc_id)"""

_DECONTAMINATION = f"""
WITH d AS MATERIALIZED ({_words("documents", "doc_id", _GAP)}),
b AS MATERIALIZED ({_words("benchmark", "item_id", _GAP)}),
runs AS MATERIALIZED (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, k, array_to_string(w[i : i + k - 1], ' ') AS run
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
        FROM b WHERE len(w) > 0)),
hits AS MATERIALIZED (
  SELECT doc_id, i, k, run
  FROM (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS run
        FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
              FROM d, (SELECT DISTINCT k FROM runs) WHERE len(w) >= k))
  WHERE run IN (SELECT run FROM runs)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS h
  FROM hits JOIN runs USING (run) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


_MIX = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 13) AS BIGINT) / 16.0**13 AS draw
  FROM documents),
s AS MATERIALIZED (
  SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
-- open sources by how soon they are full: all before the first that stays open are full
ranked AS (
  SELECT *, sum(source_size) OVER () AS words,
         coalesce(sum(source_size) OVER earlier, 0) AS full_words, sum(w) OVER later AS open_w
  FROM s
  WINDOW earlier AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT words - 3 * full_words AS left_words, open_w FROM ranked
  WHERE CAST(w * (words - 3 * full_words) AS DOUBLE) / CAST(open_w AS DOUBLE) <= CAST(3 * source_size AS DOUBLE)
  ORDER BY full_words LIMIT 1),
t AS (
  SELECT source, source_size,
         least(CAST(3 * source_size AS DOUBLE), CAST(w * left_words AS DOUBLE) / CAST(open_w AS DOUBLE)) AS target
  FROM s, level)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (SELECT doc_id, size, source_size, target, draw,
             CASE WHEN source_size = 0 THEN 0 ELSE target / CAST(source_size AS DOUBLE) END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)"""


def _crc32(data: str) -> str:
    """Unsigned crc32 of a blob, bit by bit."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::BIGINT)), lambda c, z: {step})"
    data_bytes = (
        f"list_transform(range(octet_length({data})), "
        f"lambda i: CAST('0x' || substr(hex({data}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    )
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data_bytes}), lambda a, b: {byte}), 4294967295)"


_FIELDS = ", ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)
_LOWER_TEXT = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# a tree for each source, then one of their tops; a node's run is its place without the last digit
_MERKLE = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, sha256(concat({_FIELDS}, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
         CASE WHEN {_crc32("encode(CAST(doc_id AS VARCHAR))")} % 5 = 0
              THEN sha256(concat({_FIELDS}, coalesce(strlen({_LOWER_TEXT}) || ':' || {_LOWER_TEXT}, '-'))) END AS other
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM d),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 16, n),
tops AS MATERIALIZED (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, n, h FROM tops
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 16, n),
runs AS MATERIALIZED (
  SELECT false AS top, source, level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT true, NULL, level, pos // 16, list(h ORDER BY pos) FROM upper WHERE n > 1 GROUP BY ALL),
steps AS MATERIALIZED (
  SELECT top, source, level, run, hs, array_to_string(hs, '') AS joined FROM runs),
walk AS (
  SELECT p.doc_id, p.leaf, p.source, false AS top, 0 AS level, p.pos, p.leaf AS a, coalesce(p.other, p.leaf) AS b,
         '' AS proof, t.pos AS top_pos, t.h AS subroot, p.n = 1 AS up
  FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
  UNION ALL
  SELECT doc_id, leaf, w.source, w.top, w.level + 1, w.pos // 16,
         sha256(lefts || a || rights), sha256(lefts || b || rights), proof || lefts || rights, top_pos, subroot,
         false
  FROM (SELECT w.*, array_to_string(s.hs[1 : w.pos % 16], '') AS lefts,
               array_to_string(s.hs[w.pos % 16 + 2 : ], '') AS rights
        FROM (SELECT doc_id, leaf, source, top OR here AS top, CASE WHEN here THEN 0 ELSE level END AS level,
                     CASE WHEN here THEN top_pos ELSE pos END AS pos, a, b, proof, top_pos, subroot
              FROM (SELECT *, NOT top AND a = subroot AND (level > 0 OR up) AS here FROM walk)) w
        JOIN steps s ON s.top = w.top AND (w.top OR s.source IS NOT DISTINCT FROM w.source)
                    AND s.level = w.level AND s.run = w.pos // 16) w),
ends AS (SELECT *, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY length(proof) DESC, top DESC, level DESC) AS r FROM walk)
SELECT doc_id, leaf, subroot, a AS root, sha256(proof) AS proof_sha256, b AS folded_root, a = b AS verified
FROM ends WHERE r = 1"""

_SPELLING = f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("encode(doc_id || ':' || run)")} AS h FROM runs),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 : ] ELSE run END AS word, n
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (
  SELECT word, i, word[1 : i - 1] || word[i + 1 : ] AS cut
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.cut),
best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS m
  FROM near JOIN words ON words.word = b GROUP BY a),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN b END AS form,
         CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root WHERE e.form IS NULL"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_minhash_near_dedup": _NEAR,
        "op8_line_dedup": _LINES.format(min_words=line_dedup.MIN_WORDS),
        "op10_benchmark_decontamination": _DECONTAMINATION,
        "op11_source_mixing": _MIX.format(seed=mixing.SEED),
        "op12_merkle_manifest": _MERKLE,
        "op13_spelling_variants": _SPELLING,
    }
