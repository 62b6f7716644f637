"""Defined results for NULLs, empty and very long texts, repeated rows, empty tables and
columns with clashing names."""

import hashlib
import math
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexigraph.llm import (
    ann_search, decontamination, hmm_lm, language_id, line_dedup, near_dedup, pii, sentencepiece_codec,
    token_counts, toxicity,
)

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "key", "row", "made", "gone", "class", "marks", "score", "lang_pred", "ids", "decoded", "digest", "Predicted",
    "offending", "chunk", "n", "k1", "component_id", "lines_before", "doc", "a.b",
)
LONG = " ".join(f"word{i % 1999}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
BENCH = "one two three four five six seven eight nine ten eleven twelve"


def documents(spark):
    rows = [
        (None, "the nameless text " + PASSAGE, "en"), (None, None, None), (1, None, "en"), (2, "", "en"), (3, " \n\t ", None),
        (4, LONG, "en"), (5, LONG + " end", "en"), (6, "the small dog runs\n" + PASSAGE, "en"),
        (7, "le petit chien court\n" + PASSAGE, "fr"), (7, "le petit chien court\n" + PASSAGE, "fr"),
        (8, "first text of eight", "en"), (8, "second text of eight\n" + PASSAGE, "en"),
        (9, f"so {BENCH} it goes", "en"), (10, "???", "en"), (11, "x", "en"),
    ]
    df = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark):
    return spark.createDataFrame(
        [(1, BENCH), (1, BENCH), (2, None), (3, ""), (None, "the small dog"), (4, "SECOND text")],
        "item_id bigint, text string",
    ).withColumns({c: F.lit("clash") for c in ("key", "run", "w")})


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=repr)


def model_path(name):
    return public_tokenizers.path(name)


def test_language_model(spark):
    got = hmm_lm.score_documents(documents(spark), states=3, own=50, shared=16).collect()
    assert len(got) == 15 and len({r.train_tokens for r in got}) == 1
    ends = {(r.doc_id, r.n_tokens) for r in got}
    assert {(None, 1), (1, 1), (2, 1), (3, 1), (4, 60_001), (11, 2)} <= ends
    assert all(r.held_out for r in got if r.doc_id is None)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm_lm.score_documents(empty(spark)).count() == 0


def test_every_round_of_the_language_model_sees_all_training_tokens(spark, monkeypatch):
    seen, plain = [], hmm_lm._round

    def counted(*args):
        got = plain(*args)
        seen.append(got[0].sum() + got[1].sum())
        return got

    monkeypatch.setattr(hmm_lm, "_round", counted)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat('b a ', 500)").alias("text"))
    trained = hmm_lm.score_documents(docs, states=2).select("train_tokens").first()[0]
    assert trained > 1_700_000 and len(seen) == 10
    assert np.allclose(seen, trained)


def test_every_word_seen_often_enough_is_a_class_of_its_own(spark):
    counts = spark.range(45_000).select(
        F.concat(F.lit("w"), "id").alias("word"), F.when(F.col("id") < 40_000, hmm_lm.OWN_FROM).otherwise(1).alias("c")
    )
    got = hmm_lm.classed_tokens(counts, hmm_lm.OWN_FROM, 16)
    words = got.words.toPandas()
    own = words[words.part >= 0]
    assert got.n_own == len(own) == 40_000 and len(words) == 45_000
    assert not own.duplicated(["part", "place"]).any() and (own.c == hmm_lm.OWN_FROM).all() and got.tokens.sum() == 5_000


def test_rounds_over_parts_and_chunks_equal_rounds_in_one_place(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "PART", 7)
    rng = np.random.default_rng(4)
    texts = {i: " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) if x < 60) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    kept = {}
    monkeypatch.setattr(hmm_lm, "classed_tokens", lambda *a, f=hmm_lm.classed_tokens: kept.setdefault("c", f(*a)))
    got = hmm_lm.score_documents(docs, states=3, own=2, shared=4).toPandas().set_index("doc_id")
    classes, words = kept["c"], {r.word: r for r in kept["c"].words.collect()}
    own = sorted((r.part, r.place, r.c) for r in words.values() if r.part >= 0)
    number = {(r[0], r[1]): 4 + i for i, r in enumerate(own)}
    of = {w: r.place if r.part < 0 else number[r.part, r.place] for w, r in words.items()}
    shares = np.r_[classes.tokens, [r[2] for r in own]] + hmm_lm.SMOOTHING
    shares /= shares.sum()
    of_part = [-1] * 4 + [r[0] for r in own]
    emit = np.vstack([
        hmm_lm._tilted(shares[[i for i, p in enumerate(of_part) if p == k]], 3, k) for k in sorted(set(of_part))
    ])
    p = hmm_lm.Parameters(*hmm_lm.first_moves(3), emit / emit.sum(axis=0))
    coded = {i: np.array([of[w.decode()] for w in hmm_lm.tokens_of(t)]) for i, t in texts.items()}
    taught = [i for i in texts if not got.held_out[i]]
    for _ in range(hmm_lm.ROUNDS):
        start, move, emit, _ = hmm_lm.expected_counts(
            p, np.concatenate([coded[i] for i in taught]), np.array([len(coded[i]) for i in taught])
        )
        start, move, emit = start + 0.1, move + 0.1, emit + 200 * shares[:, None]
        p = hmm_lm.Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    for i, t in texts.items():
        inside = sum(
            np.log10((words[w.decode()].c + 0.1) / classes.mass[of[w.decode()]])
            for w in hmm_lm.tokens_of(t) if of[w.decode()] < 4
        )
        want = hmm_lm.log_likelihoods(p, coded[i], np.array([len(coded[i])]))[0] / np.log(10) + inside
        assert np.isclose(got.score[i], want, rtol=1e-6)
    assert len(set(of_part)) > 3 and 0 < len(taught) < 60


def test_forward_and_expected_counts_equal_brute_force():
    rng = np.random.default_rng(0)
    k, c = 3, 7
    p = hmm_lm.Parameters(
        rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T
    )
    sizes = np.array([1, 5, 23, 8, 40])
    classes = rng.integers(0, c, sizes.sum())
    start, move, emit, logs = np.zeros(k), np.zeros((k, k)), np.zeros((c, k)), []
    for own in np.split(classes, np.cumsum(sizes)[:-1]):
        n = len(own)
        a, b = np.zeros((n, k)), np.ones((n, k))
        a[0] = p.start * p.emit[own[0]]
        for t in range(1, n):
            a[t] = (a[t - 1] @ p.move) * p.emit[own[t]]
        for t in range(n - 2, -1, -1):
            b[t] = p.move @ (p.emit[own[t + 1]] * b[t + 1])
        total = a[-1].sum()
        gamma = a * b / total
        logs.append(np.log(total))
        start += gamma[0]
        np.add.at(emit, own, gamma)
        for t in range(1, n):
            move += a[t - 1][:, None] * p.move * (p.emit[own[t]] * b[t])[None] / total
    for most in (1, 2, 7, 1000):  # texts in one segment and in many
        assert np.allclose(hmm_lm.log_likelihoods(p, classes, sizes, most), logs)
        got = hmm_lm.expected_counts(p, classes, sizes, most)
        assert all(np.allclose(x, y) for x, y in zip(got, (start, move, emit, sum(logs))))


def test_nearest_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (5, [0.0, -1.0]),
        (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (7, [inf, 1.0]), (100, [1.0]), (None, [1.0, 1.0]), (8, [None, 1.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("list", F.lit(1))
    got = [tuple(r) for r in ann_search.search(table, 20, k=3).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 20, 0.5), (20, 1, 2, 1.0), (20, 2, 3, 1.0), (20, 3, 0, 0.5)
    ]
    few = ann_search.search(table, 20, k=50)
    assert few.where("query_id = 0").count() == 4
    assert ann_search.search(table.limit(0), 20).count() == 0


def test_a_very_common_vector_is_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann_search, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8))
    x[:250] = x[0]
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    index = ann_search.fit(ann_search.usable(table), list_rows=100)
    index.probes = len(index.centroids)
    index.epsilon = 100.0  # abandons nothing: all that is left is exact
    got = ann_search.search(table, 10, index=index).toPandas()
    for q in range(0, 600, 10):
        order = [j for j in np.lexsort((np.arange(600), -np.round(x @ x[q], 9))) if j != q][:20]
        assert got[got.query_id == q].sort_values("rank").vec_id.tolist() == order


def test_personal_data(spark):
    texts = ["mail a.b@c.org now", None, "", "9" * 5000 + "@x", "call +1 (555) 123-4567 or 1.2.3.400 or 10.0.0.1",
             "4111 1111 1111 1111 and 4111111111111112", "é 1.2.3.4.5.6.7.8", "a@b@c.de"]
    docs = spark.createDataFrame([(None if i == 7 else i % 6, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = by_id(pii.find_pii(docs.withColumn("spans", F.lit(1))), "n_email", "n_ip", "n_card", "n_phone", "base")
    assert got == sorted([
        (0, 1, 0, 0, 0, "email:5:14"), (1, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, ""), (3, 0, 0, 0, 0, ""),
        (4, 0, 1, 0, 1, "ip:39:47,phone:5:22"), (5, 0, 0, 1, 0, "card:0:19"),
        (0, 0, 2, 0, 0, "ip:2:9,ip:10:17"), (None, 1, 0, 0, 0, "email:2:8"),
    ], key=repr)
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_contexts_give_unseen_personal_data_away(spark):
    seeds = [(i, f"please write to name{i}@host{i}.org for help {i}") for i in range(12)]
    others = [(100, "please write to admin9@localhost for help"), (101, "nobody writes to admin9x in vain")]
    noise = [(200 + i, f"chapter number {1000 + i} of it") for i in range(12)]
    docs = spark.createDataFrame(seeds + others + noise, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert got[100].spans == "email:16:32" and got[100].n_email == 0
    assert all(got[d].spans == "" for d, _ in others[1:] + noise)
    assert got[3].spans == got[3].base


def test_near_dedup(spark):
    got = by_id(near_dedup.near_groups(documents(spark), 2), "n_shingles", "component_id", "kept")
    assert len(got) == 15
    found = {(d, c, k) for d, _, c, k in got}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (7, 6, False), (6, 6, True)} <= found
    assert (None, None, False) in found  # no text and no id
    assert (11, 1, 11, True) in got  # a single word is one shingle
    assert near_dedup.near_groups(empty(spark)).count() == 0
    kept = near_dedup.drop_near_copies(documents(spark), 2)
    assert kept.columns == documents(spark).columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {None, 1, 2, 3, 4, 6, 9, 10, 11} <= ids and not ids & {5, 7}


def test_large_group_of_near_copies_and_a_common_passage(spark):
    """Copies that differ in a word each, and texts that only share a long passage."""
    base = [f"w{i}" for i in range(200)]
    copies = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(150)]
    shared = " ".join(f"p{i}" for i in range(100))
    others = [shared + " " + " ".join(f"o{j}_{i}" for i in range(100)) for j in range(150)]
    far = " ".join(base[:150] + [f"y{i}" for i in range(50)])
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate([*copies, *others, far, copies[3]])], "doc_id bigint, text string"
    )
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, 2).collect()}
    assert {got[i] for i in range(150)} == {0} and got[301] == 0
    assert all(got[i] == i for i in range(150, 301))


def test_chains_are_one_component(spark):
    """Each text is close to its neighbours only."""
    words = [f"w{i}" for i in range(160)]
    docs = spark.createDataFrame(
        [(40 - k, " ".join(words[3 * k : 3 * k + 40])) for k in range(41)], "doc_id bigint, text string"
    )
    assert {r.component_id for r in near_dedup.near_groups(docs, 2).collect()} == {0}


def test_components(spark):
    nodes = spark.range(100).withColumnRenamed("id", "class")
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(70, 80), (80, 75)], "x bigint, y bigint")
    got = {r["class"]: r.comp for r in near_dedup.components(nodes, edges).collect()}
    assert got == {i: 0 if i <= 60 else 70 if i in (70, 75, 80) else i for i in range(100)}


def test_token_counts(spark, tmp_path):
    path, cache = model_path("byte_bpe_50k.json"), str(tmp_path / "cache")
    got = token_counts.count_tokens(documents(spark), path, cache).collect()
    assert len(got) == 15
    rows = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got}
    assert {(None, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False)} <= rows
    assert any(d == 4 and over for d, _, _, over in rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == 12
    again = token_counts.count_tokens(documents(spark), path, cache).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got)) and spark.read.parquet(cache).count() == 12
    assert token_counts.count_tokens(empty(spark), path, str(tmp_path / "other")).count() == 0


def test_token_counts_trust_the_cache_of_their_version_only(spark, tmp_path):
    path, cache = model_path("byte_bpe_50k.json"), str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "a b c <|endoftext|>")], "doc_id bigint, text string")
    with open(path, encoding="utf-8") as f:
        version = token_counts.tokenizer_version(f.read())
    digest = hashlib.sha256(b"a b c <|endoftext|>").hexdigest()
    wrong = [("another version", digest, 99)]
    spark.createDataFrame(wrong, token_counts.CACHE_SCHEMA).write.parquet(cache)
    assert token_counts.count_tokens(docs, path, cache).first().n_tokens == 5
    known = [(version, digest, 42)]
    spark.createDataFrame(known, token_counts.CACHE_SCHEMA).write.parquet(str(tmp_path / "known"))
    assert token_counts.count_tokens(docs, path, str(tmp_path / "known")).first().n_tokens == 42


def test_token_counts_of_units_add_up():
    from hypothesis import given, settings, strategies as st
    from tokenizers import Tokenizer

    path = model_path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        counter = token_counts.Counter(f.read())
    assert counter.cuts
    library = Tokenizer.from_file(path)
    some = st.sampled_from(["a", "the", " ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u3000", "é", "_", "1", "'s", ".", "<|endoftext|>", "日"])
    other = st.characters(exclude_categories=["Cs"])

    @settings(max_examples=500, deadline=None)
    @given(st.lists(st.one_of(some, other), max_size=40).map("".join))
    def same(text):
        assert counter.counts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]

    same()


def test_toxicity(spark):
    labels = spark.createDataFrame(
        [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(4, 0, None), (None, 0, 1), (7, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    texts = [
        (i, f"calm words {i % 7} here. {'You rotten fool' if i % 3 == 0 else 'A nice day'}! More of it.") for i in range(300)
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(documents(spark).unionByName(docs, allowMissingColumns=True), model)
    assert got.columns[-3:] == ["score", "offending", "predicted"] and "Predicted" not in got.columns
    for r in got.where("source IS NULL").collect():
        assert r.predicted == int(r.doc_id % 3 == 0)
        if r.predicted:
            assert [r.text[x.start : x.end] for x in r.offending] == [" You rotten fool"]
    odd = got.where("source IS NOT NULL").collect()
    assert len(odd) == 15 and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_documents(empty(spark), model).count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, blank).collect()} == {0.0}


def test_sentencepiece(spark):
    path = model_path("piece_bpe_32k.model")
    got = sentencepiece_codec.encode_decode(documents(spark), path)
    assert got.columns[-2:] == ["ids", "decoded"] and got.columns.count("ids") == 1
    rows = {(r.doc_id, bytes(r.ids), r.decoded) for r in got.collect() if not r.text}
    assert rows == {(d, b"\1\0\0\0\2\0\0\0", "") for d in (None, 1, 2)}
    assert all(r.decoded == r.text for r in got.where("text <> ''").collect())
    assert sentencepiece_codec.encode_decode(empty(spark), path).count() == 0


def test_sentencepiece_takes_few_texts_at_once_and_one_codec_for_all_tasks(spark, monkeypatch):
    got = sentencepiece_codec.encode_decode(documents(spark), model_path("piece_bpe_32k.model"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "ArrowEvalPython" not in plan

    class Pieces:
        value = sentencepiece_codec.load_pieces(model_path("piece_bpe_32k.model"))

    monkeypatch.setattr(sentencepiece_codec, "_KEPT", [])
    one = sentencepiece_codec._codec_of("one", Pieces)
    assert sentencepiece_codec._codec_of("one", Pieces) is one
    assert sentencepiece_codec._codec_of("two", Pieces) is not one
    assert [name for name, _ in sentencepiece_codec._KEPT] == ["two"]


def test_sentencepiece_keeps_recent_units_when_a_cache_is_full(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "CACHED_UNITS", 8)
    monkeypatch.setattr(sentencepiece_codec, "CACHED_PAIRS", 8)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load_pieces(model_path("piece_bpe_32k.model")))
    text = " ".join(f"often rare{i}x" for i in range(50))
    want, cut, encode_unit = codec.encode(text), [], codec._encode_unit
    monkeypatch.setattr(codec, "_encode_unit", lambda unit: cut.append(unit) or encode_unit(unit))
    assert codec.encode(text) == want and codec.decode(want) == text
    assert len(cut) == 50 and not any("often" in unit for unit in cut)
    assert len(codec._units) + len(codec._older_units) <= 8 and len(codec._pairs) + len(codec._older_pairs) <= 8


def test_sentencepiece_equals_the_library_on_odd_texts():
    from hypothesis import given, settings, strategies as st
    from sentencepiece import SentencePieceProcessor

    path = model_path("piece_bpe_32k.model")
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load_pieces(path))
    model = SentencePieceProcessor(model_file=path)
    some = st.sampled_from("ab th▁ \n\t\x00é日🎉<>sunk/")

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet=st.one_of(some, st.characters(exclude_categories=["Cs"])), max_size=60))
    def same(text):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_bos=True, add_eos=True)
        assert codec.decode(ids) == model.decode(np.frombuffer(ids, "<u4").tolist())

    same()
    broken = [codec.begin, codec.byte[0xE2], codec.byte[0x96], codec.id["a"], codec.byte[0xFF], codec.end]
    assert codec.decode(np.array(broken, "<u4").tobytes()) == model.decode(broken)


def test_line_dedup(spark):
    got = line_dedup.dedup_lines(documents(spark))
    others = [c for c in documents(spark).columns if c != "lines_before"]
    assert got.columns == [*others, "lines_before", "lines_removed"]
    rows = by_id(got, "text", "lines_before", "lines_removed")
    assert (None, None, 0, 0) in rows and (1, None, 0, 0) in rows and (2, "", 1, 0) in rows
    assert rows.count((7, "le petit chien court", 2, 1)) == 2  # equal rows are one document
    assert (8, "second text of eight", 2, 1) in rows and (8, "first text of eight", 1, 0) in rows
    assert (6, "the small dog runs\n" + PASSAGE, 2, 0) in rows
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def whole_runs_gone(texts, least):
    """Lines of any run of ``least`` words or more that stands earlier as well."""
    seen, gone = {}, set()
    for d in sorted(texts):
        lines = texts[d].split("\n")
        full = [i for i, x in enumerate(lines) if x.split()]
        for a in range(len(full)):
            words = 0
            for b in range(a, len(full)):
                words += len(lines[full[b]].split())
                if words >= least:
                    run = "\n".join(lines[i] for i in full[a : b + 1])
                    if seen.setdefault(run, (d, a)) != (d, a):
                        gone |= {(d, i) for i in full[a : b + 1]}
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in texts.items()}


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "BLOCK", 3 + seed)
    rng = np.random.default_rng(seed)
    lines = [" ".join(f"l{i}w{j}" for j in range(rng.integers(0, 9))) for i in range(12)]
    texts = {d: "\n".join(rng.choice(lines, rng.integers(1, 15))) for d in range(60)}
    texts[60] = "\n".join(["again and again"] * 60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, 10).collect()} == whole_runs_gone(texts, 10)


def test_only_window_minima_are_fingerprints(spark):
    lines = [" ".join(f"l{i}w{j}" for j in range(5)) for i in range(200)]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id bigint, text string")
    made = line_dedup._fingerprints(line_dedup._filled_lines(F.col("text")), 50)
    got = docs.select(F.inline(made)).collect()
    hashes = [r.h for r in docs.select(F.explode(F.split("text", "\n")).alias("t")).select(F.xxhash64("t").alias("h")).collect()]
    windows = [hashes[i : i + 10] for i in range(191)]
    assert {r.p - 1 for r in got} == {i + w.index(min(w)) for i, w in enumerate(windows)}
    assert len(got) < 80 and all(r.mark == hashes[r.p - 1] for r in got)


def test_line_dedup_finds_parts_of_shared_runs(spark):
    """Runs that start and end anywhere, in documents whose other lines differ."""
    rng = np.random.default_rng(3)
    shared = [" ".join(f"s{i}w{j}" for j in range(rng.integers(1, 30))) for i in range(30)]
    texts = {}
    for d in range(80):
        a, b = sorted(rng.integers(0, 31, 2))
        own = [f"own{d}x{i} " * int(rng.integers(1, 4)) for i in range(4)]
        texts[d] = "\n".join([*own[:2], *shared[a:b], *own[2:]])
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == whole_runs_gone(texts, 50)


def test_language(spark):
    docs = documents(spark)
    model = language_id.fit(docs)
    got = language_id.identify(docs, model)
    assert got.columns[-2:] == ["lang_pred", "score"] and got.count() == 15
    told = {(r.doc_id, r.lang_pred, r.score) for r in got.collect() if not any(map(str.isalpha, r.text or ""))}
    assert told == {(d, "und", 0.0) for d in (None, 1, 2, 3, 10)}
    none = language_id.fit(empty(spark))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_words_back_off_to_shorter_grams(spark):
    rows = [(i, "haus baum strasse", "de") for i in range(8)] + [(i, "house tree street", "en") for i in range(8, 16)]
    docs = spark.createDataFrame(rows * 3, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    voters = language_id._Voters(model)
    assert model.langs == ["de", "en"] and "haus" in model.words
    assert language_id.predict_text(voters, "baumhaus")[0] == "de"
    assert language_id.predict_text(voters, "streets")[0] == "en"
    assert not voters.backoff("###").any()


def plain_language(rows, text, least=2):
    """The vote by counting alone."""
    langs = sorted({lang for _, lang in rows})

    def shares(counted):  # log shares of the languages, of all that one language has often enough
        total = {x: sum(n for (lang, _), n in counted.items() if lang == x) for x in langs}
        often = {key: n for key, n in counted.items() if n >= least}
        kinds = {g for _, g in often}
        logs = {g: [math.log((often.get((x, g), 0) + 0.5) / (total[x] + 0.5 * (len(kinds) + 1))) for x in langs] for g in kinds}
        return {g: [v - math.log(sum(map(math.exp, vs))) for v in vs] for g, vs in logs.items()}

    def cuts(word, k):
        word = f"^{word}$" if k > 1 else word
        return [word[i : i + k] for i in range(len(word) - k + 1)]

    taught = [(lang, w) for t, lang in rows for w in t.lower().split()]
    words = shares(Counter(taught))
    grams = {k: shares(Counter((lang, g) for lang, w in taught for g in cuts(w, k))) for k in (1, 2, 3, 4)}
    sums = [0.0] * len(langs)
    for w in text.lower().split():
        votes, weight = [words[w]] if w in words else [], 1.0
        for k, reduced in ((4, 0.7), (3, 0.5), (2, 0.3), (1, 0.1)):
            if not votes:
                votes, weight = [grams[k][g] for g in cuts(w, k) if g in grams[k]], reduced
        for x in range(len(langs)):
            sums[x] += weight * sum(v[x] for v in votes) / max(1, len(votes))
    best = max(range(len(langs)), key=lambda x: (sums[x], -x))
    return langs[best], 1 / sum(math.exp(v - sums[best]) for v in sums)


def test_language_votes_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    letters = {"aa": "abcdeo", "bb": "bcdexy", "cc": "ceioxz"}
    stock = {lang: ["".join(rng.choice(list(x), rng.integers(1, 7))) for _ in range(60)] for lang, x in letters.items()}
    rows = [(" ".join(rng.choice(stock[lang], 12)), lang) for lang in letters for _ in range(12)]
    docs = spark.createDataFrame([(8, t, lang) for t, lang in rows], "doc_id bigint, text string, lang string")
    voters = language_id._Voters(language_id.fit(docs))
    unseen = [" ".join("".join(rng.choice(list("abcdeiowxyzq"), rng.integers(1, 9))) for _ in range(4)) for _ in range(60)]
    for text in [*unseen, *(t for t, _ in rows)]:
        lang, score = plain_language(rows, text)
        found = language_id.predict_text(voters, text)
        assert found == (lang, pytest.approx(score))


def test_language_knows_words_of_any_rank(spark):
    """A word is known by its own count, however many are more frequent; the sample bounds the characters."""
    rows = [(8, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)), "xx")] * 3
    docs = spark.createDataFrame([*rows, (8, "rare rare", "xx"), (8, "once", "xx")], "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.words) == 601 and "rare" in model.words and "once" not in model.words
    many = docs.select(F.explode(F.sequence(F.lit(1), F.lit(400))).alias("doc_id"), "text", "lang")
    part = language_id.fit(many, sample_chars=200_000)
    assert 0 < len(part.words) and len(language_id.fit(many, sample_chars=0).words) == 0


def test_decontamination(spark):
    rows = by_id(
        decontamination.decontaminate(documents(spark), benchmark(spark)), "n_words", "n_hit", "n_items", "contaminated"
    )
    assert len(rows) == 15
    assert (9, 15, 12, 1, True) in rows
    assert (6, 64, 3, 0, True) in rows  # the item has no id
    assert (8, 64, 2, 1, True) in rows and (8, 4, 0, 0, False) in rows
    assert (None, 0, 0, 0, False) in rows and (2, 0, 0, 0, False) in rows
    assert decontamination.decontaminate(documents(spark), benchmark(spark).limit(0)).where("contaminated").isEmpty()
    assert decontamination.decontaminate(empty(spark), benchmark(spark)).count() == 0


def test_decontamination_joins_a_large_benchmark_without_broadcast(spark, monkeypatch):
    small = by_id(decontamination.decontaminate(documents(spark), benchmark(spark)), "n_hit", "items_sha256")
    monkeypatch.setattr(decontamination, "broadcast_if_bounded", lambda df, **_: (df, False))
    assert by_id(decontamination.decontaminate(documents(spark), benchmark(spark)), "n_hit", "items_sha256") == small


def test_pipeline_stages(spark, tmp_path):
    benchmark(spark).select("item_id", "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (documents(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "sentencepiece":
                assert sorted(out.columns) == sorted(docs.columns)
                path = str(tmp_path / f"{name}-{len(docs.columns)}")
                out.write.parquet(path)
                docs = spark.read.schema(out.schema).parquet(path)
            else:
                assert out.count() == docs.count()


def test_language_model_sums_many_chunks_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "FAN", 4)
    monkeypatch.setattr(hmm_lm, "ROUNDS", 2)
    groups, plain = [], hmm_lm._whole
    counted = spark.sparkContext.accumulator(0)

    def whole(sums, slices):
        groups.append(slices)
        got = plain(sums, slices)
        counted.add(got.select("part").distinct().count() - got.count())
        return got

    monkeypatch.setattr(hmm_lm, "_whole", whole)
    rng = np.random.default_rng(8)
    texts = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 19) if x < 40)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = hmm_lm.score_documents(docs.repartition(60), states=3, own=2, shared=4).toPandas().set_index("doc_id")
    assert groups[0] == 15 and counted.value == 0  # a chunk a partition; after the levels, one row a part
    one = hmm_lm.score_documents(docs.coalesce(1), states=3, own=2, shared=4).toPandas().set_index("doc_id")
    assert groups[-1] == 1
    assert np.allclose(got.score.sort_index(), one.score.sort_index(), rtol=1e-5)


def test_language_model_cuts_the_memory_of_one_long_text(monkeypatch):
    rng = np.random.default_rng(2)
    k, c = 3, 9
    p = hmm_lm.Parameters(
        rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T
    )
    classes, sizes = rng.integers(0, c, 5_000), np.array([4_700, 300])
    want = hmm_lm.expected_counts(p, classes, sizes, 10_000)
    held = []
    plain = hmm_lm._Lanes.__init__

    def counted(self, *args):
        plain(self, *args)
        held.append(len(self.flat))

    monkeypatch.setattr(hmm_lm._Lanes, "__init__", counted)
    monkeypatch.setattr(hmm_lm, "AT_ONCE", 200)
    got = hmm_lm.expected_counts(p, classes, sizes, 50)
    assert max(held) <= 250
    assert all(np.allclose(x, y) for x, y in zip(got, want))


def test_language_model_runs_texts_side_by_side_once(monkeypatch):
    rng = np.random.default_rng(5)
    k, c = 3, 9
    p = hmm_lm.Parameters(
        rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), size=k), rng.dirichlet(np.ones(c), size=k).T
    )
    sizes = np.array([5_000, 3, 2_049])
    classes, ran = rng.integers(0, c, sizes.sum()), []
    monkeypatch.setattr(hmm_lm, "_forward", lambda *a, f=hmm_lm._forward, **b: ran.append(1) or f(*a, **b))
    got = hmm_lm.log_likelihoods(p, classes, sizes)
    assert len(ran) == 1  # not once more from every state for texts of a few thousand tokens
    assert np.allclose(got, hmm_lm.log_likelihoods(p, classes, sizes, 50))


def test_language_model_keeps_likelihoods_of_very_rare_tokens():
    p = hmm_lm.Parameters(np.array([0.5, 0.5]), np.full((2, 2), 0.5), np.array([[1e-60, 1e-61], [1.0, 1.0]]))
    sizes = np.array([40, 1, 3])
    classes = np.zeros(sizes.sum(), dtype=np.int64)
    assert np.allclose(hmm_lm.log_likelihoods(p, classes, sizes), np.log(5.5e-61) * sizes)
    assert np.allclose(hmm_lm.expected_counts(p, classes, sizes)[2][0].sum(), sizes.sum())


def test_language_model_cuts_words_as_its_tokens(monkeypatch):
    monkeypatch.setattr(hmm_lm, "CHUNK", 6)
    monkeypatch.setattr(hmm_lm.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = [
        "  A b\u00a0c ", "", None, "\t\n", "x\x0bY\x0cz\x1cq\x85r \u4e05 \u00c4\u00e4", "one", "a a a a a a a a", "b",
    ]
    rows = [(None if i == 5 else i, i == 3, t) for i, t in enumerate(texts)]
    docs = pa.table(dict(zip(["doc_id", "held", "text"], map(list, zip(*rows))))).to_batches(max_chunksize=3)
    got, chunks = [], [SimpleNamespace(**b.to_pylist()[0]) for b in hmm_lm._cut(iter(docs))]
    for r in chunks:
        tokens, words = hmm_lm._from_planes(r.tokens), [w.encode() for w in r.words]
        own = np.split(tokens, np.cumsum(r.sizes)[:-1])
        got += [(d if n else None, h, [words[i] for i in x]) for d, n, h, x in zip(r.docs, r.named, r.held, own)]
        taught = np.concatenate([x for x, h in zip(own, r.held) if not h] or [tokens[:0]])
        assert np.array_equal(r.counts, np.bincount(taught, minlength=len(words))) and len(set(words)) == len(words)
    assert got == [(d, h, hmm_lm.tokens_of(t)) for d, h, t in rows] and len(chunks) > 2
