"""Contextual extraction: planted identifiers of unseen form, decoys, and a plain version of the graph."""

import random

import pytest
from pyspark.sql import functions as F

from lexigraph.llm import pii


def prose(rng, n=12):
    return " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def planted(rng):
    """Fields with base mentions and, in other documents, with identifiers of forms the base lacks."""
    rows, hidden, clean = [], {}, set()
    for f in range(50):
        kind = ("email", "phone")[f % 2]
        name, mark = f"field{chr(97 + f % 26)}{chr(97 + f // 26)}", (":", " =")[f % 2]
        for i in range(100):
            value = f"u{f}x{i}@mail.example.com" if kind == "email" else f"+4930{f:02d}{i:05d}"
            rows.append((len(rows), f"{prose(rng)} {name}{mark} {value} {prose(rng)}"))
        for i in range(20):
            value = f"u{f}y{i}(at)mail" if kind == "email" else f"0171-{f:02d}{i:04d}x"
            text = f"{prose(rng)} {name}{mark} \"{value}\" {prose(rng)}"
            hidden[len(rows)] = (kind, text.index(value), text.index(value) + len(value))
            rows.append((len(rows), text))
    for i in range(500):  # secrets, numbers in prose, and card numbers whose check digit is wrong
        decoy = rng.choice([f'token = "{rng.randrange(10**15)}f"', f"room {rng.randrange(10**6)}", "fieldaa: 4111111111111112"])
        clean.add(len(rows))
        rows.append((len(rows), f"{prose(rng)} {decoy} {prose(rng)}"))
    rng.shuffle(rows)
    return rows, hidden, clean


def test_planted_identifiers_are_found_and_clean_documents_left(spark):
    rows, hidden, clean = planted(random.Random(7))
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(hidden) == 1000
    added = {(d, *map(tuple, r.added)) for d, r in got.items() if r.added}
    right = {(d, span) for d, span in hidden.items()}
    assert added <= right and len(added) >= 500
    assert not any(got[d].added for d in clean)
    base = {d: pii.base_spans(t) for d, t in rows}
    assert all(got[d].base == pii._joined(base[d]) for d in base)


def plain_patterns(mentions):
    """Confidence by dictionaries: a pattern's from its instances, an unseen instance's from its patterns."""
    kinds, edges = {}, set()
    for kind, instance, contexts in mentions:
        if kind:
            kinds.setdefault(instance, set()).add(kind)
        edges |= {(c, instance) for c in contexts}
    seeded = {}
    for c, i in edges:
        seeded.setdefault(c, set()).add(i)
    seen = {(c, i) for kind, i, contexts in mentions for c in contexts if kind}
    scores = {(i, k): 1.0 for i, ks in kinds.items() for k in ks}
    for turn in range(pii.ROUNDS):
        trusted = {}
        for c, instances in seeded.items():
            seeds = sum((c, i) in seen for i in instances)
            if not seeds:
                continue
            for k in pii.KINDS:
                mass = sum(scores.get((i, k), 0.0) for i in instances)
                if mass:
                    trusted[c, k] = (mass / (len(instances) + pii.DOUBT), seeds)
        heard = {}
        for c, i in edges - seen:
            for k in pii.KINDS:
                confidence, seeds = trusted.get((c, k), (0, 0))
                if seeds >= pii.MIN_SEEDS:
                    heard[i, k] = heard.get((i, k), 1.0) * (1 - min(confidence, 0.999999))
        scores = {(i, k): 1.0 for i, ks in kinds.items() for k in ks}
        for key, miss in heard.items():
            scores[key] = scores.get(key, 0.0) + 1 - miss
    return {key: c for key, (c, seeds) in trusted.items() if c >= pii.MIN_CONFIDENCE and seeds >= pii.MIN_SEEDS}


def test_graph_equals_a_plain_version(spark):
    rng = random.Random(3)
    mentions = []
    for i in range(400):
        kind = rng.choice(["email", "email", "phone", None])
        pool = {"email": "abcd", "phone": "cdef", None: "abcdefgh"}[kind]
        mentions.append((kind, f"{kind}{i % 150}", rng.sample(pool, 2)))
    df = spark.createDataFrame(mentions, "kind string, instance string, contexts array<string>")
    got = {(r.context, r.kind): r.confidence for r in pii.trusted_patterns(df).collect()}
    assert got and got == pytest.approx(plain_patterns(mentions))


def test_contexts_take_whole_words_at_any_distance():
    a, b = "x" * 100 + "1", "x" * 100 + "2"
    one = pii._contexts(f"say {a} bob@x.com" + " " * 5000 + "after", 5 + len(a), 5 + len(a) + 9)
    other = pii._contexts(f"say {b} bob@x.com" + " " * 5000 + "after", 5 + len(b), 5 + len(b) + 9)
    assert len(one) == 2 and one[1].endswith("_ after") and not set(one) & set(other)
    text = 'so phone = "12345x" go'
    assert "phone= _" in pii._contexts(text, text.index("12345x"), text.index("12345x") + 6)
    assert not list(pii._candidates("card 4111111111111112 or 1.2.3.999", []))
