"""The near-copy filters' chance of a loss, and toxicity training, by plain calculation."""

import math

import numpy as np
import pytest

from lexigraph.llm import near_dedup, toxicity


def test_filters_of_near_copies_lose_hardly_any_link():
    """The worst case: a set that is 4/5 of the other. Each of the larger one's smallest values is
    in the smaller one with a chance of 4/5."""
    k, q = near_dedup.SKETCH, near_dedup.THRESHOLD / 100
    lists = k - 1
    kept = math.ceil(lists * (1 - near_dedup.SHARED)) + 1
    chance = {(0, False): 1 - q, (0, True): q}  # by shared neighbourhoods, and whether the last value is shared
    for _ in range(lists):
        after = {}
        for (n, last), p in chance.items():
            for shared, times in ((False, 1 - q), (True, q)):
                key = (n + (last and shared), shared)
                after[key] = after.get(key, 0.0) + p * times
        chance = after
    assert sum(p for (n, _), p in chance.items() if n + kept <= lists) < 1e-8
    least = (q - near_dedup.MARGIN) * k
    assert sum(math.comb(k, i) * q**i * (1 - q) ** (k - i) for i in range(math.ceil(least))) < 1e-8


def noisy_or(weights, bias, sentences):
    none = 1.0
    for feats in sentences:
        none *= 1 - 1 / (1 + math.exp(-(bias + sum(weights[f] for f in feats))))
    return 1 - none


def test_training_follows_the_slope_of_the_noisy_or(monkeypatch):
    """Against the same steps with slopes from differences of the likelihood."""
    monkeypatch.setattr(toxicity, "STEPS", 6)
    rng = np.random.default_rng(6)
    docs = [[sorted(set(rng.integers(0, 8, 3).tolist())) for _ in range(rng.integers(1, 5))] for _ in range(12)]
    labels = np.array([int(any(3 in s for s in d)) for d in docs], dtype=float)
    assert 0 < labels.sum() < len(labels)
    bags = [
        (np.concatenate(d).astype(np.int32), np.repeat(np.arange(len(d)), [len(s) for s in d]).astype(np.int32), len(d))
        for d in docs
    ]
    model = toxicity.train_bags(bags, labels, bits=3)

    def gain(x):
        found = np.array([noisy_or(x[:8], x[8], d) for d in docs])
        yes, no = labels == 1, labels == 0
        return 0.5 * np.log(found[yes]).mean() + 0.5 * np.log1p(-found[no]).mean()

    x, seen = np.r_[np.zeros(8), toxicity.FIRST_BIAS], np.full(9, 1e-8)
    for _ in range(6):
        slope = np.array([(gain(x + h) - gain(x - h)) / 2e-6 for h in np.eye(9) * 1e-6])
        seen += slope**2
        x = x + toxicity.RATE * slope / np.sqrt(seen)
        less = toxicity.RATE * toxicity.SPARSITY / np.sqrt(seen[:8])
        x[:8] = np.sign(x[:8]) * np.maximum(0.0, np.abs(x[:8]) - less)
    assert np.allclose(model.weights, x[:8], atol=1e-4) and model.bias == pytest.approx(x[8], abs=1e-4)


def test_score_is_the_noisy_or_of_the_sentences():
    rng = np.random.default_rng(7)
    model = toxicity.Model(rng.normal(0, 2, 1 << toxicity.BITS), -2.0)
    text = "You are vile. A fine day! vile vile words\nstraße and İstanbul? end"
    known = toxicity._Weights(model)
    got, flagged = toxicity.score_text(known, text)
    want = []
    for sentence in ("You are vile", "A fine day", "vile vile words", "straße and İstanbul", "end"):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in sentence)
        want.append([f for w in toxicity._WORD.findall(low) for f in toxicity.features(w)])
    want = [sorted(set(f)) for f in want]
    assert got == pytest.approx(noisy_or(model.weights, model.bias, want))
    for a, b, p in flagged:
        assert p >= toxicity.FLAGGED and text[a:b].strip()
