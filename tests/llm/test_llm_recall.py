"""Recall of the vector index with many lists, at the probes it fits and the production epsilon."""

import numpy as np
import pytest

from lexigraph.llm import ann_search


def vectors(kind):
    rng = np.random.default_rng(11)
    n, dims = 4000, 64
    data = rng.normal(size=(n, dims))
    if kind == "clustered":
        data = rng.normal(size=(40, dims))[rng.integers(0, 40, n)] + 0.3 * data
    data[n // 2 : n // 2 + 100] = data[:100]  # copies
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    return data


@pytest.mark.parametrize("kind", ["clustered", "unstructured"])
def test_recall_with_many_lists(spark, kind):
    data = vectors(kind)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    index = ann_search.fit(ann_search.usable(df), list_rows=100)
    found = {}
    for r in ann_search.search(df, 20, index=index).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in range(0, len(data), 20):
        scores = data @ data[q]
        scores[q] = -np.inf
        best = np.argpartition(-scores, ann_search.K)[: ann_search.K]
        hits += len(found[q] & set(best.tolist()))
        total += ann_search.K
    assert len(index.centroids) >= 20
    assert hits / total >= 0.9
