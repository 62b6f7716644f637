"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are dealt to lists by their nearest centroid. A query probes its closest lists; within
each, partial distances over blocks of the rotated dimensions are tested against the query's
current bound, and candidates that fail the test are abandoned early. What is left is measured on the
original vectors. Nearness is the inner product: one more dimension lifts all vectors to the length
of the longest, which turns the largest product into the smallest distance.

The centroids, and the number of lists that a query needs to probe for a recall of TARGET, are fitted
on about SAMPLE vectors chosen by hash; every vector is indexed. A query's first list gives its
bound, the other lists only report what is within it. Lists are cut into blocks of BLOCK_ROWS vectors
and their queries into blocks of BLOCK_QUERIES, so no task gets a whole large list; and a query's
lists go on until they hold ``k`` candidates.

Defined cases: vectors that are NULL, zero, hold NULL or non-finite components, have no vec_id or not
the commonest number of dimensions take no part. Rows that repeat a vec_id count once per query, by
the better vector. Ties go to the smaller vec_id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lexigraph.llm.common import written

K = 20
SAMPLE = 20_000
LIST_ROWS = 2_000
MAX_LISTS = 1_024
TURNS = 12
TARGET = 0.96
TRIALS = 200
STEP = 16
EPSILON = 2.1
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 2_048
QUERIES_AT_ONCE = 256
SEED = 2

_PROBES = "query_id bigint, vector array<double>, list int, place int"
_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part."""
    v = F.col("embedding")
    whole = (
        F.col("vec_id").isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.where(F.coalesce(whole, F.lit(False))).select(
        F.col("vec_id").cast("bigint"), v.cast("array<double>").alias("vector")
    )
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (common.d if common else 0))


@dataclass
class Index:
    turn: np.ndarray  # a random rotation of the lifted vectors
    centroids: np.ndarray  # in rotated space
    reach: float  # squared length of the longest vector
    probes: int
    epsilon: float = EPSILON

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.reach - (x * x).sum(axis=1)))
        return np.column_stack([x, rest]) @ self.turn

    def asked(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.turn


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T)


def fit(rows: DataFrame, sample: int = SAMPLE, list_rows: int = LIST_ROWS, k: int = K) -> Index:
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("reach"), F.max(F.size("vector")).alias("d")).first()
    n, dims = stats.n, (stats.d or 0) + 1
    drawn = F.pmod(F.xxhash64(F.lit("centroids"), "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    taken = rows.where(drawn < sample / max(1, n)).orderBy("vec_id").select("vector").toPandas()
    rng = np.random.default_rng(SEED)
    turn, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
    index = Index(turn, np.zeros((1, dims)), stats.reach or 0.0, 1)
    if not len(taken):
        return index
    own = np.stack(taken["vector"].to_numpy())
    x = index.lifted(own)
    lists = max(1, min(MAX_LISTS, n // list_rows, len(x) // k))
    centroids = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(TURNS):
        near = _distances(x, centroids).argmin(axis=1)
        size = np.bincount(near, minlength=lists)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
    index.centroids = centroids
    # lists that hold the sample's own neighbours of some of its vectors
    tried = rng.choice(len(x), min(TRIALS, len(x)), replace=False)
    near = _distances(x, centroids).argmin(axis=1)
    order = _distances(index.asked(own[tried]), centroids).argsort(axis=1).argsort(axis=1)
    scores = own[tried] @ own.T
    scores[np.arange(len(tried)), tried] = -np.inf
    best = np.argsort(-scores, axis=1)[:, : min(k, len(x) - 1)]
    places = np.sort(np.take_along_axis(order, near[best], axis=1).ravel())
    if len(places):
        index.probes = int(places[min(len(places) - 1, int(np.ceil(TARGET * len(places))) - 1)]) + 1
    return index


def scan(
    index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    floor: np.ndarray, k: int,
) -> pd.DataFrame:
    """Of each query the best ``k`` vectors that score at least its ``floor``."""
    x, out = index.lifted(vectors), []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(at, at + QUERIES_AT_ONCE)
        q = index.asked(queries[part])
        dims = q.shape[1]
        bound = (q * q).sum(axis=1) + index.reach - 2 * floor[part]
        a, b = np.nonzero(ids[None, :] != query_ids[part][:, None])
        so_far = np.zeros(len(a))
        for start in range(0, dims, STEP):
            stop = min(dims, start + STEP)
            block = slice(start, stop)
            if len(a) * 4 > len(q) * len(x):  # most are left: a matrix product for all
                so_far += _distances(q[:, block], x[:, block])[a, b]
            else:
                gap = q[a, block] - x[b, block]
                so_far += np.einsum("ij,ij->i", gap, gap)
            if stop < dims:
                # a rotated vector's first dimensions estimate its length to within epsilon / sqrt
                passed = so_far * (dims / stop) <= bound[a] * (1 + index.epsilon / np.sqrt(stop)) ** 2
            else:
                passed = so_far <= bound[a] * (1 + 1e-9) + 1e-9
            a, b, so_far = a[passed], b[passed], so_far[passed]
        score = np.einsum("ij,ij->i", queries[part][a], vectors[b])
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        firsts = np.searchsorted(a, np.arange(len(q)))
        best = np.arange(len(a)) - firsts[a] < k
        out.append(pd.DataFrame({"query_id": query_ids[part][a[best]], "vec_id": ids[b[best]], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(vectors: DataFrame, every: int, k: int = K, index: Index | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row whose vec_id is divisible by
    ``every``, among all others."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    shared = spark.sparkContext.broadcast(index or fit(rows, k=k))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            if len(batch):
                x = own.lifted(np.stack(batch["vector"].to_numpy()))
                yield batch.assign(list=_distances(x, own.centroids).argmin(axis=1))

    indexed = written(rows.mapInPandas(deal, "vec_id bigint, vector array<double>, list int"), "ann-index")
    sizes = indexed.groupBy("list").count().toPandas()  # at most MAX_LISTS rows
    held = np.zeros(len(shared.value.centroids), dtype=np.int64)
    held[sizes["list"].to_numpy(dtype=int)] = sizes["count"]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            if not len(batch):
                continue
            order = _distances(own.asked(np.stack(batch["vector"].to_numpy())), own.centroids).argsort(axis=1)
            enough = (np.cumsum(held[order], axis=1) > k).argmax(axis=1) + 1
            enough[held.sum() <= k] = len(held)
            n = np.maximum(enough, own.probes)
            at = np.repeat(np.arange(len(batch)), n)
            place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            yield pd.DataFrame({
                "query_id": batch["vec_id"].to_numpy()[at], "vector": batch["vector"].to_numpy()[at],
                "list": order[at, place], "place": place,
            })

    asked = indexed.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    probes = written(asked.mapInPandas(probe, _PROBES), "ann-probes")

    def scanned(wanted: DataFrame) -> DataFrame:
        """``wanted``: query_id, vector, list, floor."""
        load = wanted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).toPandas()
        grid = spark.createDataFrame(
            [(int(i), int(-(-held[i] // BLOCK_ROWS)), int(-(-n // BLOCK_QUERIES))) for i, n in zip(load["list"], load["n"])],
            "list int, row_blocks int, query_blocks int",
        )
        grid = F.broadcast(grid)

        def block(column: str, blocks: str):  # noqa: ANN202
            return F.pmod(F.xxhash64(column), F.col(blocks)).cast("int")

        def every_block(blocks: str):  # noqa: ANN202
            return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

        ours = indexed.join(grid, "list").select(
            "list", block("vec_id", "row_blocks").alias("rb"), every_block("query_blocks").alias("qb"), "vec_id", "vector"
        )
        theirs = wanted.join(grid, "list").where(F.col("row_blocks") > 0).select(
            "list", every_block("row_blocks").alias("rb"), block("query_id", "query_blocks").alias("qb"),
            "query_id", "vector", "floor",
        )

        def run(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            if not len(x) or not len(q):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            return scan(
                shared.value, x["vec_id"].to_numpy(), np.stack(x["vector"].to_numpy()),
                q["query_id"].to_numpy(), np.stack(q["vector"].to_numpy()), q["floor"].to_numpy(), k,
            )

        key = ["list", "rb", "qb"]
        return ours.groupBy(*key).cogroup(theirs.groupBy(*key)).applyInPandas(run, _FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    nothing = F.lit(float("-inf"))
    first = written(ranked(scanned(probes.where("place = 0").withColumn("floor", nothing))), "ann-first")
    floors = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    others = (
        probes.where("place > 0").join(floors, "query_id", "left")
        .withColumn("floor", F.coalesce("floor", nothing))
    )
    found = first.select("query_id", "vec_id", "score").unionByName(scanned(written(others, "ann-others")))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
