"""Exact top-k inner products by norm buckets.

Vectors lie in buckets of similar length. A query brings a score that its k-th best surely reaches; divided by the
query's length and a bucket's greatest length it is the bucket's local cosine threshold. Above one, the whole bucket
falls; if high, vectors must lie within bounds in the query's heaviest coordinates; if low, only the length decides.
What is left is verified with exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, stage

GROUP = 8192  # queries of a pass, and
GROUP_BYTES = 64 << 20  # their bytes: both bound what is broadcast
LONGEST = 2048  # longest vectors that give the first thresholds
COSINE = 0.3  # local threshold from which coordinates prune better than lengths
FOCUS = 4  # coordinates looked at
BUCKETS = 8  # buckets from one length to its double


def integer_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, dim, norm, bucket, ints``: floor(256 x) of the vectors that take part, as packed whole numbers."""
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )

    def rows(found):
        for name, values in found:
            ints = np.floor(256.0 * np.array(values, np.float64))
            norm = float(np.sqrt(ints @ ints))
            bucket = int(np.floor(np.log2(norm) * BUCKETS)) if norm else -(1 << 20)
            yield name, len(ints), norm, bucket, blob(ints.astype("<i8"))

    kept = vectors.where(usable).select(key, F.col(vector).cast("array<double>").alias(vector))
    return arrow_rows(kept, rows, f"{key} long, dim int, norm double, bucket int, ints binary")


def _products(matrix: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact: in floating point where no sum leaves 53 bits, else in whole numbers."""
    top = np.abs(matrix).max(initial=0) * np.abs(q).max(initial=0) * max(1, len(q))
    if top < 2**53:
        return np.rint(matrix @ q).astype(np.int64)
    return matrix.astype(np.int64) @ q.astype(np.int64)


class _Best:
    """The k best of a query so far, each id once with its best score: higher scores, then smaller ids."""

    def __init__(self, k: int, floor: float):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        ids, scores = _once(np.r_[self.ids, ids], np.r_[self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, float(self.scores[-1]))


def search_bucket(q: np.ndarray, q_norm: float, best: _Best, matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Indexes of the vectors of a bucket, longest first, that may reach the query's floor."""
    floor = best.floor
    if floor <= 0 or q_norm == 0:
        return np.arange(len(norms))
    slack = floor * (1 - 1e-9) - 1e-6
    if q_norm * norms[0] < slack:
        return np.zeros(0, np.int64)
    within = int(np.searchsorted(-norms, -slack / q_norm, "right"))  # length pruning
    local = min(1.0, slack / (q_norm * norms[0]))
    if local < COSINE:
        return np.arange(within)
    # coordinate pruning: with cosine t to q, component f of the unit vector is near t * q_f
    unit = q / q_norm
    alive = np.arange(within)
    for f in np.argsort(-np.abs(unit))[:FOCUS]:
        own = matrix[alive, f] / np.maximum(norms[alive], 1e-300)
        reach = np.sqrt(max(0.0, 1 - unit[f] ** 2) * np.maximum(0.0, 1 - own**2))
        # cosine of the vector is at most unit_f own_f + reach
        need = slack / (q_norm * norms[alive])
        alive = alive[unit[f] * own + reach >= need - 1e-9]
    return alive


def _with_floors(asked: DataFrame, longest: list, key: str, k: int) -> DataFrame:
    """Queries with a score that the k-th best surely reaches, from products with the longest vectors."""
    sent = asked.sparkSession.sparkContext.broadcast(longest)

    def rows(found):
        by_dim: dict[int, tuple] = {}
        for dim in {len(v) for _, v in sent.value}:
            own = [(i, v) for i, v in sent.value if len(v) == dim]
            by_dim[dim] = np.array([i for i, _ in own]), np.stack([v for _, v in own]).reshape(len(own), dim)
        for name, ints in found:
            q = np.frombuffer(ints, "<i8").astype(np.float64)
            ids, matrix = by_dim.get(len(q), (np.zeros(0), np.zeros((0, len(q)))))
            scores = np.sort(_products(matrix, q)[ids != name])
            yield name, ints, float(scores[-k]) if len(scores) >= k else float("-inf")

    return arrow_rows(asked.select(key, "ints"), rows, f"{key} long, ints binary, floor double")


def search(
    vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", group: int = GROUP
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of every row whose key is divisible by ``every``.

    Candidates are all rows with another key and as many components; ties go to the smaller key. Rows with a null
    key, a null vector, or null or non-finite components take no part; components are to stay below 2^31, so that
    products fit. A repeated key is one query, with the smallest of its packed vectors; as candidates its rows count
    once with their best score. Queries run in groups of at most about ``group`` rows and ``GROUP_BYTES``, one pass over
    the vectors each; only a pass's group is on the driver, to be broadcast, and its result is written before the next.
    Nothing is cut off: pruning leaves out only what cannot reach the k-th best.
    """
    held = stage(integer_vectors(vectors, key, vector), "vectors")
    spark = vectors.sparkSession
    asked = held.where(F.col(key) % every == 0).groupBy(key).agg(F.min("ints").alias("ints"))
    # at most LONGEST keys; they come first, so that a task passes on numbers and not vectors
    top = held.groupBy(key).agg(F.max("norm").alias("norm")).orderBy(F.desc("norm"), key).limit(LONGEST).select(key)
    longest = [
        (r[0], np.frombuffer(r[1], "<i8").astype(np.float64))
        for r in held.join(F.broadcast(top), key).groupBy(key).agg(F.min("ints")).collect()
    ]
    asked = stage(_with_floors(asked, longest, key, k), "queries")
    size = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("ints")), F.lit(0))).first()
    groups = max(1, -(-size[0] // group), -(-size[1] // GROUP_BYTES))
    found = None
    for number in range(groups):
        own = asked.where(F.pmod(F.xxhash64(key), F.lit(groups)) == number).collect()
        queries = {r[0]: np.frombuffer(r[1], "<i8").astype(np.float64) for r in own}
        sent = spark.sparkContext.broadcast((queries, {r[0]: r[2] for r in own}))
        some = arrow_rows(held.select(key, "dim", "norm", "bucket", "ints"), _scan(sent, k), "query_id long, vec_id long, score long")
        some = stage(some, "scores")
        sent.unpersist()
        found = some if found is None else found.union(some)
    # a query has at most k rows of each task here
    unique = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = unique.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _scan(sent, k: int):
    def rows(found: Iterator[tuple]):
        queries, floors = sent.value
        best = {name: _Best(k, floors[name]) for name in queries}
        lengths = {name: float(np.sqrt(q @ q)) for name, q in queries.items()}

        def look(batch: list[tuple]) -> None:
            buckets: dict[tuple[int, int], list[tuple]] = {}
            for row in batch:
                buckets.setdefault((row[1], row[3]), []).append(row)
            for (dim, _), members in sorted(buckets.items(), key=lambda b: -b[0][1]):
                members.sort(key=lambda r: -r[2])
                ids = np.array([m[0] for m in members], np.int64)
                norms = np.array([m[2] for m in members])
                matrix = np.frombuffer(b"".join(m[4] for m in members), "<i8").reshape(len(members), dim)
                matrix = matrix.astype(np.float64)
                for name, q in queries.items():
                    if len(q) != dim:
                        continue
                    at = search_bucket(q, lengths[name], best[name], matrix, norms)
                    at = at[ids[at] != name]
                    if len(at):
                        scores = _products(matrix[at], q)
                        good = scores >= best[name].floor
                        if good.any():
                            best[name].add(scores[good], ids[at][good])

        batch: list[tuple] = []
        for row in found:
            batch.append(row)
            if len(batch) == 8192:
                look(batch)
                batch = []
        look(batch)
        for name, own in best.items():
            for score, candidate in zip(own.scores.tolist(), own.ids.tolist(), strict=True):
                yield name, candidate, score

    return rows


def _once(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id with its best score."""
    order = np.lexsort((-scores, ids))
    ids, scores = ids[order], scores[order]
    first = np.r_[True, ids[1:] != ids[:-1]]
    return ids[first], scores[first]


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.e) = len(p.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
