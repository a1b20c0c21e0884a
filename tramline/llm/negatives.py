"""Hard negatives by angular triangle filtering, with exact integer scores.

Every vector keeps its angles to a few reference directions. Angles obey the triangle inequality, so two vectors'
angles to one direction bound the angle between them from both sides; times the lengths this bounds their inner
product, with a margin beyond any rounding. Vectors lie in blocks of like label and angle. Blocks whose bounds miss all
windows of an anchor group are not sent to it, rows whose bounds miss all windows of an anchor get no score, and the
rest is scored in whole numbers.

Two passes over pairs of anchor groups and blocks: the anchors' best rows of the same label, then for each of these
scores the best rows of other labels within the window it opens.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, shards, stage

REFERENCES = 12  # directions
SAMPLE = 1024  # rows that directions are chosen from
BLOCK = 2048  # vectors of a block
GROUP = 512  # anchors of a group
RUN = 16  # blocks that one task holds against a group, about
ANGLE = 1e-6  # margin of an angle; arccos of a rounded cosine is off by less than 1e-7
LARGEST = 2.0**31  # length of a vector from which products may not fit a long


def usable_rows(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key, label, dim, ints, norm`` of the rows that take part, each key once."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) >= LARGEST / 256))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite)
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), whole.alias("ints"))
    squares = F.aggregate("ints", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("norm", F.sqrt(squares)).where(F.col("norm") < LARGEST)
    one = rows.groupBy("key").agg(F.min(F.struct("label", "ints", "norm")).alias("row"))
    return one.select("key", "row.label", F.size("row.ints").alias("dim"), "row.ints", "row.norm")


def directions(sample: list[list[int]], count: int = REFERENCES) -> dict[int, np.ndarray]:
    """For every number of components up to ``count`` unit vectors, each as far as can be from those before it."""
    found: dict[int, np.ndarray] = {}
    for dim in {len(v) for v in sample}:
        listed = [v for v in sample if len(v) == dim and any(v)]
        own = np.array(listed, np.float64).reshape(len(listed), dim)
        own = own / np.sqrt((own * own).sum(axis=1, keepdims=True)) if len(own) else own
        chosen: list[int] = []
        nearest = np.full(len(own), -1.0)
        while len(chosen) < min(count, len(own)):
            chosen.append(int(np.argmin(nearest)) if chosen else 0)
            nearest = np.maximum(nearest, own @ own[chosen[-1]])
        found[dim] = own[chosen]
    return found


def angles_to(refs: np.ndarray, ints: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Angles of vectors to unit vectors; zero vectors have none that matters."""
    cosines = (ints @ refs.T) / np.maximum(norms, 1e-300)[:, None] if len(refs) else np.zeros((len(ints), 0))
    return np.arccos(np.clip(cosines, -1, 1))


def products(matrix: np.ndarray, norms: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
    """Exact inner products: in floating point where no sum leaves 53 bits, else in whole numbers."""
    if norms.max(initial=0.0) * q_norm < 2.0**52:
        return np.rint(matrix @ q).astype(np.int64)
    return matrix.astype(np.int64) @ q.astype(np.int64)


def reaches(
    low: float, high: float, a_angles: np.ndarray, a_norm: float, angles: np.ndarray, norms: np.ndarray, alive: np.ndarray
) -> np.ndarray:
    """Those of the rows ``alive`` whose product with the anchor may lie between ``low`` and ``high``."""
    # nearest directions first: they bound best
    for r in np.argsort(a_angles).tolist():
        if not len(alive):
            break
        size = a_norm * norms[alive]
        margin = size * 1e-9 + 1e-6
        own = angles[alive, r]
        most = size * np.cos(np.maximum(np.abs(own - a_angles[r]) - ANGLE, 0)) + margin
        total = own + a_angles[r]
        total = np.minimum(np.minimum(total, 2 * np.pi - total) + ANGLE, np.pi)  # three angles sum to 2 pi at most
        least = size * np.cos(total) - margin
        alive = alive[(most >= low) & (least <= high)]
    return alive


def _placed(rows: DataFrame, refs, each: int, size: int, extra: str = "") -> DataFrame:
    """Blocks of up to ``each`` rows of one number of components, of like label and angle.

    Rows are dealt by ranges of (components, label, nearest direction, angle, key), so that a label or direction with
    any share of the rows spreads over ranges.
    """
    names = ["key", "label", "dim", "norm", "ints", *([extra] if extra else [])]

    def near(found):
        for row in found:
            own = np.array(row[4], np.float64)
            angles = angles_to(refs.get(len(own), np.zeros((0, len(own)))), own[None, :], np.array([row[3]]))[0]
            cell = int(np.argmin(angles)) if len(angles) else 0
            rest = (row[5],) if extra else ()
            yield *row[:4], cell, float(angles[cell]) if len(angles) else 0.0, blob(angles), blob(own), *rest

    kind = f", {extra} array<long>" if extra else ""
    schema = "key long, label long, dim int, norm double, cell int, angle double, angles binary, ints binary" + kind
    dealt = stage(arrow_rows(rows.select(*names), near, schema), "vectors")
    dealt = dealt.repartitionByRange(max(4, size), "dim", "label", "cell", "angle", "key")
    dealt = dealt.sortWithinPartitions("dim", "label", "cell", "angle", "key")

    def packed(found):
        number = TaskContext.get().partitionId() << 32
        for _, same in groupby(found, key=lambda r: r[2]):
            held: list[tuple] = []
            for row in same:
                held.append(row)
                if len(held) == each:
                    yield block(number, held)
                    number, held = number + 1, []
            if held:
                yield block(number, held)
                number += 1

    def block(number: int, held: list[tuple]) -> tuple:
        keys, labels, dims, norms, _, _, angles, ints, *rest = zip(*held, strict=True)
        turned = np.frombuffer(b"".join(angles), np.float64).reshape(len(held), -1)
        ends = turned.min(axis=0).tolist(), turned.max(axis=0).tolist()
        lists = ([list(w) for w in rest[0]],) if extra else ()
        return (
            number, dims[0], sorted(set(labels)), *ends, min(norms), max(norms),
            list(keys), list(labels), list(norms), b"".join(angles), b"".join(ints), *lists,
        )

    schema = (
        "block long, dim int, among array<long>, least array<double>, most array<double>, short double, long double, "
        "keys array<long>, labels array<long>, norms array<double>, angles binary, ints binary"
    ) + (f", {extra} array<array<long>>" if extra else "")
    return stage(arrow_rows(dealt, packed, schema), "vector-blocks")


class _Rows:
    """The rows of a block."""

    def __init__(self, keys, labels, norms, angles, ints, extra=None):
        self.keys, self.labels = np.array(keys, np.int64), np.array(labels, np.int64)
        self.norms = np.array(norms, np.float64)
        self.angles = np.frombuffer(angles, np.float64).reshape(len(keys), -1)
        self.ints = np.frombuffer(ints, np.float64).reshape(len(keys), -1)
        self.extra = extra


def first_of(scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((keys, -scores))[:k]
    return scores[order], keys[order]


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _positives(found: Iterator[tuple], k: int) -> Iterator[tuple]:
    """Sorted rows ``(group, salt, group's rows, block's rows)`` to the anchors' best rows of their own label."""
    for _, rows in groupby(found, key=lambda r: (r[0], r[1])):
        group, best = None, []
        for row in rows:
            if group is None:
                group = _Rows(*row[2:7])
                best = [_NONE] * len(group.keys)
            block = _Rows(*row[7:12])
            for i, (name, label) in enumerate(zip(group.keys.tolist(), group.labels.tolist(), strict=True)):
                scores, keys = best[i]
                floor = float(scores[-1]) if len(scores) == k else -np.inf
                alive = np.flatnonzero((block.labels == label) & (block.keys != name))
                alive = reaches(floor, np.inf, group.angles[i], group.norms[i], block.angles, block.norms, alive)
                if len(alive):
                    own = products(block.ints[alive], block.norms[alive], group.ints[i], group.norms[i])
                    best[i] = first_of(np.r_[scores, own], np.r_[keys, block.keys[alive]], k)
        for i, (scores, keys) in enumerate(best):
            for score, other in zip(scores.tolist(), keys.tolist(), strict=True):
                yield int(group.keys[i]), other, score


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole numbers n with ``low * score <= 100 * n <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _negatives(found: Iterator[tuple], k: int, low: int, high: int) -> Iterator[tuple]:
    """Sorted rows like above, the group with its anchors' positive scores, to the best rows of each score's window."""
    for _, rows in groupby(found, key=lambda r: (r[0], r[1])):
        group, best, windows = None, [], []
        for row in rows:
            if group is None:
                group = _Rows(*row[2:7], row[12])
                windows = [[(s, *window(s, low, high)) for s in sorted(set(own))] for own in group.extra]
                best = [{s: _NONE for s, *_ in own} for own in windows]
            block = _Rows(*row[7:12])
            for i, (name, label) in enumerate(zip(group.keys.tolist(), group.labels.tolist(), strict=True)):
                # a window that has its rows asks for none below them any more
                open_ = [(s, max(a, int(best[i][s][0][-1])) if len(best[i][s][0]) == k else a, b) for s, a, b in windows[i]]
                open_ = [(s, a, b) for s, a, b in open_ if a <= b]
                if not open_:
                    continue
                alive = np.flatnonzero((block.labels != label) & (block.keys != name))
                least, most = min(a for _, a, _ in open_), max(b for *_, b in open_)
                alive = reaches(least, most, group.angles[i], group.norms[i], block.angles, block.norms, alive)
                if not len(alive):
                    continue
                own = products(block.ints[alive], block.norms[alive], group.ints[i], group.norms[i])
                for s, a, b in open_:
                    inside = (own >= a) & (own <= b)
                    if inside.any():
                        scores, keys = best[i][s]
                        best[i][s] = first_of(np.r_[scores, own[inside]], np.r_[keys, block.keys[alive][inside]], k)
        for i, own in enumerate(best):
            for s, (scores, keys) in own.items():
                for score, other in zip(scores.tolist(), keys.tolist(), strict=True):
                    yield int(group.keys[i]), s, other, score


_PAYLOAD = ("keys", "labels", "norms", "angles", "ints")


def _met(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, parts: int, extra: str = "") -> DataFrame:
    """The rows of the pairs ``g, b``, dealt by group and a salt for about ``RUN`` blocks, nearest blocks first."""
    runs = pairs.groupBy("g").agg(F.ceil(F.count("*") / RUN).alias("runs"))
    salted = pairs.join(runs, "g").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("runs")))
    names = [*_PAYLOAD, *([extra] if extra else [])]
    left = groups.select(F.col("block").alias("g"), *[F.col(c).alias(f"g_{c}") for c in names])
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"b_{c}") for c in _PAYLOAD])
    met = salted.join(left, "g").join(right, "b").repartition(parts, "g", "salt").sortWithinPartitions("g", "salt", "b")
    rest = [f"g_{extra}"] if extra else []
    return met.select("g", "salt", *[f"g_{c}" for c in _PAYLOAD], *[f"b_{c}" for c in _PAYLOAD], *rest)


def _ranked(rows: DataFrame, keys: list[str], name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), name)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components count as floor(256 x), scores are integer inner products, higher first, ties to the smaller key. Anchors
    are the rows whose key is divisible by ``every``; an anchor's positives are its first ``positives`` other rows of
    the same label; of the rows of other labels with ``low`` to ``high`` percent of a positive's score the first
    ``negatives`` are returned. Rows with a null key, label or vector, or null or non-finite components, take no part,
    nor do vectors of a length of 2**31 or more, whose products may not fit a long. Vectors of different numbers of
    components have no score. A repeated key is one row: the one with the smallest label, then vector. Empty tables give
    no rows. Other columns are not read, whatever their names. Directions come from ``SAMPLE`` rows with the smallest
    hash of the key; they change what is skipped, not what is found.
    """
    held = stage(usable_rows(vectors, key, vector, label), "usable-vectors")
    sample = held.select("ints", "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect()
    refs = directions([list(r["ints"]) for r in sample])
    size = shards(held, 32 << 20, 4)
    blocks = _placed(held, refs, BLOCK, size)
    asked = held.where(F.col("key") % every == 0)
    groups = _placed(asked, refs, GROUP, max(4, size // every))
    parts = max(24, 4 * size)

    ours = groups.select(F.col("block").alias("g"), "dim", F.explode("among").alias("label"))
    theirs = blocks.select(F.col("block").alias("b"), "dim", F.explode("among").alias("label"))
    pairs = ours.join(theirs, ["dim", "label"]).select("g", "b").distinct()
    met = _met(pairs, groups, blocks, parts)
    found = arrow_rows(met, lambda rows: _positives(rows, positives), "anchor_id long, positive_id long, score long")
    best = _ranked(stage(found, "positives"), ["anchor_id"], "positive_id", positives)
    best = stage(best.select("anchor_id", "positive_id", F.col("score").alias("positive_score")), "best-positives")

    # a score below zero opens no window
    wanted = best.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))
    asked = asked.join(wanted.withColumnRenamed("anchor_id", "key"), "key")
    groups = _placed(asked, refs, GROUP, max(4, size // every), "scores")
    every_score = F.flatten("scores")
    span = groups.select(
        F.col("block").alias("g"), "dim", F.col("least").alias("g0"), F.col("most").alias("g1"), F.col("long").alias("glong"),
        F.array_min(every_score).alias("s0"), F.array_max(every_score).alias("s1"),
    )
    other = blocks.select(F.col("block").alias("b"), "dim", "least", "most", F.col("long").alias("blong"))
    # the least angle between a row of the group and one of the block, by any direction; then the largest
    gaps = F.zip_with(
        F.arrays_zip("g0", "g1"), F.arrays_zip("least", "most"),
        lambda a, b: F.greatest(b["least"] - a["g1"], a["g0"] - b["most"], F.lit(0.0)),
    )
    sums = F.zip_with("g1", "most", lambda a, b: a + b)
    near = F.greatest(F.coalesce(F.array_max(gaps), F.lit(0.0)) - F.lit(ANGLE), F.lit(0.0))
    wide = F.least(F.coalesce(F.array_min(sums), F.lit(float(np.pi))) + F.lit(ANGLE), F.lit(float(np.pi)))
    length = F.col("glong") * F.col("blong")
    margin = length * 1e-9 + 1e-6
    may = (length * F.greatest(F.cos(near), F.lit(0.0)) + margin >= F.col("s0") * (low / 100) - 1) & (
        F.least(length * F.cos(wide), F.lit(0.0)) - margin <= F.col("s1") * (high / 100) + 1
    )
    pairs = span.join(other, "dim").where(may).select("g", "b")
    met = _met(pairs, groups, blocks, parts, "scores")
    schema = "anchor_id long, positive_score long, negative_id long, score long"
    found = arrow_rows(met, lambda rows: _negatives(rows, negatives, low, high), schema)
    ranked = _ranked(stage(found, "negatives"), ["anchor_id", "positive_score"], "negative_id", negatives)
    return best.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = x.label AS same, x.vec_id AS other_id,
         CAST(list_inner_product(a.e, x.e) AS BIGINT) AS score
  FROM v a JOIN v x ON a.vec_id <> x.vec_id AND len(a.e) = len(x.e) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n FROM s WHERE same
  ) WHERE n <= 5
), r AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""


def brute_force(rows: list[tuple], every: int = 50, positives: int = 5, negatives: int = 3) -> list[tuple]:
    """The same rows from all products of ``(key, label, vector)`` rows, in whole numbers: for tests."""
    held: dict[int, tuple] = {}
    for key, label, vector in rows:
        if None in (key, label, vector) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        ints = [int(np.floor(256 * float(x))) for x in vector]
        if sum(x * x for x in ints) < 2**62:
            held[key] = min(held.get(key, (label, ints)), (label, ints))
    out = []
    for anchor, (label, q) in held.items():
        if anchor % every:
            continue
        others = [(n, own, v) for n, (own, v) in held.items() if n != anchor and len(v) == len(q)]
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), n, own == label) for n, own, v in others)
        for p, name, _ in [s for s in scored if s[2]][:positives]:
            inside = [(n, -s) for s, n, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(anchor, name, i + 1, n, -p, s) for i, (n, s) in enumerate(inside)]
    return out
