"""Quality by compression: two zstandard dictionaries, one of good and one of bad text.

Text compresses better with the dictionary of its own kind. The difference of the two compressed sizes, divided by
the length, goes through a logistic curve fitted on labelled rows and becomes a score from 0 to 1.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows

BLOCK = 1024  # bytes compressed at a time: short enough for the dictionary to matter in every part of a long text


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and curve; about a quarter of a megabyte, whatever the input."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    level: int

    def score(self, difference: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(curve_inputs(difference, length) @ np.array(self.weights))))


def curve_inputs(difference: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The difference, its weight growing with the length, and the length: short texts say little."""
    d, n = np.clip(difference, -0.5, 0.5), np.log1p(np.minimum(length, 20_000))
    return np.stack([np.ones_like(d), d, n, d * n], axis=1)


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


class _Sizes:
    """Compressed sizes of a text with either dictionary; one per worker."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        self.packers = []
        for content in (good, bad):
            words = zstandard.ZstdCompressionDict(content)
            words.precompute_compress(level=level)
            self.packers.append(
                zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_dict_id=False)
            )

    def difference(self, data: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, per byte of text; 0 for an empty text."""
        if not data:
            return 0.0
        good, bad = (sum(len(p.compress(b)) for b in _blocks(data)) for p in self.packers)
        return (bad - good) / len(data)


def _differences(docs: DataFrame, good: bytes, bad: bytes, level: int, carried: list[str], text: str) -> DataFrame:
    """``carried`` columns with ``difference`` and ``n_bytes`` of every text."""
    sizes = docs.sparkSession.sparkContext.broadcast((good, bad))

    def rows(found):
        packers = _Sizes(*sizes.value, level)
        for *rest, content in found:
            data = (content or "").encode()
            yield (*rest, packers.difference(data), len(data))

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    return arrow_rows(docs.select(*carried, text), rows, f"{kinds}, difference double, n_bytes long")


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Logistic regression by Newton's method; one class alone gives a constant near that class."""
    if len(x) == 0:
        return (0.0,) * 4
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1]) * len(x) / 1000
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    per_class: int = 3000,
    blocks_per_text: int = 3,
    dictionary_bytes: int = 131_072,
    level: int = 3,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> QualityModel:
    """Fit on a bounded sample: ``per_class`` labelled rows of either class, ``blocks_per_text`` blocks of each.

    Three rows of four build the dictionaries, the fourth fits the curve on whole texts. ``usable`` says, from the
    key alone, which rows may be learnt from. Rows are taken in the order of a hash of the key, so the sample is the
    same for the same table. A key that is labelled twice counts once, with the lower label, and a key with several
    texts with the smallest of them (null last); null keys and labels do not count. Without labelled rows, or with texts too few for a dictionary, dictionaries stay empty or raw.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("_label"))
    order = F.xxhash64(F.col(key), F.lit("sample"))
    known = docs.where(usable & F.col(key).isNotNull()).select(key).distinct().join(one, key)
    picked = [
        known.where(F.col("_label") == c).withColumn("_order", order).orderBy("_order", key).limit(per_class)
        for c in (1, 0)
    ]
    # at most 2 * per_class keys: bounded, so broadcasting is safe at any input size
    sample = F.broadcast(picked[0].union(picked[1]).select(key, "_label", F.pmod("_order", F.lit(4)).alias("_part")))
    rows = docs.select(key, text).join(sample, key).groupBy(key, "_label", "_part").agg(F.min(text).alias(text))

    def some_blocks(found):
        for name, content, c in found:
            own = _blocks((content or "").encode())
            draw = random.Random(str(name))
            for block in draw.sample(own, min(blocks_per_text, len(own))):
                yield c, block

    kind = labels.schema[label].dataType.simpleString()
    taken = arrow_rows(
        rows.where("_part > 0").select(key, text, "_label"), some_blocks, f"label {kind}, block binary"
    ).collect()
    good, bad = (_dictionary([bytes(r.block) for r in taken if r.label == c], dictionary_bytes) for c in (1, 0))
    held = rows.where("_part = 0").select("_label", text)
    seen = _differences(held, good, bad, level, ["_label"], text).toPandas()
    seen = seen.sort_values(["_label", "n_bytes", "difference"])  # rows come in any order, sums of floats depend on it
    x = curve_inputs(seen["difference"].to_numpy(float), seen["n_bytes"].to_numpy(float))
    return QualityModel(good, bad, _fit_curve(x, seen["_label"].to_numpy(float)), level)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    samples = sorted(samples)
    random.Random(0).shuffle(samples)
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8, f=20, accel=1).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def score(
    docs: DataFrame, model: QualityModel, threshold: float = 0.3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, score, predicted`` for every row; nothing but the text decides. Null counts as empty text."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def rows(found):
        own = packed.value
        sizes = _Sizes(own.good, own.bad, own.level)
        for name, content in found:
            data = (content or "").encode()
            value = float(own.score(np.array([sizes.difference(data)]), np.array([float(len(data))]))[0])
            yield name, value, int(value >= threshold)

    kind = docs.schema[key].dataType.simpleString()
    return arrow_rows(docs.select(key, text), rows, f"{key} {kind}, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    packed = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def rows(found):
        own = packed.value
        sizes = _Sizes(own.good, own.bad, own.level)
        for row in found:
            data = (row[at] or "").encode()
            if own.score(np.array([sizes.difference(data)]), np.array([float(len(data))]))[0] >= threshold:
                yield row

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_rows(docs, rows, schema)
