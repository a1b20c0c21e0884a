"""Names that meet in shards: packed texts stay where they are, only fingerprints and answers move.

Texts are packed in blocks once. On each level every block asks about names (pairs of 64-bit fingerprints): does a
name stand in two places, and which block stands for it? A shard sorts its tuples (name, known common length, source)
in a priority queue that spills sorted runs to disk and merges them, so it may be larger than memory. Blocks of a task
ask together: with a row for each block and shard, rows would grow with the square of the input.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, shards, stage
from tramline.session import scratch_path

BLOCK = 1 << 20  # bytes of text from which a block ends
SHARD = 1 << 20  # names of a shard, about
BUCKET = 64 << 20  # bytes of input of a bucket of blocks, at most about
GROUP = 32 << 20  # bytes of names from which blocks of a task ask together
MOST = 4096  # beyond as many shards they grow instead, and their queues go to disk
HELD = 4_000_000  # tuples a priority queue keeps in memory
POLYNOMIAL = 256  # bytes up to which a polynomial tells strings apart that are made to look alike (Thue-Morse)

# odd multipliers of the two fingerprints, fixed so that all tasks agree
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of whole numbers (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    steps = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
    for s in steps:
        s[0] = 1
    return np.cumprod(steps[0]), np.cumprod(steps[1])


class Fingerprints:
    """Fingerprints of any substring of a block: polynomials in constant time, digests beyond ``POLYNOMIAL`` bytes."""

    def __init__(self, data: np.ndarray, family: int):
        size = 1 << max(20, int(len(data)).bit_length())
        self.family, self.data = family, data
        up, self.down = _powers(_BASE[family], size)
        letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE[1 - family]))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = mix((self.sums[stop] - self.sums[start]) * self.down[start])
        for i in np.flatnonzero(stop - start > POLYNOMIAL).tolist():
            digest = hashlib.blake2b(self.data[start[i] : stop[i]], digest_size=8, key=b"%d" % self.family)
            out[i] = int.from_bytes(digest.digest(), "little")
        return out

    def all(self, size: int) -> np.ndarray:
        """Fingerprints of every substring of this size, of ``POLYNOMIAL`` bytes at most."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), [("a", "<u8"), ("b", "<u8")])
    out["a"], out["b"] = a, b
    return out


def single(a: np.ndarray) -> np.ndarray:
    return pairs(a, np.zeros(len(a), np.uint64))


class DiskQueue:
    """A priority queue of tuples (name, common length, serial), smallest name first.

    Pushed tuples are sorted in memory; beyond ``held`` they go to disk as sorted runs, which pops merge. Files lie in
    the task's own temporary folder and are gone when the queue is closed.
    """

    KIND = np.dtype([("a", "<u8"), ("b", "<u8"), ("common", "<u4"), ("serial", "<u8")])

    def __init__(self, held: int = HELD):
        self.held, self.size, self.folder = held, 0, None
        self.pushed: list[np.ndarray] = []
        self.runs: list[np.ndarray] = []

    def push(self, names: np.ndarray, common: int, first_serial: int) -> None:
        own = np.empty(len(names), self.KIND)
        own["a"], own["b"], own["common"] = names["a"], names["b"], common
        own["serial"] = np.arange(first_serial, first_serial + len(names), dtype=np.uint64)
        self.pushed.append(own)
        self.size += len(own)
        if self.size >= self.held:
            self._spill()

    def _sorted(self) -> np.ndarray:
        own = np.concatenate(self.pushed) if self.pushed else np.zeros(0, self.KIND)
        self.pushed, self.size = [], 0
        return own[np.lexsort((own["serial"], own["b"], own["a"]))]

    def _spill(self) -> None:
        self.folder = self.folder or tempfile.mkdtemp(prefix="queue-")
        path = os.path.join(self.folder, str(len(self.runs)))
        self._sorted().tofile(path)
        self.runs.append(np.memmap(path, self.KIND, "r"))

    def pop_all(self, block: int = 1 << 18) -> Iterator[np.ndarray]:
        """Tuples in order of their names; a name's tuples always come in one array."""
        if not self.runs:
            yield self._sorted()
            return
        runs = [*self.runs, self._sorted()]
        at = [0] * len(runs)
        while any(i < len(r) for i, r in zip(at, runs, strict=True)):
            # up to the smallest last name of the runs' next blocks, all names are known
            bound = min(int(r["a"][min(i + block, len(r)) - 1]) for i, r in zip(at, runs, strict=True) if i < len(r))
            taken = []
            for k, r in enumerate(runs):
                stop = int(np.searchsorted(r["a"], np.uint64(bound), "right")) if at[k] < len(r) else at[k]
                taken.append(np.array(r[at[k] : stop]))
                at[k] = stop
            own = np.concatenate(taken)
            yield own[np.lexsort((own["serial"], own["b"], own["a"]))]

    def close(self) -> None:
        self.runs = []
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


# answers to a name: it stands in two places; this block stands for it
REPEATED, STANDS = 1, 2


def _answer(rows: Iterator[tuple], common: int) -> Iterator[tuple]:
    """Rows ``(shard, group, blocks, counts, names, local)`` of a shard to ``(group, shard, blocks, counts, answers)``.

    ``local`` tells of each name whether its block holds it twice. The first source of a name stands for it. What
    stays in memory is two bytes a name; the names themselves are in the queue.
    """
    queue = DiskQueue()
    sources, flags, count = [], [], 0
    for shard, group, blocks, counts, names, local in rows:
        own = np.frombuffer(names, [("a", "<u8"), ("b", "<u8")])
        queue.push(own, common, count)
        sources.append((group, shard, blocks, counts, len(own)))
        flags.append(local)
        count += len(own)
    local = np.frombuffer(b"".join(flags), np.uint8)
    answers = np.zeros(count, np.uint8)
    for own in queue.pop_all():
        if not len(own):
            continue
        new = np.r_[True, (own["a"][1:] != own["a"][:-1]) | (own["b"][1:] != own["b"][:-1])]
        group = np.cumsum(new) - 1
        serial = own["serial"].astype(np.int64)
        twice = (np.bincount(group) > 1) | (np.bincount(group, weights=local[serial]) > 0)
        answers[serial] = twice[group] * REPEATED + new * STANDS
    queue.close()
    at = 0
    for *source, size in sources:
        yield *source, answers[at : at + size].tobytes()
        at += size


def _together(held: list[tuple[int, bytes, bytes, np.ndarray]]) -> Iterator[tuple]:
    """Names, flags and edges of blocks to rows ``(shard, group, blocks, counts, names, local)``; a group is its first block."""
    if not held:
        return
    edges = np.stack([e for _, _, _, e in held])
    counts = np.diff(edges, axis=1).astype("<u4")
    blocks = blob(np.array([block for block, _, _, _ in held], np.int64))
    for shard in np.flatnonzero(counts.any(axis=0)).tolist():
        cut = list(zip(held, edges[:, shard].tolist(), edges[:, shard + 1].tolist(), strict=True))
        names = b"".join(own[1][16 * a : 16 * b] for own, a, b in cut)
        yield shard, held[0][0], blocks, blob(counts[:, shard]), names, b"".join(own[2][a:b] for own, a, b in cut)


def _parted(rows: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
    """A group's rows ``(group, shard, blocks, counts, answers)``, by shard, to the answers of each of its blocks."""
    parts: dict[int, list[bytes]] = {}
    for _, _, blocks, counts, answers in rows:
        stop = 0
        for block, count in zip(np.frombuffer(blocks, np.int64).tolist(), np.frombuffer(counts, "<u4").tolist(), strict=True):
            start, stop = stop, stop + count
            parts.setdefault(block, []).append(answers[start:stop])
    for block, own in parts.items():
        yield block, b"".join(own)


class Level:
    """Names of one level of a block: unique, with their shards, in the order that answers come back in."""

    def __init__(self, names: np.ndarray, shards: int):
        first, second = np.ascontiguousarray(names["a"]), np.ascontiguousarray(names["b"])
        order = np.lexsort((second, first)) if second.any() else np.argsort(first, kind="stable")
        first, second = first[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.unique = pairs(first[new], second[new])
        self.local = (np.diff(np.r_[np.flatnonzero(new), len(order)]) > 1).astype(np.uint8)
        # unique names are sorted by fingerprint, so shards lie in stretches
        bounds = np.array([-(-(s << 64) // shards) for s in range(1, shards)], np.uint64)
        self.edges = np.r_[0, np.searchsorted(self.unique["a"], bounds), len(self.unique)].astype(np.int64)

    def answers(self, given: bytes) -> np.ndarray:
        """Answers in the order of the names that were given; without any, nothing is known of them."""
        out = np.frombuffer(given, np.uint8) if given else np.zeros(len(self.unique), np.uint8)
        return out[self.inverse]


def pack(docs: DataFrame, text: str, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Blocks of whole texts with their rows, written once, dealt over the files by their number."""
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c != text]
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in rest)

    def rows(found):
        task = TaskContext.get().partitionId() << 32
        number, own, data, weight = 0, [], [], 0
        for *values, content in found:
            encoded = (content or "").encode()
            if own and weight + len(encoded) > block:
                yield task + number, blob(np.array([len(d) for d in data], np.int64)), own, b"".join(data)
                number, own, data, weight = number + 1, [], [], 0
            own.append(dict(zip(rest, values, strict=True)))
            data.append(encoded)
            weight += len(encoded)
        if own:
            yield task + number, blob(np.array([len(d) for d in data], np.int64)), own, b"".join(data)

    packed = arrow_rows(
        docs.select(*rest, text), rows, f"block long, sizes binary, rest array<struct<{kinds}>>, data binary"
    )
    # bucketed by the block's number: answers come to the texts, which stay where they are
    name = f"llm_blocks_{uuid.uuid4().hex}"
    buckets = shards(docs, BUCKET, max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    packed.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "llm-blocks")).saveAsTable(name)
    packed = spark.table(name)
    packed.schema  # resolved: the name can go, the files stay  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return packed, packed.agg(F.sum(F.length("data"))).first()[0] or 0


def shard_count(n_bytes: int, bytes_per_name: int) -> int:
    return min(MOST, max(24, n_bytes // bytes_per_name // SHARD))


def ask(
    packed: DataFrame,
    given: DataFrame | None,
    level: int,
    common: int,
    shards: int,
    names: Callable[[bytes, np.ndarray, dict], Level],
) -> DataFrame:
    """One level: every block asks, shards answer; the answers of this level and those before.

    ``names`` gives a block's names from its bytes, its texts' sizes and the answers so far. Blocks without earlier
    answers have nothing left to ask.
    """

    def asked(found):
        held, weight = [], 0
        for block, sizes, data, *answers in found:
            own = names(bytes(data), np.frombuffer(sizes, np.int64), by_level(answers))
            if len(own.unique):
                held.append((block, blob(own.unique), blob(own.local), own.edges))
                weight += 17 * len(own.unique)
            if weight >= GROUP:
                yield from _together(held)
                held, weight = [], 0
        yield from _together(held)

    source = packed.select("block", "sizes", "data")
    if given is not None:
        source = source.join(by_block(given).hint("shuffle_hash"), "block")
    else:
        source = source.coalesce(max(64, shards // 4))  # some files in a task, so that blocks can ask together
    sent = arrow_rows(source, asked, "shard int, group long, blocks binary, counts binary, names binary, local binary")
    dealt = sent.repartition(shards, "shard").sortWithinPartitions("shard")

    def answered(found):
        for _, rows in groupby(found, key=lambda r: r[0]):
            yield from _answer(rows, common)

    own = arrow_rows(dealt, answered, "group long, shard int, blocks binary, counts binary, answers binary")
    own = own.repartition("group").sortWithinPartitions("group", "shard")

    def parted(found):
        for _, rows in groupby(found, key=lambda r: r[0]):
            yield from ((level, *r) for r in _parted(rows))

    own = stage(arrow_rows(own, parted, "level int, block long, answers binary"), f"names-{level}")
    return own if given is None else given.unionByName(own)


def by_block(given: DataFrame) -> DataFrame:
    """The answers of each block: bounded by what the block asked."""
    return given.groupBy("block").agg(F.collect_list(F.struct("level", "answers")).alias("given"))


def by_level(answers: list) -> dict[int, bytes]:
    out = {row["level"]: bytes(row["answers"]) for row in (answers[0] if answers else None) or ()}
    # a block that had nothing left to ask has no answers on later levels
    return {level: out.get(level, b"") for level in range(1, max(out, default=0) + 1)}
