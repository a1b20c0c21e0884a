"""Removal of long repeated byte strings, by names of sampled suffixes that are induced to all others.

A repeated string is ``length`` bytes that start in two places. Sorting every suffix would need many bytes for each
byte of text, so the work runs through levels, each on what the one before left open:

1. Every window of ``length`` bytes has a sampled suffix: the one with the smallest fingerprint of its first ``CORE``
   bytes, leftmost on ties. Neighbouring windows share it and form a run. Equal windows have equal samples, so windows
   whose sample's name occurs once are done.
2. A run's whole string, from its first window to the end of its last, gets a name. If it occurs twice, so does every
   window in it.
3. Samples that still stand for different strings are found: only there can windows agree in part of a run.
4. The windows of those runs are named one by one; of equal runs one stands for all.

Names meet in shards. A shard sorts its tuples (name, known common length, source) in a priority queue that spills
sorted runs to disk and merges them, so a shard may be larger than memory; equal neighbours share a name. Texts are
packed in blocks once and are never shuffled; only names and answers move. Each block sends a name once, however often
it holds it, so no passage that many documents share is a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows
from tramline.llm.names import (
    REPEATED,
    STANDS,
    Fingerprints,
    Level,
    ask,
    by_block,
    by_level,
    mix,
    pack,
    pairs,
    shard_count,
    single,
)

LENGTH = 200
CORE = 150  # bytes of a sampled suffix that name it
BLOCK = 1 << 19  # bytes of text from which a block ends: where all strings repeat, a block takes a hundred times its size


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def core_names(cores: np.ndarray) -> np.ndarray:
    """Names of sampled suffixes. A sample has the smallest fingerprint of many, so its bits are mixed before its upper
    ones choose a shard; else most names would meet in the first."""
    return single(mix(cores))


class Runs:
    """Runs of neighbouring windows of a block that share their sampled suffix."""

    def __init__(self, data: bytes, sizes: np.ndarray, length: int = LENGTH, core: int = CORE):
        self.length = length
        self.bytes = np.frombuffer(data, np.uint8)
        self.sizes = sizes
        n = len(self.bytes)
        self.first = self.last = self.sample = np.zeros(0, np.int64)
        self.cores = np.zeros(0, np.uint64)
        if n < length:
            return
        self.prints = Fingerprints(self.bytes, 0)
        names = self.prints.all(core)
        # fingerprint above, place below: the smallest is the leftmost of the smallest
        order = (names & ~np.uint64((1 << 36) - 1)) | np.arange(len(names), dtype=np.uint64)
        sample = (_sliding_min(order, length - core + 1) & np.uint64((1 << 36) - 1)).astype(np.int64)
        stops = np.cumsum(sizes)
        valid = np.zeros(n + 1, np.int32)  # windows that stay inside a document
        long = sizes >= length
        np.add.at(valid, (stops - sizes)[long], 1)
        np.add.at(valid, stops[long] - length + 1, -1)
        valid = np.cumsum(valid)[: len(sample)] > 0
        at = np.flatnonzero(valid)
        if not len(at):
            return
        cut = np.flatnonzero((np.diff(sample[at]) != 0) | (np.diff(at) != 1))
        self.first, self.last = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]]
        self.sample = sample[self.first]
        self.cores = names[self.sample]

    def second(self) -> Fingerprints:
        return Fingerprints(self.bytes, 1)

    def strings(self, which: np.ndarray) -> np.ndarray:
        """Names of the whole strings of runs: two fingerprints."""
        start, stop = self.first[which], self.last[which] + self.length
        return pairs(self.prints.of(start, stop), self.second().of(start, stop) ^ (stop - start).astype(np.uint64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all windows of runs, and their names."""
        size = self.last[which] - self.first[which] + 1
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(self.first[which], size) + inner
        return at, pairs(self.prints.of(at, at + self.length), self.second().of(at, at + self.length))


class BlockState:
    """A block led through the levels as far as answers are known."""

    def __init__(self, data: bytes, sizes: np.ndarray, given: dict[int, bytes], shards: int, shape: tuple):
        self.runs = Runs(data, sizes, *shape)
        n = len(self.runs.first)
        self.sure = np.zeros(n, bool)  # all windows of the run are repeated
        self.single = np.zeros(0, np.int64)  # repeated windows of other runs
        self.level = Level(core_names(self.runs.cores), shards)
        if 1 not in given:
            return
        open_ = np.flatnonzero(self.level.answers(given[1]) & REPEATED)
        self.level = Level(self.runs.strings(open_), shards)
        if 2 not in given:
            return
        answer = self.level.answers(given[2])
        self.sure[open_[answer & REPEATED > 0]] = True
        # one run for each string: where this block stands for it, its first run of that string
        stands = np.flatnonzero(answer & STANDS)
        stands = stands[np.sort(np.unique(self.level.inverse[stands], return_index=True)[1])]
        open_ = open_[stands]
        self.level = Level(core_names(self.runs.cores[open_]), shards)
        if 3 not in given:
            return
        open_ = open_[self.level.answers(given[3]) & REPEATED > 0]
        at, names = self.runs.windows(open_)
        self.level = Level(names, shards)
        if 4 not in given:
            return
        self.single = at[self.level.answers(given[4]) & REPEATED > 0]

    def removed(self) -> np.ndarray:
        """A flag for every byte of the block."""
        edge = np.zeros(len(self.runs.bytes) + 1, np.int64)
        np.add.at(edge, self.runs.first[self.sure], 1)
        np.add.at(edge, self.runs.last[self.sure] + self.runs.length, -1)
        np.add.at(edge, self.single, 1)
        np.add.at(edge, self.single + self.runs.length, -1)
        return np.cumsum(edge)[:-1] > 0


def find_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, core: int = CORE
) -> tuple[DataFrame, DataFrame, int]:
    """Packed texts and the answers to the names of all levels: ``block, given``; and the number of shards."""
    packed, size = pack(docs, text, BLOCK)
    shards = shard_count(size, 30)
    given = None
    for level, common in enumerate((core, length, core, length), 1):

        def names(data, sizes, answers):
            return BlockState(data, sizes, answers, shards, (length, core)).level

        given = ask(packed, given, level, common, shards, names)
    return packed, by_block(given), shards


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, core: int = CORE) -> DataFrame:
    """Every row of ``docs`` with ``kept`` (bytes left of the text), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte is removed that lies in a string of ``length`` bytes which starts anywhere else too, in the same text
    or another; strings never cross texts, and all are judged on the input. Rows keep their other columns, whatever
    their names; repeated rows are copies of each other and lose all that is long enough. Null counts as empty; texts
    shorter than ``length`` stay whole.
    """
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    schema = ", ".join([*rest, "kept binary", "n_bytes long", "n_removed long", "n_spans long"])

    def row(values: dict, kept: bytes, size: int, spans: int) -> tuple:
        return (*values.values(), kept, size, size - len(kept), spans)

    return _each_left(docs, text, length, core, row, schema)


def _each_left(docs: DataFrame, text: str, length: int, core: int, row: Callable[..., tuple], schema: str) -> DataFrame:
    """A row for every row, made of its other columns, the bytes left, the bytes before and the number of runs."""
    packed, given, shards = find_repeats(docs, text, length, core)
    names = [c for c in docs.columns if c != text]

    def rows(found):
        for _, sizes, own, data, answers in found:
            sizes = np.frombuffer(sizes, np.int64)
            state = BlockState(bytes(data), sizes, _full(by_level([answers])), shards, (length, core))
            gone, whole = state.removed(), state.runs.bytes
            del state
            stop = 0
            for values, size in zip(own, sizes.tolist(), strict=True):
                start, stop = stop, stop + size
                flags = gone[start:stop]
                kept = whole[start:stop][~flags].tobytes()
                spans = int(np.count_nonzero(np.diff(flags.astype(np.int8), prepend=0) == 1))
                yield row({n: values[n] for n in names}, kept, size, spans)

    joined = packed.join(given.hint("shuffle_hash"), "block", "left")
    return arrow_rows(joined, rows, schema)


def _full(given: dict) -> dict:
    return {level: given.get(level, {}) for level in (1, 2, 3, 4)}


def without_repeats(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns, with what :func:`remove_repeats` leaves of the text.

    A character that is cut by an edge of a removed run goes as a whole. Where ``docs`` has a column ``chars``, it
    becomes the new text's number of characters.
    """
    names = docs.columns

    def row(values: dict, kept: bytes, size: int, spans: int) -> tuple:
        left = kept.decode("utf-8", "ignore")
        own = values | {text: left}
        if chars in own:
            own[chars] = len(left)
        return tuple(own[c] for c in names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return _each_left(docs, text, LENGTH, CORE, row, schema)


def digest(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    return removed.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(documents: list[tuple], length: int = LENGTH) -> list[tuple]:
    """The same digests from all strings in a dictionary: for tests."""
    count: dict[bytes, int] = {}
    data = [(name, (text or "").encode()) for name, text in documents]
    for _, d in data:
        for i in range(len(d) - length + 1):
            count[d[i : i + length]] = count.get(d[i : i + length], 0) + 1
    out = []
    for name, d in data:
        flags = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                flags[i : i + length] = True
        kept = np.frombuffer(d, np.uint8)[~flags].tobytes()
        spans = int(np.count_nonzero(np.diff(flags.astype(np.int8), prepend=0) == 1))
        out.append((name, len(d), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
