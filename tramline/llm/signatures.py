"""Similarity join of shingle sets (Jaccard) with signature trees.

A node of a tree holds the OR of its sets' bitmaps and the range of their sizes. Two nodes are compared by the
largest overlap that any of their sets could have; a pair that cannot reach the threshold falls with all below it.

1. Equal sets become one. Sets that have too few shingles in common with any others cannot link and leave early: by
   the prefix rule first (of the smallest fingerprints a linked set must share a known number), then by all shingles.
   Shingles are names that meet in shards; texts do not move.
2. What is left meets in groups of equal smallest fingerprint under some permutations, in chunks. Each chunk has a
   tree, and a dual traversal of it with itself finds its links; sets that are connected already need no look.
3. Links missed so far can only join different components. Sets that share too little with other components leave.
   The rest meets by the rarest shingles that several components share, of which linked sets have one in common: sets
   that such shingles connect have trees together, chunk by chunk, or, where those are too many, for each shingle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, stage
from tramline.llm.components import connected_components
from tramline.llm.names import (
    REPEATED,
    STANDS,
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
from tramline.llm.sketches import shingle_sets

WORDS = 5
PERCENT = 75  # Jaccard, in percent
SHARED = 0.3  # shingles of the prefix that linked sets must share, as a part of a set
CHUNK = 256  # sets of a tree in one task
CHUNKS = 32  # chunks of a cluster that all meet, some fewer than the groups of a set
PASSES = 2  # permutations
BITS = 4096
LEAF, FAN = 8, 8


def shingles(data: bytes, sizes: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each of a block's texts, all of them in one pass."""
    found, edges = shingle_sets(data, sizes, WORDS)
    return [found[a:b] for a, b in pairwise(edges.tolist())]


def _need(size: np.ndarray | int, percent: int = PERCENT):
    """Shingles that a set of this size must share with any set it links to: ceil(size * percent / 100)."""
    return -(-size * percent // 100)


def _must_share(size: int) -> int:
    return 1 + int(SHARED * size)


def _prefix(own: np.ndarray) -> np.ndarray:
    """The smallest fingerprints; of them, linked sets share as many as the smaller one must share."""
    n = len(own)
    return own[: n - _need(n) + _must_share(n)]


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


class Forest:
    """Which sets are connected already."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def bitmap(own: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, bool)
    out[(own % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out)


class Node:
    """OR of bitmaps, range of sizes, and the most shingles of a set that share a bit with another of its own."""

    __slots__ = ("bits", "least", "most", "extra", "below", "sets")

    def __init__(self, bits, least, most, extra, below, sets):
        self.bits, self.least, self.most, self.extra, self.below, self.sets = bits, least, most, extra, below, sets


def _over(nodes: list[Node]) -> Node:
    bits = np.bitwise_or.reduce([n.bits for n in nodes])
    sets = [i for n in nodes for i in n.sets]
    return Node(bits, min(n.least for n in nodes), max(n.most for n in nodes), max(n.extra for n in nodes), nodes, sets)


def may_link(bits: int, extra: int, least_a: int, most_a: int, least_b: int, most_b: int) -> bool:
    """Whether sets of these sizes could link with ``bits`` common bits and ``extra`` shingles beside them."""
    if 100 * most_a < PERCENT * least_b or 100 * most_b < PERCENT * least_a:
        return False
    return (100 + PERCENT) * (bits + extra) >= PERCENT * (least_a + least_b)


def _may(a: Node, b: Node) -> bool:
    common = int(np.bitwise_count(a.bits & b.bits).sum())
    return may_link(common, min(a.extra, b.extra), a.least, a.most, b.least, b.most)


class SignatureTree:
    """A tree over sets in the given order (similar ones near each other)."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        level = []
        for i, own in enumerate(sets):
            bits = bitmap(own, BITS)
            level.append(Node(bits, len(own), len(own), len(own) - int(np.bitwise_count(bits).sum()), [], [i]))
        width = LEAF
        while len(level) > 1:
            level = [_over(level[i : i + width]) for i in range(0, len(level), width)]
            width = FAN
        self.root = level[0] if level else None

    def join(self, forest: Forest, other: SignatureTree | None = None, shift: int = 0) -> Iterator[tuple[int, int]]:
        """Links that connect what ``forest`` has apart; with ``other``, whose sets count from ``shift`` on."""
        if self.root is None or (other and other.root is None):
            return
        right = other or self
        todo = [(self.root, right.root)]
        while todo:
            a, b = todo.pop()
            same = other is None and a is b
            if same and not a.below:
                continue
            roots = {forest.root(i) for i in a.sets} | {forest.root(i + shift) for i in b.sets}
            if len(roots) == 1 or not _may(a, b):
                continue
            if not a.below and not b.below:
                i, j = a.sets[0], b.sets[0]
                if linked(self.sets[i], right.sets[j]):
                    forest.join(i, j + shift)
                    yield i, j + shift
            elif same:
                # neighbours last, so that they are looked at first
                todo += [(x, y) for k, x in enumerate(a.below) for y in a.below[k:]][::-1]
            else:
                todo += [(x, y) for x in (a.below or [a]) for y in (b.below or [b])]


class _Shingled:
    """A block led through the levels as far as answers are known; sets are (place of the text, fingerprints)."""

    def __init__(self, data: bytes, sizes: np.ndarray, given: dict, shards: int):
        self.sets = shingles(data, sizes)
        self.keys = [hashlib.md5(s.tobytes()).digest() for s in self.sets]
        chosen = [i for i, s in enumerate(self.sets) if len(s)]
        words = np.frombuffer(b"".join(self.keys[i] for i in chosen), [("a", "<u8"), ("b", "<u8")])
        self.level = Level(words, shards)
        self.open = chosen
        if 1 not in given:
            return
        # one block stands for each set, with its first text
        stands = np.flatnonzero(self.level.answers(given[1]) & STANDS)
        first = np.sort(np.unique(self.level.inverse[stands], return_index=True)[1])
        self.open = [chosen[i] for i in stands[first].tolist()]
        self.level = self._names(_prefix, shards)
        if 2 not in given:
            return
        self._keep(_prefix, given[2], lambda n: _must_share(_need(n)))
        self.level = self._names(lambda s: s, shards)
        if 3 not in given:
            return
        self._keep(lambda s: s, given[3], _need)

    def _names(self, part, shards: int) -> Level:
        own = [part(self.sets[i]) for i in self.open]
        return Level(single(mix(np.concatenate(own) if own else np.zeros(0, np.uint64))), shards)

    def _keep(self, part, given: dict, least) -> None:
        answers = self.level.answers(given) & REPEATED
        kept, at = [], 0
        for i in self.open:
            n = len(part(self.sets[i]))
            if np.count_nonzero(answers[at : at + n]) >= least(len(self.sets[i])):
                kept.append(i)
            at += n
        self.open = kept


def _full(given: dict) -> dict:
    return {level: given.get(level, {}) for level in (1, 2, 3)}


def tree_links(found: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows ``(key, cell, side, id, component, tokens)`` to links that connect what is apart in their cell.

    Rows of one side meet each other where the cell has one side only, else the sides meet. Rows of the same component
    (null: unknown) are connected from the start.
    """

    def verified(held: list[tuple]):
        sides = [[h for h in held if h[2] == s] for s in (0, 1)]
        whole = [*sides[0], *sides[1]]
        forest = Forest(len(whole))
        first: dict = {}
        for i, row in enumerate(whole):
            if row[4] is not None:
                forest.join(i, first.setdefault(row[4], i))
        trees = [SignatureTree([np.frombuffer(h[5], np.uint64) for h in side]) for side in sides]
        found = trees[0].join(forest, trees[1], len(sides[0])) if sides[1] else trees[0].join(forest)
        for i, j in found:
            yield whole[i][3], whole[j][3]

    held: list[tuple] = []
    for row in found:
        if held and row[:2] != held[0][:2]:
            yield from verified(held)
            held = []
        held.append(row)
    if held:
        yield from verified(held)


def in_cells(keyed: DataFrame, chunk: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows ``key, id`` to ``key, cell, side, id``: a large key's rows are dealt over chunks, and all chunks meet.

    Cell (i, j) with i < j holds chunk i on one side and chunk j on the other, cell (i, i) one side. Keys of one row
    have nothing to meet. ``counts`` (``key, count``) may be given, of some keys alone: then the others are left out.
    """
    if counts is None:
        counts = keyed.groupBy("key").count().where("count > 1")
    chunks = F.ceil(F.col("count") / chunk).cast("int")
    placed = keyed.join(counts, "key").select(
        "key", "id", chunks.alias("k"), F.pmod(F.xxhash64("id"), chunks.cast("long")).cast("int").alias("c")
    )
    cell = F.transform(
        F.sequence(F.lit(0), F.col("k") - 1),
        lambda o: F.struct(
            (F.least(o, F.col("c")) * F.col("k") + F.greatest(o, F.col("c"))).alias("cell"),
            (o < F.col("c")).cast("int").alias("side"),
        ),
    )
    return placed.select("key", "id", F.explode(cell).alias("at")).select("key", "at.cell", "at.side", "id")


def _grouped_links(sets: DataFrame, count: int, parts: int) -> DataFrame:
    """Links found among sets of equal smallest fingerprint, for some permutations.

    Keys with more than a thousandth of all sets are dealt over tasks; there are fewer than a thousand of them. Groups
    are looked at in chunks: what chunks or tasks keep apart is found later.
    """

    def rows(found, p):
        for name, tokens in found:
            own = np.frombuffer(tokens, np.uint64)
            yield int(mix(own ^ np.uint64(p * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).min() >> 1), name, tokens

    def links(found):
        last = None
        held: list[tuple] = []
        for key, salt, name, tokens in found:
            last = (key, salt)
            if held and (held[0][0] != last or len(held) == CHUNK):
                yield from tree_links(iter(held))
                held = []
            held.append((last, 0, 0, name, None, tokens))
        yield from tree_links(iter(held))

    found = None
    for p in range(1, PASSES + 1):
        own = arrow_rows(sets.select("id", "tokens"), lambda f, p=p: rows(f, p), "key long, id binary, tokens binary")
        own = stage(own, "smallest")
        large = F.broadcast(own.groupBy("key").count().where(F.col("count") > max(4 * CHUNK, count // 1000)))
        salt = F.pmod(F.xxhash64("id", F.lit(p)), F.ceil(F.col("count") / (4 * CHUNK)).cast("long"))
        met = own.join(large, "key", "left").select("key", F.coalesce(salt, F.lit(0)).alias("salt"), "id", "tokens")
        dealt = met.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt")
        some = arrow_rows(dealt, links, "a binary, b binary")
        found = some if found is None else found.union(some)
    return stage(found, "group-links")


def _exploded(sets: DataFrame, comps: DataFrame, part) -> DataFrame:
    """``id, n, size, comp, token``: the chosen shingles of every set, how many they are, and a number of its component."""

    def rows(found):
        for name, tokens in found:
            own = np.frombuffer(tokens, np.uint64)
            chosen = part(own)
            yield name, len(own), len(chosen), chosen.astype(np.int64).tolist()

    listed = arrow_rows(sets.select("id", "tokens"), rows, "id binary, n int, size int, shingles array<long>")
    named = listed.join(comps.select("id", "component"), "id", "left")
    comp = F.xxhash64(F.coalesce("component", "id"))
    return named.select("id", "n", "size", comp.alias("comp"), F.explode("shingles").alias("token"))


def _shared(each: DataFrame) -> DataFrame:
    """Shingles that stand in sets of several components, with their number of sets."""
    groups = each.groupBy("token").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.count("*").alias("sets"))
    return groups.where("_a <> _b").select("token", "sets")


def _across_links(sets: DataFrame, comps: DataFrame, parts: int) -> DataFrame:
    """Links between components.

    A set that links to another component shares enough of its prefix with other components; the rest leaves. Of all
    shingles, those of one component alone come first, then the rarest: linked sets share one of the first that are
    more than a set may lack. Shingles with the same sets give one group.
    """
    prefix = _exploded(sets, comps, _prefix)
    need = 1 + F.floor(F.lit(SHARED) * F.ceil(F.col("n") * PERCENT / 100))
    met = prefix.join(_shared(prefix).select("token"), "token", "left_semi")
    enough = met.groupBy("id").agg(F.count("*").alias("_m"), F.first("n").alias("n")).where(F.col("_m") >= need)
    apart = stage(sets.join(enough.select("id"), "id", "left_semi"), "apart")
    each = stage(_exploded(apart, comps, lambda own: own), "apart-shingles")
    known = each.join(_shared(each), "token")
    # n - m shingles stand in one component alone; more than n - need of them, and the set can't link elsewhere
    lists = known.groupBy("id", "n", "comp").agg(F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("l"))
    first = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.size("l"))
    keyed = lists.where(first > 0).select(
        "id", "comp", F.explode(F.slice("l", F.lit(1), first.cast("int"))).alias("s")
    ).select("id", "comp", F.col("s.token").alias("key"))
    keyed = stage(keyed, "rare")
    same = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
        (F.min("comp") != F.max("comp")).alias("several"),
    )
    chosen = same.where("several").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    groups = stage(keyed.join(chosen, "key", "left_semi").select("key", "id"), "groups")
    # sets that groups connect meet together, each in as many cells as its cluster has chunks; where that is more than
    # a set has groups, they meet group by group
    least = groups.groupBy("key").agg(F.min("id").alias("b"))
    clusters = connected_components(groups.join(least, "key").select(F.col("id").alias("a"), "b"))
    sizes = clusters.groupBy("component").agg((F.count("*") <= CHUNKS * CHUNK).alias("small"))
    clusters = stage(clusters.join(sizes, "component"), "clusters")
    together = clusters.where("small").select(F.xxhash64("component").alias("key"), "id")
    crowded = groups.join(clusters.where("not small").select("id"), "id", "left_semi").select("key", "id")
    cells = in_cells(together.unionByName(crowded), CHUNK)
    whole = apart.join(comps.select("id", "component"), "id", "left")
    whole = whole.select("id", F.coalesce("component", "id").alias("component"), "tokens")
    placed = cells.join(whole, "id").select("key", "cell", "side", "id", "component", "tokens")
    dealt = placed.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")
    return stage(arrow_rows(dealt, tree_links, "a binary, b binary"), "across-links")


def _components(packed: DataFrame, size: int, key: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """All rows as ``block, at, key, n_shingles, id``; and ``id, component`` of the sets that link."""
    shards = shard_count(size, 12)
    parts = max(24, size >> 25)
    given = None
    for level in (1, 2, 3):
        given = ask(packed, given, level, WORDS, shards, lambda d, s, g: _Shingled(d, s, g, shards).level)

    def described(found):
        for block, sizes, rest, data in found:
            sets = shingles(bytes(data), np.frombuffer(sizes, np.int64))
            for at, (values, one) in enumerate(zip(rest, sets, strict=True)):
                yield block, at, values[key], len(one), hashlib.md5(one.tobytes()).digest()

    described_ = arrow_rows(
        packed.select("block", "sizes", "rest", "data"),
        described,
        f"block long, at int, {key} {kind}, n_shingles long, id binary",
    )
    rows_ = stage(described_, "sets")

    def left(found):
        for sizes, data, answers in found:
            state = _Shingled(bytes(data), np.frombuffer(sizes, np.int64), _full(by_level([answers])), shards)
            for i in state.open:
                yield state.keys[i], blob(state.sets[i])

    rest = packed.select("block", "sizes", "data").join(by_block(given).hint("shuffle_hash"), "block")
    sets = stage(arrow_rows(rest.select("sizes", "data", "given"), left, "id binary, tokens binary"), "candidates")
    links = _grouped_links(sets, sets.count(), parts)
    comps = connected_components(links)
    more = _across_links(sets, comps, parts)
    if not more.isEmpty():
        comps = connected_components(links.unionByName(more))
    return rows_, comps


def similar_sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` of every row.

    Sets hold the distinct 5-word shingles, or all words of a shorter text as one; two rows link when their sets'
    Jaccard similarity is 0.75 or more; the component is the smallest key reachable by links, itself included. Equal
    sets, of repeated rows or not, are one. Null and empty texts, and texts of white space, have no shingles and link
    with nothing: they are their own component. Rows with a null key keep it and link like others; a component whose
    keys are all null has none.
    """
    packed, size = pack(docs.select(key, text), text)
    rows_, comps = _components(packed, size, key, docs.schema[key].dataType.simpleString())
    # the smallest key of each set, of each component, and back
    least = rows_.where("n_shingles > 0").groupBy("id").agg(F.min(key).alias("_least"))
    least = least.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    roots = least.groupBy("component").agg(F.min("_least").alias("component_id"))
    least = least.join(roots, "component").select("id", "component_id")
    found = rows_.join(least, "id", "left")
    smallest = F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id"))
    return found.select(key, "n_shingles", smallest.alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns: the one with the smallest key, of equal keys the first one read.

    Null keys come last. Rows without shingles link with nothing and all stay.
    """
    packed, size = pack(docs, text)
    rows_, comps = _components(packed, size, key, docs.schema[key].dataType.simpleString())
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key), "block", "at"))
    sets = rows_.where("n_shingles > 0").groupBy("id").agg(first.alias("first"))
    sets = sets.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    stays = sets.groupBy("component").agg(F.min("first").alias("first")).select("first.block", "first.at")
    stays = stays.unionByName(rows_.where("n_shingles = 0").select("block", "at"))
    stays = stays.groupBy("block").agg(F.collect_list("at").alias("places"))
    names, at_text = docs.columns, docs.columns.index(text)

    def rows(found):
        for sizes, rest, data, places in found:
            wanted, start = set(places), 0
            for at, (values, n) in enumerate(zip(rest, np.frombuffer(sizes, np.int64).tolist(), strict=True)):
                if at in wanted:
                    own = bytes(data[start : start + n]).decode()
                    yield tuple(own if i == at_text else values[c] for i, c in enumerate(names))
                start += n

    joined = packed.join(stays.hint("shuffle_hash"), "block").select("sizes", "rest", "data", "places")
    return arrow_rows(joined, rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def brute_force(documents: list[tuple]) -> list[tuple]:
    """The same rows from all pairs: for tests."""
    sets = []
    for name, text in documents:
        own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            own = own.replace(c, " ")
        words = [w for w in own.split(" ") if w]
        k = min(WORDS, len(words))
        sets.append((name, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()))
    forest = Forest(len(sets))
    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= PERCENT * len(x | y):
                forest.join(i, j)
    least: dict[int, int] = {}
    for i, (name, _) in enumerate(sets):
        if name is not None:
            least[forest.root(i)] = min(least.get(forest.root(i), name), name)
    return [(n, len(s), least.get(forest.root(i)) if s else n) for i, (n, s) in enumerate(sets)]
