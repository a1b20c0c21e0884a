"""Near-duplicate paragraphs: MinHash bands, exact verification, and removal by components.

Paragraphs are lines, cut at sentence ends and, where a sentence is long, at words that the words around choose, so that
a passage is cut alike wherever it stands. Equal shingle sets become one; the rest get band names, which meet in shards.
Paragraphs that collide in a band meet in one place and their Jaccard similarity is verified; components of verified
pairs are classes, and of each class the first paragraph stays. Repeated neighbours together are a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, stage
from tramline.llm.components import connected_components
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
from tramline.llm.signatures import PERCENT, Forest, in_cells

WORDS = 5
LEAST = WORDS  # words from which a piece has a shingle, and so counts as a paragraph that can be a duplicate
SENTENCE = 16  # words of a sentence from which on it is cut further
NEAR = 4  # a long sentence is cut after words whose hash is the smallest among as many words on both sides
PASSAGE = 30  # words of a repeated passage: what is whole of 50 words, less a piece of some ten words at each end
BANDS, ROWS = 9, 2  # at a similarity of 0.75, 1 - (1 - 0.75 ** 2) ** 9 = 0.9994 of the pairs collide
SMALLEST = 3  # sets of fewer shingles reach 0.75 with equal sets only, which are one already
CHUNK = 512  # paragraphs of one side of a verification
TOGETHER = 1 << 17  # shingles from which groups are verified in one pass
PAIRS = 1 << 20  # pairs of paragraphs, or shingles of such, in one step of it
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def _cuts(low: np.ndarray, begins: np.ndarray, starts: np.ndarray, stops: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether a word begins a piece: after a line break, after a sentence end, after a chosen word of a long sentence."""
    breaks = np.unique(np.r_[begins[begins < len(low)], np.flatnonzero(low == 10) + 1])
    line = np.searchsorted(breaks, starts, "right")
    first = np.ones(len(starts), bool)
    first[1:] = (line[1:] != line[:-1]) | np.isin(low[stops[:-1] - 1], np.frombuffer(b".!?", np.uint8))
    at = np.flatnonzero(first)
    size = np.diff(np.r_[at, len(starts)])
    place = np.arange(len(starts)) - np.repeat(at, size)
    size = np.repeat(size, size)
    # no piece of fewer words than a shingle comes of it
    chosen = np.flatnonzero((size > SENTENCE) & (place >= LEAST - 1) & (size - place > LEAST))
    rank = mix(names ^ _SEEDS[-1])
    for k in range(1, NEAR + 1):
        chosen = chosen[(rank[chosen] < rank[chosen - k]) & (rank[chosen] <= rank[chosen + k])]
    first[chosen + 1] = True
    return first


def piece_sets(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of five words or more of concatenated texts, with their sets of 5-word shingles.

    Returns the pieces' texts, their places among the text's pieces, the bytes of the text they begin and stop at, where
    each piece's shingles start (and where the last one's end), and the shingles, distinct and ascending within a piece.
    Words are what stands between white space once A-Z are lower-cased.
    """
    low = np.frombuffer(data.lower(), np.uint8)
    nothing = np.zeros(0, np.int64)
    begins = np.cumsum(sizes) - sizes
    inside = begins[begins < len(low)]
    word = ~((low == 32) | ((low >= 9) & (low <= 13)))
    if not word.any():
        return nothing, nothing, nothing, nothing, np.zeros(1, np.int64), np.zeros(0, np.uint64)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[inside] |= word[inside]
    ends = inside[inside > 0] - 1
    last[ends] |= word[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    names = Fingerprints(low, 0).of(starts, stops)
    at = np.flatnonzero(_cuts(low, begins, starts, stops, names))
    size = np.diff(np.r_[at, len(starts)])
    piece = np.repeat(np.arange(len(at)), size)
    wanted = np.flatnonzero(size >= LEAST)
    together = np.zeros(max(0, len(names) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        together += names[k : k + len(together)] * (_SEEDS[k] | np.uint64(1))
    whole = np.flatnonzero(piece[: len(together)] == piece[WORDS - 1 :][: len(together)])
    shingle, own = mix(together[whole]), piece[whole]
    order = np.lexsort((shingle, own))
    shingle, own = shingle[order], own[order]
    new = np.ones(len(own), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (own[1:] != own[:-1])
    shingle, own = shingle[new], own[new]
    edges = np.searchsorted(own, np.r_[wanted, len(at)])
    begin, stop = starts[at[wanted]], stops[at[wanted] + size[wanted] - 1]
    text = np.searchsorted(begins, begin, "right") - 1
    place = np.arange(len(wanted)) - np.searchsorted(text, text)
    return text, place, begin - begins[text], stop - begins[text], edges.astype(np.int64), shingle


class _Pieces:
    """The paragraphs of a block, led through the levels as far as answers are known."""

    def __init__(self, data: bytes, sizes: np.ndarray, given: dict, shards: int):
        self.text, self.place, self.begin, self.stop, self.edges, self.shingles = piece_sets(data, sizes)
        begin = self.edges[:-1]
        if len(begin):
            sums = [np.add.reduceat(mix(self.shingles ^ seed), begin) for seed in _SEEDS[:2]]
            self.keys = pairs(sums[0], sums[1] ^ np.diff(self.edges).astype(np.uint64))
        else:
            self.keys = single(np.zeros(0, np.uint64))
        self.level = Level(self.keys, shards)
        if 1 not in given:
            return
        flags = self.level.answers(given[1])
        self.repeated = flags & REPEATED > 0
        stands = np.flatnonzero((flags & STANDS > 0) & (np.diff(self.edges) >= SMALLEST))
        self.open = stands[np.sort(np.unique(self.level.inverse[stands], return_index=True)[1])]
        self.names = self.bands(self.open)
        self.level = Level(single(self.names.ravel()), shards)
        if 2 in given:
            self.met = (self.level.answers(given[2]) & REPEATED > 0).reshape(-1, BANDS)

    def bands(self, which: np.ndarray) -> np.ndarray:
        """A name for each band of pieces: the smallest shingles under ``ROWS`` permutations, mixed."""
        out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(which), 1))
        if not len(which):
            return out
        size = np.diff(self.edges)[which]
        begin = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(begin, size)
        own = self.shingles[np.repeat(self.edges[which], size) + inner]
        for band in range(BANDS):
            for row in range(ROWS):
                out[:, band] = mix(out[:, band] ^ np.minimum.reduceat(mix(own ^ _SEEDS[band * ROWS + row]), begin))
        return out

    def key(self, i: int) -> bytes:
        return self.keys[i].tobytes()

    def set(self, i: int) -> bytes:
        return blob(self.shingles[self.edges[i] : self.edges[i + 1]])


class _Met:
    """Paragraphs of many groups, verified in one pass.

    Within a group shingles are ordered, the rarest first. Paragraphs that link share one of the first that are more
    than a paragraph may lack, so only those that do are compared: rare shingles bring few paragraphs together, however
    large the group is.
    """

    def __init__(self, groups: list[int], sides: list[int], sets: list[bytes]):
        self.size = np.array([len(s) for s in sets], np.int64) >> 3
        self.group, self.side = np.array(groups), np.array(sides)
        self.both_sides = np.bincount(self.group, weights=self.side) > 0
        self.label = np.arange(len(sets))  # of what is connected already
        self.forest = Forest(len(sets))
        shingles = np.frombuffer(b"".join(sets), np.uint64)
        row = np.repeat(np.arange(len(sets)), self.size)
        own = mix(shingles ^ mix(self.group.astype(np.uint64) + np.uint64(1))[row])  # a shingle in a group
        order = np.argsort(own)
        new = np.concatenate(([True], own[order[1:]] != own[order[:-1]]))
        often = np.diff(np.flatnonzero(new), append=len(own))
        number = np.empty(len(own), np.int64)
        number[order] = np.cumsum(new) - 1
        self.start = np.cumsum(self.size) - self.size
        bit = np.uint64(1) << (shingles & np.uint64(63))
        self.bits = np.bitwise_or.reduceat(bit, self.start)
        self.extra = self.size - np.bitwise_count(self.bits)  # shingles that share a bit with another of their set
        self.base = len(often)
        self.known = row * self.base + number  # which shingles a paragraph has
        self.known.sort()
        ordered = (row * (int(often.max()) + 1) + often[number]) * self.base + number
        ordered.sort()
        first = np.arange(len(row)) - self.start[row] <= (self.size * (100 - PERCENT) // 100)[row]
        number = ordered[first] % self.base
        row = row[first]
        shared = often[number] > 1
        at = np.sort(number[shared] * len(sets) + row[shared])
        self.row = at % len(sets)  # by shingle
        new = np.concatenate(([True], at[1:] // len(sets) != at[:-1] // len(sets)))[: len(at)]
        begin = np.flatnonzero(new)
        self.place = np.arange(len(at)) - np.repeat(begin, np.diff(begin, append=len(at)))

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect what is apart: paragraphs meet the first with their shingle, then the others."""
        later = np.flatnonzero(self.place)
        yield from self._linked(self.row[later - self.place[later]], self.row[later])
        later = later[self.place[later] > 1]
        done = 0
        stops = np.cumsum(self.place[later] - 1)
        while done < len(later):
            stop = max(done + 1, int(np.searchsorted(stops, (stops[done - 1] if done else 0) + PAIRS, "right")))
            some = later[done:stop]
            count = self.place[some] - 1
            inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            yield from self._linked(self.row[np.repeat(some - count, count) + inner], np.repeat(self.row[some], count))
            done = stop

    def _linked(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        may = (self.label[a] != self.label[b]) & ((self.side[a] != self.side[b]) | ~self.both_sides[self.group[a]])
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        common = np.bitwise_count(self.bits[a] & self.bits[b]) + np.minimum(self.extra[a], self.extra[b])
        may &= (100 * small >= PERCENT * large) & ((100 + PERCENT) * common >= PERCENT * (small + large))
        pair = np.unique(a[may] * len(self.size) + b[may])
        a, b = pair // len(self.size), pair % len(self.size)
        done = 0
        stops = np.cumsum(self.size[a])
        while done < len(a):
            stop = max(done + 1, int(np.searchsorted(stops, (stops[done - 1] if done else 0) + PAIRS, "right")))
            x, y = a[done:stop], b[done:stop]
            size = self.size[x]
            begin = np.cumsum(size) - size
            inner = np.arange(int(size.sum())) - np.repeat(begin - self.start[x], size)
            wanted = self.known[inner] + np.repeat((y - x) * self.base, size)
            there = np.searchsorted(self.known, wanted)
            there[there == len(self.known)] = 0
            both = np.add.reduceat((self.known[there] == wanted).astype(np.int64), begin)
            linked = 100 * both >= PERCENT * (size + self.size[y] - both)
            for i, j in zip(x[linked].tolist(), y[linked].tolist(), strict=True):
                if self.forest.root(i) != self.forest.root(j):
                    self.forest.join(i, j)
                    yield i, j
            touched = np.unique(np.r_[x[linked], y[linked]])
            self.label[touched] = [self.forest.root(i) for i in touched.tolist()]
            done = stop


def near_links(found: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows ``(key, cell, side, id, tokens)`` to links that connect what is apart in their cell.

    Rows of one side meet each other where the cell has one side only, else the sides meet.
    """
    groups, sides, names, sets = [], [], [], []
    last, weight = None, 0

    def verified():
        for i, j in _Met(groups, sides, sets).links():
            yield names[i], names[j]
        for held in (groups, sides, names, sets):
            held.clear()

    for key, cell, side, name, tokens in found:
        if (key, cell) != last:
            if weight > 8 * TOGETHER:
                yield from verified()
                weight = 0
            group = groups[-1] + 1 if groups else 0
            last = key, cell
        groups.append(group)
        sides.append(side)
        names.append(name)
        sets.append(tokens)
        weight += len(tokens)
    if groups:
        yield from verified()


def _by_rare(crowded: DataFrame, candidates: DataFrame) -> DataFrame:
    """``key, id`` of crowded keys to smaller groups, of paragraphs that share a key and one of their rarest shingles.

    Shingles are counted within a key. Paragraphs that link share one of the first that are more than a paragraph may
    lack; those that stand in one paragraph alone come first.
    """

    def rows(found):
        for key, name, tokens in found:
            own = np.frombuffer(tokens, np.int64)
            yield key, name, len(own), own.tolist()

    listed = crowded.join(candidates.select("id", "tokens"), "id").select("key", "id", "tokens")
    listed = arrow_rows(listed, rows, "key long, id binary, n int, shingles array<long>")
    each = stage(listed.select("key", "id", "n", F.explode("shingles").alias("token")), "crowded")
    often = each.groupBy("key", "token").agg(F.count("*").alias("often")).where("often > 1")
    known = each.join(often, ["key", "token"])
    lists = known.groupBy("key", "id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("l"))
    first = 1 + F.floor(F.col("n") * (100 - PERCENT) / 100) - (F.col("n") - F.size("l"))
    lists = lists.where(first > 0).select("key", "id", F.explode(F.slice("l", F.lit(1), first.cast("int"))).alias("s"))
    return lists.select(F.xxhash64("key", "s.token").alias("key"), "id")


def _verified_links(candidates: DataFrame, parts: int) -> DataFrame:
    """Links of paragraphs that share a band; those of a crowded band meet by their rarest shingles in it.

    Of such groups too, those beyond ``CHUNK`` meet cell by cell, all chunks with all.
    """
    keyed = candidates.select("id", F.explode("keys").alias("key"))
    counts = stage(keyed.groupBy("key").count().where("count > 1"), "bands")
    cells = in_cells(keyed, CHUNK, counts.where(F.col("count") <= CHUNK))
    hot = counts.where(F.col("count") > CHUNK).select("key")
    if not hot.isEmpty():
        cells = cells.unionByName(in_cells(_by_rare(keyed.join(hot, "key", "left_semi"), candidates), CHUNK))
    met = cells.join(candidates.select("id", "tokens"), "id").select("key", "cell", "side", "id", "tokens")
    dealt = met.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")
    return stage(arrow_rows(dealt, near_links, "a binary, b binary"), "paragraph-links")


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without some of its pieces and the blanks behind them; lines of which nothing is left go."""
    out, at, spans = [], 0, iter(spans)
    span = next(spans, None)
    for line in text.split(b"\n"):
        begin, at = at, at + len(line) + 1
        left, done = [], begin
        while span and span[0] < at:
            left.append(text[done : span[0]])
            done = span[1]
            done += len(text[done : at - 1]) - len(text[done : at - 1].lstrip())
            span = next(spans, None)
        left.append(text[done : at - 1])
        rest = b"".join(left)
        if len(left) == 1 or rest.strip():
            out.append(rest)
    return b"\n".join(out)


def _passages(text: bytes, hits: list[tuple]) -> tuple[int, int]:
    """Passages of ``PASSAGE`` words or more among a text's repeated pieces, and the pieces outside of them."""
    passages = short = 0
    begin = 0
    for i, (place, _, stop, _) in enumerate(hits):
        if i and place != hits[i - 1][0] + 1:
            begin = i
        if i + 1 == len(hits) or hits[i + 1][0] != place + 1:
            if len(text[hits[begin][1] : stop].split()) >= PASSAGE:
                passages += 1
            else:
                short += i + 1 - begin
    return passages, short


def remove_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_paragraphs, n_repeated, n_short, n_removed, kept`` (the text left) of every row.

    A line is cut behind words that end in a full stop, exclamation or question mark; a sentence of more than
    ``SENTENCE`` words also behind words of the smallest hash among ``NEAR`` on both sides, but into no piece under five
    words. Pieces of five words or more are near duplicates when the Jaccard similarity of their 5-word shingles is
    0.75 or more; classes are components of such pairs. Pieces of a class of two or more are repeated; all of them go but
    the class's first, by key (null last), by the text's place, by place in the text.

    Repeated pieces with nothing between but pieces under five words make a passage, over line ends too.
    ``n_paragraphs`` counts lines that are not blank, ``n_repeated`` passages of ``PASSAGE`` words or more, ``n_short``
    repeated pieces outside of these, ``n_removed`` the pieces that go. Pieces under five words have no shingle and
    stay. Null counts as empty. One row per row, also of null or repeated keys; other columns are left out.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    packed, size = pack(docs, "text")
    shards = shard_count(size, 15)
    parts = max(24, size >> 25)
    given = None
    for level in (1, 2):
        given = ask(packed, given, level, 5, shards, lambda d, s, g: _Pieces(d, s, g, shards).level)
    kind = docs.schema["key"].dataType.simpleString()

    def listed(found):
        for block, sizes, rest, data, answers in found:
            own = {level: by_level([answers]).get(level, {}) for level in (1, 2)}
            state = _Pieces(bytes(data), np.frombuffer(sizes, np.int64), own, shards)
            met = {i: (n, m) for i, n, m in zip(state.open.tolist(), state.names, state.met, strict=True) if m.any()}
            # a piece that stands once and collides with none is no class
            for i in np.flatnonzero(state.repeated | np.isin(np.arange(len(state.text)), list(met))).tolist():
                names = tokens = None
                if i in met:
                    names, tokens = (met[i][0][met[i][1]] >> np.uint64(1)).astype(np.int64).tolist(), state.set(i)
                at = int(state.text[i])
                place = int(state.place[i]), int(state.begin[i]), int(state.stop[i])
                yield block, at, *place, rest[at]["key"], state.key(i), names, tokens

    source = packed.select("block", "sizes", "rest", "data").join(by_block(given).hint("shuffle_hash"), "block")
    columns = f"block long, at int, place int, begin int, stop int, key {kind}, id binary, keys array<long>, tokens binary"
    pieces = stage(arrow_rows(source, listed, columns), "paragraphs")
    comps = connected_components(_verified_links(pieces.where("tokens IS NOT NULL").select("id", "keys", "tokens"), parts))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "block", "at", "place")).alias("first")
    # per set first, then per component, so that only sets are joined
    sets = pieces.groupBy("id").agg(first, F.count("*").alias("n"))
    sets = sets.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    classes = sets.groupBy("component").agg(F.min("first").alias("stays"), F.sum("n").alias("size")).where("size > 1")
    classes = sets.join(classes, "component").select("id", "stays")
    hit = pieces.select("block", "at", "place", "begin", "stop", "id").join(classes, "id")
    stays = F.col("stays")
    goes = ~((F.col("block") == stays["block"]) & (F.col("at") == stays["at"]) & (F.col("place") == stays["place"]))
    found = hit.groupBy("block").agg(F.collect_list(F.struct("at", "place", "begin", "stop", goes.alias("goes"))).alias("hit"))

    def finished(rows):
        for _, sizes, rest, data, hit in rows:
            own: dict[int, list[tuple]] = {}
            for at, *piece in sorted(tuple(h.values()) for h in hit or ()):
                own.setdefault(at, []).append(tuple(piece))
            begin = 0
            for at, (values, size) in enumerate(zip(rest, np.frombuffer(sizes, np.int64).tolist(), strict=True)):
                content = bytes(data[begin : begin + size])
                begin += size
                hits = own.get(at, [])
                gone = [(start, stop) for _, start, stop, goes in hits if goes]
                lines = sum(bool(x.strip()) for x in content.split(b"\n"))
                kept = _without(content, gone) if gone else content
                yield values["key"], lines, *_passages(content, hits), len(gone), kept

    joined = packed.join(found.hint("shuffle_hash"), "block", "left")
    columns = f"key {kind}, n_paragraphs long, n_repeated long, n_short long, n_removed long, kept binary"
    return arrow_rows(joined, finished, columns).withColumnRenamed("key", key)


def digest(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    return removed.select(key, "n_paragraphs", "n_repeated", "n_short", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
