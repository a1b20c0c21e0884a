"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has ``BINS`` coordinates. In round i every shingle of a set falls into one hashed bin with a hashed value; a
bin keeps the smallest value of the first round that reaches it. The last ``BINS`` rounds put all shingles into one bin
each, so every coordinate is filled after 2 ``BINS`` rounds, mostly after a few. Two sets agree in a coordinate with a
probability of their Jaccard similarity, and the share of agreeing coordinates is concentrated around it.

1. Equal sets become one, whatever the number of their copies.
2. Sets that agree in all ``ROWS`` coordinates of a band share a bucket; a pair of similarity 0.8 shares none of the 30
   with a probability of 1.4e-7. Each set is compared with the first of its buckets on the full sets.
3. Buckets whose sets are still in several components have pairs to look at. Sets that share too few of their shingles
   with other components cannot link and leave. What is left meets chunk by chunk; only pairs in different components
   count, so the sets of a bucket's largest component do not meet each other. Nothing is cut off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, stage
from tramline.llm.components import connected_components
from tramline.llm.names import mix, pack

WORDS = 4
PERCENT = 80  # Jaccard, in percent
BANDS, ROWS = 30, 4
BINS = BANDS * ROWS
CHUNK = 512  # sets of a chunk, about
TOKENS = 1 << 19  # shingles of a chunk, about
LONG_WORD = 64  # bytes from which a word is hashed on its own
_SEEDS = mix(np.arange(1, 2 * BINS + BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ORDER = _SEEDS[:8] | np.uint64(1)  # of words in a shingle, seven at most
_KEPT = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # the first bytes of eight
_OPEN = np.uint64(2**64 - 1)


def word_hashes(low: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes a step."""
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(low) + 1,), "<u8", padded, strides=(1,))
    left = stops - starts
    out = mix(left.astype(np.uint64))
    for i in np.flatnonzero(left > LONG_WORD).tolist():
        own = hashlib.blake2b(low[starts[i] : stops[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(own, "<u8")[0]
    todo = np.flatnonzero(left <= LONG_WORD)
    at, left = starts[todo], left[todo]
    while len(todo):
        own = eight[at] & _KEPT[np.minimum(left, 8)]
        out[todo] = mix(out[todo] ^ mix(own + _SEEDS[0]))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def shingle_sets(data: bytes, sizes: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of concatenated UTF-8 texts, ascending in each text, and where each text's begin and end.

    Words are what stands between white space once A-Z are lower-cased; a text of fewer than ``size`` words is one
    shingle, a text without words has none.
    """
    low = np.frombuffer(data.lower(), np.uint8)
    count = len(sizes)
    if not len(low):
        return np.zeros(0, np.uint64), np.zeros(count + 1, np.int64)
    begins = np.cumsum(sizes) - sizes
    inside = begins[begins < len(low)]
    word = ~((low == 32) | ((low >= 9) & (low <= 13)))
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[inside] |= word[inside]
    ends = inside[inside > 0] - 1
    last[ends] |= word[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(begins, starts, "right") - 1
    hashes = word_hashes(low, starts, stops)
    words = np.bincount(text, minlength=count)
    n = max(0, len(hashes) - size + 1)
    whole = np.full(n, _ORDER[size])
    for k in range(size):
        whole = mix(whole ^ hashes[k : k + n]) + _ORDER[k]
    same = np.flatnonzero(text[:n] == text[size - 1 :][:n])
    shingles, owner = whole[same], text[same]
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        at = np.searchsorted(text, short)
        own = _ORDER[words[short]].copy()
        for k in range(size - 1):
            more = words[short] > k
            own[more] = mix(own[more] ^ hashes[at[more] + k]) + _ORDER[k]
        order = np.argsort(np.r_[owner, short], kind="stable")
        shingles, owner = np.r_[shingles, own][order], np.r_[owner, short][order]
    edges = np.searchsorted(owner, np.arange(count + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        shingles[a:b].sort()
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(count + 1))


def sketches(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A row of ``BINS`` coordinates for every set; sets without shingles keep open ones."""
    count = len(edges) - 1
    out = np.full(count * BINS, _OPEN, np.uint64)
    owner = np.repeat(np.arange(count), np.diff(edges))
    for number in range(2 * BINS):
        if not len(owner):
            break
        drawn = mix(shingles ^ _SEEDS[number])
        if number < BINS:
            place = (((drawn >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
        else:
            place = number - BINS
        slot = owner * BINS + place
        empty = out[slot] == _OPEN
        np.minimum.at(out, slot[empty], mix(drawn[empty] + _SEEDS[number]) >> np.uint64(1))
        unfilled = (out.reshape(count, BINS) == _OPEN).any(axis=1)[owner]
        shingles, owner = shingles[unfilled], owner[unfilled]
    return out.reshape(count, BINS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for every band of every sketch; bands differ in their keys too."""
    out = np.empty((len(sketch), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sketch), _SEEDS[2 * BINS + band])
        for row in range(ROWS):
            key = mix(key ^ sketch[:, band * ROWS + row])
        out[:, band] = key
    return out.view(np.int64)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def overlaps(x: list[np.ndarray], y: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets in ``x`` with all in ``y``, by products of 0/1 matrices."""
    tokens = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (x, y)]
    shared = np.intersect1d(*(np.unique(t) for t in tokens), assume_unique=True)
    out = np.zeros((len(x), len(y)))
    places = []
    for own, sets in zip(tokens, (x, y), strict=True):
        at = np.searchsorted(shared, own)
        known = at < len(shared)
        known[known] = shared[at[known]] == own[known]
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(at[known], kind="stable")
        places.append((rows[known][order], at[known][order]))
    for begin in range(0, len(shared), width):
        sides = []
        for (rows, at), sets in zip(places, (x, y), strict=True):
            a, b = np.searchsorted(at, (begin, begin + width))
            side = np.zeros((len(sets), width), np.float32)
            side[rows[a:b], at[a:b] - begin] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T  # whole numbers below 2 ** 24: exact
    return out.astype(np.int64)


def _cell_links(found: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows ``(key, cell, side, sid, component, tokens)`` to links that connect what is apart in their cell."""
    for _, rows in groupby(found, key=lambda r: (r[0], r[1])):
        sides: tuple[list, list] = ([], [])
        for row in rows:
            sides[row[2]].append((row[3], row[4], np.frombuffer(row[5], np.uint64)))
        left, right = sides[0], sides[1] or sides[0]
        if not left:
            continue
        up: dict[int, int] = {}

        def root(c: int, up: dict = up) -> int:
            while up.get(c, c) != c:
                up[c] = up.get(up[c], up[c])
                c = up[c]
            return c

        both = overlaps([s for *_, s in left], [s for *_, s in right])
        sizes = [np.array([len(s) for *_, s in side]) for side in (left, right)]
        hits = 100 * both >= PERCENT * (sizes[0][:, None] + sizes[1][None, :] - both)
        hits &= np.array([c for _, c, _ in left])[:, None] != np.array([c for _, c, _ in right])[None, :]
        for i, j in zip(*(h.tolist() for h in np.nonzero(hits)), strict=True):
            a, b = root(left[i][1]), root(right[j][1])
            if a != b:
                up[max(a, b)] = min(a, b)
                yield left[i][0], right[j][0]


def _in_cells(keyed: DataFrame) -> DataFrame:
    """Rows ``key, sid, n, component`` to ``key, cell, side, sid``: chunks of a key that have components apart meet.

    The sets of a key's largest component are dealt over ``kb`` chunks, the others over ``kr``. All chunks of the
    others meet each other and those of the largest; the latter do not meet among themselves.
    """
    each = keyed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n").alias("t"))
    most = F.max(F.struct("n", "component", "t"))
    totals = each.groupBy("key").agg(most.alias("big"), F.sum("n").alias("n"), F.sum("t").alias("t"), F.count("*").alias("c"))

    def chunks(n, t):
        return F.ceil(F.greatest(n / CHUNK, t / TOKENS)).cast("int")

    several = totals.where("c > 1").select(
        "key",
        F.col("big.component").alias("largest"),
        chunks(F.col("big.n"), F.col("big.t")).alias("kb"),
        chunks(F.col("n") - F.col("big.n"), F.col("t") - F.col("big.t")).alias("kr"),
    )
    big = F.col("component") == F.col("largest")
    chunk = F.pmod(F.xxhash64("sid"), F.when(big, F.col("kb")).otherwise(F.col("kr")).cast("long")).cast("int")
    placed = keyed.join(several, "key").select("key", "sid", "kb", "kr", big.alias("big"), chunk.alias("c"))

    def with_big(rest, large, side: int):
        return F.struct((F.col("kr") * F.col("kr") + rest * F.col("kb") + large).alias("cell"), F.lit(side).alias("side"))

    others = F.sequence(F.lit(0), F.col("kr") - 1)
    among = F.transform(
        others,
        lambda o: F.struct(
            (F.least(o, F.col("c")) * F.col("kr") + F.greatest(o, F.col("c"))).alias("cell"),
            (o < F.col("c")).cast("int").alias("side"),
        ),
    )
    beside = F.transform(F.sequence(F.lit(0), F.col("kb") - 1), lambda b: with_big(F.col("c"), b, 0))
    at = F.when(F.col("big"), F.transform(others, lambda r: with_big(r, F.col("c"), 1))).otherwise(F.concat(among, beside))
    return placed.select("key", "sid", F.explode(at).alias("at")).select("key", "at.cell", "at.side", "sid")


def _apart(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``key, sid, n, component`` of the buckets of three sets or more that lie in several components."""
    labelled = members.join(comps.withColumnRenamed("id", "sid"), "sid", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "sid"))
    ends = labelled.groupBy("key").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b"), F.count("*").alias("_n")
    )
    open_ = ends.where("_a <> _b AND _n > 2").select("key")
    return labelled.join(open_, "key", "left_semi").select("key", "sid", "n", "component")


def _may_link(left: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rows of ``left`` whose sets share enough shingles with sets of other components there."""
    sets = left.select("sid", "n", "component").distinct().join(tokens, "sid")

    def listed(found):
        for sid, n, component, own in found:
            yield sid, n, component, np.frombuffer(own, np.int64).tolist()

    each = arrow_rows(sets, listed, "sid long, n long, component long, tokens array<long>")
    each = stage(each.select("sid", "n", "component", F.explode("tokens").alias("token")), "left-shingles")
    ends = each.groupBy("token").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b")
    shared = each.join(ends.select("token"), "token", "left_semi").groupBy("sid").agg(
        F.count("*").alias("_m"), F.first("n").alias("_n")
    )
    able = shared.where(100 * F.col("_m") >= PERCENT * F.col("_n")).select("sid")
    return left.join(able, "sid", "left_semi")


def _components(packed: DataFrame, size: int, key: str, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``block, at, key, n, id``; distinct sets ``sid, id, least``; and ``id, component`` of linked ``sid``."""
    parts = max(24, size >> 25)

    def described(found):
        for block, sizes, rest, data in found:
            shingles, edges = shingle_sets(bytes(data), np.frombuffer(sizes, np.int64))
            keys = band_keys(sketches(shingles, edges)).tolist()
            for at, (values, a, b) in enumerate(zip(rest, edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                name = hashlib.md5(shingles[a:b].tobytes()).digest() if b > a else None
                yield block, at, values[key], b - a, name, keys[at] if b > a else None

    rows_ = arrow_rows(
        packed.select("block", "sizes", "rest", "data"),
        described,
        f"block long, at int, key {kind}, n long, id binary, bands array<long>",
    )
    rows_ = stage(rows_, "sketched")
    sets = rows_.where("n > 0").groupBy("id").agg(
        F.min("key").alias("least"),
        F.min(F.struct("block", "at")).alias("place"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    )
    sets = stage(sets.withColumn("sid", F.monotonically_increasing_id()), "distinct-sets")
    each = sets.select("sid", "n", F.explode("bands").alias("key"))
    # a first set per bucket: its smallest number
    buckets = each.groupBy("key").agg(F.min("sid").alias("hub"), F.count("*").alias("c")).where("c > 1")
    members = stage(each.join(buckets.select("key", "hub"), "key"), "buckets")

    wanted = members.select("sid").distinct().join(sets.select("sid", "place"), "sid")
    wanted = wanted.groupBy(F.col("place.block").alias("block")).agg(
        F.collect_list(F.struct(F.col("place.at").alias("at"), "sid")).alias("wanted")
    )

    def left(found):
        for sizes, data, places in found:
            shingles, edges = shingle_sets(bytes(data), np.frombuffer(sizes, np.int64))
            for place in places:
                yield place["sid"], blob(shingles[edges[place["at"]] : edges[place["at"] + 1]])

    held = packed.select("block", "sizes", "data").join(wanted.hint("shuffle_hash"), "block")
    tokens = stage(arrow_rows(held.select("sizes", "data", "wanted"), left, "sid long, tokens binary"), "candidates")

    # sizes first: sets too different in size cannot link
    own_size, hub_size = members.select("sid", "n", "hub"), sets.select(F.col("sid").alias("hub"), F.col("n").alias("m"))
    pairs = own_size.where("sid <> hub").distinct().join(hub_size, "hub")
    pairs = pairs.where(f"100 * least(n, m) >= {PERCENT} * greatest(n, m)").select("sid", "hub")
    sided = pairs.join(tokens, "sid").join(tokens.select(F.col("sid").alias("hub"), F.col("tokens").alias("other")), "hub")

    def verified(found):
        for a, b, x, y in found:
            if linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)):
                yield a, b

    links = stage(arrow_rows(sided.select("sid", "hub", "tokens", "other"), verified, "a long, b long"), "first-links")
    comps = connected_components(links)
    apart = stage(_apart(members, comps), "apart")
    if apart.isEmpty():
        return rows_, sets, comps
    able = stage(_may_link(apart, tokens), "able")
    cells = _in_cells(able).join(able.select("sid", "component").distinct(), "sid").join(tokens, "sid")
    dealt = cells.select("key", "cell", "side", "sid", "component", "tokens")
    dealt = dealt.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell", "sid")
    more = stage(arrow_rows(dealt, _cell_links, "a long, b long"), "cell-links")
    if not more.isEmpty():
        comps = connected_components(links.unionByName(more))
    return rows_, sets, comps


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    Sets hold the distinct 4-word shingles, or all words of a shorter text as one; rows link when the Jaccard
    similarity of their full sets is 0.8 or more; the component is the smallest key reachable by links, itself
    included, and the row with that key is kept. Equal sets, of repeated rows or not, are one. Null and empty texts and
    texts of white space have no shingles and link with nothing. Rows with a null key link like others; where all keys
    of a component are null it has none, and its rows are kept. Other columns are not read, whatever their names.
    """
    packed, size = pack(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text")
    rows_, sets, comps = _components(packed, size, "key", docs.schema[key].dataType.simpleString())
    named = sets.select("sid", "id", "least").join(comps.withColumnRenamed("id", "sid"), "sid", "left")
    named = named.withColumn("component", F.coalesce("component", "sid"))
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "component").select("id", "component_id")
    found = rows_.select("key", "n", "id").join(named, "id", "left")
    smallest = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
    found = found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), smallest.alias("component_id"))
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns, where the keys are unique and not null."""
    kept = near_duplicates(docs, key, text).where("kept").select(key).distinct()
    return docs.join(kept, key, "left_semi")


def brute_force(documents: list[tuple]) -> list[tuple]:
    """The same rows from all pairs of plain word sets: for tests."""
    sets = []
    for name, text in documents:
        own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            own = own.replace(c, " ")
        words = [w for w in own.split(" ") if w]
        k = min(WORDS, len(words))
        sets.append((name, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()))
    up = list(range(len(sets)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= PERCENT * len(x | y):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, (name, _) in enumerate(sets):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    out = []
    for i, (name, own) in enumerate(sets):
        component = least.get(root(i)) if own else name
        out.append((name, len(own), component, name == component))
    return out
