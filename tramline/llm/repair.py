"""Token files compressed by grammar: neighbours that stand twice become nonterminals, shard by shard (Re-Pair).

A token file is a table of parts. A part holds the documents of a stretch of ascending ``doc_id``: their ids, token
counts and lengths in the compressed sequence, the sequence itself, the rules, and the expansion length of every
nonterminal. Rules never cross documents, so one document is decoded from its own piece of the sequence, and the
expansion lengths lead to any token in it without decoding what comes before.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, blob, shards, stage
from tramline.llm.wordids import WordIds, worker_ids

PART = 1_000_000  # tokens from which a part ends
SLOTS = 1 << 20  # counters of a round whose pairs do not fit in 64 bits beside their places
FILE = (
    "shard int, part int, n_tokens long, width int, keys array<{key}>, counts binary, pieces binary, "
    "rules binary, expansions binary, sequence binary"
)


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (right.astype(np.uint32) * np.uint32(0x85EBCA6B))
    return (mixed ^ (mixed >> np.uint32(15))) & np.uint32(SLOTS - 1)


def _counted(pairs: np.ndarray, slot: np.ndarray, busy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs ascending, the place of each pair among them, and how often they stand.

    Nearly all slots hold one pair, which needs no sorting; pairs that met another one in their slot are told apart.
    """
    rank = np.zeros(SLOTS, np.int32)
    rank[busy] = np.arange(len(busy))
    where = rank[slot].astype(np.int64)
    known = np.zeros(len(busy), np.uint64)
    known[where] = pairs  # one of the slot's pairs
    other = np.flatnonzero(known[where] != pairs)
    more, place = np.unique(pairs[other], return_inverse=True)
    where[other] = len(known) + place
    every = np.r_[known, more]
    often = np.bincount(where, minlength=len(every))
    order = np.argsort(every)
    order = order[often[order] > 0]
    at = np.zeros(len(every), np.int64)
    at[order] = np.arange(len(order))
    return every[order], at[where], often[order]


def _often(left: np.ndarray, right: np.ndarray, symbols: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that stand in ``least`` places or more, the rarest first, and the rank of each place's pair from 1 on (0: rare)."""
    n = len(left)
    bits = n.bit_length()
    if (symbols * symbols - 1).bit_length() + bits <= 64:  # a pair and its place are one number, and sort as such
        packed = left.astype(np.uint64)
        packed *= np.uint64(symbols)
        packed += right
        packed <<= np.uint64(bits)
        packed |= np.arange(n, dtype=np.uint32)
        packed.sort()
        place = (packed & np.uint64((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)
        packed >>= np.uint64(bits)
        begin = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1])))
        found, often, base = packed[begin], np.diff(begin, append=n), np.uint64(symbols)
        del packed
    else:
        slot = _slots(left, right)
        count = np.bincount(slot, minlength=SLOTS)
        place = np.flatnonzero(count[slot] >= least)
        pair = left[place].astype(np.uint64) << np.uint64(32) | right[place]
        found, which, often = _counted(pair, slot[place], np.flatnonzero(count >= least))
        place, base = place[np.argsort(which, kind="stable")], np.uint64(1 << 32)
    good = np.flatnonzero(often >= least)
    good = good[np.argsort(often[good], kind="stable")]
    number = np.zeros(len(often), np.uint32)
    number[good] = np.arange(1, len(good) + 1)
    rank = np.zeros(n, np.uint32)
    rank[place] = np.repeat(number, often)
    return np.stack(np.divmod(found[good], base), axis=1).astype(np.uint32), rank


def _ascending(places: np.ndarray, n: int) -> np.ndarray:
    """Distinct places from -1 to n - 1 in order, -1 as such or as n."""
    if len(places) < n >> 5:
        return np.unique(places)
    there = np.zeros(n + 1, bool)
    there[places] = True
    return np.flatnonzero(there)


def compress(ids: np.ndarray, ends: np.ndarray, first: int, least: int = 2):
    """Re-Pair in rounds, until no pair of neighbours stands in ``least`` places that do not overlap.

    ``ends`` are the documents' ends in ``ids``; ``first`` is the first free symbol. A round takes all frequent pairs,
    and replaces a pair where it is more frequent than those that share a symbol with it; so the most frequent pair is
    replaced in all its places, and every round has a rule. Pairs that win fewer than ``least`` places wait for the
    next round. Only pairs with a new symbol, and those that waited, can be frequent then: the others are not counted
    again. Returns the sequence, the documents' ends in it, and the rules (pairs of symbols; rule i is symbol
    ``first + i``).
    """
    seq, ends = ids.astype(np.uint32), ends.astype(np.int64)
    n = len(seq)
    kind = np.int32 if n < 1 << 31 else np.int64
    after, before = np.arange(1, n + 1, dtype=kind), np.arange(-1, n, dtype=kind)  # the symbols left beside each; place n is none
    done = np.zeros(n + 1, bool)  # symbols that end a document, or have become part of the one before
    done[ends[ends > 0] - 1] = done[n - 1 :] = True
    stays = np.ones(n, bool)
    rules: list[np.ndarray] = []
    free = first
    at = np.flatnonzero(~done).astype(kind)
    while len(at):
        behind = after[at]
        left, right = seq[at], seq[behind]
        # in a run of one symbol every second place counts
        run = np.flatnonzero(left == right)
        start = np.ones(len(run), bool)
        start[1:] = at[run[1:]] != behind[run[:-1]]
        place = np.arange(len(run))
        second = run[(place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 1]
        left[second] = free  # a symbol that does not stand anywhere yet
        pairs, rank = _often(left, right, free + 1, least)
        rank[second] = 0
        del left, right
        near = at[1:] == behind[:-1]
        more = rank[1:] > rank[:-1]
        wins = rank > 0
        wins[1:] &= ~near | more
        wins[:-1] &= ~near | ~more
        won = np.flatnonzero(wins)
        ruled = np.bincount(rank[won], minlength=len(pairs) + 1) >= least
        won = won[ruled[rank[won]]]
        if not len(won):
            break
        name = (np.cumsum(ruled) + (free - 1)).astype(np.uint32)
        taken, gone = at[won], behind[won]
        seq[taken] = name[rank[won]]
        following = after[gone]
        after[taken] = following
        before[following] = taken
        done[taken] = done[gone]
        done[gone] = True
        stays[gone] = False
        at = _ascending(np.concatenate([at[rank > 0], at[second], before[taken]]), n)
        at = at[~done[at]].astype(kind)
        rules.append(pairs[ruled[1:]])
        free += len(rules[-1])
    size = np.r_[0, np.cumsum(stays)]
    return seq[stays], size[ends], np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def _batches(rules: np.ndarray, first: int) -> Iterator[tuple[int, int]]:
    """Stretches of rules that use no rule of their own stretch; a rule uses earlier symbols only."""
    latest = np.maximum.accumulate(rules.max(axis=1, initial=0).astype(np.int64) - first)
    begin = 0
    while begin < len(rules):
        stop = int(np.searchsorted(latest, begin))
        yield begin, stop
        begin = stop


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Tokens that each nonterminal stands for."""
    size = np.ones(first + len(rules), np.int64)
    for a, b in _batches(rules, first):
        size[first + a : first + b] = size[rules[a:b]].sum(axis=1)
    return size[first:]


class Grammar:
    """Rules of a part, with all expansions laid out once behind the plain symbols."""

    def __init__(self, rules: np.ndarray, sizes: np.ndarray, first: int):
        self.sizes = np.concatenate([np.ones(first, np.int64), sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.arange(self.sizes.sum(), dtype=np.uint32)
        for a, b in _batches(rules, first):
            own = self.decode(rules[a:b].ravel())
            begin = self.starts[first + a]
            self.flat[begin : begin + len(own)] = own

    def lengths(self, seq: np.ndarray) -> np.ndarray:
        return self.sizes[seq]

    def decode(self, seq: np.ndarray) -> np.ndarray:
        length = self.lengths(seq)
        stop = np.cumsum(length)
        total = int(stop[-1]) if len(seq) else 0
        return self.flat[np.repeat(self.starts[seq] - stop + length, length) + np.arange(total)]

    def tokens(self, seq: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Tokens ``start`` to ``stop`` of a document, decoding only the symbols that hold them."""
        edge = np.cumsum(self.lengths(seq))
        a, b = np.searchsorted(edge, start, "right"), np.searchsorted(edge, stop, "left") + 1
        skipped = int(edge[a - 1]) if a else 0
        return self.decode(seq[a:b])[start - skipped : stop - skipped]


def _narrow(values: np.ndarray) -> tuple[bytes, int]:
    """Whole numbers in as few bytes each as the largest needs, and how many that are."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes(), width


def _wide(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel()


def part_rows(found: Iterator[tuple], first: int, width: int) -> Iterator[tuple]:
    """Sorted rows ``(shard, key, ids)`` to rows of the token file."""
    dtype = np.dtype(f"<u{width}")
    state: dict = {"shard": None, "part": 0}
    keys: list = []
    held: list[bytes] = []
    weight = 0

    def finish():
        ids = np.frombuffer(b"".join(held), dtype)
        counts = np.array([len(h) // width for h in held], np.int64)
        seq, ends, rules = compress(ids, np.cumsum(counts), first)
        pieces = np.diff(np.r_[0, ends])
        symbols, width_ = _narrow(np.concatenate([rules.ravel(), seq]))
        sizes, _ = _narrow(expansion_lengths(rules, first))
        row = (state["shard"], state["part"], len(ids), width_, list(keys), blob(counts), blob(pieces))
        row += (symbols[: rules.size * width_], sizes, symbols[rules.size * width_ :])
        keys.clear()
        held.clear()
        state["part"] += 1
        return row

    for shard, key, ids in found:
        if held and (shard != state["shard"] or weight >= PART * width):
            yield finish()
            weight = 0
        if shard != state["shard"]:
            state.update(shard=shard, part=0)
        keys.append(key)
        held.append(ids)
        weight += len(ids)
    if held:
        yield finish()


def read_part(row: dict, first: int) -> tuple[Grammar, np.ndarray, np.ndarray, np.ndarray]:
    """Grammar, sequence, token counts and piece lengths of a part."""
    rules = _wide(row["rules"], row["width"]).reshape(-1, 2)
    sizes = _wide(row["expansions"], max(1, len(row["expansions"]) // max(1, len(rules)))).astype(np.int64)
    grammar, seq = Grammar(rules, sizes, first), _wide(row["sequence"], row["width"])
    return grammar, seq, np.frombuffer(row["counts"], np.int64), np.frombuffer(row["pieces"], np.int64)


def shard_edges(docs: DataFrame, key: str, count: int) -> list[int]:
    """Keys at which shards begin, from approximate quantiles; a key's shard is the number of edges up to it."""
    known = docs.select(key).where(F.col(key).isNotNull())
    return sorted({int(e) for e in known.approxQuantile(key, [i / count for i in range(1, count)], 0.2 / count)})


def encoded(docs: DataFrame, tokenizer: str, end: int, key: str, text: str, count: int) -> tuple[DataFrame, int, int]:
    """``shard, key, ids`` of every text, the end id behind each; the first free symbol, and bytes per id.

    Special strings in a text are special tokens, as in the library.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    own = WordIds(content)
    edges = shard_edges(docs, key, count)
    first, width = max(own.library.get_vocab_size(), end + 1), own.dtype.itemsize
    sent = docs.sparkSession.sparkContext.broadcast(content)  # as large as the vocabulary, whatever the input

    def rows(found):
        words = worker_ids(sent.value, special=True)
        last = np.array([end], words.dtype).tobytes()
        for (name,), ids in words.encode_all(found):
            yield 0 if name is None else bisect_right(edges, name), name, ids + last
        words.forget()

    kind = docs.schema[key].dataType.simpleString()
    return arrow_rows(docs.select(key, text), rows, f"shard int, {key} {kind}, ids binary"), first, width


def write_token_file(
    docs: DataFrame, tokenizer: str, end: int = 1, key: str = "doc_id", text: str = "text", shard_bytes: int = 8 << 20
) -> tuple[DataFrame, int]:
    """Encode whole texts and write them in ascending order of the key; the file's table and its first free symbol.

    Null and empty texts have the end id alone. Rows with the same key keep all their rows, in the order of their
    ids; null keys come first. ``key`` is a whole number. Shards follow the size of the input.
    """
    count = shards(docs.select(key, text), shard_bytes)
    ids, first, width = encoded(docs, tokenizer, end, key, text, count)
    kind = docs.schema[key].dataType.simpleString()
    dealt = ids.repartition(count, "shard").sortWithinPartitions("shard", F.col(key).asc_nulls_first(), "ids")
    parts = arrow_rows(dealt, lambda found: part_rows(found, first, width), FILE.format(key=kind))
    return stage(parts, "tokens"), first


def part_starts(parts: DataFrame) -> DataFrame:
    """``shard, part, base``: tokens before each part, by sums of shards first and of parts within a shard then."""
    sizes = parts.select("shard", "part", "n_tokens")
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    totals = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return sizes.withColumn("_in", inner).join(totals, "shard").select(
        "shard", "part", (F.col("_base") + F.col("_in")).alias("base")
    )


def read_documents(parts: DataFrame, first: int, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, decoded from the file."""
    names = parts.columns

    def rows(found):
        for values in found:
            row = dict(zip(names, values, strict=True))
            grammar, seq, counts, pieces = read_part(row, first)
            ends = np.cumsum(grammar.lengths(seq))[np.cumsum(pieces) - 1]  # every document has a token, its end id
            tokens = grammar.decode(seq).astype("<u4", copy=False)
            for name, stop, count in zip(row["keys"], ends.tolist(), counts.tolist(), strict=True):
                own = tokens[stop - count : stop]
                yield row["shard"], row["part"], name, stop - count, count, zlib.crc32(own.tobytes())

    kind = parts.schema["keys"].dataType.elementType.simpleString()
    out = arrow_rows(
        parts, rows, f"shard int, part int, {key} {kind}, _at long, n_tokens long, ids_crc32 long"
    )
    return out.join(part_starts(parts), ["shard", "part"]).select(
        key, (F.col("base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"
    )
