"""Benchmark decontamination with one Aho-Corasick automaton over the windows of all items.

Texts are scanned once as bytes: A-Z become a-z, every other byte that is no word character becomes a space, and
all else stays, so each byte keeps its place. Words are what stands between spaces. Windows and documents are both
written as words with one space before and after each; the automaton then finds whole words only, and the number of
spaces before a match gives its words, whose bytes in the original are known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows, stage

# 0-9, a-z, A-Z in lower case, and all bytes of characters outside ASCII; all else separates words
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def item_windows(text: str | None, words: int) -> Iterator[bytes]:
    """Every ``words`` consecutive words of an item, or all of them if fewer; none without words."""
    own = normal_words(text)
    for i in range(max(1, len(own) - words + 1) if own else 0):
        yield b" " + b" ".join(own[i : i + words]) + b" "


class Scanner:
    """One automaton over windows given as ``(item, window)``; bytes are looked at as Latin-1 characters."""

    def __init__(self, windows: list[tuple[object, bytes]]):
        self.items: list[set] = []
        self.words: list[int] = []
        self.machine = ahocorasick.Automaton()
        place: dict[bytes, int] = {}
        for item, window in windows:
            if window not in place:
                place[window] = len(self.items)
                self.items.append(set())
                self.words.append(window.count(b" ") - 1)
                self.machine.add_word(window.decode("latin-1"), place[window])
            self.items[place[window]].add(item)
        if place:
            self.machine.make_automaton()

    def scan(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, sorted indexes of the words hit, and the items found."""
        words = normal_words(text)
        found: dict[int, set[int]] = {}
        items: set = set()
        if words and self.items:
            line = (b" " + b" ".join(words) + b" ").decode("latin-1")
            for end, window in self.machine.iter(line):
                found.setdefault(window, set()).add(end)
        if not found:
            return len(words), np.zeros(0, np.int64), items
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        hit = np.zeros(len(words) + 1, np.int64)
        for window, ends in found.items():
            items |= self.items[window]
            last = np.searchsorted(spaces, np.fromiter(ends, np.int64))  # the window ends with word last - 1
            np.add.at(hit, last - self.words[window], 1)
            np.add.at(hit, last, -1)
        return len(words), np.flatnonzero(np.cumsum(hit)[:-1]), items


def word_places(text: str) -> np.ndarray:
    """First and last-plus-one byte of every word in the UTF-8 text."""
    inside = np.frombuffer(text.encode().translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges.reshape(-1, 2)


WINDOW_BYTES = 32 << 20  # of an automaton, beside the number of its windows


def _in_blocks(items: DataFrame, words: int, item: str, text: str, most: int) -> Iterator[list]:
    """The windows of all items, at most ``most`` and about ``WINDOW_BYTES`` at a time; one empty block without any."""

    def rows(found):
        for name, content in found:
            for window in item_windows(content, words):
                yield name, window

    kind = items.schema[item].dataType.simpleString()
    windows = arrow_rows(items.select(item, text), rows, f"item {kind}, window binary")
    block, weight, full = [], 0, False
    for r in windows.toLocalIterator():
        if full:
            yield block
            block, weight = [], 0
        block.append((r.item, bytes(r.window)))
        weight += len(r.window)
        full = len(block) >= most or weight >= WINDOW_BYTES
    yield block


def _passes(docs: DataFrame, at: int, blocks: Iterator[list], finish: Callable[..., Iterator[tuple]], schema: str):
    """Scan with one automaton after another; ``finish`` makes the rows of ``schema`` in the last pass.

    ``at`` is the text's place in a row. Nothing is shuffled; what earlier passes found travels with the row. Every pass
    but the last is written, so that a task holds one automaton at a time.
    """
    spark = docs.sparkSession
    # rows are read by place; columns are named by it too, so that no name clashes with what is carried
    own = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    found_columns = [F.array().cast("array<long>").alias("hit"), F.array().cast("array<string>").alias("items")]

    def one(frame: DataFrame, windows: list, last: bool) -> DataFrame:
        held = spark.sparkContext.broadcast(windows)

        def rows(found):
            scanner = Scanner(held.value)
            for *row, before, before_items in found:
                count, hit, items = scanner.scan(row[at])
                if before:
                    hit = np.union1d(hit, np.array(before, np.int64))
                items = {str(i) for i in items if i is not None} | set(before_items)
                if last:
                    yield from finish(row, count, hit, sorted(items))
                else:
                    yield (*row, hit.tolist(), list(items))

        return arrow_rows(frame, rows, schema if last else f"{own}, hit array<long>, items array<string>")

    frame, block = docs.toDF(*(f"_{i}" for i in range(len(docs.columns)))).select("*", *found_columns), next(blocks)
    for following in blocks:
        frame, block = stage(one(frame, block, False), "scanned"), following
    return one(frame, block, True)


def scan_documents(
    docs: DataFrame,
    items: DataFrame,
    words: int = 13,
    most: int = 200_000,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
) -> DataFrame:
    """``key, n_words, n_hit, items, spans`` of every document.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` lists the items with such a window (as
    sorted text), ``spans`` the hit runs as first and last-plus-one byte of the original UTF-8 text. An automaton
    holds ``most`` windows, a bound on what is broadcast; items with more windows in all are scanned for in as many
    passes, united per row. Every row gives one row, with repeated and null keys too; null and empty texts have no
    words; an item without words has no window; windows that several items share count for each. Items with a null id
    hit words like others, but have no name to be listed by; items with the same id are one in the list.
    """
    kind = docs.schema[key].dataType.simpleString()

    def finish(row, count, hit, own):
        spans = []
        if len(hit):
            cut = np.flatnonzero(np.diff(hit) > 1)
            places = word_places(row[1])
            spans = np.stack([places[hit[np.r_[0, cut + 1]], 0], places[hit[np.r_[cut, len(hit) - 1]], 1]], axis=1)
            spans = spans.tolist()
        yield row[0], count, len(hit), own, spans

    schema = f"{key} {kind}, n_words long, n_hit long, items array<string>, spans array<array<long>>"
    return _passes(docs.select(key, text), 1, _in_blocks(items, words, item, text, most), finish, schema)


def clean_documents(
    docs: DataFrame, items: DataFrame, words: int = 13, most: int = 200_000, share: int = 20, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that the rule does not call contaminated."""

    def finish(row, count, hit, _):
        if not len(hit) or share * len(hit) < count:
            yield tuple(row)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return _passes(docs, docs.columns.index(text), _in_blocks(items, words, "item_id", "text", most), finish, schema)


def contaminated(n_hit, n_words, share: int = 20):
    """The rule: hit at all, and at least one word in ``share``."""
    return (n_hit > 0) & (F.lit(share) * n_hit >= n_words)


def digest(scanned: DataFrame) -> DataFrame:
    """The counts and the digest of the items, per document."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def brute_force(documents: list[tuple], items: list[tuple], words: int = 13) -> list[tuple]:
    """The same digests by comparing every window with every place: for tests."""
    windows = [(name, w.split()) for name, text in items for w in item_windows(text, words)]
    out = []
    for name, text in documents:
        own = normal_words(text)
        hit, met = set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    met |= {str(item)} - {"None"}
        digest_ = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((name, len(own), len(hit), len(met), digest_, bool(hit) and 20 * len(hit) >= len(own)))
    return out
