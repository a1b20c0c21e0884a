"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library, word by word.

Tokenizers that never join across white space give the ids of a text as the ids of its words in order. Words repeat
far more often than texts, so each worker remembers the ids of words it has met and asks the library for new ones
only. Whether a tokenizer is of this kind is checked when it is loaded; if not, whole texts go to the library. Where
its pattern takes runs of letters, single digits and runs of other characters, words of ASCII and of Latin or Cyrillic
letters are cut into those: a word then is one with and without the punctuation behind it. Words with an apostrophe
(the pattern knows some endings) or any other character stay whole. Many texts are cut in one pass, and a word that
stands in them often is looked up once.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

CACHE = 250_000  # words a worker remembers at most of the newest and of those before them
CUT = 2_000_000  # bytes of text whose words are cut in one pass
TOGETHER = 16_000_000  # bytes of text whose distinct words are looked up once
LINE = 128  # new words in one text of such a call
MARK = "\x00"  # stands between them
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # cut by kinds of bytes
SPACE, LETTER, DIGIT, OTHER, WHOLE = range(5)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[*b" \t\n\x0b\x0c\r"]] = SPACE
KINDS[[*b"abcdefghijklmnopqrstuvwxyz"]] = LETTER
KINDS[[*b"0123456789"]] = DIGIT
KINDS[128:192] = LETTER  # behind the first byte of a character
KINDS[192:] = KINDS[ord("'")] = WHOLE
# U+00C0 to U+017F and U+0400 to U+047F: letters but for three, each of them one in lower case and composed (NFC)
KINDS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = LETTER
# the model's letters for bytes: printable ones stand for themselves, the others follow from U+0100 on; the space splits
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
BYTE_LEVEL = "".join(" " if b == 32 else chr(b if b in _PRINTED else 256 + _OTHERS.index(b)) for b in range(256))
LATIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # lower case already


class WordIds:
    """Ids of one worker. With ``special``, special strings in a text are special tokens, as the library has it by
    default; without, they are plain text."""

    def __init__(self, content: str, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        parts = json.loads(content)
        self.content = content
        self.special = [t["content"] for t in parts.get("added_tokens") or []] if special else []
        self.by_word = _drops_white_space(parts)
        self.lower = self.by_word and '"Lowercase"' in json.dumps(parts.get("normalizer"))
        # ASCII words split by the pattern alone, and nothing but the model acts on a piece of letters
        self.split = re.compile(_ascii_pattern(parts).encode()) if self.lower else None
        self.runs = self.lower and _pattern(parts) == RUNS
        self.model = self.library
        if self.split:
            bare = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
            self.model = Tokenizer.from_str(json.dumps(parts | bare))
        # a mark tells words apart by its id, which words without it do not have; the bare model takes its byte-level letter
        self.marks = {by: self._mark(by, m) for by, m in ((self.library, MARK), (self.model, BYTE_LEVEL[0])) if self.by_word}
        self.cache: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    @cached_property
    def whole(self):
        """The tokenizer for texts with special strings, loaded when the first of them comes."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.content)

    def library_ids(self, texts: list[str], by=None) -> list[bytes]:
        found = (by or self.library).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _mark(self, by, mark: str) -> tuple[str, int | None]:
        ids = by.encode(mark, add_special_tokens=False).ids
        return mark, ids[0] if len(ids) == 1 and by.id_to_token(ids[0]).startswith("\u0100") else None

    def word_ids(self, words: list[bytes], by=None) -> Iterator[bytes]:
        """Ids of words that hold no mark, many of them in a text."""
        by = by or self.library
        bare = by is not self.library

        def read(line: bytes) -> str:
            return charmap_decode(line, "strict", BYTE_LEVEL)[0] if bare else line.decode()

        _, own = self.marks[by]
        if own is None:
            yield from self.library_ids([read(w) for w in words], by)
            return
        between, size = f" {MARK} ".encode(), self.dtype.itemsize
        lines = [read(between.join(words[i : i + LINE])) for i in range(0, len(words), LINE)]
        for line in by.encode_batch_fast(lines, add_special_tokens=False):
            ids = np.array(line.ids, self.dtype)
            data, at = ids.tobytes(), (np.flatnonzero(ids == own) * size).tolist()
            for start, stop in zip([0, *(a + size for a in at)], [*at, len(data)], strict=True):
                yield data[start:stop]

    def learn(self, words: Iterable[bytes]) -> None:
        """Make the cache hold all these words."""
        if len(self.cache) > CACHE:  # words that come again are taken over from the generation before
            self.before, self.cache = self.cache, {}
        cache, before = self.cache, self.before
        new = {w for w in words if w not in cache}
        known = new.intersection(before)
        cache.update((w, before[w]) for w in known)
        new -= known
        split = {w: self.split.findall(w) for w in new if w.isascii() and not w.isalpha()} if self.split else {}
        ask = (new - split.keys()).union(*split.values()).difference(cache)
        letters = [w for w in ask if w.isalpha() or (self.runs and LATIN.fullmatch(w))] if self.split else []
        rest = ask.difference(letters)
        marked = [w for w in rest if MARK.encode() in w]
        plain = list(rest.difference(marked))
        cache.update(zip(letters, self.word_ids(letters, self.model), strict=True))
        cache.update(zip(plain, self.word_ids(plain), strict=True))
        cache.update(zip(marked, self.library_ids([w.decode() for w in marked]), strict=True))
        for w, pieces in split.items():
            cache[w] = b"".join(map(cache.__getitem__, pieces))

    def forget(self) -> None:
        """Leave the words' room to what the worker does next, and to the other processes of the executor."""
        self.cache, self.before = {}, {}
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps it otherwise
            trim(0)

    def encode_all(self, rows: Iterator[tuple]) -> Iterator[tuple[tuple, bytes]]:
        """Rows whose last value is a text (null: empty) to ``(other values, little-endian ids)``."""
        held: list[tuple[tuple, bytes]] = []
        cut: list[tuple] = []
        weight = done = 0
        for *rest, text in rows:
            text = text or ""
            special = any(s in text for s in self.special)
            if special or not self.by_word:
                yield from self._encoded([*cut, self._cut(held)])  # rows keep their order
                held, cut, weight, done = [], [], 0, 0
                yield tuple(rest), self.library_ids([text], self.whole if special else None)[0]
                continue
            data = text.encode()
            held.append((tuple(rest), data))
            weight += len(data)
            if weight - done > CUT:
                cut.append(self._cut(held))
                held, done = [], weight
            if weight > TOGETHER:
                yield from self._encoded([*cut, self._cut(held)])
                held, cut, weight, done = [], [], 0, 0
        yield from self._encoded([*cut, self._cut(held)])

    def _cuts(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes are no white space, and the places where words begin, or their pieces that the library keeps apart."""
        kind = KINDS[line]
        inside = kind != SPACE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        if not self.runs:
            return inside, np.flatnonzero(first)
        begins = first.copy()
        begins[1:] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        cuts = np.flatnonzero(begins)
        at = np.flatnonzero((line == 0xC3) | (line == 0xC4))
        pair = line[at].astype(np.int64) << 8 | line[at + 1]
        signs = at[(pair == 0xC397) | (pair == 0xC3B7) | (pair == 0xC4B0)]  # times, divided by; two in lower case
        odd = np.r_[np.flatnonzero(kind == WHOLE), signs]
        word = np.cumsum(first[cuts])
        whole = np.zeros(len(cuts) + 1, bool)
        whole[word[np.searchsorted(cuts, odd, "right") - 1]] = True
        return inside, cuts[first[cuts] | ~whole[word]]

    def _cut(self, held: list[tuple[tuple, bytes]]) -> tuple[list[tuple], np.ndarray, pa.Array]:
        """The rows' other values, the number of words before each text and at the end, and the words."""
        data = b"\n".join(text for _, text in held)
        line = np.frombuffer(data.lower() if self.lower else data, np.uint8)  # A-Z only; the library lowers the rest
        inside, cuts = self._cuts(line)
        begins = np.cumsum([0, *(len(text) + 1 for _, text in held)])
        # words without the white space between them
        before = np.cumsum(inside, dtype=np.int64)
        buffers = [None, pa.py_buffer(np.append(before[cuts] - 1, before[-1:])), pa.py_buffer(line[inside])]
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts), buffers)
        return [rest for rest, _ in held], np.searchsorted(cuts, begins), words

    def _encoded(self, cut: list[tuple]) -> Iterator[tuple[tuple, bytes]]:
        found = pa.chunked_array([words for _, _, words in cut]).dictionary_encode()  # one dictionary for all
        words = found.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist() if len(found) else []
        places = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in found.chunks)])
        self.learn(words)
        known = [self.cache[w] for w in words]
        ids = np.frombuffer(b"".join(known), self.dtype)
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        start = np.cumsum(size) - size
        done = 0
        for rests, texts, own in cut:
            which = places[done : done + len(own)]
            done += len(own)
            stops = np.r_[0, np.cumsum(size[which])]
            source = np.arange(stops[-1]) + np.repeat(start[which] - stops[:-1], size[which])
            out = ids[source].tobytes()
            edges = (stops[texts] * self.dtype.itemsize).tolist()
            for rest, a, b in zip(rests, edges, edges[1:], strict=False):
                yield rest, out[a:b]


@lru_cache(maxsize=1)
def _loaded(content: str, special: bool) -> WordIds:
    return WordIds(content, special)


def worker_ids(content: str, special: bool) -> WordIds:
    """An encoder without words; the tokenizer is loaded once by a worker, which Spark gives one task after another."""
    own = _loaded(content, special)
    own.forget()
    return own


def _pattern(parts: dict) -> str:
    steps = parts["pre_tokenizer"].get("pretokenizers") or [parts["pre_tokenizer"]]
    return steps[0]["pattern"]["Regex"]


def _ascii_pattern(parts: dict) -> str:
    """The splitting pattern for lower-case ASCII words, with the classes spelt out for ``re``."""
    pattern = _pattern(parts)
    return pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")


def _drops_white_space(parts: dict) -> bool:
    """Whether the pre-tokenizer keeps matches of a pattern that holds no white space, and nothing else."""
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [parts.get("pre_tokenizer") or {}]
    first = steps[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    bare = re.sub(r"\[\^[^\]]*\\s[^\]]*\]", "", pattern)  # a class that leaves white space out holds none
    spaces = " " in bare or "\\s" in bare or "[^" in bare or "." in bare
    kept = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    known = {"NFC", "Replace", "Lowercase", "Sequence", None}
    normaliser = parts.get("normalizer") or {}
    kinds = {n.get("type") for n in normaliser.get("normalizers", [normaliser])}
    return bool(kept and pattern and not spaces and kinds <= known)
