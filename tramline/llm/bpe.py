"""Byte-level BPE through a sentencepiece model that is serialised from the ranks.

No tokenizer is trained: the vocabulary file holds byte strings with ranks. Every byte becomes one printable
character, every byte string a piece with the score ``-rank``, and the normaliser is the identity. sentencepiece's
BPE joins the best-scored neighbours first, leftmost on ties, which is the merge order of the ranks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import islice

import regex
import sentencepiece
from pyspark.sql import DataFrame

from tramline.llm.common import arrow_rows

CACHE = 400_000  # pre-tokens a worker remembers at most; then it starts anew
LONG = 2_000_000  # characters from which pre-tokens are taken in portions
PORTION = 200_000
LATIN = 0x250  # code points below are Latin letters, digits, signs and controls


def byte_characters() -> list[str]:
    """A printable character for every byte: visible Latin-1 as it is, the rest from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank (ranks run from 0 without gaps)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def latin_pattern(pattern: str) -> str:
    """The same splits for texts of Latin characters alone, with the classes spelt out for the faster ``re``."""

    def members(kind: str) -> str:
        return "".join(f"\\u{i:04x}" for i in range(LATIN) if regex.fullmatch(kind, chr(i)))

    out, bracket = [], False
    for token in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        if token.startswith("\\p") or token == r"\s":
            out.append(members(token) if bracket else f"[{members(token)}]")
        elif token == r"\S":
            out.append(f"[^{members(chr(92) + 's')}]")
        else:
            bracket = token == "[" or bracket and token != "]"
            out.append(token)
    return "".join(out)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol-buffer message: bytes, whole number or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece i is the byte-mapped i-th byte string with score -i; the last id is unknown."""
    chars = byte_characters()
    model = bytearray()
    for rank, piece in enumerate(pieces):
        text = "".join(chars[b] for b in piece).encode()
        model += _field(1, _field(1, text) + _field(2, float(-rank)) + _field(3, 1))
    unknown = len(pieces)
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    no_id = (1 << 64) - 1  # -1
    trainer = _field(3, 2) + _field(4, unknown + 1) + _field(40, unknown)
    trainer += b"".join(_field(n, no_id) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(model + _field(2, trainer) + _field(3, normaliser))


class ByteBpe:
    """Encoder and decoder of one worker over a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chars = byte_characters()
        self.map = str.maketrans({chr(i): c for i, c in enumerate(self.chars)})
        back = {c: i for i, c in enumerate(self.chars)}
        count = self.model.get_piece_size() - 1
        names = [self.model.id_to_piece(i) for i in range(count)]
        self.whole = {name: i for i, name in enumerate(names)}
        self.bytes_of = {str(i): bytes(back[c] for c in name) for i, name in enumerate(names)}
        self.split = regex.compile(pattern)
        self.cache: dict[str, str] = {}
        self.narrow = re.compile(latin_pattern(pattern))
        self.beyond = re.compile(f"[^\0-{chr(LATIN - 1)}]").search

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """Matches of the pattern, in bounded portions for very long texts."""
        split = self.split if self.beyond(text) else self.narrow
        if len(text) < LONG:
            yield split.findall(text)
            return
        found = split.finditer(text)
        while part := [m.group() for m in islice(found, PORTION)]:
            yield part

    def learn(self, lists: list[list[str]]) -> None:
        """Encode the pre-tokens that were not seen before: a whole piece as its id, others by merging."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list(set().union(*lists).difference(self.cache))
        # UTF-8 bytes seen as Latin-1 characters, then each byte's own character
        mapped = [w.encode().decode("latin-1").translate(self.map) for w in new]
        rest = []
        for word, m in zip(new, mapped, strict=True):
            if m in self.whole:
                self.cache[word] = str(self.whole[m])
            else:
                rest.append((word, m))
        for (word, _), ids in zip(rest, self.model.encode([m for _, m in rest], num_threads=1), strict=True):
            self.cache[word] = " ".join(map(str, ids))

    def joined(self, words: list[str]) -> str:
        """Ids of learnt pre-tokens as decimal text, joined by one space."""
        return " ".join(map(self.cache.__getitem__, words))

    def encode(self, text: str) -> Iterator[str]:
        """Portions of a text's ids as decimal text."""
        for words in self.pre_tokens(text):
            if words:
                self.learn([words])
                yield self.joined(words)

    def encode_all(self, rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[str]]]:
        """``(key, text)`` rows to ``(key, portions of ids)``; short texts learn their pre-tokens together."""
        held: list[tuple[object, list[str]]] = []
        weight = 0
        for key, text in rows:
            text = text or ""
            if len(text) >= LONG:
                yield key, self.encode(text)
                continue
            held.append((key, next(self.pre_tokens(text))))
            weight += len(held[-1][1])
            if weight > PORTION:
                yield from self._flush(held)
                held, weight = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[tuple[object, list[str]]]) -> Iterator[tuple[object, Iterator[str]]]:
        self.learn([words for _, words in held])
        for key, words in held:
            yield key, iter([self.joined(words)] if words else [])

    def decode(self, ids: str) -> bytes:
        """The bytes of ids given as decimal text."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" ")))


def encode_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every text, decode the ids, and digest both.

    Returns ``key, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``, the ids as an array. One row per
    input row, repeated and null keys included; null and empty texts have no ids. Other columns of ``docs`` are not
    read, so their names cannot clash. Only the serialised model travels to the executors; its size is that of the
    vocabulary, whatever the input.
    """
    model = docs.sparkSession.sparkContext.broadcast(serialise_model(read_ranks(ranks_path)))

    def rows(found):
        codec = ByteBpe(model.value, pattern)
        for doc, parts in codec.encode_all(found):
            ids_hash, text_hash, count, kept = hashlib.sha256(), hashlib.sha256(), 0, []
            for part in parts:
                ids_hash.update(f" {part}".encode() if count else part.encode())
                count += part.count(" ") + 1
                text_hash.update(codec.decode(part))
                if keep_ids:
                    kept.extend(map(int, part.split(" ")))
            row = (doc, count, ids_hash.hexdigest(), text_hash.hexdigest())
            yield (*row, kept) if keep_ids else row

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return arrow_rows(docs.select(key, text), rows, schema)
