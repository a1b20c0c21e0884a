"""Alignment of two tokenizers over the same bytes, once per distinct text.

Documents are shuffled by their full text; each distinct text is tokenised and aligned once, with its number of
documents as weight. Byte offsets where tokens of both sides end cut a text into groups; tokens link when they share a
group. How many documents hold an id pair linked is summed over blocks of texts, each of which sends a pair once. The
counts return to the blocks, and the measures of a text to its documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.bpe import byte_characters
from tramline.llm.common import arrow_rows, blob, stage

BLOCK = 3 << 20  # bytes of text from which a block ends
EXPANDED = 1 << 21  # links expanded at once
PLAIN = 1 << 16  # links from which a group's repeated ids are counted first
LONG = 500_000  # characters from which the tokenizer file's own library encodes


class ByteLevel:
    """Byte strings and ids of a byte-level tokenizer file of the ``tokenizers`` library.

    Where the ids are the order of the merges, as in rank files, the ids come from ``tiktoken``, which is four times as
    fast and gives the same ids (tested on every code point); else, and for very long texts, from the library itself.
    """

    def __init__(self, content: str, pattern: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = True  # their strings in a text are plain text
        model = json.loads(content)["model"]
        back = {c: i for i, c in enumerate(byte_characters())}
        self.bytes_of = [b""] * (max(model["vocab"].values()) + 1)
        ranks = {}
        for name, i in model["vocab"].items():
            if all(c in back for c in name):
                self.bytes_of[i] = bytes(back[c] for c in name)
                ranks[self.bytes_of[i]] = i
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        in_order = [model["vocab"].get(m) for m in merged] == list(range(256, 256 + len(merged)))
        self.fast = None
        if in_order and len(ranks) >= 256 + len(merged):
            import tiktoken

            known = {own: i for own, i in ranks.items() if i < 256 + len(merged)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [
            self.fast.encode_ordinary(t) if len(t) < LONG else self.library.encode(t, add_special_tokens=False).ids
            for t in texts
        ]


class Pieces:
    """Byte strings and ids of a sentencepiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of = []
        for i in range(self.model.get_piece_size()):
            name = self.model.id_to_piece(i)
            if len(name) == 6 and name.startswith("<0x") and name.endswith(">"):
                self.bytes_of.append(bytes([int(name[3:5], 16)]))
            else:
                self.bytes_of.append(name.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Two tokenizers and the tables that alignment needs of them."""

    def __init__(self, first: tuple[str, str], second: bytes):
        self.sides = ByteLevel(*first), Pieces(second)
        self.sizes = [np.array([len(b) for b in s.bytes_of], np.int64) for s in self.sides]
        self.shift = int(len(self.sizes[1])).bit_length()  # bits of an id of the second side
        self.width = self.shift + int(len(self.sizes[0])).bit_length()
        # decimal ids with what follows them: "," inside, "|" and ";" at the end of a group's sides
        ends = ((0, b","), (0, b"|"), (1, b","), (1, b";"))
        self.decimal = [b"%d%s" % (i, end) for side, end in ends for i in range(len(self.sizes[side]))]
        starts = np.cumsum([0] + [len(self.sizes[side]) for side, _ in ends])
        self.inside, self.last = starts[[0, 2]], starts[[1, 3]]

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides, none where joined bytes differ from a space and the text."""
        spaced = [" " + t for t in texts]
        found = []
        for text, a, b in zip(spaced, self.sides[0].encode(spaced), self.sides[1].encode(texts), strict=True):
            whole = text.encode()
            same = all(b"".join(map(s.bytes_of.__getitem__, ids)) == whole for s, ids in zip(self.sides, (a, b), strict=True))
            found.append((a, b) if same and len(whole) > 1 else ([], []))
        return found

    def align(self, texts: list[str]) -> Alignment:
        return Alignment(self, self.tokens(texts))


def _slices(weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches whose weights sum up to ``most``, or single heavier items."""
    total = np.cumsum(weights)
    begin = 0
    while begin < len(weights):
        before = int(total[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + most, "right")))
        yield begin, end
        begin = end


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values, first)


class Alignment:
    """Groups and links of some texts."""

    def __init__(self, aligner: Aligner, tokens: list[tuple[list[int], list[int]]]):
        self.aligner = aligner
        self.counts = np.array([[len(ids) for ids in t] for t in tokens], np.int64).reshape(-1, 2).T
        self.ids = [
            np.fromiter(chain.from_iterable(t[side] for t in tokens), np.int64, int(self.counts[side].sum())) for side in (0, 1)
        ]
        ends = [np.cumsum(size[ids]) for size, ids in zip(aligner.sizes, self.ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        self.group = [np.searchsorted(cuts, e) for e in ends]
        self.members = [np.bincount(g, minlength=len(cuts)) for g in self.group]
        self.starts = [np.cumsum(m) - m for m in self.members]
        owner = np.repeat(np.arange(len(tokens)), self.counts[0])
        self.text = owner[self.starts[0]]  # of each group
        self.n_groups = np.bincount(self.text, minlength=len(tokens))
        links = self.members[0] * self.members[1]
        self.n_links = np.zeros(len(tokens), np.int64)
        np.add.at(self.n_links, self.text, links)
        self.most = int(links.max(initial=0))

    def digests(self) -> list[str]:
        """sha256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``; empty where there are none."""
        per_group = self.members[0] + self.members[1]
        begin = np.cumsum(per_group) - per_group
        order = np.empty(int(per_group.sum()), np.int64)
        for side in (0, 1):
            group, members = self.group[side], self.members[side]
            inner = np.arange(len(group)) - self.starts[side][group]
            at = begin[group] + inner + (self.members[0][group] if side else 0)
            last = inner == members[group] - 1
            order[at] = self.ids[side] + np.where(last, self.aligner.last[side], self.aligner.inside[side])
        out, stop = [], 0
        for n in self.counts.sum(axis=0).tolist():
            own = b"".join(map(self.aligner.decimal.__getitem__, order[stop : stop + n].tolist()))
            out.append(hashlib.sha256(own[:-1]).hexdigest() if n else "")
            stop += n
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text its distinct linked id pairs: the text's number, the pair's code, how often it is linked."""
        shift, width = self.aligner.shift, self.aligner.width
        group, ids, starts, members = self.group, self.ids, self.starts, self.members
        times = [np.ones(len(i), np.int64) for i in ids]
        if self.most > PLAIN:  # repeated ids of a group once, with their number
            group, ids = list(group), list(ids)
            for side in (0, 1):
                key, times[side] = _summed(group[side] << width | ids[side], times[side])
                group[side], ids[side] = key >> width, key & ((1 << width) - 1)
            members = [np.bincount(g, minlength=len(self.text)) for g in group]
            starts = [np.cumsum(m) - m for m in members]
        partners = members[1][group[0]]
        found, often = [], []
        for a, b in _slices(partners, EXPANDED):
            own = partners[a:b]
            left = np.repeat(np.arange(a, b), own)
            inner = np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
            right = starts[1][group[0][left]] + inner
            code = (ids[0][left] << shift) | ids[1][right]
            keys, sums = _summed(self.text[group[0][left]] << width | code, times[0][left] * times[1][right])
            found.append(keys)
            often.append(sums)
        if not found:
            return (np.zeros(0, np.int64),) * 3
        keys, sums = (found[0], often[0]) if len(found) == 1 else _summed(np.concatenate(found), np.concatenate(often))
        return keys >> width, keys & ((1 << width) - 1), sums


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(first: tuple[str, str], second: bytes) -> Aligner:
    """One per worker and pair of files."""
    name = hashlib.md5(first[0].encode() + first[1].encode() + second).hexdigest()
    if name not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[name] = Aligner(first, second)
    return _ALIGNERS[name]


def _int64(values: bytes) -> np.ndarray:
    return np.frombuffer(values, np.int64)


def _blocks(texts: DataFrame, sent) -> DataFrame:
    """Distinct texts ``text, copies`` to blocks with the measures of their texts and the pairs these hold."""

    def block(number: int, held: list[tuple]) -> tuple:
        found = _aligner(*sent.value).align([t for t, _ in held])
        text, code, often = found.pairs()
        unique, index = np.unique(code, return_inverse=True)
        copies = np.array([c for _, c in held], np.int64)
        weight = np.zeros(len(unique), np.int64)
        np.add.at(weight, index, copies[text])
        digests = [hashlib.sha256(t.encode()).digest() for t, _ in held]
        measures = np.stack([*found.counts, found.n_groups, found.n_links], axis=1)
        listed = [
            {"digest": d, "n_a": a, "n_b": b, "n_groups": g, "n_links": n, "groups_sha256": s}
            for d, (a, b, g, n), s in zip(digests, measures.tolist(), found.digests(), strict=True)
        ]
        per_text = np.bincount(text, minlength=len(held))
        return number, listed, blob(per_text), blob(index.astype(np.int64)), blob(often), blob(unique), blob(weight)

    def rows(found):
        number, held, weight = TaskContext.get().partitionId() << 32, [], 0
        for text, copies in found:
            held.append((text, copies))
            weight += len(text)
            if weight >= BLOCK // 2:  # characters; of other scripts two bytes or three each
                yield block(number, held)
                number, held, weight = number + 1, [], 0
        if held:
            yield block(number, held)

    measures = "digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    kinds = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in measures.split(", "))
    return arrow_rows(
        texts,
        rows,
        f"block long, texts array<struct<{kinds}>>, per_text binary, place binary, often binary, codes binary, weights binary",
    )


def _pair_rows(blocks: DataFrame, shift: int) -> DataFrame:
    """``block, a, b, weight``: the distinct pairs of every block with the number of documents that hold them there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes, weights = _int64(codes), _int64(weights)
                columns = [
                    np.full(len(codes), block, np.int64),
                    (codes >> shift).astype(np.int32),
                    (codes & ((1 << shift) - 1)).astype(np.int32),
                    weights,
                ]
                whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "a", "b", "weight"])
                for at in range(0, whole.num_rows, 50_000):
                    yield whole.slice(at, 50_000)

    return blocks.select("block", "codes", "weights").mapInArrow(run, "block long, a int, b int, weight long")


def align_documents(
    docs: DataFrame, first_file: str, pattern: str, second_file: str, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Measures of every row, and the id pairs of the two tokenizers with their numbers of documents.

    ``first_file`` is a byte-level tokenizer file (it encodes a space and the text), ``second_file`` a sentencepiece
    model (which adds the space). The first result has ``key, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` for every row, the second ``a, b, count, best``: in how many rows the ids are linked, and whether
    no other ``b`` is linked to ``a`` in more. A text is one, whatever its number of rows; rows with a null or repeated
    key count like others. Null and empty texts, and texts whose tokens do not give back a space and the text, have no
    tokens: zeros and an empty digest. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    with open(first_file, encoding="utf-8") as one, open(second_file, "rb") as two:
        sent = spark.sparkContext.broadcast(((one.read(), pattern), two.read()))
    shift = _aligner(*sent.value).shift
    rows_ = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = rows_.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    blocks = stage(_blocks(texts, sent), "aligned-blocks")
    asked = _pair_rows(blocks, shift)
    counts = asked.groupBy("a", "b").agg(F.sum("weight").alias("count"))
    counts = stage(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = asked.drop("weight").join(counts, ["a", "b"]).groupBy("block").agg(
        F.collect_list(F.struct("a", "b", "count", "best")).alias("known")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for row in range(batch.num_rows):
                known = columns["known"][row].values
                parts = [] if known is None else [known.field(n).to_numpy(zero_copy_only=False) for n in range(4)]
                texts_, per_text, place, often = (columns[c][row].as_py() for c in ("texts", "per_text", "place", "often"))
                out = {n: [t[n] for t in texts_] for n in ("digest", "n_a", "n_b", "n_groups", "n_links")}
                owner = np.repeat(np.arange(len(texts_)), _int64(per_text))
                n_best, count_sum = np.zeros(len(texts_), np.int64), np.zeros(len(texts_), np.int64)
                if parts:
                    order = np.argsort(parts[0].astype(np.int64) << shift | parts[1])
                    count, best = parts[2][order], parts[3][order]
                    place, often = _int64(place), _int64(often)
                    np.add.at(n_best, owner, often * best[place])
                    np.add.at(count_sum, owner, often * count[place])
                out |= {"n_best": n_best, "count_sum": count_sum, "groups_sha256": [t["groups_sha256"] for t in texts_]}
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))

    whole = blocks.select("block", "texts", "per_text", "place", "often").join(answers, "block", "left")
    schema = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    measured = whole.select("texts", "per_text", "place", "often", "known").mapInArrow(run, schema)
    measured = stage(measured, "aligned-texts")
    named = rows_.select("key", F.unhex(F.sha2("text", 256)).alias("digest")).join(measured, "digest", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in measured.columns[1:-1]]
    found = named.select(F.col("key").alias(key), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return found, counts


def brute_force(texts: list[str | None], first: ByteLevel, second: Pieces) -> list[tuple]:
    """The same measures from plain loops over whole texts: for tests."""
    linked: list[list[tuple[int, int]]] = []
    rows = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = first.library.encode(whole.decode(), add_special_tokens=False).ids if text else []
        b = second.model.encode(text) if text else []
        joined = [b"".join(side.bytes_of[i] for i in ids) for side, ids in ((first, a), (second, b))]
        groups, own_a, own_b, pairs, i, j = [], [], [], [], 0, 0
        if text and joined == [whole, whole]:
            end_a = end_b = 0
            while i < len(a) or j < len(b):
                if end_a <= end_b:
                    end_a += len(first.bytes_of[a[i]])
                    own_a.append(a[i])
                    i += 1
                else:
                    end_b += len(second.bytes_of[b[j]])
                    own_b.append(b[j])
                    j += 1
                if end_a == end_b:
                    groups.append((own_a, own_b))
                    pairs += [(x, y) for x in own_a for y in own_b]
                    own_a, own_b = [], []
        linked.append(pairs)
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((i, j, len(groups), len(pairs), hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    count: dict[tuple[int, int], int] = {}
    for pairs in linked:
        for p in set(pairs):
            count[p] = count.get(p, 0) + 1
    most: dict[int, int] = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return [
        (*row[:4], sum(count[p] == most[p[0]] for p in pairs), sum(count[p] for p in pairs), row[4])
        for row, pairs in zip(rows, linked, strict=True)
    ]
