"""Sketches of documents, hard negatives, and two tokenizers over one text."""

import random
import types

import numpy as np
import public_tokenizers
import pytest

from tramline.llm import alignment, negatives, sketches


def ordered(found):
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


# near duplicates


def test_near_duplicates_equal_brute_force(documents, corpus, rows):
    found = sketches.near_duplicates(documents(corpus, extra=True))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows(found) == ordered(sketches.brute_force(corpus))


def test_near_groups_that_hang_together_in_chains(documents, prose, rows, monkeypatch):
    monkeypatch.setattr(sketches, "CHUNK", 8)  # several chunks and cells
    monkeypatch.setattr(sketches, "TOKENS", 1 << 11)
    draw = random.Random(4)
    texts, own = [], prose(1, 100).split()
    for i in range(120):  # each a word or two from the one before or from the first
        base = own if i % 3 else texts[-1][1].split() if texts else own
        base = list(base)
        for _ in range(draw.randint(1, 3)):
            base[draw.randrange(len(base))] = f"w{draw.randint(0, 10**6)}"
        texts.append((1000 - i, " ".join(base)))
    texts += [(2000 + i, " ".join(own[:60] + prose(50 + i, 25).split())) for i in range(60)]  # a common passage
    found = sketches.near_duplicates(documents(texts))
    assert rows(found) == ordered(sketches.brute_force(texts))


def test_cells_leave_the_largest_component_among_itself_out(spark):
    keyed = spark.createDataFrame(
        [(7, i, 10, 1) for i in range(900)] + [(7, 1000 + i, 10, 1000 + i) for i in range(700)],
        "key long, sid long, n long, component long",
    )
    cells = sketches._in_cells(keyed).collect()
    met = {}
    for r in cells:
        met.setdefault(r.cell, ([], []))[r.side].append(r.sid)
    pairs = set()
    for left, right in met.values():
        pairs |= {frozenset((a, b)) for a in left for b in (right or left) if a != b}
    assert all(frozenset((1000 + i, j)) in pairs for i in range(0, 700, 50) for j in [*range(0, 900, 30), 1001 + i % 600])
    assert not any(max(p) < 900 for p in pairs)


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(1)
    shared = draw.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(shared), np.unique(np.r_[shared[:320], draw.integers(0, 2**63, 80).astype(np.uint64)]), shared[:1]]
    edges = np.cumsum([0, *map(len, sets)])
    found = sketches.sketches(np.concatenate(sets), edges)
    assert (found != sketches._OPEN).all()  # one shingle fills all coordinates as well
    agree = (found[0] == found[1]).mean()
    assert abs(agree - 320 / 480) < 0.15
    assert sketches.sketches(np.zeros(0, np.uint64), np.array([0, 0])).shape == (1, sketches.BINS)


def test_words_of_equal_polynomials_stay_apart(documents, rows):
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))  # equal under any polynomial modulo 2 ** 64
    found = rows(sketches.near_duplicates(documents([(1, one), (2, two), (3, one.upper())])))
    assert [r[2] for r in found] == [1, 2, 1]


def test_word_hashes_see_every_byte():
    data = np.frombuffer(b"abcdefgh abcdefghi abcdefghj abcdefgh " + b"x" * 70 + b" " + b"x" * 71, np.uint8)
    gaps = np.r_[np.flatnonzero(data == 32), len(data)]
    found = sketches.word_hashes(data, np.r_[0, gaps[:-1] + 1], gaps).tolist()
    assert found[0] == found[3] and len(set(found)) == 5


def test_overlaps_equal_intersections():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    found = sketches.overlaps(sets[:12], sets[12:], width=7)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def test_no_documents(documents, spark):
    assert sketches.near_duplicates(documents([])).count() == 0
    assert sketches.near_duplicates(documents([(1, None), (2, "")])).count() == 2


def test_keep_first_keeps_columns(documents, prose):
    docs = documents([(3, prose(1)), (2, prose(1)), (5, None)], extra=True)
    kept = sketches.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5] and set(kept.columns) == set(docs.columns)


# hard negatives


def vectors_of(seed: int, count: int, dim: int = 8, labels: int = 4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (labels, dim))
    out = []
    for i in range(count):
        label = int(draw.integers(0, labels))
        own = (centres[label] + draw.normal(0, 0.7, dim)) * draw.uniform(0.2, 2)
        out.append((i, label, own.astype(np.float32).astype(float).tolist()))
    return out


VECTORS = "vec_id long, label int, embedding array<float>"


def test_negatives_equal_brute_force(spark, rows):
    data = vectors_of(2, 400)
    data += [(1000 + i, *data[i][1:]) for i in range(60)]  # ties
    data += [(50 * 40 + i, 1, [0.0] * 8) for i in range(3)] + [(5000 + i, i % 3, [0.5] * 4) for i in range(9)]
    odd = [(600, None, [1.0] * 8), (650, 1, None), (700, 1, [None] + [1.0] * 7), (None, 2, [1.0] * 8)]
    odd += [(750, 1, [float("nan")] * 8), (800, 1, [float("inf")] * 8), (850, 1, [3e38] * 8), (900, 2, [])]
    odd += [(100, 0, data[7][2]), (100, 3, data[8][2])]  # a repeated key
    df = spark.createDataFrame(data + odd, VECTORS).selectExpr("*", "'x' AS key", "1 AS ints", "2 AS block").repartition(5)
    found = negatives.mine(df)
    expected = negatives.brute_force(data + odd)
    assert rows(found) == ordered(expected) and len(expected) > 60


def test_negatives_in_small_blocks_skip_rows_that_cannot_matter(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "GROUP", 3)
    monkeypatch.setattr(negatives, "RUN", 2)
    data = vectors_of(9, 300, labels=3)
    found = negatives.mine(spark.createDataFrame(data, VECTORS), every=10)
    assert rows(found) == ordered(negatives.brute_force(data, every=10))


def test_bounds_never_lose_a_product():
    draw = np.random.default_rng(5)
    ints = np.floor(draw.normal(0, 200, (500, 6)))
    ints[:20] = ints[20:40]
    norms = np.sqrt((ints**2).sum(axis=1))
    refs = negatives.directions([v.astype(int).tolist() for v in ints[:100]], 5)[6]
    angles = negatives.angles_to(refs, ints, norms)
    skipped = 0
    for i in range(60):
        own = ints @ ints[i]
        low, high = np.sort(draw.choice(own, 2))
        alive = negatives.reaches(low, high, angles[i], norms[i], angles, norms, np.arange(len(ints)))
        assert set(np.flatnonzero((own >= low) & (own <= high))) <= set(alive.tolist())
        skipped += len(ints) - len(alive)
    assert skipped > 1000


def test_windows_are_whole_numbers():
    for score in (0, 1, 7, 99, 100, 12345):
        a, b = negatives.window(score, 50, 95)
        inside = [n for n in range(score + 1) if 50 * score <= 100 * n <= 95 * score]
        assert inside == list(range(a, b + 1))


def test_no_vectors(spark):
    assert negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0
    assert negatives.mine(spark.createDataFrame([(50, 1, [1.0])], VECTORS)).count() == 0


# two tokenizers

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    with open(FILES[0], encoding="utf-8") as one, open(FILES[1], "rb") as two:
        return alignment.Aligner((one.read(), public_tokenizers.PATTERN), two.read())


ODD = [
    "hello <|endoftext|> world", "a▁b", "", None, " ", "\n", "é\x00x", "<s> </s> <unk> <0x41>", "日本語 it's ½",
    "  two  spaces ", "x" * 3000, "😀" * 50, "don't\r\n\tstop", "  z", "ab" * 500 + "漢字" * 300,
]


def aligned(docs):
    return alignment.align_documents(docs, FILES[0], public_tokenizers.PATTERN, FILES[1])


def test_alignment_equals_brute_force(documents, corpus, rows, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 4000)
    pairs = corpus + [(200 + i, t) for i, t in enumerate(ODD)] + [(300, ODD[0]), (300, ODD[0])]
    found, counts = aligned(documents(pairs, extra=True))
    expected = alignment.brute_force([t for _, t in pairs], *aligner.sides)
    assert rows(found) == ordered([(name, *own) for (name, _), own in zip(pairs, expected, strict=True)])
    assert counts.where("best").select("a").distinct().count() == counts.select("a").distinct().count()


def test_expansion_in_slices_and_of_large_groups(aligner, prose, monkeypatch):
    texts = [t for t in ODD if t] + [prose(i, 200) for i in range(6)]
    whole = [x.tolist() for x in aligner.align(texts).pairs()]
    monkeypatch.setattr(alignment, "EXPANDED", 7)
    assert [x.tolist() for x in aligner.align(texts).pairs()] == whole
    monkeypatch.setattr(alignment, "PLAIN", 1)
    assert [x.tolist() for x in aligner.align(texts).pairs()] == whole


def test_fast_ids_are_the_library_s(aligner):
    side = aligner.sides[0]
    assert side.fast is not None
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"ab{chr(c)}1 {chr(c)}x{chr(c)}?" for c in points[i : i + 50]) for i in range(0, 0x30000, 50)]
    texts += ["<|endoftext|>", "a" * 2000, " \n \t  x", "it's THEY'LL 'd"]
    assert side.encode(texts) == [e.ids for e in side.library.encode_batch(texts, add_special_tokens=False)]


def test_very_long_text_takes_the_library(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "LONG", 10)
    side = types.SimpleNamespace(fast=None, library=aligner.sides[0].library)
    assert alignment.ByteLevel.encode(side, ["a b c d e f g"]) == aligner.sides[0].encode(["a b c d e f g"])


def test_no_texts(documents, rows):
    found, counts = aligned(documents([(1, None), (2, "")]))
    assert rows(found) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")] and counts.count() == 0
    assert aligned(documents([]))[0].count() == 0
