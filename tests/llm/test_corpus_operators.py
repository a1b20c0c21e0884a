"""Operators that compare texts or vectors with each other."""

import random
import re
import types

import numpy as np
import pytest

from tramline.llm import names, paragraphs, signatures, suffixes, topk
from tramline.llm.components import connected_components


def ordered(found):
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_repeats_equal_brute_force(documents, corpus, rows):
    found = suffixes.digest(suffixes.remove_repeats(documents(corpus, extra=True)))
    assert rows(found) == ordered(suffixes.brute_force(corpus))


def test_repeats_in_periodic_and_overlapping_texts(documents, rows):
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("ab") for _ in range(n))
    part, texts = word(260), []
    texts.append((1, word(50) + part + word(30)))
    texts.append((2, part[:230] + word(100)))
    texts.append((3, word(100) + part[40:] + part[:215]))
    texts.append((4, "ab" * 300 + word(10)))
    texts.append((5, part[:199]))
    texts.append((6, part[30:230]))
    texts += [(7 + i, word(random.Random(i).randint(0, 900))) for i in range(20)]
    found = suffixes.digest(suffixes.remove_repeats(documents(texts)))
    assert rows(found) == ordered(suffixes.brute_force(texts))


def test_short_windows_stress(documents, rows):
    draw = random.Random(5)
    texts = [(i, "".join(draw.choice("abc") for _ in range(draw.randint(0, 60)))) for i in range(150)]
    found = suffixes.digest(suffixes.remove_repeats(documents(texts), length=8, core=5))
    assert rows(found) == ordered(suffixes.brute_force(texts, 8))


def test_texts_without_repeats_stay_whole(documents, prose):
    docs = documents([(1, "é" * 400), (2, prose(5)), (3, prose(5) + "é"), (4, None)])
    left = {r.doc_id: r for r in suffixes.without_repeats(docs).collect()}
    assert left[4].text == "" and all(r.n_chars == len(r.text) for r in left.values())
    assert left[1].text == "" and set(docs.columns) == set(left[1].asDict())


def test_sampled_suffixes_spread_over_the_shards(prose):
    texts = [prose(i, 400).encode() for i in range(40)]
    state = suffixes.BlockState(b"".join(texts), np.array([len(t) for t in texts]), {}, 24, (200, 150))
    sizes = np.diff(state.level.edges)
    assert sizes.sum() > 1000 and sizes.max() < 2 * sizes.mean()


def test_disk_queue_merges_runs():
    draw = np.random.default_rng(2)
    queue = names.DiskQueue(held=50)
    every, serial = [], 0
    for _ in range(12):
        own = names.pairs(draw.integers(0, 40, 30).astype(np.uint64), draw.integers(0, 3, 30).astype(np.uint64))
        queue.push(own, 5, serial)
        serial += len(own)
        every += own.tolist()
    found = [(int(t["a"]), int(t["b"])) for part in queue.pop_all(block=7) for t in part]
    queue.close()
    assert found == sorted(every)


def test_blocks_of_a_task_ask_a_shard_in_one_row():
    draw = np.random.default_rng(4)
    blocks = {}
    for number in (7, 3, 9, 12):
        own = names.pairs(*(draw.integers(0, most, 60 * (number != 9)).astype(np.uint64) << np.uint64(58) for most in (60, 2)))
        blocks[number] = names.Level(own, 8), own.tolist()
    every = [name for _, own in blocks.values() for name in own]
    held = [(n, names.blob(own.unique), names.blob(own.local), own.edges) for n, (own, _) in blocks.items()]
    sent = sorted(names._together(held), key=lambda r: r[0])
    assert len({r[0] for r in sent}) == len(sent) <= 8  # a row a shard, not one for each of a shard's blocks
    answers = [a for shard in sent for a in names._answer(iter([shard]), 5)]
    given = dict(names._parted(answers))
    assert list(given) == list(blocks)
    for number, (level, own) in blocks.items():
        found = level.answers(given[number])
        assert [bool(f & names.REPEATED) for f in found.tolist()] == [every.count(name) > 1 for name in own]


def test_similar_sets_equal_brute_force(documents, corpus, rows):
    found = signatures.similar_sets(documents(corpus, extra=True))
    assert rows(found) == ordered(signatures.brute_force(corpus))


def test_words_of_equal_polynomials_stay_apart(documents, rows):
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))  # equal under any polynomial modulo 2 ** 64
    pairs = [(1, f"{one} x y z w"), (2, f"{two} x y z w"), (3, f"{one.upper()} x\ty z w")]
    assert rows(signatures.similar_sets(documents(pairs))) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]
    found = rows(paragraphs.digest(paragraphs.remove_paragraphs(documents(pairs))))
    assert [r[4] for r in found] == [0, 0, 1]


def test_similar_sets_at_the_threshold(documents, rows):
    def text(tokens):
        return " ".join(f"w{t}" for t in tokens)

    pairs = []
    for k in range(30):  # lengths around the threshold, ends cut off
        pairs.append((100 + k, text(range(40 - k))))
    for k in range(12):
        pairs.append((200 + k, text([*range(1000, 1040), *range(2000 + 50 * k, 2000 + 50 * k + k)])))
    assert rows(signatures.similar_sets(documents(pairs))) == ordered(signatures.brute_force(pairs))


@pytest.mark.parametrize("chunks", [32, 0])
def test_links_between_components(documents, rows, monkeypatch, chunks):
    """With small chunks the groups leave links out; clusters in cells, or groups by shingle, find them."""
    monkeypatch.setattr(signatures, "PASSES", 1)
    monkeypatch.setattr(signatures, "CHUNK", 3)
    monkeypatch.setattr(signatures, "CHUNKS", chunks)
    draw = random.Random(8)
    base = [[draw.randint(0, 9999) for _ in range(60)] for _ in range(6)]
    pairs = []
    for i in range(120):
        own = list(base[i % 6])
        for _ in range(draw.randint(0, 2)):
            own[draw.randrange(60)] = draw.randint(0, 9999)
        pairs.append((i, " ".join(map(str, own))))
    assert rows(signatures.similar_sets(documents(pairs))) == ordered(signatures.brute_force(pairs))


def test_one_of_each_group_stays(documents, corpus):
    kept = signatures.keep_one(documents(corpus)).collect()
    groups = {c for _, n, c in signatures.brute_force(corpus) if n}
    empty = sum(n == 0 for _, n, _ in signatures.brute_force(corpus))
    assert len(kept) == len(groups) + empty
    assert {r.doc_id for r in kept if r.text and r.text.strip()} == groups


def test_a_blocks_texts_are_shingled_in_one_pass(monkeypatch, prose):
    """The work of a block's texts is shared, words of neighbouring texts never meet, and sets are those of each text alone."""
    passes, whole = [], signatures.shingle_sets
    monkeypatch.setattr(signatures, "shingle_sets", lambda *a: passes.append(a) or whole(*a))
    texts = ["", "a b c d e", "f", "A\tb  c\nd e\x0b", " ", "a b c d e f", "a b", "ab", "", "é " * 9, prose(1), prose(1).upper(), ""]
    texts += [f"{'x' * 300} b c d e", f"{'x' * 301} b c d e", "a b c d e f a b c d e f", "a\x1cb c\u00a0d"]
    data = [t.encode() for t in texts]
    block = signatures._Shingled(b"".join(data), np.array([len(d) for d in data]), {}, 8)
    assert len(passes) == 1
    plain = [n for _, n, _ in signatures.brute_force(list(enumerate(texts)))]
    assert [len(s) for s in block.sets] == plain
    alone = [signatures.shingles(d, np.array([len(d)]))[0] for d in data]
    assert all(np.array_equal(x, y) for x, y in zip(block.sets, alone, strict=True))
    assert block.keys[1] == block.keys[3] != block.keys[5] and block.keys[6] != block.keys[7]
    assert not signatures.linked(block.sets[13], block.sets[14]) and signatures.linked(block.sets[1], block.sets[3])


def test_bound_never_prunes_a_link():
    draw = np.random.default_rng(4)
    for _ in range(200):
        x = np.unique(draw.integers(0, 1 << 62, 60).astype(np.uint64))
        y = np.unique(np.r_[draw.choice(x, 54, replace=False), draw.integers(0, 1 << 62, 5).astype(np.uint64)])
        trees = [signatures.SignatureTree([s]) for s in (x, y)]
        if signatures.linked(x, y):
            assert list(trees[0].join(signatures.Forest(2), trees[1], 1)) == [(0, 1)]


def test_paragraphs_keep_the_first_of_each_class(documents, prose):
    one, two, other = (re.sub(r"[.,\s]+", " ", prose(i, 60)).strip() for i in (1, 2, 9))
    near = one.replace(one.split()[30], "zz")
    pairs = [(1, f"{one}\nshort"), (2, f"head\n{near}\n{two}"), (3, one), (4, f"{two}\n{two}"), (5, None), (6, ""), (7, "short")]
    pairs += [(8, other)]
    found = {r.doc_id: r for r in paragraphs.remove_paragraphs(documents(pairs, extra=True)).collect()}
    assert [found[i].n_repeated for i in range(1, 9)] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert found[1].n_removed == 0 and found[3].n_removed > 1 and found[8].n_removed == 0
    assert bytes(found[3].kept) == b"" and bytes(found[4].kept) == b"" and bytes(found[1].kept).decode() == f"{one}\nshort"


def test_large_paragraph_groups_meet_cell_by_cell(documents, prose, monkeypatch):
    monkeypatch.setattr(paragraphs, "CHUNK", 4)
    words = [f"w{i}" for i in range(16)]
    pairs = []
    for i in range(30):
        own = list(words)
        own[15] = f"x{i}"
        pairs.append((i, " ".join(own)))
    found = paragraphs.remove_paragraphs(documents(pairs)).collect()
    assert sorted(r.doc_id for r in found if r.n_removed == 0) == [0]


def plain_pieces(text):
    """Pieces of a text as (begin, stop, words), by the rule alone."""
    def rank(word):
        data = np.frombuffer(word, np.uint8)
        name = names.Fingerprints(data, 0).of(np.array([0]), np.array([len(data)]))
        return int(names.mix(name ^ paragraphs._SEEDS[-1])[0])

    sentences, at = [], 0
    for line in (text or "").encode().split(b"\n"):
        own = []
        for m in re.finditer(rb"[^\x20\x09-\x0d]+", line):
            own.append((at + m.start(), at + m.end(), m.group().lower()))
            if m.group()[-1:] in b".!?":
                sentences.append(own)
                own = []
        sentences.append(own)
        at += len(line) + 1
    out = []
    for own in sentences:
        cuts, ranks = [], [rank(w) for _, _, w in own]
        for i in range(4, len(own) - 5):
            if len(own) > 16 and ranks[i] < min(ranks[i - 4 : i]) and ranks[i] <= min(ranks[i + 1 : i + 5]):
                cuts.append(i + 1)
        for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True):
            if b - a >= 5:
                out.append((own[a][0], own[b - 1][1], [w for _, _, w in own[a:b]]))
    return out


def met(draw, groups, most):
    """Rows of cells: sets around a common core, some of two sides."""
    found = []
    for group in range(groups):
        core = draw.integers(0, 1 << 62, draw.integers(3, 30)).astype(np.uint64)
        two = draw.random() < 0.3
        for _ in range(draw.integers(2, most)):
            own = core[draw.random(len(core)) < draw.choice([0.5, 0.9, 1])]
            own = np.unique(np.r_[core[:3], own, draw.integers(0, 1 << 62, draw.integers(0, 4)).astype(np.uint64)])
            found.append((group, 0, int(draw.integers(0, 2)) if two else 0, b"%d" % len(found), own.tobytes()))
    return sorted(found, key=lambda r: r[:3])


@pytest.mark.parametrize("step", [1, 40, 1 << 20])
def test_met_paragraphs_equal_all_pairs(monkeypatch, step):
    draw = np.random.default_rng(6)
    monkeypatch.setattr(paragraphs, "TOGETHER", step)
    monkeypatch.setattr(paragraphs, "PAIRS", step)
    for _ in range(20):
        cells = met(draw, 4, 40)
        number, sets = {r[3]: i for i, r in enumerate(cells)}, [np.frombuffer(r[4], np.uint64) for r in cells]
        forest, found = signatures.Forest(len(cells)), signatures.Forest(len(cells))
        two = {r[0] for r in cells if r[2]}
        for i, x in enumerate(cells):
            for j, y in enumerate(cells[:i]):
                if x[0] == y[0] and (x[2] != y[2] or x[0] not in two) and signatures.linked(sets[i], sets[j]):
                    forest.join(i, j)
        for a, b in paragraphs.near_links(iter(cells)):
            assert signatures.linked(sets[number[a]], sets[number[b]])
            found.join(number[a], number[b])
        assert [forest.root(i) for i in range(len(cells))] == [found.root(i) for i in range(len(cells))]


def test_paragraphs_with_common_shingles_alone_are_not_compared(monkeypatch):
    draw = np.random.default_rng(7)
    common = draw.integers(0, 1 << 62, 5)
    cells = [(1, 0, 0, b"%d" % i, np.sort(np.r_[common, draw.integers(0, 1 << 62, 7)]).tobytes()) for i in range(500)]
    cells.append((*cells[0][:3], b"near", cells[0][4][:-8]))
    compared, linked = [], paragraphs._Met._linked
    monkeypatch.setattr(paragraphs._Met, "_linked", lambda self, a, b: (compared.append(len(a)), linked(self, a, b))[1])
    assert list(paragraphs.near_links(iter(cells))) == [(b"0", b"near")]
    assert sum(compared) < 10  # of 125,250 pairs


def test_crowded_bands_meet_by_rare_shingles(spark, monkeypatch):
    draw = np.random.default_rng(8)
    monkeypatch.setattr(paragraphs, "CHUNK", 16)
    common = draw.integers(0, 1 << 62, 5)
    sets = [np.r_[common, draw.integers(0, 1 << 62, 7)] for _ in range(300)]
    near = [s[:-1] for s in sets[:40]]  # links across all chunks
    rows = [(b"%d" % i, [5, 6], np.sort(s).tobytes()) for i, s in enumerate([*sets, *near])]
    table = spark.createDataFrame(rows, "id binary, keys array<long>, tokens binary")
    cells, seen = [], paragraphs.in_cells
    monkeypatch.setattr(paragraphs, "in_cells", lambda *a: (cells.append(seen(*a)), cells[-1])[1])
    links = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in paragraphs._verified_links(table, 4).collect()}
    assert links == {tuple(sorted((b"%d" % i, b"%d" % (300 + i)))) for i in range(40)}
    assert sum(c.count() for c in cells) < 1000  # two bands of 340 in 22 chunks each were 14,960 rows


def plain_paragraphs(pairs):
    """Rows of ``remove_paragraphs`` by comparing all pieces with all."""
    found = [(key, place, *p) for key, text in pairs for place, p in enumerate(plain_pieces(text))]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for *_, w in found]
    forest = signatures.Forest(len(sets))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 75 * len(x | y):
                forest.join(i, j)
    roots = [forest.root(i) for i in range(len(sets))]
    expected, gone = [], 0
    for key, text in pairs:
        data = (text or "").encode()
        own = [i for i, f in enumerate(found) if f[0] == key and roots.count(roots[i]) > 1]
        goes = [i for i in own if roots[i] in roots[:i]]
        runs = []
        for i in own:
            if runs and found[runs[-1][-1]][1] + 1 == found[i][1]:
                runs[-1].append(i)
            else:
                runs.append([i])
        long = [r for r in runs if len(data[found[r[0]][2] : found[r[-1]][3]].split()) >= 30]
        marked = bytearray(data)
        for i in goes:
            stop = found[i][3]
            while stop < len(data) and data[stop : stop + 1].isspace() and data[stop] != 10:
                stop += 1
            marked[found[i][2] : stop] = b"\x00" * (stop - found[i][2])
        lines = [line.replace(b"\x00", b"") for line in marked.split(b"\n") if b"\x00" not in line or line.replace(b"\x00", b"").strip()]
        n = sum(bool(x.strip()) for x in data.split(b"\n"))
        expected.append((key, n, len(long), sum(map(len, runs)) - sum(map(len, long)), len(goes), bytearray(b"\n".join(lines))))
        gone += len(goes)
    return expected, gone


def test_short_paragraphs_equal_brute_force(documents, prose, rows):
    """Lines of 1 to 24 words: copies, and near copies on both sides of the threshold."""
    lines = []
    for n in range(1, 25):
        words = (prose(200 + n, 80).replace("\n", " ").split() * 2)[:n]
        lines += [" ".join(words)] * 2 + [" ".join(words).title(), " ".join([*words[:-1], "zz"]), " ".join(["zz", *words[1:-1], "yy"])]
    lines += ["a b c d e"] * 5
    random.Random(3).shuffle(lines)
    pairs = [(i, "\n".join(lines[i::9])) for i in range(9)]
    expected, gone = plain_paragraphs(pairs)
    assert gone > 35
    assert rows(paragraphs.remove_paragraphs(documents(pairs))) == ordered(expected)


def test_passages_inside_longer_lines_equal_brute_force(documents, rows):
    """A passage of 60 words, with sentences and without, at any place of a line, and broken over lines elsewhere."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    plain = [word() for _ in range(60)]
    ended = [w + "." if i % 13 == 12 else w for i, w in enumerate(plain[::-1])]
    pairs = []
    for i in range(12):
        passage = [plain, ended][i % 2]
        inner = [w + ("\n" if i == 4 + j % 7 and j % 20 == 5 else " ") for j, w in enumerate(passage)] if i in (4, 5) else [w + " " for w in passage]
        before, after = ([word() for _ in range(draw.randint(3, 30))] for _ in "ab")
        pairs.append((i, " ".join(before) + " " + "".join(inner) + " ".join(after) + "  \n a b! a b c d e f. x"))
    pairs += [(20 + i, " ".join(word() for _ in range(120))) for i in range(5)]
    expected, gone = plain_paragraphs(pairs)
    assert gone > 20
    found = rows(paragraphs.remove_paragraphs(documents(pairs)))
    assert found == ordered(expected)
    assert [r[2] for r in sorted(expected)] == [1] * 12 + [0] * 5


def test_paragraphs_of_null_and_repeated_keys(spark, prose):
    one = prose(1, 60)
    table = spark.createDataFrame([(None, one, "x"), (3, one, "y"), (3, one, None), (4, None, "z"), (5, "\n \n", "z"), (6, ". ! ?", "b")], "doc_id long, text string, block string")
    found = paragraphs.remove_paragraphs(table).collect()
    assert sorted((str(r.doc_id), r.n_removed > 0) for r in found) == [("3", False), ("3", True), ("4", False), ("5", False), ("6", False), ("None", True)]
    assert paragraphs.remove_paragraphs(table).columns == ["doc_id", "n_paragraphs", "n_repeated", "n_short", "n_removed", "kept"]


def test_empty_tables(documents, spark):
    none = documents([])
    assert suffixes.remove_repeats(none).count() == 0
    assert signatures.similar_sets(none).count() == 0
    assert signatures.keep_one(none).count() == 0
    assert paragraphs.remove_paragraphs(none).count() == 0
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i != 20] + [(100, 100), (None, 3), (7, 5)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 if i <= 20 else 21 for i in range(41)}


@pytest.mark.parametrize("group", [8192, 3])
def test_top_k_equals_all_products(spark, group):
    draw = np.random.default_rng(6)
    vectors = [(i, (draw.normal(size=8) * draw.choice([0.1, 1, 4])).astype(float).tolist()) for i in range(400)]
    vectors += [(1000, vectors[0][1]), (1050, vectors[0][1]), (1100, [0.0] * 8), (1150, [1.0] * 5), (1200, [])]
    odd = [(2000, None), (2050, [1.0] * 7 + [None]), (2100, [1.0] * 7 + [float("nan")]), (2150, [float("inf")] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").repartition(3)
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in vectors}
    expected = []
    for q in (i for i in ints if i % 50 == 0):
        near = [(-int(ints[q] @ v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q])]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(near)[:5], 1)]
    assert sorted(map(tuple, topk.search(table, group=group).collect())) == sorted(expected)


def best_of_keys(vectors, query, k):
    """Every other key once with its best score: higher scores, then smaller keys."""
    asked, best = next(v for i, v in vectors if i == query), {}
    for i, v in vectors:
        if i != query:
            best[i] = max(best.get(i, -(1 << 62)), int(asked @ v))
    return sorted(((i, s) for i, s in best.items()), key=lambda x: (-x[1], x[0]))[:k]


def test_top_k_of_keys_repeated_in_several_buckets(spark):
    draw = np.random.default_rng(7)
    vectors = [(0, np.ones(8)), *((i, draw.normal(size=8) + 0.5) for i in range(1, 200))]
    vectors += [(7, np.ones(8) * 2.0**n) for n in range(6)] + [(9, np.ones(8) * 3)] * 6
    rows = [(i, v.tolist()) for i, v in vectors]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    found = sorted(map(tuple, topk.search(table, every=1000).collect()))
    expected = best_of_keys([(i, np.floor(256 * v).astype(int)) for i, v in vectors], 0, 5)
    assert found == [(0, r, i, s) for r, (i, s) in enumerate(expected, 1)]


def test_top_k_queries_in_groups_of_few_bytes(spark, monkeypatch):
    draw = np.random.default_rng(9)
    table = spark.createDataFrame([(i, draw.normal(size=8).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    table = table.union(table.where("vec_id = 50"))  # a query that stands twice
    whole = sorted(map(tuple, topk.search(table).collect()))
    monkeypatch.setattr(topk, "GROUP_BYTES", 128)
    assert sorted(map(tuple, topk.search(table).collect())) == whole and len(whole) == 6 * 5
    assert topk.search(table.limit(0)).count() == 0


def test_top_k_of_keys_repeated_in_several_batches():
    draw = np.random.default_rng(8)
    query = np.array([256, 256, 256])
    vectors = [(0, query), *((i, draw.integers(-99, 100, 3)) for i in range(1, 3 * 8192))]
    for at in (5, 8192 + 5, 2 * 8192 + 5):  # the same row in each batch, far above the others
        vectors[at] = (5, np.array([900, 900, 900]))
    rows = [(i, 3, float(np.sqrt(v @ v)), 0, v.astype("<i8").tobytes()) for i, v in vectors]
    sent = types.SimpleNamespace(value=({0: query.astype(float)}, {0: -np.inf}))
    found = sorted((i, s) for _, i, s in topk._scan(sent, 3)(iter(rows)))
    assert found == sorted(best_of_keys(vectors, 0, 3))
