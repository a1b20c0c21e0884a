"""Operators that look at one text at a time."""

import base64
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F

from tramline.llm import bpe, decontaminate, pages, quality, repair, separators

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_tiktoken_and_decode_to_the_text(spark, documents, corpus, tiktoken_encoding, rows):
    expected = []
    for key, text in corpus:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        joined = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((key, len(ids), joined, hashlib.sha256((text or "").encode()).hexdigest()))
    found = bpe.encode_round_trip(documents(corpus, extra=True), RANKS, P.PATTERN)
    assert rows(found) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_long_texts_are_split_in_portions(tiktoken_encoding, monkeypatch, prose):
    monkeypatch.setattr(bpe, "LONG", 100)
    monkeypatch.setattr(bpe, "PORTION", 7)
    codec = bpe.ByteBpe(bpe.serialise_model(bpe.read_ranks(RANKS)), P.PATTERN)
    text = prose(1) + "  \n\n  it's 123 " + prose(2)
    assert " ".join(codec.encode(text)) == " ".join(map(str, tiktoken_encoding.encode_ordinary(text)))


def test_latin_pattern_splits_like_the_pattern():
    import re

    narrow, wide = re.compile(bpe.latin_pattern(P.PATTERN)), regex.compile(P.PATTERN)
    for i in range(bpe.LATIN):
        text = f"a{chr(i)}1 {chr(i)}{chr(i)}'s {chr(i)}\n  z{chr(i)}"
        assert narrow.findall(text) == wide.findall(text)


def test_empty_tables(spark, documents):
    none = documents([])
    items = spark.createDataFrame([], "item_id long, text string")
    assert bpe.encode_round_trip(none, RANKS, P.PATTERN).count() == 0
    assert decontaminate.scan_documents(none, items).count() == 0
    parts, first = repair.write_token_file(none, WORDS)
    assert repair.read_documents(parts, first).count() == 0
    assert separators.document_counts(none, WORDS, 49407).count() == 0
    model = quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert quality.score(none, model).count() == 0
    field = pages.fit(spark.createDataFrame([], "page_id long, url string, html string"))
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string"), field).count() == 0


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away, then comes back home again."),
    (2, "short item"),
    (3, "!!! ..."),
    (4, None),
    (10, "Short ITEM"),
    (None, "an item without id"),
    (10, "an item whose id stands twice"),
]


def test_decontamination_equals_brute_force(spark, documents, corpus, rows):
    pairs = corpus + [
        (70, "x " + ITEMS[0][1].upper() + " y"),
        (71, "jumps over the lazy dog and runs far away, then comes back home"),
        (73, "an item without id, and an item whose id stands twice, short item"),
        (72, "a short--item, and shortitem " + "pad " * 50),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for most in (200_000, 2):  # all windows in one automaton, and in several
        found = decontaminate.digest(decontaminate.scan_documents(documents(pairs, extra=True), items, most=most))
        expected = decontaminate.brute_force(pairs, ITEMS)
        assert rows(found) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    kept = decontaminate.clean_documents(documents(pairs), items)
    clean = [r for r in decontaminate.brute_force(pairs, ITEMS) if not r[5]]
    assert kept.count() == len(clean) and kept.columns == documents([]).columns


def test_automata_are_cut_by_bytes_too(spark, documents, rows, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    pairs = [(1, ITEMS[0][1]), (2, "short item"), (3, None)]
    monkeypatch.setattr(decontaminate, "WINDOW_BYTES", 100)
    blocks = list(decontaminate._in_blocks(items, 13, "item_id", "text", 1000))
    assert len(blocks) > 2 and all(sum(len(w) for _, w in b[:-1]) < 100 for b in blocks)
    found = decontaminate.digest(decontaminate.scan_documents(documents(pairs), items))
    assert rows(found) == decontaminate.brute_force(pairs, ITEMS)


def test_spans_lead_back_to_the_original_bytes(spark, documents):
    text = "é Über — THE Short  item!"
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = decontaminate.scan_documents(documents([(1, text)]), items).first()
    (start, stop), = row.spans
    assert text.encode()[start:stop].decode() == "Short  item"


def test_quality_separates_and_ignores_held_out_labels(spark, documents, prose):
    good = [(i, prose(i, 80)) for i in range(150)]
    bad = [(i + 1000, "!!! ".join(prose(i, 80).upper().split()) + " $$$") for i in range(150)]
    odd = [(5000, None), (5001, ""), (None, prose(3))]
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(1, 1), (None, 0), (7, None), (99999, 1)]
    docs = documents(good + bad + odd, extra=True)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs, known, F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held = [i for i, _ in good + bad if i % 5 == 0]
    right = sum(found[i].predicted == (i < 1000) for i in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == 303
    # the labels of held-out rows change nothing
    flipped = [(i, 1 - q if i is not None and q is not None and i % 5 == 0 else q) for i, q in labels]
    again = quality.fit(docs, spark.createDataFrame(flipped, "doc_id long, quality int"), F.col("doc_id") % 5 != 0)
    assert again == model


def test_pages_keep_the_article_alone(spark):
    def page(text, kind):
        around = f'<nav><a href="/">{text[:9]}</a></nav><div class="ad">Buy {text[:20]}</div>'
        end = f'<form><p>{text[:30]}</p><input></form><section class="comments"><p>{text[::-1]}</p></section><footer>&copy; us</footer>'
        return f"<html><head><title>t</title><script>var a='</p>';</script></head><body>{around}<{kind}><h1>Title</h1><p>{text} &amp; <b>more</b>\n text.<p>Second &eacute;</{kind.split()[0]}>{end}</body></html>"

    texts = [f"Some sentences of page {i}, which say this and that. They go on for a while, and end." for i in range(60)]
    table = spark.createDataFrame(
        [(i, "u", page(t, "article")) for i, t in enumerate(texts)]
        + [(100, "u", None), (101, "u", ""), (102, None, "<p>open"), (103, "u", page(texts[0], 'div class="content"'))],
        "page_id long, url string, html string",
    )
    field = pages.fit(table, sample=50)
    found = {r.page_id: r for r in pages.extract(table, field).collect()}
    for i, t in [*enumerate(texts), (103, texts[0])]:
        assert found[i].text == f"Title\n{t} & more text.\nSecond é", i
        assert found[i].n_chars == len(found[i].text)
    assert found[100].text == found[101].text == "" and len(found) == 64


def test_blocks_survive_broken_markup():
    for text in ("<", "<p", "<p class='x", "<!-- open", "<script>never", "</div></div>x", "<li>a<li>b", "a<br>b", "<a" * 500):
        assert [b.text for b in pages.blocks(text)] is not None
    assert [b.text for b in pages.blocks("<ul><li>a<li>b&nbsp;c</ul>x<br>y<p>&lt;p&gt;")] == ["a", "b c", "x y", "<p>"]


def library_ids(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORDS)
    own.encode_special_tokens = True
    return [e.ids for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_hold_the_librarys_ids_in_order(documents, corpus, rows):
    ordered = sorted(corpus, key=lambda d: (d[0] is not None, d[0] or 0))
    expected, start = [], 0
    for (key, _), ids in zip(ordered, library_ids(t for _, t in ordered), strict=True):
        own = np.array([*ids, 1], "<u4")
        expected.append((key, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    parts, first = repair.write_token_file(documents(corpus, extra=True), WORDS)
    assert rows(repair.read_documents(parts, first)) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    counted = separators.document_counts(documents(corpus, extra=True), WORDS, 49407)
    assert rows(counted, "doc_id", "n_tokens") == sorted(
        ((k, n - 1) for k, _, n, _ in expected), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


SPECIAL = [
    "hello <|endoftext|> world", "a<|startoftext|>b <|ENDOFTEXT|> <|EndOfText|>c", "<|endoftext|>", "it's 2024-05-11, don't!! x--'s",
    "'s 'LL '!' \"quoted,\" a.b/c?d=1&e=%20 --'re", "ÀÉ ﬁne İstanbul Σας 漢字かな ½ e\u0301", "ab\x00c d\x1fe f\x85g h\xa0i", "", "<| endoftext |>",
]


def test_special_strings_are_the_librarys(documents, rows):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORDS)
    expected, start = [], 0
    for key, text in enumerate(SPECIAL):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert any(49406 in own.encode(t, add_special_tokens=False).ids for t in SPECIAL)
    parts, first = repair.write_token_file(documents(enumerate(SPECIAL)), WORDS)
    assert rows(repair.read_documents(parts, first)) == sorted(expected, key=lambda r: tuple(map(str, r)))
    plain = library_ids(SPECIAL)  # the separator scan keeps them plain: its end id is one of them
    counted = separators.document_counts(documents(enumerate(SPECIAL)), WORDS, 49407)
    assert rows(counted, "doc_id", "n_tokens") == [(i, len(ids)) for i, ids in enumerate(plain)]


def test_words_equal_the_library_after_the_cache_turned(corpus, monkeypatch):
    from tramline.llm import wordids

    monkeypatch.setattr(wordids, "CACHE", 40)
    monkeypatch.setattr(wordids, "TOGETHER", 300)
    texts = [t for _, t in corpus if t] + SPECIAL
    with open(WORDS, encoding="utf-8") as file:
        words = wordids.WordIds(file.read())
    found = [np.frombuffer(ids, words.dtype).tolist() for _, ids in words.encode_all((i, t) for i, t in enumerate(texts))]
    assert words.by_word and words.split and found == library_ids(texts)


def test_words_told_apart_by_a_mark_equal_the_library(prose):
    from tramline.llm import wordids

    with open(WORDS, encoding="utf-8") as file:
        own = wordids.WordIds(file.read())
    assert all(mark is not None for _, mark in own.marks.values())
    texts = ["a\x00b \x00 \x00\x00c", "Ā ā Āx", "e\u0301 \u0301 x\u0301\u0301y", "don't it's''s 12a", prose(3, 600), "日本 ½x"]
    found = [ids for _, ids in own.encode_all((i, t) for i, t in enumerate(texts))]
    assert found == own.library_ids(texts)


def test_words_are_cut_into_what_the_library_keeps_apart(monkeypatch):
    from tramline.llm import wordids

    texts = ["Tion, tion. (tion) naïve, Naïve; тест! it's 12", "", None, "tion,tion\n12 no×w Éa é", " "]
    texts += ["İs ŉa ſ; ĸ", "a\u0323\u0301b e\u0301, é÷", "x\x00y\x1fz \x85a", "σας, Σ"]
    with open(WORDS, encoding="utf-8") as file:
        own = wordids.WordIds(file.read())
    asked, learn = [], own.learn
    monkeypatch.setattr(own, "learn", lambda words: (asked.extend(words), learn(words)))
    found = [np.frombuffer(ids, own.dtype).tolist() for _, ids in own.encode_all((i, t) for i, t in enumerate(texts))]
    assert found == library_ids(texts)
    assert asked.count(b"tion") == 1 and asked.count("naïve".encode()) == 1 and "тест".encode() in asked
    assert b"it's" in asked and "no×w".encode() in asked and not any(w.startswith(b"tion") and len(w) > 4 for w in asked)


@pytest.mark.parametrize(("cut", "together"), [(1, 1), (7, 40), (40, 7), (1000, 1000)])
def test_words_cut_in_passes_equal_the_library(monkeypatch, prose, cut, together):
    from tramline.llm import wordids

    monkeypatch.setattr(wordids, "CUT", cut)
    monkeypatch.setattr(wordids, "TOGETHER", together)
    texts = [*SPECIAL, None, "", "", prose(4, 30), " \n ", prose(4, 30)] * 2
    for special in (False, True):
        with open(WORDS, encoding="utf-8") as file:
            own = wordids.WordIds(file.read(), special)
        found = [(k, np.frombuffer(ids, own.dtype).tolist()) for (k,), ids in own.encode_all(enumerate(texts))]
        plain = own.whole if special else own.library
        assert found == [(k, plain.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)]


def test_pairs_that_share_a_slot_are_told_apart(monkeypatch):
    draw = np.random.default_rng(3)
    monkeypatch.setattr(repair, "SLOTS", 8)
    for _ in range(50):
        pairs = draw.integers(0, 30, 200).astype(np.uint64)
        slot = (pairs % np.uint64(8)).astype(np.uint32)
        kept = slot != 3
        found = repair._counted(pairs[kept], slot[kept], np.delete(np.arange(8), 3))
        expected = np.unique(pairs[kept], return_inverse=True, return_counts=True)
        assert all(np.array_equal(x, y) for x, y in zip(found, expected, strict=True))


def test_grammar_round_trip_and_random_access():
    draw = np.random.default_rng(0)
    ids = np.concatenate([draw.integers(0, 50, 3000), np.tile([1, 2, 3, 3, 3], 900), np.full(700, 9)]).astype(np.uint16)
    ends = np.array([0, 10, 10, 3000, 6000, len(ids)])
    seq, cut, rules = repair.compress(ids, ends, 100, least=8)
    assert len(rules) and len(seq) < len(ids)
    grammar = repair.Grammar(rules, repair.expansion_lengths(rules, 100), 100)
    assert (grammar.decode(seq) == ids).all()
    begin = np.r_[0, cut[:-1]]
    for a, b, c, d in zip(begin, cut, np.r_[0, ends[:-1]], ends, strict=True):
        assert (grammar.decode(seq[a:b]) == ids[c:d]).all()
        if d - c > 20:
            assert (grammar.tokens(seq[a:b], 7, 15) == ids[c + 7 : c + 15]).all()


def apart(seq, ends):
    """Pairs of neighbours in a document, each with its places that do not overlap."""
    found, cut = {}, set(ends)
    for i in range(len(seq) - 1):
        places = found.setdefault((seq[i], seq[i + 1]), [])
        if i + 1 not in cut and (not places or places[-1] < i - (seq[i] == seq[i + 1])):
            places.append(i)
    return {pair: len(places) for pair, places in found.items()}


@pytest.mark.parametrize("wide", [False, True])
def test_no_pair_is_left_that_stands_twice(monkeypatch, wide):
    draw = np.random.default_rng(5)
    first = 1 << 31 if wide else 60_000  # of the wide ones, a pair and its place do not fit in 64 bits
    copies = np.tile(draw.integers(0, 200, 500), 3)
    cases = [[], [7], [9, 9, 9], [9] * 4, [9] * 700, [1, 2, 3] * 400, [1, 2, 3, 2, 3, 1, 3, 1, 2], copies]
    cases += [draw.integers(0, draw.integers(2, 60), draw.integers(1, 2000)) for _ in range(30)]
    for ids in map(np.array, cases):
        ids = ids.astype(np.uint32)
        ends = np.sort(np.r_[0, 0, draw.integers(0, len(ids) + 1, 4), len(ids)])
        for least in (2, 5):
            seq, cut, rules = repair.compress(ids, ends, first, least=least)
            assert max(apart(seq.tolist(), cut.tolist()).values(), default=0) < least
            if not wide:
                grammar = repair.Grammar(rules, repair.expansion_lengths(rules, first), first)
                assert (grammar.decode(seq) == ids).all() and len(cut) == len(ends)
                stops = np.r_[0, np.cumsum(grammar.lengths(seq))]
                assert (stops[cut] == ends).all()


def test_rules_follow_however_deep_they_go():
    ids = np.tile(np.arange(40), 1 << 11)
    seq, _, rules = repair.compress(ids, np.array([len(ids)]), 100)  # more than three rounds' worth of rules
    sizes = repair.expansion_lengths(rules, 100)
    assert len(seq) <= 2 and sizes.max() >= len(ids) // 2
    own = [(1 if a < 100 else 0) + (1 if b < 100 else 0) for a, b in rules.tolist()]
    for i, (a, b) in enumerate(rules.tolist()):
        own[i] += sum(own[x - 100] for x in (a, b) if x >= 100)
    assert own == sizes.tolist()
    assert (repair.Grammar(rules, sizes, 100).decode(seq) == ids).all()


def test_separator_scan_stitches_blocks(spark, monkeypatch):
    draw = np.random.default_rng(1)
    for size in (1, 3, 64):
        expected, table, base = [], [], 0
        for shard in range(3):
            ids = draw.integers(0, 4, 50 + shard).astype("<u2")  # 0 ends a document
            cut = np.flatnonzero(ids == 0)
            stops = [*cut, len(ids)] if not len(cut) or cut[-1] + 1 < len(ids) else [*cut]
            at = 0
            for place, stop in enumerate(stops):
                expected.append((shard, place, base + at, int(stop) - at))
                at = int(stop) + 1
            base += len(ids)
            table += [(shard, i // size, bytearray(ids[i : i + size].tobytes())) for i in range(0, len(ids), size)]
        blocks = spark.createDataFrame(table, "shard int, block int, tokens binary")
        assert sorted(map(tuple, separators.count_tokens(blocks, 0, 2).collect())) == expected


def test_raw_elements_end_where_they_end():
    texts = lambda page: [b.text for b in pages.blocks(page)]
    assert texts("<article><p>a <svg width='1'/> b</p><p>c</p></article>") == ["a b", "c"]
    assert texts("<article><p>a <svg><text>x</text></svg> b</p><title-bar>t</title-bar><select-box>s</select-box></article>") == ["a b", "t", "s"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert texts("<noscript><p>n</p></noscript><object data='x'>o</object>") == ["n", "o"]
    assert texts("<script>a</script><style>b</style><textarea>c</textarea><select><option>d</select>e") == ["e"]
    assert texts("<svg viewBox='0 0 / 1' title=\"a/>b\"><path/></svg>f") == ["f"]


def test_viterbi_and_marginals_equal_all_labellings():
    draw = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        field = pages.Field(draw.normal(size=(pages.WIDTH, 2)), draw.normal(size=(2, 2)))
        rows = [draw.choice(pages.WIDTH, 6, replace=False) for _ in range(n)]
        scores = field.scores(rows)
        ways = list(itertools.product((0, 1), repeat=n))
        totals = np.array([sum(scores[i, y] for i, y in enumerate(w)) + sum(field.pairs[a, b] for a, b in zip(w, w[1:])) for w in ways])
        assert tuple(field.viterbi(rows).tolist()) == ways[int(totals.argmax())]
        weights = np.exp(totals - totals.max())
        weights /= weights.sum()
        single, both = pages._marginals(scores, field.pairs)
        for i in range(n):
            assert np.isclose(single[i, 1], sum(p for p, w in zip(weights, ways, strict=True) if w[i]))
        expected = np.zeros((2, 2))
        for p, w in zip(weights, ways, strict=True):
            for a, b in zip(w, w[1:]):
                expected[a, b] += p
        assert np.allclose(both, expected)
