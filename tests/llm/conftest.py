"""Shared inputs of the operators' tests."""

import random

import pytest

KEYS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def prose():
    """Random words from a small vocabulary, the same for the same seed."""

    def make(seed: int, words: int = 120) -> str:
        draw = random.Random(seed)
        letters = "abcdefghijklmnopqrstuvwxyzéñ"
        own = ["".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(words)]
        return " ".join(w + draw.choice(["", "", "", ".", ",", ".\n"]) for w in own)

    return make


@pytest.fixture
def documents(spark):
    """A documents table from ``(doc_id, text)`` pairs, with columns that an operator might use itself."""

    def make(pairs, extra: bool = False):
        rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in pairs]
        df = spark.createDataFrame(rows, KEYS).repartition(3)
        if extra:
            for name in ("id", "key", "block", "data", "score", "component", "_items", "count", "value"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def corpus(prose):
    """Copies, near copies, shared passages, odd texts, nulls and repeated keys."""
    base = [prose(i) for i in range(12)]
    pairs = list(enumerate(base))
    pairs += [(20, base[0]), (21, base[0]), (21, base[0])]  # exact copies, a repeated row
    pairs += [(30 + i, base[1].replace(base[1].split()[5 + 9 * i], "zz")) for i in range(5)]  # near copies
    pairs += [(40 + i, prose(90 + i, 60) + "\n" + prose(80, 70) + "\n" + prose(95 + i, 30)) for i in range(4)]  # a passage
    pairs += [(50, None), (51, ""), (52, " \n\t "), (53, "one"), (54, "One"), (55, "a b c d"), (None, base[2])]
    pairs += [(60, "ab " * 400), (61, "x" * 500), (62, "日本語 ½ Ⅷ it's x\r\n" * 3), (63, prose(63, 4000))]
    return pairs
