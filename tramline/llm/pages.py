"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into blocks, the runs of text between block-level tags, in page order. Each block has features of its
ancestors (tags, words of class and id) and of its text; the field scores blocks and neighbours, and Viterbi finds
the best labelling, main text or not. It is trained on labelled pages: a bounded sample of the pages themselves,
labelled by their ``article`` elements, and pages composed from the same blocks in other mark-up.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import arrow_rows

WIDTH = 1 << 12  # hashed features
# elements that do not end a block
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder "
    "mover munderover mspace mstyle mpadded semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements whose content is no text of the page
RAW = "script|style|template|iframe|svg|annotation|textarea|select|title"
# elements that an opening tag of the same group closes
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
CLOSES |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
MARK = "data-main"  # names the label on composed pages; never a feature

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|annotation)(?=[\s/])(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*+/>"
    rf"|<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(class|id|role|" + MARK + r")\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    ancestors: tuple[str, ...]
    hints: tuple[str, ...]
    linked: int  # characters inside links
    mark: str | None


class _Open:
    """An open element, with what its descendants inherit."""

    __slots__ = ("tag", "hints", "mark")

    def __init__(self, tag: str, attributes: str, mark: str | None):
        self.tag, self.hints, self.mark = tag, (), mark
        if attributes:
            words = []
            for name, value in _ATTRIBUTE.findall(attributes):
                value = value.strip("\"'")
                if name.lower() == MARK:
                    self.mark = value
                else:
                    words += [w.lower() for w in _WORD.findall(value)]
            self.hints = tuple(words)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page: runs of text between block-level tags, white space made one, empty ones left out."""
    out: list[Block] = []
    stack: list[_Open] = []
    pieces: list[tuple[str, bool]] = []
    links = 0
    page = page or ""

    def end() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if text:
            outer = [e for e in stack if e.tag not in INLINE]
            linked = sum(len(p) for p, inside in pieces if inside)
            mark = next((e.mark for e in reversed(stack) if e.mark is not None), None)
            hints = tuple(h for e in outer for h in e.hints)
            out.append(Block(text, tuple(e.tag for e in outer), hints, linked, mark))
        pieces.clear()

    def close(at: int) -> None:
        nonlocal links
        links -= sum(e.tag == "a" for e in stack[at:])
        del stack[at:]

    last = 0
    for token in _TOKEN.finditer(page):
        if token.start() > last:
            pieces.append((page[last : token.start()], links > 0))
        last = token.end()
        name = token.group(3)
        if name is None:
            continue  # a comment, a declaration, or an element whose content is left out
        tag = name.lower()
        if tag not in INLINE:
            end()
        elif tag == "br":
            pieces.append((" ", links > 0))
        if token.group(2):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        gone = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        if gone:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in gone:
                    close(i)
                    break
                if stack[i].tag not in INLINE and tag in CLOSES:
                    break
        if tag not in VOID and not token.group(4).endswith("/"):
            stack.append(_Open(tag, token.group(4), None))
            links += tag == "a"
    if last < len(page):
        pieces.append((page[last:], links > 0))
    end()
    return out


def features(found: list[Block]) -> list[np.ndarray]:
    """Hashed features of every block of a page."""
    out, n = [], len(found)
    for i, b in enumerate(found):
        words = b.text.count(" ") + 1
        names = {"bias", f"words {min(6, words.bit_length())}"}
        names.update(f"in {t}" for t in b.ancestors)
        names.update(f"hint {h}" for h in b.hints)
        names.add(f"leaf {b.ancestors[-1] if b.ancestors else ''}")
        names.add(f"links {min(4, 5 * b.linked // max(1, len(b.text)))}")
        names.add(f"end {b.text[-1] in '.!?:;'}")
        names.add(f"place {4 * i // n}")
        if b.text[0] == "©":
            names.add("copyright")
        out.append(np.fromiter({zlib.crc32(x.encode()) % WIDTH for x in names}, np.int64))
    return out


@dataclass(frozen=True)
class Field:
    """Weights of the two labels for every feature, and of label pairs; some 64 KB."""

    own: np.ndarray
    pairs: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.own[r].sum(axis=0) for r in rows]) if rows else np.zeros((0, 2))

    def viterbi(self, rows: list[np.ndarray]) -> np.ndarray:
        scores = self.scores(rows)
        n = len(scores)
        if not n:
            return np.zeros(0, np.int64)
        best, back = scores[0], np.zeros((n, 2), np.int64)
        for i in range(1, n):
            way = best[:, None] + self.pairs
            back[i] = way.argmax(axis=0)
            best = way.max(axis=0) + scores[i]
        labels = np.zeros(n, np.int64)
        labels[-1] = int(best.argmax())
        for i in range(n - 1, 0, -1):
            labels[i - 1] = back[i, labels[i]]
        return labels


def _marginals(scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels and expected label pairs, by the forward-backward recursion."""
    n = len(scores)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = np.logaddexp.reduce(ahead[i - 1][:, None] + pairs, axis=0) + scores[i]
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp.reduce(pairs + scores[i + 1] + behind[i + 1], axis=1)
    total = np.logaddexp.reduce(ahead[-1])
    both = np.zeros((2, 2))
    for i in range(1, n):
        both += np.exp(ahead[i - 1][:, None] + pairs + scores[i] + behind[i] - total)
    return np.exp(ahead + behind - total), both


def train(pages: list[tuple[list[np.ndarray], np.ndarray]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Conditional likelihood by stochastic gradients with steps scaled per weight; same pages, same weights."""
    own, pairs = np.zeros((WIDTH, 2)), np.zeros((2, 2))
    own_sum, pairs_sum = np.full((WIDTH, 2), 1e-2), np.full((2, 2), 1e-2)
    order = list(range(len(pages)))
    draw = random.Random(0)
    for _ in range(epochs):
        draw.shuffle(order)
        for at in order:
            rows, labels = pages[at]
            if not rows:
                continue
            scores = np.stack([own[r].sum(axis=0) for r in rows])
            single, both = _marginals(scores, pairs)
            gap = np.eye(2)[labels] - single
            step = np.zeros((WIDTH, 2))
            for r, g in zip(rows, gap, strict=True):
                step[r] += g
            touched = np.flatnonzero(np.abs(step).sum(axis=1))
            change = step[touched] - decay * own[touched]
            own_sum[touched] += change**2
            own[touched] += rate * change / np.sqrt(own_sum[touched])
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            change = seen - both - decay * pairs
            pairs_sum += change**2
            pairs += rate * change / np.sqrt(pairs_sum)
    return Field(own, pairs)


# names that pages give to the container of the article, and to what stands around it
MAIN = ("content", "post-body", "entry-content", "article-body", "story", "main-text", "page-body")
AROUND = {
    "nav": ("menu", "navbar", "breadcrumb", "main-nav", "topnav"),
    "header": ("header", "site-header", "masthead", "banner"),
    "footer": ("footer", "site-footer", "copyright", "legal"),
    "aside": ("sidebar", "related", "widget", "right-rail"),
    "div": ("ad", "advert", "sponsored", "promo", "cookie-notice", "notice", "popup", "newsletter", "share", "social"),
    "section": ("comments", "comment-list", "replies", "reader-comments", "discussion"),
    "form": ("search", "login", "subscribe", "contact-form"),
}


def compose(main: list[str], rest: list[str], draw: random.Random) -> str:
    """A labelled page of the given texts in some mark-up: what stands around the article is not main text."""

    def some(kind: str) -> str:
        plain = draw.random() < 0.5 and kind not in ("div", "section", "form")
        name = draw.choice(AROUND[kind])
        tag = kind if plain or kind in ("div", "section", "form") else "div"
        hint = "" if plain and draw.random() < 0.5 else f' {draw.choice(("class", "id"))}="{name}"'
        texts = [html.escape(draw.choice(rest or ["x"])) for _ in range(draw.randint(1, 4))]
        if kind == "nav":
            inner = "<ul>" + "".join(f'<li><a href="/">{t}</a></li>' for t in texts) + "</ul>"
        elif kind == "form":
            inner = "".join(f"<label>{t}</label><input><button>{t[:12]}</button>" for t in texts)
        else:
            wrap = draw.choice(("p", "div", "span"))
            inner = "".join(f"<{wrap}>{t}</{wrap}>" for t in texts)
            if kind == "section":  # readers write like authors
                inner += "".join(f'<div class="comment"><p>{html.escape(draw.choice(main or ["x"]))}</p></div>' for _ in "ab")
        return f'<{tag}{hint} {MARK}="0">{inner}</{tag}>'

    kind = draw.random()
    tag, hint = ("article", "") if kind < 0.4 else ("main", "") if kind < 0.55 else ("div", f' class="{draw.choice(MAIN)}"')
    body = [f"<h1>{html.escape(main[0])}</h1>"] if main else []
    for text in main[1:]:
        form = draw.choice(("p", "p", "p", "p", "li", "blockquote", "h2", "pre", "td"))
        inner = html.escape(text)
        if draw.random() < 0.2:
            inner = f'<b>{inner[:20]}</b>{inner[20:]} <a href="/x">{inner[:9]}</a>' if "&" not in inner[:20] else inner
        shell = {"li": "<ul><li>{}</li></ul>", "td": "<table><tr><td>{}</td></tr></table>"}.get(form, f"<{form}>{{}}</{form}>")
        body.append(shell.replace("{}", inner))
    for _ in range(draw.randint(0, 2)):
        body.insert(draw.randint(1, max(1, len(body))), some(draw.choice(("div", "aside", "form"))))
    if draw.random() < 0.4:
        body.append(some("section"))
    before = [some(k) for k in ("header", "nav", "div") if draw.random() < 0.7]
    after = [some(k) for k in ("aside", "section", "form", "footer", "div") if draw.random() < 0.5]
    inner = f'<{tag}{hint} {MARK}="1">{"".join(body)}</{tag}>'
    return f"<html><body>{''.join(before)}{inner}{''.join(after)}</body></html>"


def labelled(pages: list[str], composed: int = 2, seed: int = 0) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """Training pages: each given page with its ``article`` as main text, and ``composed`` pages of its texts."""
    draw = random.Random(seed)
    out, rest = [], []
    for page in pages:
        found = blocks(page)
        if not any("article" in b.ancestors for b in found):
            continue
        labels = np.array([int("article" in b.ancestors) for b in found], np.int64)
        out.append((features(found), labels))
        main = [b.text for b, y in zip(found, labels, strict=True) if y]
        rest = (rest + [b.text for b, y in zip(found, labels, strict=True) if not y])[-200:]
        for _ in range(composed):
            made = blocks(compose(main[: draw.randint(1, 12)], rest, draw))
            out.append((features(made), np.array([int(b.mark or 0) for b in made], np.int64)))
    return out


def fit(pages: DataFrame, sample: int = 300, key: str = "page_id", page: str = "html", longest: int = 40_000) -> Field:
    """Train on ``sample`` pages, first in the order of a hash of the key, of at most ``longest`` characters each.

    The sample bounds what the driver sees; extraction reads every page. Without any page that has an ``article``,
    composed pages of fixed texts are used. A key that stands on several pages counts once, with the smallest of them.
    """
    usable = pages.where(F.col(page).contains("<article") & (F.length(page) <= longest))
    order = F.xxhash64(F.col(key), F.lit("sample"))
    # keys first: a task then passes on a few numbers, not pages
    chosen = usable.select(key).distinct().orderBy(order, key).limit(sample)
    taken = usable.join(F.broadcast(chosen), key).groupBy(key).agg(F.min(page).alias(page)).orderBy(order, key).select(page).collect()
    texts = [r[0] for r in taken] or ["<nav><a>Home</a></nav><article><h1>Title</h1><p>Some text of a page.</p></article>"]
    return train(labelled(texts))


def main_text(field: Field, page: str | None) -> str:
    found = blocks(page)
    labels = field.viterbi(features(found))
    return "\n".join(b.text for b, y in zip(found, labels, strict=True) if y)


def extract(
    pages: DataFrame, field: Field, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """``key, url, text, n_chars`` of every page; null and empty pages have an empty text. One row per row."""
    sent = pages.sparkSession.sparkContext.broadcast((field.own, field.pairs))

    def rows(found: Iterator[tuple]):
        own = Field(*sent.value)
        for name, address, content in found:
            text = main_text(own, content)
            yield name, address, text, len(text)

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in (key, url))
    return arrow_rows(pages.select(key, url, page), rows, f"{kinds}, text string, n_chars long")
