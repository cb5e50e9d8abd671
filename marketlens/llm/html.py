"""Main text of web pages as the maximum-scoring run of page tokens.

A page is read as a list of tokens: words score positive, tags negative, and words that stand in a
boilerplate block (menus, forms, adverts, comments ...) count as markup, so they score negative too.
One linear scan finds the contiguous run with the highest sum. Such a block is also scanned by itself, with
its words as words, and its best run is the main text if it still beats the run around the blocks when it is
weighed by the trust in the block's mark: a page whose whole story stands in ``<div class="legal-news">`` is read, and
comments beside a story are not. The weights come from labelled pages: pages whose main text is marked by an
``article`` element give, for words and for every tag, how much more often the token stands inside the
article than outside (log odds, held to the sign the method asks for), and take trust from every mark by the
words that its blocks hold beside the main text. They are fitted on a bounded sample of such pages; all pages
are then read whole.
The article tag itself weighs as much as a block tag and no more: pages whose articles are teasers or
cards, and pages without any, have their main text found by the run alone.

Null and empty html give an empty text. Each row is read by itself, so repeated rows repeat their
result, ties between runs of equal score go to the first and longest one, an empty table gives an
empty result, and other columns are never read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import bounded_sample, column, slices, texts

SAMPLE_PAGES = 500  # labelled pages that the weights are fitted on, about at most

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!/?][^>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
# Elements that are skipped as a whole: the first two to the end of the page if they are left open,
# the others only where they are closed.
RAW = frozenset(("script", "style"))
SEALED = RAW | frozenset("noscript template textarea title svg iframe select button".split())
ATTR = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements and attribute words that mark blocks which are no part of an article.
OUTSIDE = frozenset("head nav footer aside form dialog menu".split())
OUTSIDE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert adverts advertisement "
    "banner promo promotion promoted sponsor sponsored cookie cookies consent notice alert disclaimer popup modal overlay newsletter subscribe "
    "subscription paywall signup login form dialog "
    "search share sharing social comment comments reply replies respond disqus discussion related recommended pagination pager skip complementary contentinfo "
    "toolbar copyright legal".split()
)
LAYOUT_NAMES = frozenset("has with no without".split())  # "content-with-sidebar" holds more than the sidebar
TITLE_NAMES = frozenset("article post entry story".split())  # "article-header" holds the title
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
# A start tag of these ends an open element of the same kind, as pages often leave out the end tag.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLANK = re.compile(r"\s+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TRUST, TRUST_WORDS, LEAST_TRUST = 0.1, 500, 0.05  # of a mark before any page is seen, in so many words; after all pages
LEAST_WORDS = 8  # by which a boilerplate block's own run, weighed by the trust in its mark, has to be better


def _outside(tag: str, attr: str, in_article: bool) -> str:
    """What marks a block as boilerplate: a tag or a word of its attributes, or nothing."""
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return tag
    if tag in ("html", "body", "main") or not attr:
        return ""
    for m in ATTR.finditer(attr):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = {p.lower() for p in PART.findall(name)}
            marks = parts & OUTSIDE_NAMES
            if marks and not parts & LAYOUT_NAMES and not (marks == {"header"} and parts & TITLE_NAMES):
                return min(marks)
    return ""


class Block(NamedTuple):
    mark: str
    outer: Block | None  # the boilerplate block around it


class Token(NamedTuple):
    kind: str  # "text" or the tag's name
    value: str
    block: Block | None  # the innermost boilerplate block that it stands in
    inside: bool  # of an article


def tokens(page: str) -> list[Token]:
    """Every tag and text of a page, in order.

    An end tag that nothing opened is ignored, and the first article ends blocks left open before it.
    """
    found: list[Token] = []
    open_tags: list[tuple[str, bool, bool]] = []
    where: dict[str, list[int]] = {}  # places of the open tags by name
    solid: list[int] = []  # places of those that are not inline
    block: Block | None = None
    art_depth = 0
    seen_article = False

    def drop(k: int) -> None:
        nonlocal block, art_depth
        while len(open_tags) > k:
            tag, out, article = open_tags.pop()
            where[tag].pop()
            if tag not in INLINE:
                solid.pop()
            if out:
                block = block.outer
            art_depth -= article

    ends: dict[str, re.Pattern | None] = {t: re.compile(rf"</{t}\s*>", re.I) for t in SEALED}
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        tag = (m["tag"] or "").lower()
        if m["text"]:
            found.append(Token("text", html.unescape(m["text"]), block, art_depth > 0))
        elif m["cdata"]:
            found.append(Token("text", m["cdata"], block, art_depth > 0))
        elif tag in SEALED and not m["close"] and (ends[tag] or tag in RAW):
            end = ends[tag].search(page, at) if ends[tag] else None
            if end is None:
                ends[tag] = None  # no later one is closed either
            if end or tag in RAW:
                at = end.end() if end else len(page)
            found.append(Token(tag, "", block, art_depth > 0))
        elif tag:
            if m["close"]:
                k = where[tag][-1] if where.get(tag) else -1
                # An end tag of an inline element never ends a block around it.
                if k >= 0 and (tag not in INLINE or not solid or solid[-1] < k):
                    drop(k)
            elif tag not in VOID and tag not in SEALED:
                if tag in SELF_CLOSING and solid and open_tags[solid[-1]][0] in SELF_CLOSING[tag]:
                    drop(solid[-1])
                out = _outside(tag, m["attr"], art_depth > 0)
                article = tag == "article" and not out
                if article and not seen_article:
                    drop(sum(t in ("html", "body", "main") for t, _, _ in open_tags[:3]))
                    seen_article = True
                where.setdefault(tag, []).append(len(open_tags))
                if tag not in INLINE:
                    solid.append(len(open_tags))
                open_tags.append((tag, bool(out), article))
                block = Block(out, block) if out else block
                art_depth += article
            found.append(Token(tag, m["close"], block, art_depth > 0))
    return found


def counts(page: str) -> Counter:
    """How often each kind of token stands inside and outside the article of a labelled page, and words by the
    mark of the block that they are in."""
    found: Counter = Counter()
    for kind, value, block, inside in tokens(page):
        if kind == "text":
            n = len(value.split())
            found["outside words" if block and inside else "words", inside] += n
            if block:
                found[f"in {block.mark}", False] += n
        elif kind != "article":
            found[kind, inside] += 1
    return found


def weights_from(found: Counter) -> dict[str, float]:
    """Log odds of standing inside, at least 0.1 for words and at most -0.1 for tags.

    Words of boilerplate blocks count as markup, half a point each. The main text of labelled pages is none of them,
    so the more words a mark holds there, the less it is trusted."""
    marked = {k: n for (k, _), n in found.items() if k.startswith("in ")}
    found = Counter({k: n for k, n in found.items() if k[0] not in marked})
    total = {side: sum(n for (_, s), n in found.items() if s == side) + 1.0 for side in (True, False)}

    def odds(kind: str) -> float:
        inside, outside = (found[kind, True] + 0.5) / total[True], (found[kind, False] + 0.5) / total[False]
        return math.log(inside / outside)

    kinds = {k for k, _ in found} | {"words", "outside words"}
    weights = {k: max(-5.0, min(-0.1, odds(k))) for k in kinds if k != "words"}
    weights["words"] = min(5.0, max(0.1, odds("words")))
    weights["outside words"] = -0.5
    weights |= {k: max(LEAST_TRUST, TRUST * TRUST_WORDS / (TRUST_WORDS + n)) for k, n in marked.items()}
    return weights


def fit_weights(pages: DataFrame, key: str = "page_id", page: str = "html", most: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from about ``most`` pages at most that mark their main text, drawn by the hashes of their keys."""
    marked = pages.select(key, page).filter(F.lower(page).contains("<article"))
    sample = bounded_sample(marked, key, most).select(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            found: Counter = Counter()
            for t in texts(batch, page):
                found.update(counts(t.decode("utf-8", "replace")))
            kinds, sides = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(sides, pa.bool_()), pa.array(list(found.values()), pa.int64())],
                names=["kind", "inside", "n"],
            )

    rows = sample.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    return weights_from(Counter({(r["kind"], r["inside"]): r["n"] for r in rows.collect()}))


class Run:
    """The best run of the tokens that stand in ``block`` and in no block within it, as they are met."""

    def __init__(self, block: Block | None):
        self.block, self.total, self.start = block, 0.0, 0
        self.best, self.begin, self.end = 0.0, 0, 0
        self.cost = 0.0  # of the block to the run around it

    def add(self, at: int, score: float) -> None:
        if self.total <= 0:
            self.total, self.start = 0.0, at
        self.total += score
        if self.total > self.best:
            self.best, self.begin, self.end = self.total, self.start, at + 1


def main_text(page: str, weights: dict[str, float]) -> str:
    """The blocks of the best run of tokens, without boilerplate blocks inside it.

    Boilerplate blocks within an article score nothing, so that they do not cut it in two.
    """
    items = tokens(page)
    other = weights.get("div", -0.5)
    runs, closed = [Run(None)], []

    def close(at: int) -> None:
        closed.append(runs.pop())
        runs[-1].add(at, closed[-1].cost)
        runs[-1].cost += closed[-1].cost

    for i, (kind, value, block, inside) in enumerate(items):
        while runs[-1].block is not block and runs[-1].block is not (block and block.outer):
            close(i - 1)
        if runs[-1].block is not block:
            runs.append(Run(block))
        run = runs[-1]
        if kind == "text":
            n = len(value.split())
            run.add(i, weights["words"] * n)
            cost = weights["outside words"] * n
        else:
            cost = 0.0 if inside and kind in SEALED else weights.get(kind, other)
            run.add(i, cost)
        run.cost += 0.0 if inside else cost
    while len(runs) > 1:
        close(len(items) - 1)
    chosen, least = runs[0], runs[0].best + LEAST_WORDS * weights["words"]
    for run in closed:
        worth = run.best * weights.get(f"in {run.block.mark}", TRUST)
        if worth > least:
            chosen, least = run, worth
    blocks: list[list[str]] = [[]]
    for kind, value, block, _ in items[chosen.begin : chosen.end]:
        if kind == "text":
            if block is chosen.block:
                blocks[-1].append(value)
        elif kind not in INLINE and (kind not in SEALED or kind == "title"):
            blocks.append([])
    cleaned = (BLANK.sub(" ", "".join(b)).strip() for b in blocks)
    return " ".join(b for b in cleaned if b)


def extract_text(pages: DataFrame, weights: dict[str, float] | None = None, key: str = "page_id", page: str = "html", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: key, url, main text and its number of code points."""
    fitted = weights or fit_weights(pages, key, page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            found = [main_text(t.decode("utf-8", "replace"), fitted) for t in texts(batch, page)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, key), column(batch, url), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, page).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
