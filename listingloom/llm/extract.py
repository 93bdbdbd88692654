"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative; both
weights depend on where they stand and come from labelled pages, the ones that
mark their article themselves. A linear scan finds the contiguous run with the
highest sum. Elements that are never part of an article, such as menus, forms or
adverts, score nothing and are left out of the run's text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field, replace
from itertools import accumulate
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value

# Names that HTML gives to kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = frozenset("li dt dd tr td th option optgroup p".split())
BLOCKS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "td", "th", "div", "section", "blockquote", "pre", "dd", "dt")
LANDMARKS = frozenset(("article", "main"))
#: Pages that open such an element.
MARKED = r"(?i)<(article|main)[\s/>]"
NEVER = frozenset(
    "head script style template noscript nav footer aside form button select textarea iframe object svg canvas "
    "audio video dialog menu title noframes noembed xmp datalist math map".split()
)
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Words of a class or id that mark an element as no part of an article.
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar "
    "rail widget widgets nav navbar navigation menu breadcrumb breadcrumbs masthead topbar header footer copyright "
    "comment comments disqus respond replies social share sharing related recommended recommendations trending pagination "
    "pager toolbar login".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z][^>]*(?P<cut>>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

IN, OUT, NONE = "in", "out", "none"
#: Where a page marks its article this outweighs all else; where it does not it says nothing.
PLACES = {IN: 9.0, OUT: -9.0, NONE: 0.0}
#: Any tag costs so much, one that stands outside of articles up to 1 more.
TAG_COST = 0.1


@dataclass(frozen=True)
class Piece:
    """A run of text or a tag, with what its weight depends on."""

    text: str | None
    block: str
    linked: bool
    landmark: bool
    never: bool
    breaks: bool


@dataclass
class Weights:
    """Log odds of being article text, added up for a word; the cost of each tag."""

    blocks: dict[str, float] = field(default_factory=dict)
    links: dict[bool, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)


def _never(name: str, attrs: str, in_landmark: bool) -> bool:
    if name in NEVER or (name == "header" and not in_landmark):
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, *values, hidden in ATTRIBUTE.findall(attrs):
        if hidden:
            return True
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower() in NEVER_ROLES:
            return True
        if key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id") and name in LANDMARKS:
            if {"comment", "comments"} & {p.lower() for p in NAME_PART.findall(value)}:
                return True
    return False


def _named(name: str, attrs: str) -> bool:
    """Whether a class or id names the element as no part of an article, which its content can outweigh."""
    if not attrs or name in ("html", "body") or name in LANDMARKS:
        return False
    for key, *values, _ in ATTRIBUTE.findall(attrs):
        if key.lower() in ("class", "id"):
            for word in "".join(values).split():
                parts = [p.lower() for p in NAME_PART.findall(word)]
                if not NEVER_NAMES.isdisjoint(parts) and not {"with", "has", "no"} & set(parts):
                    return True
    return False


def _shut_out(out: list[Piece], named: list[tuple[int, int]], landmarks: list[tuple[int, int]]) -> list[Piece]:
    """``out`` with the pieces of elements in ``named`` as never.

    Spared are elements with most words of the landmark that has the most, or of
    the page if no landmark has any: those are wrappers named after what they also
    hold.
    """
    sums = list(accumulate((0 if p.never or p.text is None else _words(p.text) for p in out), initial=0))

    def words(span: tuple[int, int]) -> int:
        return sums[span[1]] - sums[span[0]]

    first, last = max(landmarks, key=words, default=(0, 0))
    if not words((first, last)):
        first, last = 0, len(out)
    change = [0] * (len(out) + 1)
    for start, end in named:
        shared = (max(start, first), min(end, last))
        if shared[0] >= shared[1] or 2 * words(shared) <= words((first, last)):
            change[start] += 1
            change[end] -= 1
    return [replace(p, never=True) if depth and not p.never else p for p, depth in zip(out, accumulate(change))]


def pieces_of(page: str) -> list[Piece]:
    """The page in order. Unclosed elements end with their parents; stray closing tags count as tags only."""
    out: list[Piece] = []
    open_names: list[str] = []
    # How many of each name are open, so that a stray closing tag looks at none of them.
    open_count: Counter = Counter()
    open_never: list[bool] = []
    open_at: list[tuple[int, bool]] = []
    named: list[tuple[int, int]] = []
    landmarks: list[tuple[int, int]] = []
    state = {"never": 0, "landmark": 0, "link": 0}
    blocks = ["div"]

    def pop(to: int) -> None:
        while len(open_names) > to:
            name = open_names.pop()
            open_count[name] -= 1
            state["never"] -= open_never.pop()
            state["landmark"] -= name in LANDMARKS
            state["link"] -= name == "a"
            start, shuts = open_at.pop()
            if shuts:
                named.append((start, len(out)))
            if name in LANDMARKS and not state["landmark"]:
                landmarks.append((start, len(out)))
            if name in BLOCKS:
                blocks.pop()

    def add(text: str | None, breaks: bool = False, block: str | None = None) -> None:
        out.append(
            Piece(
                text,
                block or blocks[-1],
                state["link"] > 0,
                state["landmark"] > 0,
                state["never"] > 0,
                breaks,
            )
        )

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        breaks = name not in INLINE
        if found["close"]:
            add(None, breaks, name)
            if open_count[name] > 0:
                # What is passed on the way is closed, so each element is passed once.
                depth = len(open_names) - 1
                while open_names[depth] != name:
                    depth -= 1
                pop(depth)
            continue
        if open_names and (name in CLOSES_P or name in SAME_CLOSES):
            closing = {"p"} if name in CLOSES_P else set()
            if name in SAME_CLOSES:
                closing |= {"td", "th"} if name in ("td", "th") else {"dt", "dd"} if name in ("dt", "dd") else {name}
                closing |= {"td", "th"} if name == "tr" else set()
            depth = len(open_names)
            if not any(open_count[c] for c in closing):
                depth = 0
            while depth and (open_names[depth - 1] in INLINE or open_names[depth - 1] in closing):
                depth -= 1
                if open_names[depth] in closing:
                    pop(depth)
                    break
        if name in VOID or found["attrs"].endswith("/") and name not in RAW and name in INLINE:
            add(None, breaks, name)
            continue
        open_names.append(name)
        open_count[name] += 1
        open_at.append((len(out), _named(name, found["attrs"])))
        open_never.append(_never(name, found["attrs"], state["landmark"] > 0))
        state["never"] += open_never[-1]
        state["landmark"] += name in LANDMARKS
        state["link"] += name == "a"
        if name in BLOCKS:
            blocks.append(name)
        add(None, breaks, name)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else end
    pop(0)
    return _shut_out(out, named, landmarks) if named else out


def _words(text: str) -> int:
    return len(text.split())


def count_features(page: str) -> Counter:
    """How often each feature stands inside and outside the article that the page marks itself."""
    pieces = pieces_of(page)
    counts: Counter = Counter()
    if not any(p.landmark and p.text and p.text.strip() for p in pieces):
        return counts
    for p in pieces:
        inside = p.landmark and not p.never
        if p.text is None:
            counts["tag", p.block, inside] += 1
        elif n := _words(p.text):
            counts["block", p.block, inside] += n
            counts["link", str(p.linked), inside] += n
            counts["landmark", IN if p.landmark else OUT, inside] += n
    return counts


def weights_of(counts: dict[tuple[str, str, bool], int]) -> Weights:
    """Weights by log odds. Nothing known gives words in text blocks a small score and every tag a cost."""

    def odds(kind: str, name: str, least: float, most: float) -> float:
        inside, outside = counts.get((kind, name, True), 0), counts.get((kind, name, False), 0)
        return max(least, min(most, log((inside + 1) / (outside + 1))))

    tags = {}
    for kind, name, _ in counts:
        if kind == "tag":
            inside, outside = counts.get((kind, name, True), 0), counts.get((kind, name, False), 0)
            tags[name] = -(TAG_COST + outside / (inside + outside + 2))
    return Weights(
        # Bounded so that a word counts for something in any block, unless it is a link.
        {name: odds("block", name, -0.9, 4) for name in BLOCKS},
        {linked: odds("link", str(linked), -3, 0) for linked in (True, False)},
        tags,
    )


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest sum above 0; the first and shortest of equal ones."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, best_at = total, (start, at + 1)
    return best_at


def main_text(page: str | None, weights: Weights) -> str:
    """Text of the best run, one line per block. NULL, empty and wordless pages give an empty text."""
    pieces = pieces_of(page or "")
    marked = any(p.landmark and not p.never and p.text and p.text.strip() for p in pieces)
    scores = []
    for p in pieces:
        if p.never:
            scores.append(0.0)
        elif p.text is None:
            scores.append(weights.tags.get(p.block, -TAG_COST))
        else:
            place = (IN if p.landmark else OUT) if marked else NONE
            word = 1.0 + weights.blocks.get(p.block, 0.0) + weights.links.get(p.linked, 0.0) + PLACES[place]
            scores.append(word * _words(p.text))
    start, end = best_run(scores)
    lines, line = [], []
    for p in pieces[start:end]:
        if p.breaks:
            lines.append("".join(line))
            line = []
        elif p.text is not None and not p.never:
            line.append(p.text)
    lines.append("".join(line))
    clean = (" ".join(html.unescape(x).split()) for x in lines)
    return "\n".join(x for x in clean if x)


def fit(pages: DataFrame, sample: int = 1024) -> Weights:
    """Weights from about ``sample`` of the pages that mark their article, picked by a hash of the page's own text.

    Only counts per feature leave the tasks, and features are names known to HTML.
    """
    rows = pages.select("html").where(F.col("html").rlike(MARKED))
    rate = sample / max(rows.count(), 1)
    picked = rows.where(F.pmod(F.xxhash64("html"), F.lit(2**30)) < F.lit(int(rate * 2**30)))
    known = CLOSES_P | SAME_CLOSES | INLINE | VOID | RAW | NEVER | set(BLOCKS) | LANDMARKS | {"html", "body"}

    def count(batches):
        for batch in batches:
            total: Counter = Counter()
            for page in batch["html"]:
                for (kind, name, inside), n in count_features(page).items():
                    total[kind, name if kind != "tag" or name in known else "other", inside] += n
            yield pd.DataFrame(
                [(*key, n) for key, n in total.items()], columns=["kind", "name", "inside", "n"]
            ).astype({"n": "int64", "inside": "bool"})

    counted = (
        picked.mapInPandas(count, "kind string, name string, inside boolean, n long")
        .groupBy("kind", "name", "inside")
        .agg(F.sum("n").alias("n"))
    )
    return weights_of({(r["kind"], r["name"], r["inside"]): r["n"] for r in counted.collect()})


def extract(page: Column, weights: Weights) -> Column:
    """The main text of a column of whole pages; never NULL."""

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p if isinstance(p, str) else None, weights) for p in pages], dtype=object)

    return text(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row. Repeated rows stay; other columns are not read."""
    weights = fit(pages)
    return pages.select("page_id", "url", extract(F.col("html"), weights).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


ship_by_value(__name__)
