"""Product cards in stored HTML pages.

Spark has no HTML reader, so the markup is walked in Arrow batches on the
executors. The walk only picks raw strings out of each card; links, prices and
flags are cleaned afterwards with column expressions.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Tasks get the functions of this module themselves, not a reference to it, so
# the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID_TAGS = set("area base br col embed hr img input link meta source track wbr".split())
# Tags that a new one of the same kind closes when the page left them open.
SELF_CLOSING = set("li p tr td th option dt dd".split())
HIDDEN = {"script", "style"}
TEXTS = ("text", "tight_text")
CARDS_AT_ONCE = 4096
# Class names are the pages' own, so that many are remembered and no more.
KNOWN_CLASSES = 4096
# Markup as nearly all is written, which every version of Python's parser reads alike; from
# the first that is not, a page is left to the parser.
_GAP, _NAME, _ATTRIBUTE = r"[ \t\n\r\f]", r"[a-zA-Z][a-zA-Z0-9-]*", r"[a-zA-Z][a-zA-Z0-9_:.-]*"
_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'<>=`]+))"""
_UNNAMED = re.sub(r"(?<!\[)\((?!\?)", "(?:", _VALUE)
PLAIN_MARKUP = re.compile(
    rf"<(?:/({_NAME}){_GAP}*|({_NAME})((?:{_GAP}+{_ATTRIBUTE}(?:={_UNNAMED})?)*){_GAP}*(/?)"
    r"|!--(?!-?>)[^-]*(?:-[^-]+)*--|![dD][oO][cC][tT][yY][pP][eE][^<>]*)>"
)
PLAIN_ATTRIBUTE = re.compile(rf"({_ATTRIBUTE})(?:={_VALUE})?")
# Contents of tags whose insides are no markup, up to the closing tag; others of these tags are not plain.
PLAIN_INSIDE = {
    **{tag: re.compile(rf"((?:[^<]|<(?![/!]))*)</{tag}{_GAP}*>", re.I) for tag in HIDDEN},
    **{tag: re.compile(rf"([^<]*)</{tag}{_GAP}*>", re.I) for tag in ("title", "textarea")},
    **{tag: re.compile(rf"([^<&]*)</{tag}{_GAP}*>", re.I) for tag in "iframe noembed noframes xmp".split()},
}
STEP = re.compile(r"([a-z0-9]*)((?:\.[\w-]+)*)(?:\[([\w-]+)(?:\*=['\"]?([^'\"\]]*)['\"]?)?\])?$")


@dataclass
class CardSpec:
    """Where the parts of a shop's product card are.

    ``fields`` maps an output name to ``(selector, attribute)``; an empty selector
    is the card itself, attribute ``text`` the visible text (``tight_text``:
    without spaces between its pieces). Selectors know tags, classes, ``[attr]``,
    ``[attr*=part]``, descendants and commas. If no card matches,
    ``link_fallback`` makes one of every matching link's third ancestor.
    """

    cards: str
    fields: dict[str, tuple[str, str]]
    link_fallback: str | None = None


Step = tuple[str, frozenset, str | None, str]


def _step(text: str) -> Step:
    tag, classes, attr, part = STEP.match(text).groups()
    return tag, frozenset(filter(None, classes.split("."))), attr, part or ""


class _Selectors:
    """All selectors of a page read as one automaton over the open elements.

    Each step of each alternative is a bit. An element's mask has the bits of all
    steps up to which it and the elements around it match, so an element is
    selected if its own last step fits and the one before is in its parent's mask.
    """

    def __init__(self, selectors: list[str]) -> None:
        self.steps: list[tuple[Step, int, int, int]] = []
        self.known: dict[tuple[str, str], list[tuple]] = {}
        bit = 1
        for number, selector in enumerate(selectors):
            for option in selector.split(","):
                names, before = option.split(), 0
                for at, name in enumerate(names):
                    last = 1 << number if at == len(names) - 1 else 0
                    self.steps.append((_step(name), bit, before, last))
                    before, bit = bit, bit << 1

    def fitting(self, tag: str, classes: str) -> list[tuple]:
        """The steps that a tag of these classes takes, but for what they ask of other attributes."""
        if len(self.known) >= KNOWN_CLASSES:
            self.known.clear()
        own = frozenset(classes.split())
        found = self.known[tag, classes] = [
            (attr, part, bit, before, last)
            for (name, needed, attr, part), bit, before, last in self.steps
            if (not name or name == tag) and needed <= own
        ]
        return found

    def enter(self, tag: str, attrs: dict[str, str], mask: int) -> tuple[int, int]:
        """Mask of an element in one with ``mask``, and the selectors that it is selected by, as bits."""
        classes = attrs.get("class", "")
        steps = self.known.get((tag, classes))
        if steps is None:
            steps = self.fitting(tag, classes)
        inner, selected = mask, 0
        for attr, part, bit, before, last in steps:
            if before & mask != before or attr and not (attr in attrs and part in attrs[attr]):
                continue
            inner |= bit
            selected |= last
        return inner, selected


class _Element:
    """An element that something is wanted of; ``text`` is set when it closes."""

    __slots__ = ("attrs", "first", "level", "pieces", "is_text")

    def __init__(self, attrs: dict[str, str], first: int, level: int, is_text: bool) -> None:
        self.attrs, self.first, self.level, self.is_text = attrs, first, level, is_text
        self.pieces: list[str] = []


class _Card:
    __slots__ = ("element", "hits")

    def __init__(self, element: _Element, fields: int) -> None:
        self.element = element
        self.hits: list[_Element | None] = [None] * fields


def _plain_attributes(text: str) -> dict[str, str]:
    values = {}
    for name, double, single, bare in PLAIN_ATTRIBUTE.findall(text):
        value = double or single or bare
        values[name.lower()] = unescape(value) if "&" in value else value
    return values


class _CardReader(HTMLParser):
    """Reads the cards of a page in one pass, without a tree of it.

    Kept are the open elements, how many of each name are open (so that a stray
    closing tag looks at none of them), and per field the open cards that still
    wait for it: the first element selected below them serves all of these at once.
    So the time is that of the page, however its tags nest or fail to.

    Selector 0 finds the cards, selector 1 the fallback's links, the others the
    fields. Text is gathered for the selectors whose bits are in ``texts``. With
    ``only`` the cards are the elements of these numbers instead.
    """

    def __init__(self, selectors: _Selectors, fields: int, texts: int, only: list[int] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.selectors, self.fields, self.wanted = selectors, fields, texts
        self.only = None if only is None else set(only)
        self.cards: dict[int, _Card] = {}
        self.fallback: list[int] = []
        self.count = self.level = 0
        self.texts: list[tuple[int, str]] = []
        self.waiting: list[list[_Card]] = [[] for _ in range(fields)]
        self.open_names: dict[str, int] = {}
        # Name, number, mask, card and element of each open element; the page is the first.
        page = _Element({}, 0, 0, bool(texts & 1))
        card = self._card(0, page) if self.only and 0 in self.only else None
        self.open: list[tuple[str, int, int, _Card | None, _Element | None]] = [("", 0, 0, card, page)]

    def _card(self, number: int, element: _Element) -> _Card:
        card = self.cards[number] = _Card(element, self.fields)
        for waiting in self.waiting:
            waiting.append(card)
        return card

    def read(self, markup: str) -> None:
        """The whole page: plain markup is taken here, the rest from the first that is not goes to the parser."""
        at = 0
        while (start := markup.find("<", at)) >= 0:
            found = PLAIN_MARKUP.match(markup, start)
            if found is None:
                break
            closing, tag, attrs, slash = found.groups()
            tag, inside = tag and tag.lower(), None
            if tag in PLAIN_INSIDE:
                inside = PLAIN_INSIDE[tag].match(markup, found.end())
                if inside is None or slash:
                    break
            elif tag == "plaintext":
                break
            if start > at:
                text = markup[at:start]
                self.handle_data(unescape(text) if "&" in text else text)
            at = found.end()
            if closing is not None:
                self.handle_endtag(closing.lower())
            elif tag is not None:
                self._open(tag, _plain_attributes(attrs) if attrs else {})
                if slash and tag not in VOID_TAGS:
                    self._close()
                if inside is not None:
                    self.handle_data(inside[1] if tag in HIDDEN else unescape(inside[1]))
                    self.handle_endtag(tag)
                    at = inside.end()
        if at < len(markup):
            self.feed(markup[at:])
        self.finish()

    def handle_starttag(self, tag, attrs):
        self._open(tag, {k: v or "" for k, v in attrs})

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in SELF_CLOSING and self.open[-1][0] == tag:
            self._close()
        self.count += 1
        number = self.count
        mask, selected = self.selectors.enter(tag, attrs, self.open[-1][2])
        if tag in HIDDEN:
            self.level += 1
        element = card = None
        if selected >> 2 or selected & 1 or (self.only and number in self.only):
            is_card = number in self.only if self.only is not None else bool(selected & 1)
            is_text = bool((selected & ~1 | is_card) & self.wanted)
            element = _Element(attrs, len(self.texts), self.level, is_text)
            for field in range(self.fields):
                if selected >> (2 + field) & 1 and self.waiting[field]:
                    for waiting in self.waiting[field]:
                        waiting.hits[field] = element
                    self.waiting[field] = []
            if is_card:
                card = self._card(number, element)
        if selected & 2:
            self.fallback.append(self.open[-3][1] if len(self.open) > 2 else 0)
        self.open.append((tag, number, mask, card, element))
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        if tag in VOID_TAGS:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close()

    def handle_endtag(self, tag):
        if self.open_names.get(tag):
            while self.open[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        piece = data.strip()
        if piece:
            self.texts.append((self.level, piece))

    def _close(self) -> None:
        tag, _, _, card, element = self.open.pop()
        if tag:
            self.open_names[tag] -= 1
        if element is not None and element.is_text:
            # What is in a script or style is no text, unless of that element itself.
            element.pieces = [text for level, text in self.texts[element.first :] if level == element.level]
        if card is not None:
            for waiting in self.waiting:
                if waiting and waiting[-1] is card:
                    waiting.pop()
        if tag in HIDDEN:
            self.level -= 1

    def finish(self) -> None:
        self.close()
        while self.open:
            self._close()


def _value(element: _Element | None, attr: str) -> str | None:
    if element is None:
        return None
    if attr in TEXTS:
        return (" " if attr == "text" else "").join(element.pieces)
    return element.attrs.get(attr)


def extract_cards(
    pages: DataFrame, spec: CardSpec, keep: list[str], html: str = "html"
) -> DataFrame:
    """One row per card: the page's ``keep`` columns, the position, the raw fields."""
    names = list(dict.fromkeys(sel for sel, _ in spec.fields.values() if sel))
    # An empty alternative selects nothing.
    selectors = _Selectors([spec.cards, spec.link_fallback or "", *names])
    parts = [(names.index(sel) if sel else None, attr) for sel, attr in spec.fields.values()]

    of_text = [0 if at is None else 2 + at for at, attr in parts if attr in TEXTS]
    wanted = sum(1 << bit for bit in set(of_text))

    def read(markup: str, only: list[int] | None = None) -> _CardReader:
        reader = _CardReader(selectors, len(names), wanted, only)
        reader.read(markup)
        return reader

    def cards_of(markup: str | None) -> list[_Card]:
        reader = read(markup or "")
        if reader.cards or not reader.fallback:
            return list(reader.cards.values())
        # No card: the links' third ancestors, which a second reading knows by number.
        cards = read(markup or "", reader.fallback).cards
        return [cards[number] for number in reader.fallback]

    def values_of(card: _Card) -> list[str | None]:
        return [_value(card.element if at is None else card.hits[at], attr) for at, attr in parts]

    def card_batch(batch: pa.RecordBatch, page_rows: list[int], cells: list[tuple]) -> pa.RecordBatch:
        kept = [batch.column(name).take(pa.array(page_rows, pa.int64())) for name in keep]
        columns = list(zip(*cells)) or [()] * (len(parts) + 1)
        return pa.RecordBatch.from_arrays(
            kept
            + [pa.array(columns[0], pa.int32())]
            + [pa.array(column, pa.string()) for column in columns[1:]],
            names=[*keep, "pos", *spec.fields],
        )

    def batches(page_batches):
        for batch in page_batches:
            page_rows, cells = [], []
            # One page at a time is text, and cards leave the task every few thousand.
            for row, markup in enumerate(batch.column(html)):
                for pos, card in enumerate(cards_of(markup.as_py())):
                    page_rows.append(row)
                    cells.append((pos, *values_of(card)))
                    if len(cells) == CARDS_AT_ONCE:
                        yield card_batch(batch, page_rows, cells)
                        page_rows, cells = [], []
            yield card_batch(batch, page_rows, cells)

    kept_types = [f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in keep]
    field_types = [f"`{name}` string" for name in spec.fields]
    return pages.select(*dict.fromkeys([*keep, html])).mapInArrow(
        batches, ", ".join([*kept_types, "pos int", *field_types])
    )
