"""The one-pass card reader against a plain tree of the page."""

import random
import time
from html.parser import HTMLParser

import pytest

from listingloom.sources import html_cards
from listingloom.sources.html_cards import HIDDEN, SELF_CLOSING, VOID_TAGS, CardSpec, _step, extract_cards


class Tree(HTMLParser):
    """Elements as [tag, attrs, parent, children]; text as strings."""

    def __init__(self, markup):
        super().__init__(convert_charrefs=True)
        self.root = self.at = ["", {}, None, []]
        self.order = []
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in SELF_CLOSING and self.at[0] == tag:
            self.at = self.at[2]
        node = [tag, {k: v or "" for k, v in attrs}, self.at, []]
        self.at[3].append(node)
        self.order.append(node)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.at = self.at[2]

    def handle_endtag(self, tag):
        node = self.at
        while node[2] is not None and node[0] != tag:
            node = node[2]
        if node[2] is not None:
            self.at = node[2]

    def handle_data(self, data):
        self.at[3].append(data)


def above(node):
    while node[2] is not None:
        node = node[2]
        yield node


def fits(node, step):
    tag, classes, attr, part = step
    own = set(node[1].get("class", "").split())
    return (not tag or node[0] == tag) and classes <= own and (not attr or (attr in node[1] and part in node[1][attr]))


def selected(node, selector):
    for option in selector.split(","):
        *outer, last = [_step(s) for s in option.split()]
        if fits(node, last):
            for around in above(node):
                if outer and fits(around, outer[-1]):
                    outer.pop()
            if not outer:
                return True
    return False


def text(node, gap):
    def pieces(at, top):
        if isinstance(at, str):
            yield at.strip()
        elif top or at[0] not in HIDDEN:
            for child in at[3]:
                yield from pieces(child, False)

    return gap.join(p for p in pieces(node, True) if p)


def by_tree(markup, spec):
    tree = Tree(markup)
    cards = [n for n in tree.order if selected(n, spec.cards)]
    if not cards and spec.link_fallback:
        for link in (n for n in tree.order if selected(n, spec.link_fallback)):
            for _ in range(3):
                link = link[2] or link
            cards.append(link)
    rows = []
    for card in cards:
        row = []
        for selector, attr in spec.fields.values():
            hit = card if not selector else next(
                (n for n in tree.order if any(a is card for a in above(n)) and selected(n, selector)), None
            )
            as_text = {"text": " ", "tight_text": ""}
            row.append(None if hit is None else text(hit, as_text[attr]) if attr in as_text else hit[1].get(attr))
        rows.append(tuple(row))
    return rows


SPECS = [
    CardSpec(".c", {"own": ("", "text"), "t": ("", "title"), "n": (".n", "text"), "h": ("a[href]", "href"),
                    "d": ("div .n, p b", "tight_text"), "s": ("script", "text")}),
    CardSpec("div.c, li .c", {"x": (".x i", "text"), "y": ("b", "text"), "z": (".c", "class")}, "a[href*=/a]"),
    CardSpec("nav", {"own": ("", "text"), "b": ("b", "text"), "img": ("img", "id")}, 'p a[href*="/a"], i'),
]


def pages(pick):
    tags = "div li p a b span img br script style td tr i".split()
    attrs = ["", "", ' class="c"', ' class="x c"', ' class="n"', " id=q", ' href="/a/b"', ' title="t &amp; u"']
    for _ in range(600):
        out = []
        for _ in range(pick.randrange(60)):
            tag, kind = pick.choice(tags), pick.randrange(8)
            if kind < 5:
                out.append(f"<{tag}{pick.choice(attrs)}{'/' * (kind == 4)}>")
            elif kind < 7:
                out.append(f"</{tag}>")
            else:
                out.append(pick.choice([" ", "text", "a &lt; b", "<!-- c -->", "\n"]))
        yield "".join(out)


@pytest.mark.parametrize("number", range(3))
def test_same_as_a_tree(spark, number):
    made = list(pages(random.Random(number)))
    df = spark.createDataFrame(list(enumerate(made)), "page_id int, html string")
    got = {}
    for row in extract_cards(df, SPECS[number], ["page_id"]).collect():
        got.setdefault(row["page_id"], []).append((row["pos"], tuple(row)[2:]))
    for page_id, markup in enumerate(made):
        assert [values for _, values in sorted(got.get(page_id, []), key=lambda x: x[0])] == by_tree(markup, SPECS[number]), markup


@pytest.mark.parametrize(
    "piece", ["<b></i>", '<div class="c">', "<li class=c>x", "<p><a href=/a>", '<div class="c"><b>x</b></div>', "<p></li></div>"]
)
def test_time_is_that_of_the_page(spark, piece):
    """200,000 stray, nested or repeated tags: far below what a square would take."""
    df = spark.createDataFrame([(piece * (200_000 // piece.count("<")),)], "html string")
    started = time.time()
    extract_cards(df, SPECS[1], []).count()
    assert time.time() - started < 15


ODD = [
    '<div class="c">', "<DIV CLASS='c x'>", "<p>", "<li class=c>", '<a href="/a/b">', "<a href='/a?x=1&amp;y'", '<a title="a<b>c">',
    '<a title="a', '"', "'", ">", "<", "/>", "<br/>", "<br />", "<script>", "<script>if (a < b & c) {}</Script >", "</script>",
    "<STYLE>x</style>", "<!-- a - b -->", "<!-- c", "-->", "<!--->", "<!DOCTYPE html>", "<!", "<?php", "<![CDATA[", "]]>", "</", "</>",
    "</p>", "</div>", "</a >", '</b x="1">', "&", "&amp;", "&lt", "&am", "text", " ", "\n", '<i class="x"/>', "<b\x0bc>", "<é>", '<a é="1">',
    "<title>x &amp; y</title>", "<title>", "<textarea>q</textarea>", '<td\n\tid="1"  class="n"\r>', '<tr a="1"b="2">', "<x-y>", "<plaintext>",
    "<input disabled>", "<a href=/a/b/>", '<a b="1" c d=x/>', '<a class="c" class="n">', "<a href=''>", "\x1c", "=", 'x="1"', "<script/>",
]


@pytest.mark.parametrize("number", range(3))
def test_plain_markup_is_read_as_the_parser_reads_it(number):
    pick, spec = random.Random(number), SPECS[number]
    names = [selector for selector, _ in spec.fields.values() if selector]
    selectors = html_cards._Selectors([spec.cards, spec.link_fallback or "", *names])

    def seen(reader):
        cards = [
            (n, c.element.attrs, c.element.pieces, [h and (h.attrs, h.pieces) for h in c.hits]) for n, c in reader.cards.items()
        ]
        return cards, reader.fallback, reader.texts, reader.count

    for _ in range(3000):
        markup = "".join(pick.choices(ODD, k=pick.randrange(40)))
        parsed = html_cards._CardReader(selectors, len(names), -1)
        parsed.feed(markup)
        parsed.finish()
        read = html_cards._CardReader(selectors, len(names), -1)
        read.read(markup)
        assert seen(read) == seen(parsed), markup


def test_plain_markup_needs_no_parser(monkeypatch):
    """Python's parser takes several times as long for a tag; a common page must not need it."""
    fed = []
    monkeypatch.setattr(HTMLParser, "feed", lambda self, data: fed.append(data))
    page = (
        "<!DOCTYPE html><html><head><title>T &amp; u</title><script src='a.js'>if (a < b) {}</script></head><!-- c --><body>"
        '<LI class="c x" data-id=7 hidden>t &lt; u<br/><img src="i.jpg" /><a href=\'/a?x&amp;y\'>A</a></LI></body></html>'
    )
    reader = html_cards._CardReader(html_cards._Selectors([".c", "", "a[href]"]), 1, -1)
    reader.read(page)
    assert fed == []
    (card,) = reader.cards.values()
    assert card.element.attrs == {"class": "c x", "data-id": "7", "hidden": ""}
    assert card.element.pieces == ["t < u", "A"] and card.hits[0].attrs == {"href": "/a?x&y"}
