import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingloom.llm import winnow

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        own = words(text)
        size = min(len(own), 10)
        for at in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[at : at + size]), set()).add("" if item_id is None else str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for at in range(len(own) - size + 1):
                if tuple(own[at : at + size]) in windows:
                    hit.update(range(at, at + size))
                    found |= windows[tuple(own[at : at + size])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    found = winnow.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    return sorted((tuple(r)[:6] for r in found.collect()), key=repr)


def test_same_as_brute_force(spark):
    """Few different words, so that runs repeat and windows are shared by chance and by copying."""
    pick = random.Random(5)
    vocabulary = ["a", "B", "c9", "éa", "Ü", "dd", "7"]
    marks = [" ", ", ", "\n", " -- ", "_"]

    def text(count):
        return "".join(pick.choice(vocabulary) + pick.choice(marks) for _ in range(count))

    items = [(n, text(pick.choice([1, 2, 3, 5, 9, 10, 11, 14, 30]) if n > 3 else 12)) for n in range(14)]
    items = [i for i in items if len(words(i[1])) != 1] + [(50, "onlyhere"), (50, "onlyhere"), (7, "a a a a a a a a a a a")]
    docs = [(n, text(pick.randrange(0, 90))) for n in range(60)]
    docs += [(100 + n, text(20) + pick.choice(items)[1].upper() + text(20)) for n in range(30)]
    docs += [(200, "b. OnlyHere! b"), (200, "b. OnlyHere! b")]
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("length", range(1, 11))
def test_every_shared_span_keeps_a_common_hash(length):
    draw = np.random.default_rng(length)
    span = draw.integers(0, 3, length).astype(np.uint64)
    for _ in range(50):
        a = np.concatenate([draw.integers(0, 3, draw.integers(0, 30)).astype(np.uint64), span, draw.integers(0, 3, 9).astype(np.uint64)])
        b = np.concatenate([draw.integers(0, 3, draw.integers(0, 30)).astype(np.uint64), span])
        assert set(winnow.winnow(a, length)[1].tolist()) & set(winnow.winnow(b, length)[1].tolist())
    long = draw.integers(0, 1 << 60, 10_000).astype(np.uint64)
    gram, width = winnow.scheme(length)
    kept, _ = winnow.winnow(long, length)
    assert len(kept) < 10_000 * 2.2 / (width + 1) and gram + width - 1 == length


def test_bitmap_of_any_size(spark):
    prints = [-(2**63), -5, 0, 3, 2**62 + 9]
    bits = winnow.bitmap_of(spark.createDataFrame([(p,) for p in prints], "print long"), 1 << 16)
    for cell in [p % (1 << 16) for p in prints] + [77, 40000]:
        assert bool(bits[cell >> 3] >> (cell & 7) & 1) == (cell in {p % (1 << 16) for p in prints})
    # A full bitmap tests nothing, and the join still decides.
    docs = spark.createDataFrame([(1, "x y z")], "doc_id long, text string")
    found = winnow.find_hits(docs, [2], np.full(1 << 13, 255, np.uint8))
    assert found.select(F.inline("hits")).count() >= 1


def test_nulls_empty_tables_long_texts_and_clashing_names(spark):
    long_item = " ".join(f"w{n}" for n in range(3000))
    docs = [(None, None, 1), (1, "", 1), (2, None, 1), (3, "  . ", 1), (4, long_item + " end", 1), (None, long_item, 1)]
    items = [(None, long_item, 5), (9, None, 5), (10, "", 5), (11, "..", 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, row int")
    listed = spark.createDataFrame(items, "item_id long, text string, window int")
    found = sorted((tuple(r)[:6] for r in winnow.contamination(df, listed).collect()), key=repr)
    assert found == brute([d[:2] for d in docs], [i[:2] for i in items])
    spans = winnow.contamination(df.where("doc_id = 4"), listed).first()["spans"]
    assert (spans[0]["start"], spans[-1]["start"], len(spans)) == (0, 2990, 2991)
    assert winnow.contamination(df.where("1 = 0"), listed).count() == 0
    assert winnow.contamination(df, listed.where("1 = 0")).where("contaminated").count() == 0


def test_text_ids_and_a_passage_in_most_documents_and_items(spark):
    passage = " ".join(f"p{n}" for n in range(12))
    docs = [(f"d{n}", f"own{n} {passage} tail{n}") for n in range(400)]
    items = [(n, f"{passage} item{n}") for n in range(300)]
    found = winnow.contamination(
        spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r["n_hit"], r["n_items"]) for r in found.collect()} == {(12, 300)}
