"""Filter interaction and source divergence, against their definitions."""

import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import numpy as np

from listingloom.llm import divergence, filters

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- filter interaction -------------------------------------------------------


def fails(docs):
    out = []
    for doc_id, text, _ in docs:
        said = text or ""
        words = SPACE.findall(said)
        out.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", said)) > 2 * len(said),
                "D": bool(re.search("[#$%&*|]", said)),
                "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == said for o, t, _ in docs),
            }
        )
    return out


def brute_audit(docs, labels):
    failing = fails(docs)
    out = []
    for part in {s or "" for _, _, s in docs}:
        own = [(d, f) for (d, _, s), f in zip(docs, failing) if (s or "") == part]
        removed_by = Counter()
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[letter]]
                kept = [(d, f) for d, f in left if not f[letter]]
                removed_by[letter] += len(gone)
                is_marked = lambda d, at: any(x[0] == d and d is not None and x[at] == 1 for x in labels)
                rows.append(
                    [
                        part, "".join(order), step, len(kept), len(gone),
                        sum(f[letter] for _, f in own) - len(gone),
                        sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                        sum(is_marked(d, 1) for d, _ in gone), sum(is_marked(d, 2) for d, _ in gone), letter,
                    ]
                )
                left = kept
        out += [tuple(r[:9] + [removed_by[r[9]]]) for r in rows]
    return sorted(out)


def test_audit_same_as_running_every_order(spark):
    pick = random.Random(2)
    texts = [
        " ".join(pick.choice(["one", "two", "#3", "UP", "é", f"w{n}"][: pick.randrange(1, 7)]) for n in range(size))
        for size in (0, 1, 150, 199, 200, 201, 400)
        for _ in range(3)
    ] + [None, "", " \x0b\x1c ", "x " * 199 + "a\x1cb " + "y", " ".join(f"v{n}" for n in range(300))]
    docs = [(n, pick.choice(texts), pick.choice([None, "", "s1", "s2"])) for n in range(150)]
    docs += [(3, docs[3][1], "s1"), (3, docs[3][1], "s2"), (None, texts[5], "s1"), (None, None, None), (900, texts[5], "only")]
    labels = [(n, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for n in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    found = filters.audit_documents(
        spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, source string, mask int"),
        spark.createDataFrame([(*x, 7) for x in labels], "doc_id long, quality int, toxic int, print int"),
    )
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute_audit(docs, labels)
    assert found.where("1 = 0").count() == 0


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id string, text string, source string")
    labels = spark.createDataFrame([], "doc_id string, quality int, toxic int")
    assert filters.audit_documents(docs, labels).count() == 0
    one = spark.createDataFrame([("a", "x", "s")], docs.schema)
    rows = filters.audit_documents(one, labels).collect()
    assert len(rows) == 600 and {r["good_lost"] for r in rows} == {0}


def test_paths_through_the_lattice():
    lattice = filters.Lattice("ABCD")
    for state in range(16):
        used = bin(state).count("1")
        assert (lattice.forward[state], lattice.backward[state]) == (factorial(used), factorial(4 - used))
    failing = np.arange(16, dtype=np.int64) ** 2
    kept = lattice.kept(failing)
    assert all(kept[s] == sum(failing[m] for m in range(16) if not m & s) for s in range(16))
    # Over all orders the filters together remove every failing row once an order.
    assert lattice.shapley(lattice.edges(kept)).sum() == 24 * failing[1:].sum()


# --- source divergence --------------------------------------------------------


def brute_divergence(docs):
    counts, holding, groups = {}, {}, set()
    for text, lang, source in docs:
        group = (lang or "", source or "")
        groups.add(group)
        terms = TERM.findall((text or "").translate(LOWER))
        counts.setdefault(group, Counter()).update(terms)
        holding.setdefault(group[0], Counter()).update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holding.get(lang, Counter()).items() if n >= 3]
        own = {s: counts.get((lang, s), Counter()) for x, s in groups if x == lang}
        everyone = sum(own.values(), Counter())

        def shares(count):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(everyone)
        for s in own:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:most]
                out += [(lang, s, part, item, value, n) for n, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def made_docs(pick, count, sources):
    vocabulary = [f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(400)] + ["É", "ß", "zz z", "ſ"]
    docs = []
    for _ in range(count):
        shift = pick.randrange(60)
        words = [vocabulary[min(int(pick.expovariate(0.02)) + shift, 403)] for _ in range(pick.randrange(40))]
        docs.append((pick.choice([" ", "1", "_\n"]).join(words).title(), pick.choice(["en", "de", None]), pick.choice(sources)))
    return docs


def test_divergence_same_as_dense_sums(spark, monkeypatch):
    pick = random.Random(8)
    docs = made_docs(pick, 500, ["a", "b", "c", None, "é"])
    docs += [("rare once", "xx", "a"), ("other", "xx", "b"), (None, "yy", "a"), ("12 34", "en", "wordless"), ("t t t", "zz", "one")]
    docs += [("same text", "dup", s) for s in ("a", "a", "b", "b")]
    for module_size in (500_000, 37):
        monkeypatch.setattr(divergence, "CHUNK", module_size)
        monkeypatch.setattr(divergence, "HELD", module_size)
        df = spark.createDataFrame([(*d, 1) for d in docs], "text string, lang string, source string, term int")
        got = sorted(tuple(r) for r in divergence.source_audit(df).collect())
        assert got == brute_divergence(docs)
    assert divergence.source_audit(df.where("1 = 0")).count() == 0


def test_top_terms_stop_at_their_number_and_ties_go_by_bytes(spark):
    words = [f"a{chr(0x61 + n % 26)}{chr(0x61 + n // 26 % 26)}" for n in range(300)]
    docs = [(" ".join(words), "en", "s")] * 3 + [("zzz " * 50, "en", "t")] * 3 + [("￿ \U00010000 zzz", "en", "u")] * 3
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.source_audit(df).collect())
    assert got == brute_divergence(docs)
    assert sum(r[1] == "s" and r[2] == "term" for r in got) == 200


def test_shares_of_very_many_words(spark):
    count, words, terms = 8 * 10**14, 9 * 10**15 - 10**6, 10**6
    df = spark.createDataFrame([(count, words, terms)], "c long, w long, t long")
    assert df.select(divergence.share(df.c, df.w, df.t)).first()[0] == 1 + 10**9 * (count + 1) // (words + terms)
