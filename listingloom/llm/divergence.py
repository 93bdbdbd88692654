"""Where the sources of a language differ in their words.

Each group, a source of a language, has a smoothed share p for every kept term of
the language, in billionths; a term it lacks has the group's base share. Groups
are compared term by term with f(p, q) = floor((p - q)^2 / q), summed.

The sum over all terms of two groups g and h is split by which of them hold a term:

    V f(bg, bh)  +  sum over g of [f(p, bh) - f(bg, bh)]  +  sum over h of [f(bg, q) - f(bg, bh)]
                 +  sum over both of [f(p, q) - f(p, bh) - f(bg, q) + f(bg, bh)]

The first three need no term of the other side: p depends on a count only, so a
histogram of g's shares against the bases of its peers gives them. The last one
is Gustavson's row accumulation. In the term-major index every group scatters its
terms through their posting lists into one dense accumulator over its peers, chunk
by chunk; sums leave a task, pairs of postings never do. All of it is integers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.storage import stage

#: A term is kept if so many documents of its language hold it.
LEAST_DOCUMENTS = 3
#: Terms listed for a group.
TOP_TERMS = 200
#: Entries that a task counts before it hands them on, and postings of the index taken at once.
HELD, CHUNK = 200_000, 500_000
#: Files of the table of groups.
GROUP_FILES = 16
PAIRS = "lang string, source string, item string, value long"


def _letters() -> bytes:
    """Maps UTF-8 bytes: a-z and all beyond ASCII stay, A-Z in lower case; the rest parts terms."""
    return bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in bytes(range(256)).lower())


LETTERS = _letters()


def named(docs: DataFrame) -> DataFrame:
    """lang and source of every document, NULL as empty, and its text."""
    return docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text"
    )


def count_terms(docs: DataFrame) -> DataFrame:
    """Partial counts: lang, source, term, count (occurrences), docs (documents that hold it).

    A task adds up what it reads in tables of bounded size, so frequent terms leave
    it once for each of them.
    """
    names = ["lang", "source", "term", "count", "docs"]

    def flush(held):
        for (lang, source), (count, docs_with) in held.items():
            terms = list(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                    pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(count.values(), pa.int64()),
                    pa.array(map(docs_with.__getitem__, terms), pa.int64()),
                ],
                names,
            )

    def read(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms = (text or "").encode("utf-8", "replace").translate(LETTERS).split()
                if not terms:
                    continue
                count, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(count)
                count.update(terms)
                docs_with.update(set(terms))
                size += len(count) - before
                if size >= HELD:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return docs.mapInArrow(read, "lang string, source string, term string, count long, docs long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, words: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (words + terms)), by long division in steps of a thousand.

    So numbers stay below 2^63 for up to 9 * 10^15 words.
    """
    whole = words + terms
    rest = count + 1
    digits = []
    for _ in range(3):
        digits.append(_div(rest * 1000, whole))
        rest = (rest * 1000) % whole
    return 1 + digits[0] * 1_000_000 + digits[1] * 1_000 + digits[2]


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def term_index(docs: DataFrame) -> DataFrame:
    """Stored lang, term, total (occurrences) and postings (source, count) of every kept term.

    One shuffle by language and term serves all three steps. A posting list is at
    most as long as the language has sources.
    """
    by_term = count_terms(docs).repartition("lang", "term")
    per_source = by_term.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    index = (
        per_source.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("count").alias("total"),
            F.collect_list(F.struct("source", "count")).alias("postings"),
        )
        .where(F.col("docs") >= LEAST_DOCUMENTS)
    )
    return stage(index.drop("docs"), "divergence-index")


def group_sizes(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Stored lang, source, words, terms, lang_words and base of every group, those without a kept term included.

    ``terms`` counts the language's kept terms, ``base`` is the share of a term that
    the group lacks (NULL where nothing is kept).
    """
    counted = (
        index.select("lang", F.inline("postings")).groupBy("lang", "source").agg(F.sum("count").alias("words"))
    )
    kept = index.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_words"))
    none = F.lit(0).cast("long")
    sizes = (
        docs.select("lang", "source")
        .distinct()
        .join(counted, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("words", none).alias("words"),
            F.coalesce("terms", none).alias("terms"),
            F.coalesce("lang_words", none).alias("lang_words"),
        )
    )
    base = F.when(F.col("terms") > 0, share(none, F.col("words"), F.col("terms")))
    # A row per source: a few files are enough, whatever the number of partitions.
    return stage(sizes.withColumn("base", base).coalesce(GROUP_FILES), "divergence-groups")


def shares(index: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, term, source, p, base and q (the language's share) of every posting.

    Not stored: working a share out again is cheaper than writing and reading it.
    """
    rows = index.select("lang", "term", "total", F.inline("postings"))
    return rows.join(groups, ["lang", "source"], "inner").select(
        "lang",
        "term",
        "source",
        share(F.col("count"), F.col("words"), F.col("terms")).alias("p"),
        "base",
        share(F.col("total"), F.col("lang_words"), F.col("terms")).alias("q"),
    )


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def scatter(starts: np.ndarray, source: np.ndarray, p: np.ndarray, base: np.ndarray, peers: int):
    """Per group of a chunk, its dense accumulator over ``peers`` and which of them it met.

    The chunk is term-major: postings from ``starts[t]`` to ``starts[t + 1]`` belong
    to term t. For each posting of a group the whole list of its term is visited.
    """
    term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(source, kind="stable")
    bounds = np.searchsorted(source[order], np.arange(peers + 1))
    for group in range(peers):
        own = order[bounds[group] : bounds[group + 1]]
        if not len(own):
            continue
        first, length = starts[term[own]], np.diff(starts)[term[own]]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(first - (ends - length), length)
        mine, bottom = np.repeat(p[own], length), base[own[0]]
        value = _f(mine, p[at]) - _f(mine, base[at]) - _f(bottom, p[at]) + _f(bottom, base[at])
        sums = np.zeros(peers, np.int64)
        np.add.at(sums, source[at], value)
        met = np.zeros(peers, bool)
        met[source[at]] = True
        met[group] = False
        yield group, sums, met


def common_terms(postings: DataFrame) -> DataFrame:
    """The last part of the sum for pairs of groups with a term in common, not yet added up over chunks."""

    def accumulate(chunk: pa.Table):
        lang, term, source = (chunk.column(c).combine_chunks() for c in ("lang", "term", "source"))
        p, base = (chunk.column(c).to_numpy() for c in ("p", "base"))
        lang_code, codes = lang.dictionary_encode(), source.dictionary_encode()
        langs, names = lang_code.dictionary.to_pylist(), codes.dictionary
        lang_at, code = lang_code.indices.to_numpy(), codes.indices.to_numpy()
        term_at = term.dictionary_encode().indices.to_numpy()
        new = np.concatenate([[True], (term_at[1:] != term_at[:-1]) | (lang_at[1:] != lang_at[:-1])])
        starts = np.append(np.flatnonzero(new), len(new))
        for number, name in enumerate(langs):
            # Rows are sorted by language, so those of one are neighbours.
            low, high = np.searchsorted(lang_at, [number, number + 1])
            used, local = np.unique(code[low:high], return_inverse=True)
            inner = starts[(starts >= low) & (starts <= high)] - low
            for group, sums, met in scatter(inner, local, p[low:high], base[low:high], len(used)):
                item = names.take(pa.array(used[met]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(name, pa.string()), len(item)),
                        pa.repeat(pa.scalar(names[int(used[group])].as_py(), pa.string()), len(item)),
                        item,
                        pa.array(sums[met], pa.int64()),
                    ],
                    ["lang", "source", "item", "value"],
                )

    def read(batches):
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                rows = pa.Table.from_batches(waiting)
                # The last term may go on in the next batch.
                last = rows.slice(rows.num_rows - 1).select(["lang", "term"]).to_pylist()[0]
                keep = rows.num_rows
                while keep and rows.slice(keep - 1, 1).select(["lang", "term"]).to_pylist()[0] == last:
                    keep -= 1
                if keep:
                    yield from accumulate(rows.slice(0, keep))
                rest = rows.slice(keep)
                waiting, size = rest.to_batches(), rest.num_rows
        if size:
            yield from accumulate(pa.Table.from_batches(waiting))

    term_major = postings.select("lang", "term", "source", "p", "base").repartition("lang", "term")
    return term_major.sortWithinPartitions("lang", "term").mapInArrow(read, PAIRS)


def lone_terms(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """The first three parts of the sum, for every pair of groups of a language.

    A group's histogram has at most as many shares as it has different counts,
    about the root of twice its words; its peers' bases are one array a language,
    the width of the dense accumulator.
    """
    histogram = (
        postings.groupBy("lang", "source", "p")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "source")
        .agg(F.collect_list("p").alias("p"), F.collect_list("n").alias("n"))
    )
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "base")).alias("peers"))
    rows = groups.join(histogram, ["lang", "source"], "left").join(peers, "lang", "inner")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                others = [x for x in row["peers"] if x["source"] != row["source"]]
                if not others:
                    continue
                there = np.zeros(len(others), np.int64)
                back = np.zeros(len(others), np.int64)
                if row["terms"]:
                    bases = np.array([x["base"] for x in others], np.int64)
                    own = np.int64(row["base"])
                    p, n = np.array(row["p"] or [], np.int64), np.array(row["n"] or [], np.int64)
                    there += row["terms"] * _f(own, bases)
                    block = max(1, 500_000 // len(others))
                    for at in range(0, len(p), block):
                        each, times = p[at : at + block, None], n[at : at + block, None]
                        there += (times * (_f(each, bases) - _f(own, bases))).sum(axis=0)
                        back += (times * (_f(bases, each) - _f(bases, own))).sum(axis=0)
                names = pa.array([x["source"] for x in others], pa.string())
                lang = pa.repeat(pa.scalar(row["lang"], pa.string()), len(others))
                me = pa.repeat(pa.scalar(row["source"], pa.string()), len(others))
                columns = ["lang", "source", "item", "value"]
                yield pa.RecordBatch.from_arrays([lang, me, names, pa.array(there)], columns)
                yield pa.RecordBatch.from_arrays([lang, names, me, pa.array(back)], columns)

    return rows.select("lang", "source", "terms", "base", "p", "n", "peers").mapInArrow(read, PAIRS)


def source_audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank of every group.

    Part ``pair`` holds every other source of the language with the group's
    divergence from it, all ranks. Part ``term`` holds the terms that the group
    uses more than its language does, with their share of the divergence from it,
    the first 200. Ranks go by value, highest first, then by item.

    ``docs`` has text, lang and source, all NULLs as empty texts; other columns are
    ignored, and repeated rows are documents of their own. Terms are runs of
    letters and characters beyond ASCII, A-Z in lower case; those in fewer than
    three documents of a language are left out. A language without kept terms has
    pairs of value 0. No documents give no rows.
    """
    said = named(docs)
    index = term_index(said)
    groups = group_sizes(said, index)
    postings = shares(index, groups)
    pairs = (
        common_terms(postings)
        .unionByName(lone_terms(postings, groups))
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    terms = postings.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair_ranks = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    term_ranks = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pair_ranks.unionByName(term_ranks.where(F.col("rank") <= TOP_TERMS))


ship_by_value(__name__)
