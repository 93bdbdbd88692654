"""Benchmark decontamination by winnowing.

Every run of ``gram`` words is hashed, and of each ``width`` neighbouring hashes the
smallest is kept, the last one of equals. Two texts that share a span of
``gram + width - 1`` words hold the same hashes there, so they keep the same one:
with spans of the window's length no shared window can be missed, though only
about two in ``width + 1`` hashes are kept.

Kept hashes of documents are first tested against a bitmap of the items' hashes,
whose size is fixed, then joined with them. Each hit is extended: the windows of
words around it that hold it are compared with the items' windows as text. So a
hash of chance or a passage that many items share never pairs documents with
items; both meet on distinct windows, and documents with the same windows look
their items up together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.llm.jaccard import mix
from listingloom.storage import stage

#: Words of a window. An item of fewer words is one window.
WINDOW = 10
#: Bits of the items' bitmap, whatever their number; Spark's bitmaps hold 2^15 each.
FILTER_BITS = 1 << 25
BITMAP = 1 << 15

_HIT = pa.struct([("print", pa.int64()), ("length", pa.int32()), ("first", pa.int32()), ("near", pa.string())])


def _letters() -> bytes:
    """Maps UTF-8 bytes: digits, letters and all beyond ASCII stay, A-Z in lower case; the rest parts words."""
    return bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


LETTERS = _letters()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LETTERS).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def scheme(length: int) -> tuple[int, int]:
    """Words of a hashed run and runs of a sliding window, for shared spans of ``length`` words."""
    gram = (length + 1) // 2
    return gram, length - gram + 1


def winnow(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the kept hashes; none if there are fewer than ``length`` words."""
    gram, width = scheme(length)
    if len(hashes) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = len(hashes) - gram + 1
    total = np.full(runs, length, np.uint64)
    for k in range(gram):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : runs + k])
    # The smallest of each window, looked for from its end, so that the last of equals stays.
    at = np.arange(width - 1, runs)
    least = total[width - 1 :]
    for back in range(1, width):
        other = total[width - 1 - back : runs - back]
        less = other < least
        least = np.where(less, other, least)
        at = np.where(less, np.arange(width - 1 - back, runs - back), at)
    kept = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return kept, total[kept]


def describe_items(items: DataFrame) -> DataFrame:
    """Stored rows of items with words: item_id as text (NULL: empty), length of a window, prints, windows."""

    def read(batches):
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if not words:
                    continue
                length = min(len(words), WINDOW)
                _, prints = winnow(hashes_of(words), length)
                spans = [b" ".join(words[at : at + length]).decode() for at in range(len(words) - length + 1)]
                rows.append((item_id, length, prints.astype(np.int64).tolist(), sorted(set(spans))))
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["item_id", "length", "prints", "windows"]
            )

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return stage(
        named.mapInArrow(read, "item_id string, length int, prints array<long>, windows array<string>"), "winnow-items"
    )


def bitmap_of(prints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for the low part of each print. Its size does not depend on the number of prints."""
    cell = F.col("print").bitwiseAND(bits - 1) + 1
    pieces = (
        prints.groupBy(F.bitmap_bucket_number(cell).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bitmap"))
        .collect()
    )
    found = np.zeros(max(bits, BITMAP) // 8, np.uint8)
    for bucket, bitmap in pieces:
        found[(bucket - 1) * BITMAP // 8 : bucket * BITMAP // 8] = np.frombuffer(bitmap, np.uint8)
    return found


def find_hits(docs: DataFrame, lengths: list[int], bitmap: np.ndarray) -> DataFrame:
    """Stored row, doc_id, n_words and hits of every document.

    A hit is a kept hash whose bit is set, with the words that a window around it
    can hold (``near``, the first one's number in ``first``). ``row`` tells apart
    documents of one id; it is fixed once the table is written.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(bitmap)

    def hits(words: list[bytes]) -> list[tuple]:
        hashes = hashes_of(words)
        low = np.uint64(len(shared.value) * 8 - 1)
        found = []
        for length in lengths:
            gram, width = scheme(length)
            at, prints = winnow(hashes, length)
            cells = prints & low
            known = (shared.value[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1
            for place, value in zip(at[known].tolist(), prints[known].astype(np.int64).tolist()):
                first = max(place - width + 1, 0)
                near = b" ".join(words[first : place + length]).decode()
                found.append({"print": value, "length": length, "first": first, "near": near})
        return found

    def read(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = [words_of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + len(texts)), pa.int64()),
                    batch.column(0),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(map(hits, texts), pa.list_(_HIT)),
                ],
                ["row", "doc_id", "n_words", "hits"],
            )
            row += len(texts)

    shape = (
        f"row long, doc_id {kind}, n_words long, hits array<struct<print: long, length: int, first: int, near: string>>"
    )
    return stage(docs.select("doc_id", "text").mapInArrow(read, shape), "winnow-hits")


def covered(spans: Column) -> Column:
    """Number of words in the union of (start, length) spans."""
    sums = F.aggregate(
        F.sort_array(spans),
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("end")),
        lambda so_far, s: F.struct(
            (
                so_far["words"] + F.greatest(s["start"] + s["length"] - F.greatest(s["start"], so_far["end"]), F.lit(0))
            ).alias("words"),
            F.greatest(so_far["end"], s["start"] + s["length"]).alias("end"),
        ),
    )
    return sums["words"]


def extend(hits: DataFrame, known: DataFrame) -> DataFrame:
    """``row``, ``start``, ``length`` and ``window`` of every window of ``known`` around a hit."""
    words = F.split("near", " ")
    around = F.transform(
        F.sequence(F.lit(0), F.size(words) - F.col("length")),
        lambda i: F.struct(
            (F.col("first") + i).alias("start"),
            F.array_join(F.slice(words, i + 1, F.col("length")), " ").alias("window"),
        ),
    )
    windows = hits.select("row", "length", F.explode(around).alias("at")).select("row", "length", "at.start", "at.window")
    return windows.join(known, "window", "left_semi")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored. Words are runs of digits, letters and characters beyond ASCII, A-Z in
    lower case. A document word is hit if it lies in an occurrence of ten
    consecutive words of an item, or of all words of a shorter one. ``spans`` are
    the (start, length) of the occurrences, in words.

    NULL and empty texts have no words and no hits; repeated rows are documents of
    their own; items of one id count once, a NULL item id is the empty text. No
    documents give no rows, no items no hits.
    """
    described = describe_items(items)
    prints = described.select(F.explode("prints").alias("print")).distinct()
    # At most one row per window length.
    lengths = sorted(row["length"] for row in described.select("length").distinct().collect())
    found = find_hits(docs, lengths, bitmap_of(prints))

    by_window = described.select(F.explode("windows").alias("window"), "item_id").distinct()
    hits = found.select("row", F.inline("hits")).join(prints, "print", "left_semi")
    occurring = extend(hits, by_window.select("window").distinct())
    per_row = stage(
        occurring.groupBy("row").agg(
            F.collect_set(F.struct("start", "length")).alias("spans"),
            F.sort_array(F.collect_set("window")).alias("windows"),
        ),
        "winnow-rows",
    ).withColumn("seal", F.sha2(F.array_join("windows", "\n").cast("binary"), 256))

    # Copies and documents with the same passages look their items up once.
    alike = per_row.groupBy("seal").agg(F.any_value("windows").alias("windows"))
    their_items = (
        alike.select("seal", F.explode("windows").alias("window"))
        .join(by_window, "window", "inner")
        .groupBy("seal")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .select(
            "seal",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        )
    )
    hit_rows = per_row.join(their_items, "seal", "inner").select(
        "row", F.sort_array("spans").alias("spans"), covered(F.col("spans")).alias("n_hit"), "n_items", "items_sha256"
    )
    none = F.lit(0).cast("long")
    return (
        found.select("row", "doc_id", "n_words")
        .join(hit_rows, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", none).alias("n_hit"),
            F.coalesce("n_items", none).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
            "spans",
        )
    )


ship_by_value(__name__)
