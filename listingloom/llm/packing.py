"""Packing documents into training sequences: concatenate and cut.

First pass: every task turns its documents into token ids, adds up their lengths
as it goes and stores ids and running totals. Second pass: the running totals of
the tasks give each one its place in the one stream of tokens, and every document
is cut where a multiple of the sequence length falls. Nothing is shuffled but one
total per task. All sequences but the last are full.

Tokenizers spend most of their time on words that they have seen before, so each
task remembers the ids of words, up to a fixed number of them.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom.llm.common import ship_by_value
from listingloom.storage import stage, work_dir

SEQUENCE = 4096
END_ID = 2
#: Words that a task remembers; beyond them it starts anew.
REMEMBERED = 200_000
BIG_ENDIAN = sys.byteorder == "big"
#: Marks that may close a word and never join its letters in one token.
MARKS = ".,!?;:$%&#*|\"()=+@-"
#: The pattern by which the lower-casing tokenizer cuts words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters below this one are the same in composed form, so a word of them is one piece for the model.
AFTER_LATIN = "\u0250"
#: Lower-casing a whole text treats the first two otherwise than one by one; the others part words in Python alone.
ODD_CASES = ("Σ", "İ", "\x1c", "\x1d", "\x1e", "\x1f")


class WordIds(dict):
    """Token ids of lower-case words as bytes, found on first use."""

    def __init__(self, tokenizer, kind: str) -> None:
        super().__init__()
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.code = "H" if kind == "<u2" else "I"
        # The model reads bytes as printable characters; the tokenizer itself says which.
        to_units = tokenizer.pre_tokenizer[1].pre_tokenize_str
        letters = filter(str.isalpha, map(chr, range(0x80, ord(AFTER_LATIN))))
        self.units = {ord(c): to_units(c)[0][0] for c in letters}

    def packed(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if BIG_ENDIAN:
            found.byteswap()
        return found.tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) < AFTER_LATIN):
            units = word if word.isascii() else word.translate(self.units)
            found = self.packed([t.id for t in self.tokenize(units)])
        else:
            letters = word.rstrip(MARKS)
            if letters != word and letters.isalpha():
                found = self[letters] + self[word[len(letters) :]]
            else:
                found = self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = found
        return found


class Encoder:
    """Ids of whole texts, the same as the tokenizer's own.

    Where its settings show that white space always parts tokens and case does not
    matter, words are looked up one by one; any other tokenizer gets whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 0x10000 else "<u4"
        self.words = WordIds(self.tokenizer, self.kind) if self._by_words() else None

    def _by_words(self) -> bool:
        given = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (given["normalizer"] or {}).get("normalizers", [])]
        cuts = (given["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": WORD_SPLIT}
            and cuts[0]["behavior"] == "Removed"
            and cuts[0]["invert"]
            and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"]
        )

    def ids(self, text: str) -> bytes:
        if self.words is None or any(c in text for c in ODD_CASES):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        if len(self.words) > REMEMBERED:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, text.lower().split()))


def in_small_batches(batches, rows: int = 1000):
    """The same rows in frames of at most ``rows``, so that results leave the worker early."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, part, before, tokens and ids of every document, stored.

    ``part`` is the task, ``before`` the tokens of the documents before it in that
    task, ``ids`` the packed unsigned ids with ``end_id`` last; their width is bytes
    over tokens. NULL text is empty and has ``end_id`` only.
    """

    def encode(batches):
        encoder = Encoder(tokenizer)
        end = np.array([end_id], encoder.kind).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in in_small_batches(batches):
            ids = [(encoder.ids(t) if isinstance(t, str) else b"") + end for t in batch["text"]]
            counts = np.array([len(x) for x in ids], np.int64) // len(end)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "part": part, "before": starts, "tokens": counts, "ids": ids}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = docs.select("doc_id", "text").mapInPandas(
        encode, f"doc_id {kind}, part int, before long, tokens long, ids binary"
    )
    target = work_dir(docs.sparkSession, "packing-ids")
    encoded.write.mode("errorifexists").option("compression", "zstd").parquet(target)
    return docs.sparkSession.read.schema(encoded.schema).parquet(target)


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where a run of a document's ids lies.

    Columns doc_id, start (the document's ids before the piece), length, ids
    (packed as stored), doc_tokens, sequence_id and offset. Sequences are numbered
    from 0 and filled from 0 without gaps. Repeated rows are packed each for
    itself, NULL ids too; a document of any length is cut as often as needed. No
    rows give no pieces.
    """
    encoded = tokenize(docs, tokenizer, end_id)
    totals = encoded.groupBy("part").agg(F.sum("tokens").alias("all"))
    # One row per task of the first pass.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        totals.select("part", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("ahead")), "packing-offsets"
    )
    placed = encoded.join(offsets, "part", "inner").select(
        "doc_id", (F.col("ahead") + F.col("before")).alias("at"), "tokens", "ids"
    )

    def cut(batches):
        for batch in in_small_batches(batches):
            out = []
            for doc_id, at, tokens, ids in zip(batch["doc_id"], batch["at"], batch["tokens"], batch["ids"]):
                width = len(ids) // tokens
                start = 0
                while start < tokens:
                    here = at + start
                    length = min(tokens - start, sequence - here % sequence)
                    piece = ids[start * width : (start + length) * width]
                    out.append((doc_id, start, length, piece, tokens, here // sequence, here % sequence))
                    start += length
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInPandas(
        cut,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


@F.pandas_udf(T.LongType())
def checksum(ids: pd.Series, length: pd.Series) -> pd.Series:
    """CRC-32 of the ids as unsigned little-endian 32-bit numbers."""
    return pd.Series(
        [
            zlib.crc32(np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes())
            for x, n in zip(ids, length)
        ],
        dtype="int64",
    )


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs, tokenizer).select(
        "doc_id",
        "start",
        "length",
        checksum("ids", "length").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


ship_by_value(__name__)
