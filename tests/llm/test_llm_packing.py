import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingloom.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    found = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    found.encode_special_tokens = True
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


TEXTS = [
    None, "", " \n", "one", "It's 12.5% naïve— ΣΑΣ İx <|endoftext|>!", "word " * 9_000, "x" * 3_000, "é́ ǆ ŉa ẞ",
    "don't!!! stop... (now)", "日本語 текст mixed", "same", "same", "\x00\x1f a b c",
]


def check(rows, pieces, plain, sequence):
    at = {}
    for p in pieces:
        at.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sorted(at) == list(range(len(at)))
    for number, own in at.items():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end == sequence or number == len(at) - 1
    expected = sorted(zlib.crc32(np.array(plain(t), "<u4").tobytes()) for _, t in rows)
    stream = {}
    for p in pieces:
        width = len(p["ids"]) // p["length"]
        ids = np.frombuffer(p["ids"], f"<u{width}").astype("<u4")
        stream[p["sequence_id"] * sequence + p["offset"]] = (p, ids)
    got, held = [], []
    for place in sorted(stream):
        p, ids = stream[place]
        assert p["start"] == sum(map(len, held))
        held.append(ids)
        if p["start"] + p["length"] == p["doc_tokens"]:
            got.append(zlib.crc32(np.concatenate(held).tobytes()))
            held = []
    assert not held and sorted(got) == expected


@pytest.mark.parametrize("sequence", [4096, 64])
def test_documents_come_back_whole(spark, plain, sequence):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "one")]
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", part int").repartition(4)
    pieces = packing.pack(df, public.path("word_bpe_49k.json"), sequence).collect()
    check(rows, pieces, plain, sequence)


def test_other_tokenizer_gets_whole_texts(spark):
    path = public.path("byte_bpe_50k.json")
    own = tokenizers.Tokenizer.from_file(path)
    own.encode_special_tokens = True
    rows = list(enumerate(TEXTS))
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), path, 128).collect()
    check(rows, pieces, lambda t: [*own.encode(t or "", add_special_tokens=False).ids, packing.END_ID], 128)


def test_query_columns_and_empty_table(spark, plain):
    df = spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA)
    found = packing.pieces(df, public.path("word_bpe_49k.json"))
    row = found.where("doc_id = 3").first()
    assert row["ids_crc32"] == zlib.crc32(np.array(plain("one"), "<u4").tobytes())
    assert packing.pieces(df.where(F.lit(False)), public.path("word_bpe_49k.json")).count() == 0
