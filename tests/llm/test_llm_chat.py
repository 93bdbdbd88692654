import hashlib
import random

from pyspark.sql import functions as F

from listingloom.llm import chat


def formatted(spark, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    return chat.format_chats(df.withColumn("parts", chat.text_part(F.col("text"))))


def test_round_trip_of_hostile_texts(spark):
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "~", "<", "[", "<~s>", "[~~/INST]", "<image>", "é😀", "\n", "", "x"]
    pick = random.Random(3)
    rows = [
        (conv, turn, pick.choice(["user", "assistant", "<s>odd\n[INST]", None]), "".join(pick.choices(pieces, k=9)))
        for conv in range(60)
        for turn in range(4)
    ]
    done = formatted(spark, rows)
    read = done.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()
    for row in read:
        own = [(r or "", t) for c, _, r, t in rows if c == row["conv_id"]]
        assert [tuple(t) for t in row["turns"]] == own
        assert row["loss"] == "".join(t for r, t in own if r == "assistant")


def test_parts_become_ordered_placeholders(spark):
    part = lambda kind, **kw: {
        **dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages")), "kind": kind, **kw
    }
    parts = [
        part("text", text="see <image> "),
        part("image", ref="a.png", width=56, height=57),
        part("audio", ref="b.wav", seconds=1.5),
        None,
        part(None, text="end"),
        part("document", ref=None, pages=3),
        part("image", ref="tiny", width=None, height=-4),
    ]
    schema = "conv_id long, turn long, role string, parts " + chat.T.ArrayType(chat.PART).simpleString()
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])]
    row = chat.format_chats(spark.createDataFrame(rows, schema)).first()
    assert row["formatted"] == (
        "<s>user[INST]see <~image> <image><audio>end<document><image>[/INST]</s>"
        "<s>assistant[INST][/INST]</s><s>user[INST][/INST]</s>"
    )
    assert [tuple(a) for a in row["attachments"]] == [
        (0, "image", "a.png", 6), (0, "audio", "b.wav", 50), (0, "document", None, 3072), (0, "image", "tiny", 1),
    ]
    assert row["expanded_tokens"] == 6 + 50 + 3072 + 1
    start = row["loss_spans"][0]["start"]
    assert row["formatted"][:start].endswith("<s>assistant[INST]")


def test_control_strings_cut_over_parts(spark):
    """Any cut of hostile texts, attachments in between, comes back as the same parts."""
    pieces = ["<", "/s>", "s>", "[", "INST]", "/INST]", "~", "<s>", "</s>", "[/INST]", "image>", "<image>", "<~", "é", ""]
    pick = random.Random(11)
    blank = dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages"))
    rows = []
    for conv in range(80):
        parts = [
            {**blank, "kind": pick.choice(["text", None, "odd"]), "text": pick.choice([*pieces, None])}
            if pick.random() < 0.8
            else {**blank, "kind": pick.choice(chat.ATTACHMENTS), "ref": f"r{conv}"}
            for _ in range(pick.randrange(12))
        ]
        rows += [(conv, turn, "us<er", parts if turn == 0 else [{**blank, "kind": "text", "text": "</s>"}]) for turn in (0, 1)]
    rows.append((900, 0, "user", [{**blank, "kind": "text", "text": t} for t in ("<", "/s>")]))
    schema = "conv_id long, turn long, role string, parts " + chat.T.ArrayType(chat.PART).simpleString()
    done = chat.format_chats(spark.createDataFrame(rows, schema))
    for row in done.select("conv_id", chat.read_parts(F.col("formatted")).alias("turns"), "attachments").collect():
        given = [r for r in rows if r[0] == row["conv_id"]]
        assert len(row["turns"]) == len(given)
        for number, (turn, (_, _, role, parts)) in enumerate(zip(row["turns"], given)):
            expected, place = [], 0
            for p in parts:
                if p["kind"] in chat.ATTACHMENTS:
                    expected.append((p["kind"], None, place))
                    place += 1
                elif expected and expected[-1][0] == "text":
                    expected[-1] = ("text", expected[-1][1] + (p["text"] or ""), None)
                else:
                    expected.append(("text", p["text"] or "", None))
            assert (turn["role"], [tuple(p) for p in turn["parts"]]) == (role, [p for p in expected if p[1] != ""])
            assert [a["kind"] for a in row["attachments"] if a["turn_index"] == number] == [k for k, _, at in expected if at is not None]


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    long_text = "wörd </s> " * 30_000
    rows = [
        (None, 0, "user", "no id", "x"),
        (1, None, "assistant", None, "y"),
        (1, 0, "user", "same", "z"),
        (1, 0, "user", "same", "z"),
        (2, 0, "assistant", long_text, "z"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_chats(df.withColumn("parts", chat.text_part(F.col("text"))))
    found = {r["conv_id"]: r for r in done.collect()}
    assert set(found) == {None, 1, 2}
    assert found[1]["formatted"] == "<s>assistant[INST][/INST]</s>" + "<s>user[INST]same[/INST]</s>" * 2
    two = done.where("conv_id = 2").select(chat.read_loss(F.col("formatted"), F.col("loss_spans"))).first()[0]
    assert hashlib.sha256(two.encode()).digest() == hashlib.sha256(long_text.encode()).digest()
    assert done.where("1 = 0").count() == 0
    assert formatted(spark, []).count() == 0
