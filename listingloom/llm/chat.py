"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens the list to one string in which every attachment is an ordered
placeholder, and records what each placeholder refers to and how many tokens it
will take once expanded. Turns are then rendered with a template of control
strings. Control strings that occur in a role or a text get a tilde after their
first character, so the rendering can always be taken apart again.

All of it is column expressions: one shuffle by conversation, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("pages", T.LongType()),
    ]
)
ATTACHMENTS = ("image", "audio", "document")

TURN_OPEN, TEXT_OPEN, TEXT_CLOSE, TURN_CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: A control string, bare or with tildes; the tildes are the second group.
CONTROL = r"([<\[])(~*)(/?s>|/?INST\]|image>|audio>|document>)"
PLACEHOLDER = "<(image|audio|document)>"
ESCAPED = r"([<\[])~(~*)(/?s>|/?INST\]|image>|audio>|document>)"


@dataclass(frozen=True)
class TokenRule:
    """Tokens that a placeholder expands to.

    An image takes one token per started square of ``patch`` pixels, audio
    ``audio_rate`` per started second, a document ``page_tokens`` per page. A
    missing or negative measure counts as 0; every attachment takes one at least.
    """

    patch: int = 28
    audio_rate: int = 25
    page_tokens: int = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit("$1~$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def text_part(*texts: Column) -> Column:
    """A content list of text parts."""

    def part(text: Column) -> Column:
        values = {"kind": F.lit("text"), "text": text}
        return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PART])

    return F.array(*map(part, texts))


def _expanded(part: Column, rule: TokenRule) -> Column:
    def positive(value: Column) -> Column:
        return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))

    squares = F.ceil(positive(part["width"]) / rule.patch) * F.ceil(positive(part["height"]) / rule.patch)
    tokens = (
        F.when(part["kind"] == "image", squares)
        .when(part["kind"] == "audio", F.ceil(positive(part["seconds"])) * rule.audio_rate)
        .otherwise(positive(part["pages"]) * rule.page_tokens)
    )
    return F.greatest(tokens.cast("long"), F.lit(1).cast("long"))


def visit_parts(parts: Column, rule: TokenRule = TokenRule()) -> Column:
    """Struct of ``content`` (escaped text with placeholders) and ``attachments``.

    Attachments are structs of kind, ref and tokens in the order of their
    placeholders. A part of unknown or NULL kind is text; NULL text, NULL parts
    and a NULL list are empty. Neighbouring texts are joined before they are
    escaped, so a control string is one however it is cut into parts. Escaped text
    never forms a control string with the placeholder or template around it, as
    such a string has its bracket only in front.
    """
    parts = F.coalesce(parts, F.array().cast(T.ArrayType(PART)))
    known = F.filter(parts, lambda p: p.isNotNull())
    # Positions of the attachments, framed by the list's ends: between two of them lies one run of text parts.
    places = F.filter(
        F.transform(known, lambda p, i: F.when(p["kind"].isin(*ATTACHMENTS), i + 1)), lambda i: i.isNotNull()
    )
    ends = F.concat(F.array(F.lit(0)), places, F.array(F.size(known) + 1))

    def run(k: Column) -> Column:
        """The k-th run of text, escaped as one, and the placeholder that ends it."""
        begin, end = F.get(ends, k), F.get(ends, k + 1)
        texts = F.transform(F.slice(known, begin + 1, end - begin - 1), lambda p: F.coalesce(p["text"], F.lit("")))
        kind = F.get(known, end - 1)["kind"]
        mark = F.when(end <= F.size(known), F.concat(F.lit("<"), kind, F.lit(">"))).otherwise("")
        return F.concat(escape(F.array_join(texts, "")), mark)

    pieces = F.transform(F.sequence(F.lit(0), F.size(places)), run)
    attached = F.transform(
        F.filter(known, lambda p: F.coalesce(p["kind"].isin(*ATTACHMENTS), F.lit(False))),
        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _expanded(p, rule).alias("tokens")),
    )
    return F.struct(F.array_join(pieces, "").alias("content"), attached.alias("attachments"))


def format_chats(
    messages: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    trained_role: str = "assistant",
    rule: TokenRule = TokenRule(),
) -> DataFrame:
    """One row per conversation: its rendering, loss mask and attachments.

    Returns ``conv_id``, ``formatted``, ``loss_spans`` (start and length in code
    points of each trained text), ``attachments`` (turn_index, kind, ref, tokens;
    in placeholder order) and ``expanded_tokens`` (their sum).

    Turns are ordered by turn number, NULL first, ties by role and content. A
    NULL role is empty; repeated rows are turns of their own; rows without
    conversation id form one conversation. Other columns are ignored, whatever
    their names. No rows give no rows.
    """
    seen = visit_parts(F.col(parts), rule)
    rendered = messages.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        seen.alias("seen"),
    ).select(
        "conv_id",
        "turn",
        (F.col("role") == trained_role).alias("trained"),
        F.col("seen.attachments").alias("attachments"),
        F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(TEXT_OPEN)).alias("head"),
        F.concat(F.col("seen.content"), F.lit(TEXT_CLOSE + TURN_CLOSE)).alias("tail"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "head", "tail")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("tail")
    placed = rendered.select(
        "*",
        F.row_number().over(in_order).alias("at"),
        F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0).cast("long")).alias("start"),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "start", "trained", "head", "tail", "attachments"))).alias("turns")
    )
    closing = len(TEXT_CLOSE + TURN_CLOSE)
    spans = F.transform(
        F.filter("turns", lambda t: t["trained"]),
        lambda t: F.struct(
            (t["start"] + F.char_length(t["head"])).alias("start"),
            (F.char_length(t["tail"]) - closing).cast("long").alias("length"),
        ),
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attachments"],
                lambda a: F.struct(
                    (t["at"] - 1).alias("turn_index"),
                    a["kind"].alias("kind"),
                    a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["tail"])), "").alias("formatted"),
        spans.alias("loss_spans"),
        attached.alias("attachments"),
    ).withColumn(
        "expanded_tokens",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendering as structs of role and text (placeholders stay), unescaped."""
    pieces = F.split(formatted, TURN_CLOSE)
    bodies = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda t: F.substr(t, F.lit(len(TURN_OPEN) + 1)),
    )
    return F.transform(
        bodies,
        lambda t: F.struct(
            unescape(F.substring_index(t, TEXT_OPEN, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(t, TEXT_OPEN, -1), TEXT_CLOSE, 1)).alias("text"),
        ),
    )


def read_parts(formatted: Column) -> Column:
    """The turns of a rendering as structs of role and typed parts: the way back from the visitor.

    A part has ``kind``, ``text`` (of text parts) and ``place``, the number from 0
    of an attachment within its turn, in which order the rendering's attachments
    are listed. Neighbouring texts come back as one part, empty ones not at all. A
    literal ``<image>`` is text here, as its escape tells it from a placeholder.
    """
    pieces = F.split(formatted, TURN_CLOSE)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parts(body: Column) -> Column:
        texts = F.split(body, PLACEHOLDER)
        kinds = F.regexp_extract_all(body, F.lit(PLACEHOLDER), F.lit(1))
        both = F.transform(
            texts,
            lambda text, i: F.array(
                F.struct(F.lit("text").alias("kind"), unescape(text).alias("text"), F.lit(None).cast("int").alias("place")),
                F.struct(F.get(kinds, i).alias("kind"), F.lit(None).cast("string").alias("text"), i.alias("place")),
            ),
        )
        return F.filter(F.flatten(both), lambda p: p["kind"].isNotNull() & F.coalesce(p["text"] != "", F.lit(True)))

    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(F.substr(t, F.lit(len(TURN_OPEN) + 1)), TEXT_OPEN, 1)).alias("role"),
            parts(F.substring_index(F.substring_index(t, TEXT_OPEN, -1), TEXT_CLOSE, 1)).alias("parts"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text below the loss mask, unescaped, joined without separator."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )
