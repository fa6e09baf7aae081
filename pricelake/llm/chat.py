"""Chat formatting with typed content parts.

A message holds parts in order: text, image, audio or document. The visitor writes text as it is, with control strings escaped, and
each other part as a placeholder of its type; the attachments are numbered in the order of their placeholders, with the attachment's reference and
the tokens that it will take once expanded. A turn is ``<|turn|>role\\ntext<|end|>\\n``; the role is percent-encoded. The loss mask is the list of spans of the
assistant's content in the formatted text.

Escaping: control strings are ``<|``, ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``, each perhaps with tildes after its first
character; one tilde is put there, and taken away when reading. So no text holds a control string, and reading gives back
every text exactly.

Defined cases: null texts, roles and parts are empty; a part of any other type has the placeholder ``<|other|>`` and no tokens, so no type can be
read as a control string, and its type is kept in the list of attachments; a part without a type is text; rows of a conversation are ordered by turn (null first), then role, then
text, so equal turns have one order; rows without a conversation id are one conversation without id; a conversation is one
value by nature, and nothing else is gathered; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, END = "<|turn|>", "<|end|>\n"
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
#: Pixels on a side of an image patch, audio tokens per second, tokens per document page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 600


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<(~*)(\||/?s>)", "<~$1$2"), r"\[(~*)(/?INST\])", "[~$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\[~(~*)(/?INST\])", "[$1$2"), r"<~(~*)(\||/?s>)", "<$1$2")


def text_parts(messages: DataFrame) -> DataFrame:
    """Messages with a plain ``text`` as messages with ``parts``."""
    none = {f: F.lit(None).cast(t) for f, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    part = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), *(v.alias(k) for k, v in none.items()))
    return messages.withColumn("parts", F.array(part))


def _tokens(part: Column) -> Column:
    """Tokens that an attachment takes once expanded."""
    side = lambda c: F.ceil(F.coalesce(part[c], F.lit(0)) / PATCH)
    return (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
        .otherwise(0).cast("long")
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _placeholder(part: Column) -> Column:
    return F.when(part["type"].isin("image", "audio", "document"), part["type"]).otherwise("other")


def visit(messages: DataFrame) -> DataFrame:
    """Add ``content`` (flattened, escaped) and ``attachments`` (order, type, ref, tokens) to (conv_id, turn, role, parts)."""
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    rows = messages.withColumn("parts", parts)
    written = F.transform(
        "parts",
        lambda p: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _placeholder(p), F.lit("|>"))),
    )
    media = F.filter("parts", lambda p: ~_is_text(p))
    listed = F.transform(
        media, lambda p, i: F.struct(i.cast("long").alias("order"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))
    )
    return rows.withColumns({"content": F.array_join(written, ""), "attachments": listed})


def format_chats(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss, attachments, attachment_tokens): one row per conversation of (conv_id, turn, role, parts).

    ``loss``: array of (start, length) in code points from 0. ``attachments`` are numbered through the conversation in order.
    """
    seen = visit(messages).withColumn("role", F.coalesce("role", F.lit("")))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "content", "attachments")))
    rows = seen.groupBy("conv_id").agg(turns.alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), F.url_encode(t["role"]), F.lit("\n"))
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(head(t), t["content"], F.lit(END)).alias("text"), F.length(head(t)).alias("head"),
            F.length(t["content"]).alias("body"), (t["role"] == learn).alias("learn"),
        ),
    )
    rows = rows.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        span = F.array(F.struct((s["at"] + p["head"]).alias("start"), p["body"].alias("length")))
        return F.struct(
            (s["at"] + p["head"] + p["body"] + len(END)).alias("at"),
            F.when(p["learn"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"),
        )

    spans = F.aggregate("pieces", start, step, lambda s: s["spans"])
    media = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    numbered = F.transform(media, lambda a, i: F.struct(i.cast("long").alias("order"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    return rows.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), spans.alias("loss"), numbered.alias("attachments"),
        F.aggregate(media, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted conversation; placeholders of attachments stay in the text."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p, i: i > 0)
    role = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substr(p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - len(END))
    return F.transform(pieces, lambda p: F.struct(F.url_decode(role(p)).alias("role"), unescape(body(p)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")
