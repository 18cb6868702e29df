"""Chat formatting: typed content parts, flattened into text, placeholders and a loss mask.

A message has parts (kind, text, ref, units). The visitor below turns each into a string: text is
escaped, an attachment becomes a numbered placeholder and a record with its reference and the
tokens it will take in the model's input. Only SQL functions are used.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "\n", "<|end|>"
# Escapes of control strings: fixed values of this template, the escape character itself first.
ESCAPES = [
    ("~", "~0"), ("<|", "~1"), ("[INST]", "~2"), ("[/INST]", "~3"), ("<s>", "~4"), ("</s>", "~5"),
]
LINE_ESCAPE = ("\n", "~6")
# Tokens an attachment takes: a fixed start and a rate per unit (image tile, second, page).
EXPANSION = {"image": (1, 256), "audio": (2, 25), "document": (2, 640)}
PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column, one_line: bool = False) -> Column:
    """Text in which no control string of the template can occur; `unescape` gives it back."""
    for plain, code in ESCAPES + [LINE_ESCAPE] * one_line:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Every `~` in escaped text starts a code, so codes are replaced one kind at a time, `~` last."""
    for plain, code in [LINE_ESCAPE, *ESCAPES[::-1]]:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """Parts of a message that is plain text; a null text is an empty one."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(PARTS)


def _attachment_tokens(part: Column) -> Column:
    tokens = F.lit(0).cast("bigint")
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))
    for kind, (fixed, rate) in EXPANSION.items():
        tokens = F.when(part["kind"] == kind, (units * rate + fixed).cast("bigint")).otherwise(tokens)
    return tokens


def _is_text(part: Column) -> Column:
    return ~F.coalesce(part["kind"].isin(*EXPANSION), F.lit(False))


def visit_parts(messages: DataFrame) -> DataFrame:
    """Adds `body`, the flattened parts, and `attachments` of every message.

    A part of an unknown or null kind counts as text, a null text as an empty one, null parts as none.
    """
    parts = F.coalesce(F.filter("parts", lambda p: p.isNotNull()), F.array().cast(PARTS))
    staged = messages.withColumn("parts", parts)
    attached = F.filter("parts", lambda p: ~_is_text(p))
    records = F.transform(
        attached,
        lambda p, i: F.struct(
            (i + 1).alias("place"),
            p["kind"].alias("kind"),
            p["ref"].alias("ref"),
            _attachment_tokens(p).alias("tokens"),
        ),
    )
    body = F.array_join(
        F.transform(
            "parts",
            lambda p: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
                F.concat(F.lit("<|"), p["kind"], F.lit(":"), _attachment_tokens(p), F.lit("|>"))
            ),
        ),
        "",
    )
    return staged.withColumn("body", body).withColumn("attachments", records)


def format_chats(messages: DataFrame, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation from messages (conv_id, turn, role, parts).

    `formatted` is every turn as <|turn|>role, a line break, the flattened parts and <|end|>.
    `loss_spans` holds start and length, in code points, of what the trained roles say;
    `attachments` what placeholders stand for, in order, with the number of their turn;
    `expanded_tokens` the tokens they take. Turns that share a number go by role and content.
    Null conversation ids are one conversation, null turns come first, null roles are empty.
    Rows are formatted before they are shuffled, by conversation once; a conversation is one value and so ends
    up in one task, whose memory (and 2 GB) it must fit.
    """
    visited = visit_parts(messages)
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(TURN), escape(role, one_line=True), F.lit(BODY))
    pieces = visited.select(
        "conv_id",
        "turn",
        F.concat(head, "body", F.lit(END)).alias("piece"),
        F.length(head).cast("bigint").alias("before"),
        F.length("body").cast("bigint").alias("inside"),
        role.isin(*trained).alias("trained"),
        "attachments",
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "piece")
    placed = pieces.withColumn("nr", F.row_number().over(order)).withColumn(
        "start",
        F.coalesce(
            F.sum(F.length("piece").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).cast("bigint"),
    )
    turns = placed.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("nr", "piece", "start", "before", "inside", "trained", "attachments"))
        ).alias("t")
    )
    spans = F.transform(
        F.filter("t", lambda t: t["trained"]),
        lambda t: F.struct((t["start"] + t["before"]).alias("start"), t["inside"].alias("length")),
    )
    attachments = F.flatten(
        F.transform(
            "t",
            lambda t: F.transform(
                t["attachments"],
                lambda a: F.struct(t["nr"].alias("turn_nr"), a["place"], a["kind"], a["ref"], a["tokens"]),
            ),
        )
    )
    return turns.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn(
        "expanded_tokens",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]),
    )


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, unescaped; placeholders stay in the text."""
    turns = F.filter(F.split(formatted, r"<\|turn\|>"), lambda t, i: i > 0)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(t, BODY, 1)).alias("role"),
            unescape(
                F.substring(
                    F.substring(t, F.instr(t, BODY) + 1, F.length(t)),
                    F.lit(1),
                    F.length(t) - F.instr(t, BODY) - len(END),
                )
            ).alias("text"),
        ),
    )


def read_loss_text(formatted: str, spans: str) -> Column:
    """What the spans cover, unescaped, one after another.

    Code points are cut from a fixed-width encoding, so a conversation takes linear time; the
    mark in front of each cut keeps the decoder from taking a text's own first character as one.
    """
    wide = F.encode(F.col(formatted), "UTF-32")
    mark = F.unhex(F.lit("0000FEFF"))
    # The wide form is an element of an array, computed once and not per span.
    return F.array_join(
        F.flatten(
            F.transform(
                F.array(wide),
                lambda w: F.transform(
                    F.col(spans),
                    lambda s: unescape(
                        F.decode(
                            F.concat(
                                mark,
                                F.substring(
                                    w, (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")
                                ),
                            ),
                            "UTF-32",
                        )
                    ),
                ),
            )
        ),
        "",
    )


def chat_digests(chats: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    told = F.array_join(
        F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    read = chats.withColumn("_turns", read_turns(F.col("formatted"))).withColumn(
        "_loss", read_loss_text("formatted", "loss_spans")
    )
    return read.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
        "expanded_tokens",
    )
