import hashlib

from pyspark.sql import functions as F

from llm.chat import PARTS, chat_digests, escape, format_chats, read_turns, text_part, unescape

ROWS = "conv_id bigint, turn bigint, role string, text string"


def chats(spark, rows):
    messages = spark.createDataFrame(rows, ROWS).withColumn("parts", text_part(F.col("text")))
    return format_chats(messages)


def test_escape_is_reversible(spark):
    texts = ["", "~", "~1", "~~0", "<|turn|>", "<|end|>x", "</s>[INST] ok [/INST]", "<s>", "~<|~", "<~|", "a\n~6", "<<|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", escape(F.col("t"), True).alias("e"), unescape(escape(F.col("t"), True)).alias("u")).collect():
        assert row["u"] == row["t"]
        assert not any(x in row["e"] for x in ("<|", "[INST]", "[/INST]", "</s>", "<s>", "\n"))


def test_turns_and_loss_are_read_back(spark):
    rows = [
        (1, 2, "assistant", "﻿zwei 𝄞 <|end|>"), (1, 1, "user", "eins\n"), (1, 3, "assistant", None),
        (2, 1, "us\ner", "x"), (None, None, None, "null"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"),
    ]
    out = {r["conv_id"]: r for r in chat_digests(chats(spark, rows)).collect()}

    def digest(turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    assert out[1]["turns_sha256"] == digest([("user", "eins\n"), ("assistant", "﻿zwei 𝄞 <|end|>"), ("assistant", "")])
    assert out[1]["loss_sha256"] == hashlib.sha256("﻿zwei 𝄞 <|end|>".encode()).hexdigest()
    assert (out[1]["n_turns"], out[1]["loss_chars"]) == (3, len("﻿zwei 𝄞 <|end|>"))
    assert out[2]["turns_sha256"] == digest([("us\ner", "x")]) and out[2]["loss_chars"] == 0
    assert out[None]["turns_sha256"] == digest([("", "null")])
    assert out[3]["turns_sha256"] == digest([("assistant", "a"), ("assistant", "b")])


def test_spans_cover_the_trained_text(spark):
    row = chats(spark, [(1, 1, "user", "é" * 9), (1, 2, "assistant", "𝄞~"), (1, 3, "assistant", "z")]).first()
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]] == ["𝄞~0", "z"]


def test_attachments_become_placeholders_in_order(spark):
    parts = [
        ("text", "see <|x", None, None), ("image", None, "s3://a", 4), ("audio", "x", None, None),
        ("document", None, "d", -3), (None, "t", None, None), ("video", "v", None, None), None,
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id int, turn int, role string, parts {PARTS}")
    row = format_chats(df).first()
    assert row["formatted"].startswith("<|turn|>user\nsee ~1x<|image:1025|><|audio:27|><|document:2|>tv<|end|>")
    assert [(a["place"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (1, "image", "s3://a", 1025), (2, "audio", None, 27), (3, "document", "d", 2),
    ]
    assert row["expanded_tokens"] == 1054


def test_empty_and_long(spark):
    assert chats(spark, []).count() == 0
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} " * 20) for i in range(3000)]
    row = chat_digests(chats(spark, rows)).first()
    told = "".join(t for _, i, r, t in rows if r == "assistant")
    assert row["loss_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert len(chats(spark, rows).select(read_turns(F.col("formatted")).alias("t")).first()["t"]) == 3000
