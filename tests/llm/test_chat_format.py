"""Chat formatting: round trips over hostile texts, the loss mask, placeholders, and the query against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.llm.chat_format import (PART, content, escape, format_conversations, pieces, read_back, read_loss, text_part,
                                     turn_count, unescape)
from govlake.llm.queries import op13_chat_format

BITS = ["<", "|", "\\", ">", "[", "]", "/", "s>", "INST]", "<|", "|>", "<|turn|>", "<|end|>", "<|text|>", "</s>", "[INST]", "[/INST]", "a", " ",
        "\n", "é", "😀", "text", "end", ""]


def hostile(rng):
    return "".join(rng.choices(BITS, k=rng.randint(0, 12)))


@pytest.fixture(scope="module")
def chats(spark):
    def make(rows):
        schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                               T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("place", T.IntegerType())])
        return spark.createDataFrame([(*r, 1) for r in rows], schema)

    return make


def formatted(messages):
    out = format_conversations(messages.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    out = out.withColumn("pieces", pieces(F.col("formatted")))
    return out.select("*", read_back(F.col("pieces")).alias("turns"), read_loss(F.col("pieces"), F.col("loss_mask")).alias("under_mask"),
                      turn_count(F.col("pieces")).alias("n_turns"))


def test_escaping_is_reversible(spark):
    rng = random.Random(1)
    texts = [hostile(rng) for _ in range(3000)] + ["", "<\\|", "<\\\\|", "[\\INST]", "<\\", "\\"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_round_trip_and_loss(chats):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", hostile(rng)]), rng.choice([hostile(rng), hostile(rng), None]))
            for c in range(60) for t in range(rng.randint(1, 9))]
    shuffled = random.Random(3).sample(rows, len(rows))
    got = {r["conv_id"]: r for r in formatted(chats(shuffled)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        mine = [x for x in rows if x[0] == c]
        assert r["n_turns"] == len(mine)
        assert r["turns"] == "".join(f"{role}\n{text or ''}\n" for _, _, role, text in mine)
        said = [text or "" for _, _, role, text in mine if role == "assistant"]
        assert r["under_mask"] == "".join(said)
        # the spans say the same as the mask of the pieces
        spans = [r["formatted"][s["begin"]:s["end"]] for s in r["loss"]]
        assert len(spans) == len(said) and sum(map(len, spans)) == sum(r["loss_mask"])
        assert "".join(p[len(p) - n:] for p, n in zip(r["pieces"], r["loss_mask"])) == "".join(spans)
        assert "".join(r["pieces"]) == r["formatted"] and len(r["pieces"]) == len(r["loss_mask"])


def test_typed_parts(spark):
    parts = [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("text", "<", None, None, None, None, None),
             ("text", "|b", None, None, None, None, None), (None, "no kind", None, None, None, None, None), ("audio", None, "b.wav", None, None, 2.01, None),
             ("document", "ignored", "c.pdf", None, None, None, 3), ("video", None, "d.mp4", 5, 5, 5.0, 5), ("image", None, None, -3, None, None, None), None]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("parts", T._parse_datatype_string(f"array<{PART}>"))])
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "one", *[None] * 5), ("text", "two", *[None] * 5)]),
                                  (1, 2, "assistant", None), (1, 3, "user", [])], schema)
    r = format_conversations(rows).withColumn("back", F.transform(pieces(F.col("formatted")), content)).collect()[0]
    assert r["formatted"] == (
        "<|turn|>user<|text|>see <\\|image|><|image|><|text|><<|text|>|b<|text|>no kind<|audio|><|document|><|other|><|image|><|end|>"
        "<|turn|>assistant<|text|>one<|text|>two<|end|><|turn|>assistant<|end|><|turn|>user<|end|>")
    assert [(a["turn"], a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (0, "image", "a.png", 4), (0, "audio", "b.wav", 51), (0, "document", "c.pdf", 768), (0, "other", "d.mp4", 0), (0, "image", None, 0)]
    assert all(r["formatted"][a["place"]:].startswith(f"<|{a['kind']}|>") for a in r["attachments"])
    assert r["expanded_tokens"] == 4 + 51 + 768
    assert [r["formatted"][s["begin"]:s["end"]] for s in r["loss"]] == ["one", "two"]
    assert r["back"][:5] == ["user", "see <|image|>", "", "<", "|b"]


def test_odd_rows(chats):
    rows = [(None, 0, "user", "a"), (None, 0, "assistant", "b"), (None, 0, "assistant", "b"), (5, None, None, None), (5, 0, "assistant", "x"),
            (5, 0, "assistant", "x"), (5, 0, "user", ""), (6, 1, "assistant", "late"), (6, -1, "user", "early")]
    got = sorted((r["conv_id"] is None, r["conv_id"] or 0, r["n_turns"], r["turns"], r["under_mask"]) for r in formatted(chats(rows)).collect())
    assert got == [(False, 5, 4, "\n\nassistant\nx\nassistant\nx\nuser\n\n", "xx"), (False, 6, 2, "user\nearly\nassistant\nlate\n", "late"),
                   (True, 0, 1, "assistant\nb\n", "b"), (True, 0, 1, "assistant\nb\n", "b"), (True, 0, 1, "user\na\n", "")]
    assert formatted(chats([])).collect() == []


def test_long_conversation(chats):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "x" * 300) for t in range(3000)]
    r = formatted(chats(rows)).collect()[0]
    assert r["turns"] == "".join(f"{role}\n{text}\n" for _, _, role, text in rows)
    assert r["under_mask"] == "".join(text for _, _, role, text in rows if role == "assistant")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    query = op13_chat_format(spark, sf)
    got = {r["conv_id"]: r for r in query.collect()}
    assert set(got) == {r[0] for r in rows}
    assert not any(w in query._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "Arrow"))
    for c, r in got.items():
        mine = sorted(x for x in rows if x[0] == c)
        loss = "".join(t or "" for _, _, role, t in mine if role == "assistant")
        turns = "".join(f"{role}\n{t or ''}\n" for _, _, role, t in mine)
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] >= len(turns)
