"""Chat formatting with typed content parts (DataFrame functions only).

A message has a role and parts; a part is text, an image, a sound or a document. ``VISITORS`` holds for each kind what
its part becomes: text is written escaped, any other part leaves a placeholder, a reference to what is
attached and the number of tokens that the placeholder stands for (image patches, sound frames, document pages).
``format_conversations`` writes

    <|turn|>role<|text|>text<|image|><|text|>text<|end|><|turn|>role ...

and says which of it counts for the loss. Each part is one row until the end: its place in the formatted
text is a running sum over the conversation's parts, and only the finished pieces are gathered.

Escaping. A control string is a first character and a rest: ``<`` with ``|``, ``s>`` or ``/s>``, ``[`` with
``INST]`` or ``/INST]``. Where a text or role holds the first character, any number of
backslashes and a rest, one more backslash is put behind the first character; reading takes one away. So no text holds a
control string, and every text comes back as it was, backslashes included.

``pieces`` cuts a formatted conversation before each control string, ``read_back`` turns the pieces into text again.

Edge cases: null text and null role count as empty; a null ``parts`` array is a message without parts, null parts are left out, a
part without a kind is text, a part of an unknown kind leaves the placeholder ``<|other|>`` of 0 tokens. Missing or
negative sizes count as 0. Turns with equal numbers (null numbers come first) are in order of role and of a hash of their parts,
repeated rows are turns of their own. Rows without a conversation id belong to no conversation: each is formatted alone, with a null id.
A conversation is one row of the result, so one task holds it; nothing else is gathered. An empty
table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"

TURN, END = "<|turn|>", "<|end|>"

# First characters and rests of the control strings.
FIRST, REST = r"[<\[]", r"\||/?s>|/?INST\]"

PATCH = 14
FRAMES_A_SECOND = 25
TOKENS_A_PAGE = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({FIRST})(\\*)({REST})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({FIRST})\\(\\*)({REST})", "$1$2$3")


def _size(x: Column) -> Column:
    return F.greatest(F.coalesce(x, F.lit(0)), F.lit(0))


def _patches(x: Column) -> Column:
    return F.ceil(_size(x) / PATCH)


#: For each kind of part the number of tokens that it stands for, from the part.
VISITORS: dict[str, Callable[[Column], Column]] = {
    "text": lambda part: F.lit(0),
    "image": lambda part: _patches(part["width"]) * _patches(part["height"]),
    "audio": lambda part: F.ceil(_size(part["seconds"]) * FRAMES_A_SECOND),
    "document": lambda part: _size(part["pages"]) * TOKENS_A_PAGE,
    "other": lambda part: F.lit(0),
}


def marker(kind: str | Column) -> Column:
    return F.concat(F.lit("<|"), F.lit(kind) if isinstance(kind, str) else kind, F.lit("|>"))


def text_part(text: Column) -> Column:
    """The parts of a message that is one text."""
    others = [F.lit(None).cast(t).alias(c) for c, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *others))


def _visited(part: Column) -> Column:
    """What a part becomes: kind, piece (marker and escaped text), tokens and reference."""
    kind = F.coalesce(part["kind"], F.lit("text"))
    kind = F.when(kind.isin(*VISITORS), kind).otherwise("other")
    tokens = F.lit(0).cast("long")
    for name, count in VISITORS.items():
        tokens = F.when(kind == name, count(part).cast("long")).otherwise(tokens)
    body = F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise("")
    return F.struct(kind.alias("kind"), marker(kind).alias("marker"), body.alias("body"), tokens.alias("tokens"),
                    F.when(kind != "text", part["ref"]).alias("ref"))


def format_conversations(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, parts: array of ``PART``).

    conv_id, formatted, loss (begin and end, in characters of ``formatted``, of the texts that count),
    loss_mask (for each piece of ``formatted`` how many of its last characters count), attachments (in order of their
    placeholders: turn, kind, ref, tokens, place) and expanded_tokens (their sum).
    """
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone")
    parts = F.filter(F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    rows = messages.select("conv_id", alone, "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"),
                           F.monotonically_increasing_id().alias("row"))
    rows = rows.select("conv_id", "alone", "turn", "role", "row", F.size("parts").alias("n"), F.xxhash64("parts").alias("tie"),
                       F.posexplode_outer("parts").alias("at", "part"))
    visited = F.when(F.col("part").isNotNull(), _visited(F.col("part")))
    key = ["conv_id", "alone", "turn", "role", "tie", "row"]
    first, last = F.coalesce("at", F.lit(0)) == 0, F.coalesce("at", F.lit(0)) == F.greatest("n", F.lit(1)) - 1
    head = F.when(first, F.concat(F.lit(TURN), escape(F.col("role")))).otherwise("")
    rows = rows.select(*key, "at", visited.alias("v"), head.alias("head"), F.when(last, F.lit(END)).otherwise("").alias("tail"))
    body = F.coalesce("v.body", F.lit(""))
    before = F.concat("head", F.coalesce("v.marker", F.lit("")))
    counts = F.col("role").isin(*loss_roles) & (F.col("v.kind") == "text")
    size = F.char_length(body).cast("long")
    masked = F.when(counts, F.char_length(body)).otherwise(0)
    mask = F.concat(F.when(F.col("head") != "", F.array(F.lit(0))).otherwise(F.array().cast("array<int>")),
                    F.when(F.col("v").isNotNull(), F.array(masked)).otherwise(F.array().cast("array<int>")),
                    F.when(F.col("tail") != "", F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    rows = rows.select(
        *key, "at", F.concat(before, body, "tail").alias("piece"), mask.alias("mask"),
        F.char_length(before).cast("long").alias("skip"), size.alias("size"), F.coalesce(counts, F.lit(False)).alias("counts"),
        "v.kind", "v.ref", F.coalesce("v.tokens", F.lit(0)).alias("tokens"))
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "tie", "row", "at")
    length = F.char_length("piece").cast("long")
    rows = rows.select("*", (F.sum(length).over(order) - length).alias("place"))
    items = rows.groupBy("conv_id", "alone").agg(
        F.sort_array(F.collect_list(F.struct("place", "piece", "mask", "skip", "size", "counts", "turn", "kind", "ref", "tokens"))).alias("items"),
        F.sum("tokens").alias("expanded_tokens"))

    def begin(i: Column) -> Column:
        return i["place"] + i["skip"]

    return items.select(
        "conv_id", F.array_join(F.transform("items", lambda i: i["piece"]), "").alias("formatted"),
        F.transform(F.filter("items", lambda i: i["counts"]),
                    lambda i: F.struct(begin(i).alias("begin"), (begin(i) + i["size"]).alias("end"))).alias("loss"),
        F.flatten(F.transform("items", lambda i: i["mask"])).alias("loss_mask"),
        F.transform(F.filter("items", lambda i: i["kind"] != "text"), lambda i: F.struct(
            i["turn"].alias("turn"), i["kind"].alias("kind"), i["ref"].alias("ref"), i["tokens"].alias("tokens"),
            (begin(i) - F.char_length(marker(i["kind"]))).alias("place"))).alias("attachments"),
        "expanded_tokens")


def pieces(formatted: Column) -> Column:
    """A formatted conversation, cut before each control string."""
    return F.split(formatted, r"(?=<\|)")


def content(piece: Column) -> Column:
    """What follows the control string of a piece, unescaped."""
    return unescape(F.regexp_replace(piece, r"^<\|[a-z]+\|>", ""))


def read_back(of_pieces: Column) -> Column:
    """role, line feed, texts, line feed of each turn, joined."""
    def read(piece: Column) -> Column:
        return F.when(piece.startswith(TURN), F.concat(content(piece), F.lit("\n"))).when(piece == END, F.lit("\n")).otherwise(content(piece))

    return F.array_join(F.transform(of_pieces, read), "")


def turn_count(of_pieces: Column) -> Column:
    return F.size(F.filter(of_pieces, lambda piece: piece.startswith(TURN)))


def read_loss(of_pieces: Column, loss_mask: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.zip_with(of_pieces, loss_mask, lambda piece, n: unescape(F.right(piece, n))), "")
