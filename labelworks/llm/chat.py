"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, its
text as the only trainable part. A turn reads ``<s>[INST]role[/INST]text</s>``; control
strings and backslashes inside a role or text are escaped, so a formatted text can be
read back without loss. Turns after the last answer form a last example without a target.

At scale: one shuffle by conversation, none after it. An example is built when its row
is, so a task holds one conversation's turns and one example, not all its examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TARGET = "assistant"


def escape(text: Column) -> Column:
    """Without control strings: a backslash after a control string's first character,
    and every backslash of the text itself doubled."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example int, n_turns int, last boolean, formatted string, loss_start
    long, loss_length long``: the loss mask in code points of ``formatted``, from zero.

    Turns stand in the order of (turn, role, text); null turns come first, a null role or
    text counts as empty, and repeated rows are turns of their own. Only the exact role
    ``assistant`` is trainable. Rows without conv_id form one conversation. A conversation
    without answers gives one example with an empty mask; an empty table gives none.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct("turn", empty("role").alias("role"), empty("text").alias("text"))
    gathered = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE)))
    answers = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (F.element_at("turns", i)["role"] == TARGET) | (i == F.size("turns")))
    each = gathered.select("conv_id", "turns", parts.alias("parts"), F.posexplode(answers).alias("at", "upto"))
    own = F.element_at("turns", F.col("upto"))
    length = F.when(own["role"] == TARGET, F.length(escape(own["text"]))).otherwise(0).cast("long")
    formatted = each.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        F.col("upto").alias("n_turns"),
        (F.col("upto") == F.size("turns")).alias("last"),
        F.array_join(F.slice("parts", 1, F.col("upto")), "").alias("formatted"),
        length.alias("loss_length"),
    )
    return formatted.withColumn("loss_start", F.length("formatted") - len(CLOSE) - F.col("loss_length"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: ``array<struct<role string, text string>>``."""
    pieces = F.split(formatted, F.lit("</s>"), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, MIDDLE, 1)
        text = F.substr(body, F.length(role) + len(MIDDLE) + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """What stands under the mask, unescaped."""
    return unescape(F.substr(formatted, (start + 1).cast("int"), length.cast("int")))


def conversation_digest(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all
    read back from the formatted examples; formatted_chars sums over the examples."""
    made = examples(conversations)
    turns = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = made.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("last"), turns).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
    ).select("conv_id", "example", "chars", "loss", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"))
    learnt = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    whole = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), learnt.alias("loss"), F.sum("chars").alias("formatted_chars")
    )
    return whole.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"
    )
