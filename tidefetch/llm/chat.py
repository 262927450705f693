"""Chat formatting with Spark expressions only.

The turns of a conversation are collected, sorted, and joined to one text; adjacent turns of
one role share a block. The template is

    <s>role[INST]text[/INST][INST]text[/INST]</s>

with a block for each run of turns of one role and an [INST] pair for each turn. A control
string inside a role or text gets a backslash after its first character, and one that has
backslashes there gets one more, so that no text can end a turn and every text can be
restored. A whole conversation is one row, so a task must hold the longest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import evaluate_once

BLOCK, END_BLOCK = "<s>", "</s>"
TURN, END_TURN = "[INST]", "[/INST]"
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
TRAINED = "assistant"
#: Runs whose lengths are summed up together to find places in a text.
CHUNK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_runs and loss_bytes of every conversation in ``turns`` (conv_id, turn, role, text).

    loss_runs are lengths in characters of ``formatted``: outside the loss, inside, outside, ...;
    inside are the texts of the role ``assistant``. loss_bytes are the same in bytes of UTF-8. Rows come by turn, ties by role and text, and
    repeated rows are turns of their own. Null texts and roles are empty, a null turn comes
    first, and rows without a conv_id are one conversation with a null id. Other columns play
    no part; no rows give no conversations.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.struct(
            F.col("turn").cast("long"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def piece(turn: Column) -> Column:
        return F.struct(turn["role"].alias("role"), escape(turn["text"]).alias("text"))

    chats = evaluate_once(chats.select("conv_id", F.transform("turns", piece).alias("turns")), "__", turns=F.col("turns"))
    turns_ = F.col("__.turns")

    def before(turn: Column, i: Column) -> Column:
        first = ~turn["role"].eqNullSafe(F.get(turns_, i - 1)["role"])
        return F.concat(F.when(first, F.concat(F.lit(BLOCK), escape(turn["role"]))).otherwise(F.lit("")), F.lit(TURN))

    def after(turn: Column, i: Column) -> Column:
        last = ~turn["role"].eqNullSafe(F.get(turns_, i + 1)["role"])
        return F.concat(F.lit(END_TURN), F.when(last, F.lit(END_BLOCK)).otherwise(F.lit("")))

    parts = F.transform(
        turns_,
        lambda turn, i: F.struct(
            before(turn, i).alias("before"),
            turn["text"].alias("text"),
            after(turn, i).alias("after"),
            (turn["role"] == TRAINED).alias("trained"),
        ),
    )
    chats = evaluate_once(chats.select("conv_id", "__"), "_p", parts=parts)
    formatted = F.array_join(
        F.transform("_p.parts", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
    )

    def runs(length) -> Column:
        lengths = F.transform(
            "_p.parts",
            lambda p: F.when(
                p["trained"], F.array(length(p["before"]), length(p["text"]), length(p["after"]), F.lit(0))
            ).otherwise(F.array(length(F.concat(p["before"], p["text"], p["after"])), F.lit(0))),
        )
        return F.flatten(lengths)

    return chats.select(
        "conv_id",
        formatted.alias("formatted"),
        runs(F.char_length).alias("loss_runs"),
        runs(F.octet_length).alias("loss_bytes"),
    )


def loss_texts(chats: DataFrame) -> DataFrame:
    """``chats`` with loss_texts: what is under the loss mask, cut out of ``formatted`` along it and unescaped.

    The places come from sums of chunks of the mask, so a mask of n runs takes some n * (n / CHUNK + CHUNK) steps.
    """
    runs, data = F.col("loss_bytes"), F.encode("formatted", "UTF-8")

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0), lambda s, n: s + n)

    chunks = F.sequence(F.lit(0), F.expr(f"int(size(loss_bytes) div {CHUNK})"))
    rows = evaluate_once(
        chats, "__c", data=data, starts=F.transform(chunks, lambda c: total(F.slice(runs, F.lit(1), c * CHUNK)))
    )

    def cut(i: Column) -> Column:
        # Even places of the mask are outside the loss, odd ones inside.
        chunk = (i - i % CHUNK) / CHUNK
        start = F.get("__c.starts", chunk.cast("int")) + total(F.slice(runs, i - i % CHUNK + 1, i % CHUNK))
        return unescape(F.make_valid_utf8(F.substring(F.col("__c.data"), start + 1, F.get(runs, i)).cast("string")))

    inside = F.filter(F.sequence(F.lit(0), F.greatest(F.size(runs) - 1, F.lit(0))), lambda i: (i % 2 == 1) & (F.get(runs, i) > 0))
    return rows.withColumn("loss_texts", F.transform(inside, cut)).drop("__c")


def read_chats(chats: DataFrame) -> DataFrame:
    """``chats`` with turns (role, text), taken from ``formatted`` alone."""
    blocks = F.filter(F.split("formatted", END_BLOCK, -1), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        parts = F.split(block, r"\[INST\]", -1)
        role = unescape(F.substring(F.get(parts, F.lit(0)), len(BLOCK) + 1, 1 << 30))
        texts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.transform(
            texts, lambda t: F.struct(role.alias("role"), unescape(F.replace(t, F.lit(END_TURN), F.lit(""))).alias("text"))
        )

    return chats.withColumn("turns", F.flatten(F.transform(blocks, turns_of)))


def digest(chats: DataFrame) -> DataFrame:
    """Counts and hashes of the turns, read back from formatted, and of the texts under the loss mask."""
    read = evaluate_once(read_chats(loss_texts(chats)), "__", turns=F.col("turns"), loss=F.array_join("loss_texts", ""))
    turns, loss = F.col("__.turns"), F.col("__.loss")
    spoken = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
