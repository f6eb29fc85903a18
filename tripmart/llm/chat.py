"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role share a block; the blocks are concatenated. The template is

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Inside texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so the
marks cannot occur there and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unrole(role: Column) -> Column:
    parts = F.split(F.replace(role, F.lit("<\\|"), F.lit("<|")), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def chat_format(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row ``(conv_id, formatted, mask)`` per conversation.

    Turns are in the order of ``turn`` (null first), then of role and text, so
    ties and repeated rows have a fixed place; a null text or role is empty; null
    conversation ids are one conversation; an empty table gives no rows; other
    columns are ignored. ``mask`` has a struct per turn, in order: ``skip``
    characters of marks, then ``take`` characters of text, which are under the
    loss if ``loss``, that is if the role is ``assistant``.

    Turns are escaped before they are collected, and collecting is partial per
    task. A conversation is one row by its nature: its whole text must fit into
    a row.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        text(role_col).alias("role"), escape(text(text_col)).alias("text"))
    got = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t")))
    # A turn opens a block unless the turn before has its role.
    before = lambda i: F.try_element_at("t", i)["role"]
    opened = F.transform("t", lambda x, i: F.struct(
        F.when(i == 0, F.concat(F.lit(START), _role(x["role"]), F.lit("\n")))
         .when(before(i.cast("int")) == x["role"], F.lit(SEP))
         .otherwise(F.concat(F.lit(END + START), _role(x["role"]), F.lit("\n"))).alias("mark"),
        x["text"].alias("text"), (x["role"] == LOSS_ROLE).alias("loss")))
    made = got.select("conv_id", opened.alias("m"))
    joined = F.array_join(F.transform("m", lambda x: F.concat(x["mark"], x["text"])), "")
    return made.select("conv_id", F.concat(joined, F.lit(END)).alias("formatted"),
                       F.transform("m", lambda x: F.struct(F.char_length(x["mark"]).alias("skip"),
                                                           F.char_length(x["text"]).alias("take"),
                                                           x["loss"].alias("loss"))).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, formatted, turns, loss_texts)`` from what ``chat_format``
    wrote: ``turns`` as structs of role and text, and the texts that the mask
    puts under the loss. Raises if the mask does not fit the text."""
    block = F.split("formatted", r"<\|im_end\|>\n", -1)
    body = F.transform(F.slice(block, F.lit(1), F.size(block) - 1), lambda b: F.substr(b, F.lit(len(START) + 1)))
    turns = F.flatten(F.transform(body, lambda b: F.transform(
        F.split(F.substr(b, F.char_length(F.substring_index(b, "\n", 1)) + 2), r"<\|im_sep\|>", -1),
        lambda t: F.struct(F.substring_index(b, "\n", 1).alias("role"), t.alias("text")))))
    got = formatted.select("conv_id", "formatted", "mask", turns.alias("raw"))
    marked = F.arrays_zip("raw", "mask")
    fits = (F.size("raw") == F.size("mask")) & F.forall(
        marked, lambda z: F.char_length(z["raw"]["text"]) == z["mask"]["take"]) & (
        F.char_length("formatted") == F.char_length(F.lit(END)) + F.aggregate(
            "mask", F.lit(0), lambda n, m: n + m["skip"] + m["take"]))
    got = got.withColumn("raw", F.when(fits, F.col("raw")).otherwise(
        F.raise_error(F.lit("the loss mask does not fit the formatted text"))))
    return got.select(
        "conv_id", "formatted",
        F.transform("raw", lambda x: F.struct(_unrole(x["role"]).alias("role"),
                                              unescape(x["text"]).alias("text"))).alias("turns"),
        F.transform(F.filter(marked, lambda z: z["mask"]["loss"]),
                    lambda z: unescape(z["raw"]["text"])).alias("loss_texts"))
