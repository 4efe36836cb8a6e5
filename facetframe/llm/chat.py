"""Prefix-target expansion of conversations.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
own text is trainable. Turns after the last assistant turn (or a conversation without one) are kept
in one further example that trains on nothing.

A turn is written as ``### role:``, a line break, the text, a line break, ``</turn>`` and a line
break. Inside roles and texts a backslash becomes ``\\b``, ``</turn>`` becomes ``\\t``, ``###``
becomes ``\\h`` and, in roles, a line break becomes ``\\l``; every backslash then starts a code, so
the codes can be undone one after another.

Defined cases: a null role or text is empty; null turns come first; equal turns are ordered by role
and text; repeated rows are repeated turns; rows with a null conversation id form one conversation;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

END = "\n</turn>\n"
TARGET_ROLE = "assistant"
CODES = [("\\", "\\b"), ("</turn>", "\\t"), ("###", "\\h")]
ROLE_CODES = [*CODES, ("\n", "\\l")]


def _escaped(text: Column, codes: list[tuple[str, str]]) -> Column:
    for raw, code in codes:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def _unescaped(text: Column, codes: list[tuple[str, str]]) -> Column:
    for raw, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def unescape_text(text: Column) -> Column:
    """The text of a turn as it was before formatting."""
    return _unescaped(text, CODES)


def format_examples(turns: DataFrame) -> DataFrame:
    """One row per example from rows of ``conv_id``, ``turn``, ``role``, ``text``.

    Columns: ``conv_id``, ``example`` (from 0), ``n_examples``, ``text``, and the trainable
    characters as ``loss_start`` (from 0) and ``loss_length``. The last example of a conversation
    holds all its turns.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    head = F.concat(F.lit("### "), _escaped(role, ROLE_CODES), F.lit(":\n"))
    body = _escaped(text, CODES)
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            role.alias("role"),
            text.alias("text"),
        ).alias("place"),
        (role == TARGET_ROLE).alias("target"),
        head.alias("head"),
        body.alias("body"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    block = F.concat("head", "body", F.lit(END))
    placed = (
        rows.withColumn("block", block)
        .withColumn("row", F.count(F.lit(1)).over(so_far))
        .withColumn("end", F.sum(F.length("block").cast("long")).over(so_far))
    )
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("row", "block"))).alias("blocks"),
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("target"),
                    F.struct(
                        "row",
                        "end",
                        (F.col("end") - F.length("body") - len(END)).alias("start"),
                        F.length("body").cast("long").alias("length"),
                    ),
                )
            )
        ).alias("targets"),
        F.max("row").alias("rows"),
        F.max("end").alias("end"),
    )
    rest = F.struct(
        F.col("rows").alias("row"),
        "end",
        F.col("end").alias("start"),
        F.lit(0).cast("long").alias("length"),
    )
    last = F.when(F.size("targets") > 0, F.element_at("targets", -1)["row"]).otherwise(F.lit(0))
    targets = F.when(last < F.col("rows"), F.concat("targets", F.array(rest))).otherwise(
        F.col("targets")
    )
    return (
        whole.select(
            "conv_id",
            F.array_join(F.col("blocks.block"), "").alias("formatted"),
            targets.alias("targets"),
        )
        .select(
            "conv_id",
            "formatted",
            F.size("targets").cast("long").alias("n_examples"),
            F.posexplode("targets").alias("example", "target"),
        )
        .select(
            "conv_id",
            F.col("example").cast("long").alias("example"),
            "n_examples",
            F.substring("formatted", F.lit(1), F.col("target.end").cast("int")).alias("text"),
            F.col("target.start").alias("loss_start"),
            F.col("target.length").alias("loss_length"),
        )
    )


def loss_text(text: str = "text", start: str = "loss_start", length: str = "loss_length") -> Column:
    """The trainable text of an example, unescaped."""
    span = F.substring(
        F.col(text), (F.col(start) + 1).cast("int"), F.col(length).cast("int")
    )
    return unescape_text(span)


def parsed_turns(text: str = "text") -> Column:
    """The turns of an example as an array of (role, text), read back from its text alone."""
    blocks = F.split(F.col(text), END)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = F.substring(head, F.lit(5), F.length(head) - 5)
        body = F.substring(block, F.length(head) + 2, F.length(block))
        return F.struct(
            _unescaped(role, ROLE_CODES).alias("role"), unescape_text(body).alias("text")
        )

    return F.transform(blocks, turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, digests of what can be read back from its examples."""
    whole = F.col("example") + 1 == F.col("n_examples")
    read = examples.select(
        "conv_id",
        F.length("text").cast("long").alias("chars"),
        F.struct("example", loss_text().alias("text")).alias("reply"),
        F.when(whole, parsed_turns()).alias("turns"),
    )
    joined = F.array_join(
        F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
    )
    per = read.groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.array_join(F.array_sort(F.collect_list("reply"))["text"], "").alias("replies"),
        F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    return per.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("replies").cast("long").alias("loss_chars"),
        F.sha2("replies", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
