"""Chat formatting with Spark expressions only (operator 5).

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged into one block; blocks are joined into the text. Every step is linear in the length of
the conversation: blocks are slices of the sorted array, found from the places where the role
changes, and texts are put together by ``array_join``.

A block is ``<|turn|>role<|text|>first text<|more|>second text</s>``. Inside roles and texts every
control string is broken by a backslash after its first character and a backslash is doubled, so
a control string in the output is always one that the template wrote, and ``unescaped`` gives
the text back.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "</s>"
#: Strings a text must not hold unbroken: the template's own and those of common chat formats.
CONTROLS = ("<|", END, "[INST]", "[/INST]")
#: Roles whose texts the loss is taken on.
LOSS_ROLES = ("assistant",)

_BROKEN = r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)
#: Where the text of a conversation is cut into the pieces that the mask counts.
_EDGES = "|".join(
    [f"(?<={re.escape(c)})" for c in (TEXT, MORE, END)] + [f"(?={re.escape(c)})" for c in (MORE, END)]
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _BROKEN, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted and mask.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. Turns are ordered by
    turn number (null first), equal numbers by role and text; repeated rows are kept. A null text
    or role counts as empty, a null conv_id is a conversation of its own; an empty table gives no
    row. ``mask`` is an array of (chars, loss) in order: lengths in code points that add up to the
    length of ``formatted``, and whether the loss is taken there.
    """
    chats = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("turn").alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    # Sorted by the fields as they are, escaped afterwards.
    chats = chats.withColumn(
        "turns",
        F.transform(
            "turns",
            lambda t: F.struct(
                escaped(t["role"]).alias("role"),
                escaped(t["text"]).alias("text"),
                t["role"].isin(*LOSS_ROLES).alias("loss"),
            ),
        ),
    )
    turns = F.col("turns")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (turns[i]["role"] != turns[F.greatest(i - 1, F.lit(0))]["role"]),
    )
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size(turns)))
    blocks = F.transform(
        F.arrays_zip(F.col("starts"), ends.alias("ends")),
        lambda b: F.slice(turns, b["starts"] + 1, b["ends"] - b["starts"]),
    )
    block_text = F.transform(
        "blocks",
        lambda b: F.concat(
            F.lit(TURN),
            b[0]["role"],
            F.lit(TEXT),
            F.array_join(F.transform(b, lambda t: t["text"]), MORE),
            F.lit(END),
        ),
    )

    def piece(chars: Column, loss: Column) -> Column:
        return F.struct(chars.alias("chars"), loss.alias("loss"))

    def masks(block: Column) -> Column:
        head = F.lit(len(TURN + TEXT)) + F.length(block[0]["role"])
        texts = F.transform(
            block,
            lambda t, i: F.array(
                piece(F.when(i == 0, head).otherwise(F.lit(len(MORE))), F.lit(False)),
                piece(F.length(t["text"]), t["loss"]),
            ),
        )
        return F.concat(F.flatten(texts), F.array(piece(F.lit(len(END)), F.lit(False))))

    return (
        chats.withColumn("starts", starts)
        .withColumn("blocks", blocks)
        .select(
            "conv_id",
            F.array_join(block_text, "").alias("formatted"),
            F.flatten(F.transform("blocks", masks)).alias("mask"),
        )
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """What the formatted texts and masks hold: conv_id, turns (array of role and text) and
    loss_text, the unescaped text under the mask; null where mask and text do not fit."""
    ended = F.split("formatted", re.escape(END))
    bodies = F.transform(
        F.slice(ended, 1, F.size(ended) - 1),
        lambda b: F.split(b, re.escape(TEXT), 2),
    )

    def block_turns(block: Column) -> Column:
        role = unescaped(F.substring(block[0], len(TURN) + 1, 1 << 30))
        return F.transform(
            F.split(block[1], re.escape(MORE)),
            lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")),
        )

    # A cut never leaves an empty piece, so parts of no length are left out of the mask as well.
    fits = (F.size("pieces") == F.size("parts")) & F.forall(
        F.zip_with("pieces", "parts", lambda p, m: F.length(p) == m["chars"]), lambda ok: ok
    )
    under_mask = F.filter(
        F.zip_with("pieces", "parts", lambda p, m: F.when(m["loss"], unescaped(p))),
        lambda p: p.isNotNull(),
    )
    return chats.withColumns(
        {
            "pieces": F.filter(F.split("formatted", _EDGES), lambda p: p != ""),
            "parts": F.filter("mask", lambda m: m["chars"] > 0),
        }
    ).select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(bodies, block_turns)).alias("turns"),
        F.when(fits, F.array_join(under_mask, "")).alias("loss_text"),
    )
