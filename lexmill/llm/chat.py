"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation several times, each time with more turns. Every turn gets a hash of
the conversation up to and including it; the hash adds up one number per turn, so it is a running
sum that can be cut into ranges, and a conversation of any length needs no task of its own. Where a
whole conversation's hash equals that of a longer one's first turns, the longer one has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.skew import ordered, running_values
from lexmill.session import materialize

TURNS_PER_PART = 256
LANE = (1 << 31) - 1


def _lanes(position: Column, role: Column, text: Column) -> list[Column]:
    """Four 31-bit numbers of a turn at its position; sums of them cannot overflow in practice."""
    content = [position, F.coalesce(F.concat(F.lit("r"), role), F.lit("n")), F.coalesce(F.concat(F.lit("t"), text), F.lit("n"))]
    digest = F.md5(F.concat_ws("\x00", *[c.cast("string") for c in content]).cast("binary"))
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(LANE)) for i in range(4)]


def conversation_key(conv_id: Column) -> Column:
    """A key that is never null; rows without an id are one conversation."""
    return F.coalesce(F.concat(F.lit("c"), conv_id.cast("string")), F.lit("n"))


def prefix_hashes(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **limits
) -> DataFrame:
    """One row per turn: conv, conv_id, position (from 1), role, text, prefix (hash up to this turn).

    Turns are ordered by number (null last), then role, then text; repeated rows are turns each.
    """
    rows = turns.select(
        conversation_key(F.col(conv_col)).alias("conv"), F.col(conv_col).alias("conv_id"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit((1 << 63) - 1)).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )

    rows = materialize(rows, "turns").withColumn("row", F.monotonically_increasing_id())
    plain = [F.col(c) for c in ("turn",)] + [F.struct(F.col(c).isNull(), F.col(c)) for c in ("role", "text")] + [F.col("row")]
    cut = ordered(rows, ["conv"], plain, **limits)
    counted = running_values(cut, plain, {"position": ("sum", F.lit(1).cast("long"))})
    lanes = {f"lane{i}": ("sum", c) for i, c in enumerate(_lanes(F.col("position"), F.col("role"), F.col("text")))}
    hashed = running_values(counted, plain, lanes).df
    prefix = F.concat_ws(":", "position", *[f"lane{i}" for i in range(4)])
    return hashed.select("conv", "conv_id", "position", "role", "text", prefix.alias("prefix"))


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv) of the conversations that stay: no longer one begins with them, and of equal ones the smallest id.

    Prefixes and whole conversations are reduced to distinct hashes before they meet, so a first
    turn that a third of all conversations share is one row.
    """
    whole = hashed.groupBy("conv").agg(F.max_by("prefix", "position").alias("prefix"), F.max("position").alias("n"), F.first("conv_id").alias("conv_id"))
    whole = materialize(whole, "conversations")
    best = F.struct(F.col("conv_id").isNull().alias("a"), F.col("conv_id").alias("b"), F.col("conv").alias("conv"))
    distinct = whole.groupBy("prefix").agg(F.min(best).alias("best")).select("prefix", "best.conv")
    # A turn is inside its conversation unless it is the last; both sides are one row per turn at most.
    inside = hashed.join(whole.select("conv", F.col("n").alias("position")), ["conv", "position"], "left_anti")
    return distinct.join(inside.select("prefix").distinct(), "prefix", "left_anti").select("conv")


def render_turn(role: Column, text: Column) -> Column:
    """One turn in the chat markup; a null role is `user`, a null text is empty."""
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n")
    )


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    turns_per_part: int = TURNS_PER_PART,
    **limits,
) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, text.

    A conversation goes if its turns (role and text) are the first turns of a longer one, or equal
    those of one with a smaller id (null last). Rows without an id are one conversation. Texts are
    kept whole; a conversation of more than `turns_per_part` turns comes in parts (from 0), whose
    texts follow one another. An empty table gives no rows.
    """
    hashed = materialize(prefix_hashes(turns, conv_col, turn_col, role_col, text_col, **limits), "prefixes")
    # The conversations that stay are one row each, joined to their turns.
    kept = hashed.join(materialize(maximal(hashed), "maximal"), "conv", "left_semi")
    part = F.floor((F.col("position") - 1) / F.lit(turns_per_part)).cast("int")
    pieces = F.array_sort(F.collect_list(F.struct("position", render_turn(F.col("role"), F.col("text")).alias("text"))))
    groups = kept.groupBy("conv", "conv_id", part.alias("part")).agg(F.count(F.lit(1)).alias("n_turns"), pieces.alias("p"))
    return groups.select("conv_id", "part", "n_turns", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
