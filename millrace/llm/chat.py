"""Chat formatting: budgeted windows over conversations, by DataFrame functions alone.

Turns of a conversation are put in order and measured; prefix sums of their sizes choose spans that begin and end at
turns. Every span becomes one training text: the system turn again, a limited history of the turns before, then the
span's own turns. Only assistant turns of the span itself are targets, so each of them is a target once.

Template of a turn: ``<|im_start|>`` role, newline, text, ``<|im_end|>`` newline. In roles and texts a backslash is doubled
and ``<|`` is written as ``<\\|``, in roles a newline gets a backslash; so no text can end a turn, and every text can be read back.

Defined cases: null or empty role or text counts as empty; turns with equal numbers are ordered by role and text, null
numbers come first; repeated rows are turns of their own; rows without ``conv_id`` form one conversation; other columns
are ignored. A turn over the budget stands alone in a window, whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"

#: Turns whose number falls in the same block are ordered in one task; blocks are put together by their totals.
TURNS_PER_BLOCK = 512


@dataclass(frozen=True)
class Budget:
    """Sizes in tokens, estimated as a quarter of the bytes of the formatted turn."""

    window: int = 2048
    history: int = 256
    least_fresh: int = 512


def escaped(column: str) -> Column:
    return F.replace(F.replace(F.col(column), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(column: Column | str) -> Column:
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with its formatted text, its position and the tokens before it.

    A conversation of any length is dealt out by blocks of turn numbers: positions and prefix sums are taken within
    blocks, and the totals of the blocks before are added.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    head = F.concat(F.lit(TURN_START), F.replace(escaped("role"), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    rows = rows.select(
        "conv_id", "turn", "role", "text", F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block"),
        F.concat(head, escaped("text"), F.lit(TURN_END)).alias("formatted"), F.length(head).alias("head"),
    ).withColumn("tokens", F.ceil(F.octet_length("formatted") / 4))
    blocks = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("sum"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum_before"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumns({
        "n_inside": F.row_number().over(inside),
        "sum_inside": F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block"))
    return rows.join(blocks, same).select(
        "conv_id", "role", "formatted", "head", "tokens",
        (F.col("n_before") + F.col("n_inside") - 1).alias("position"),
        (F.col("sum_before") + F.col("sum_inside")).alias("start"),
    )


def format_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per window: conv_id, window, formatted, loss_spans, n_fresh, n_history, has_system, tokens.

    ``loss_spans``: (begin, end) of each target text, in characters of ``formatted``. ``windows`` count from 0 in turn order.

    A span is what starts in the same stretch of the prefix sums, as long as the budget leaves beside system turn and
    history. The turn that reaches over the end of its stretch is a span of its own, so the other spans never exceed it.
    """
    turns = ordered_turns(conversations)
    system = turns.where((F.col("position") == 0) & (F.lower("role") == "system")).select(
        F.col("conv_id").alias("s_conv"), F.col("formatted").alias("s_text"), F.col("tokens").alias("s_tokens")
    )
    room = F.greatest(F.lit(budget.least_fresh), F.lit(budget.window - budget.history) - F.coalesce("s_tokens", F.lit(0)))
    stretch = F.floor(F.col("start") / F.col("room"))
    crosses = F.floor((F.col("start") + F.col("tokens") - 1) / F.col("room")) > stretch
    turns = (
        turns.join(system, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
        .withColumns({"room": room, "is_system": F.col("s_text").isNotNull() & (F.col("position") == 0)})
        .withColumns({"stretch": stretch, "crosses": crosses})
    )
    # where each window begins, at the earliest turn of its span
    spans = turns.groupBy("conv_id", "stretch", "crosses").agg(F.min("start").alias("w_start"))
    spans = spans.select(
        F.col("conv_id").alias("w_conv"), F.col("stretch").alias("w_stretch"), F.col("crosses").alias("w_crosses"), "w_start"
    )
    # a turn goes to its own window and, as history, to windows that begin at most `history` tokens after its start:
    # those lie in its own stretch or the next ones
    reach = F.floor((F.col("start") + budget.history) / F.col("room"))
    copies = turns.withColumn("at", F.explode(F.sequence("stretch", reach)))
    own = (F.col("w_stretch") == F.col("stretch")) & (F.col("w_crosses") == F.col("crosses"))
    past = (
        ~F.col("is_system")
        & (F.col("start") + F.col("tokens") <= F.col("w_start"))
        & (F.col("w_start") - F.col("start") <= budget.history)
    )
    placed = copies.join(
        spans, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("at") == F.col("w_stretch")) & (own | past)
    ).withColumn("fresh", own)
    size = F.length("formatted")
    piece = F.struct(
        "position", "fresh", "formatted", size.alias("size"), F.col("head"),
        (F.col("fresh") & (F.col("role") == "assistant")).alias("target"), "tokens",
    )
    windows = placed.groupBy("conv_id", "w_start").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.first("s_text").alias("s_text"), F.first("s_tokens").alias("s_tokens"),
    )
    # the system turn is put before every window that does not begin with it
    add = F.col("s_text").isNotNull() & (F.col("pieces")[0]["position"] > 0)
    windows = windows.withColumns({
        "prefix": F.when(add, F.col("s_text")).otherwise(""),
        "p_tokens": F.when(add, F.col("s_tokens")).otherwise(0),
    })
    end = F.length(F.lit(TURN_END))
    # the offset of every piece is the sum of the sizes before it
    walked = F.aggregate(
        "pieces",
        F.struct(F.length("prefix").cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["size"]).alias("at"),
            F.when(p["target"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["head"]).alias("begin"), (acc["at"] + p["size"] - end).alias("end"))))
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    fresh = F.filter("pieces", lambda p: p["fresh"])
    return windows.select(
        "conv_id",
        F.col("w_start").alias("window_start"),
        F.concat("prefix", F.array_join(F.transform("pieces", lambda p: p["formatted"]), "")).alias("formatted"),
        walked.alias("loss_spans"),
        F.size(fresh).alias("n_fresh"),
        (F.size("pieces") - F.size(fresh)).alias("n_history"),
        F.col("s_text").isNotNull().alias("has_system"),
        add.alias("system_repeated"),
        (F.col("p_tokens") + F.aggregate("pieces", F.lit(0).cast("long"), lambda acc, p: acc + p["tokens"])).alias("tokens"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """The turns of each conversation, read back from formatted windows: conv_id, turns, targets, formatted_chars.

    ``turns`` is the list of (role, text) in order, ``targets`` the unescaped text under each loss span. A window's last
    ``n_fresh`` turns are its own; what stands before them is repeated.
    """
    parts = F.split(F.regexp_replace("formatted", r"<\|im_end\|>\n$", ""), r"<\|im_end\|>\n")
    header = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)$"
    read = windows.select(
        "conv_id", "window_start", F.length("formatted").alias("chars"),
        F.transform(
            F.slice(parts, -F.col("n_fresh"), F.col("n_fresh")),
            lambda p: F.struct(
                unescaped(F.regexp_extract(p, header, 1)).alias("role"), unescaped(F.regexp_extract(p, header, 2)).alias("text")
            ),
        ).alias("turns"),
        F.transform(
            "loss_spans",
            lambda s: unescaped(F.substring(F.col("formatted"), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))),
        ).alias("targets"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("window_start", "turns", "targets")))
    return read.groupBy("conv_id").agg(in_order.alias("windows"), F.sum("chars").alias("formatted_chars")).select(
        "conv_id",
        F.flatten(F.col("windows.turns")).alias("turns"),
        F.flatten(F.col("windows.targets")).alias("targets"),
        F.size("windows").alias("n_windows"),
        "formatted_chars",
    )
