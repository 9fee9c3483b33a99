"""Operator 6: conversations as budgeted training windows, with a mask of what is to be learned.

Prefix sums of turn tokens deal the turns of a conversation to windows, whole turns only. A window begins with the system
turn and a limited history of the turns before it; what was a target in an earlier window is masked there. Nothing of
this depends on what an earlier window took, so a long conversation is no sequential work: sums go over blocks of turns
first, and no step gathers more than a window or a block.

    <|im_start|>role\\ntext<|im_end|>\\n        per turn

`\\`, `<|` and, in roles, line ends are escaped, so a text cannot forge a turn and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY, BLOCK = 1024, 128, 512
#: Bytes that count as a token.
TOKEN_BYTES = 4


def escaped(text: Column, line_ends: bool = False) -> Column:
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("\\1"))
    return F.replace(out, F.lit("\n"), F.lit("\\2")) if line_ends else out


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\2"), F.lit("\n")), F.lit("\\1"), F.lit("<|"))
    return F.replace(out, F.lit("\\0"), F.lit("\\"))


def _turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its piece of the template, its place in the conversation and the tokens before it."""
    head = F.concat(F.lit(BEGIN), escaped(F.col("role"), True), F.lit("\n"))
    body = escaped(F.col("text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        (F.coalesce(F.col("role"), F.lit("")) == "assistant").alias("target"),
        (F.coalesce(F.col("role"), F.lit("")) == "system").alias("system"),
        F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit(END)).alias("piece"),
    ).withColumn("block", F.floor(F.col("turn") / BLOCK))
    rows = rows.withColumn("tokens", F.ceil(F.octet_length("piece") / TOKEN_BYTES))
    order = ["turn", "piece"]
    sums = rows.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("in_block"), F.sum("tokens").alias("block_tokens"),
        F.min(F.struct("turn", "piece", "system", "tokens")).alias("least"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first("least").over(whole)
    sums = sums.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("places"),
        F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("before"),
        F.when(first["system"], first["piece"]).alias("system_piece"),
        F.when(first["system"], first["tokens"]).otherwise(0).alias("system_tokens"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    counted = rows.withColumn("number", F.row_number().over(within)).withColumn(
        "upto", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = counted.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return joined.select(
        "conv_id", (F.col("places") + F.col("number") - 1).alias("place"), "target", "head", "body", "piece", "tokens",
        "system_piece", "system_tokens", (F.col("before") + F.col("upto") - F.col("tokens") - F.col("system_tokens")).alias("begin"),
    )


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (from 0), repeated (turns at its beginning that an earlier window has), turns, tokens,
    formatted, loss (spans of formatted to learn from, begin and end in code points).

    A window's own turns begin within `room` tokens, half of what the budget leaves beside the system turn and the
    history (an eighth of the budget at least), so it keeps to the budget unless a single turn is longer than that room;
    a turn is never cut. History are the turns that fit in `history` tokens before the first own turn. Only a system turn
    that comes first is retained in every window.

    Turns are ordered by `turn` (null first), equal ones by role and text; repeated rows are turns of their own. A null text
    or role is empty, a null conv_id is one conversation. Other columns are not read. An empty table gives no window.
    """
    turns = _turns(conversations)
    room = F.greatest(F.lit(budget // 8), F.floor((F.lit(budget - history) - F.col("system_tokens")) / 2))
    is_system = (F.col("place") == 0) & F.col("system_piece").isNotNull()
    turns = turns.withColumn("room", room).withColumn("is_system", is_system)
    # The system turn belongs to the window of the first other turn, which is 0.
    own = F.when(F.col("is_system"), F.lit(0)).otherwise(F.floor(F.col("begin") / F.col("room"))).cast("long")
    turns = turns.withColumn("own", own)
    last = F.greatest(F.col("own"), F.floor((F.col("begin") + history) / F.col("room")).cast("long"))
    placed = turns.withColumn("slot", F.explode(F.when(F.col("is_system"), F.array(F.col("own"))).otherwise(F.sequence("own", last))))
    slots = turns.groupBy("conv_id", "own").agg(
        F.min(F.when(~F.col("is_system"), F.col("begin"))).alias("first_begin"), F.first("system_piece").alias("retained"),
        F.min("is_system").alias("only_system"),
    ).select(F.col("conv_id").alias("c"), F.col("own").alias("s"), "first_begin", "retained")
    placed = placed.join(slots.drop("retained"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slot") == F.col("s")))
    fresh = F.col("slot") == F.col("own")
    placed = placed.where(fresh | (F.col("first_begin") - F.col("begin") <= history))
    placed = placed.select("conv_id", "slot", "place", fresh.alias("fresh"), "target", "head", "body", "piece", "tokens")
    retained = slots.where("s > 0 AND retained IS NOT NULL").select(
        F.col("c").alias("conv_id"), F.col("s").alias("slot"), F.lit(0).cast("long").alias("place"), F.lit(False).alias("fresh"),
        F.lit(False).alias("target"), F.lit(0).alias("head"), F.lit(0).alias("body"), F.col("retained").alias("piece"),
        F.ceil(F.octet_length("retained") / TOKEN_BYTES).alias("tokens"),
    )
    rows = placed.unionByName(retained)
    before = Window.partitionBy("conv_id", "slot").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    begin = (F.col("at") + F.col("head")).cast("int")
    span = F.when(F.col("fresh") & F.col("target"), F.struct(begin.alias("begin"), (begin + F.col("body")).cast("int").alias("end")))
    parts = F.sort_array(F.collect_list(F.struct("place", "piece", span.alias("span"))))
    windows = rows.groupBy("conv_id", "slot").agg(
        F.sum(F.when(F.col("fresh"), 0).otherwise(1)).alias("repeated"), F.count(F.lit(1)).alias("turns"),
        F.sum("tokens").alias("tokens"), parts.alias("parts"),
    )
    return windows.select(
        "conv_id", F.col("slot").alias("window"), "repeated", "turns", "tokens",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """What the formatted windows say, read back from them alone: conv_id, window, turns (role and text of the window's own
    turns, unescaped), learned (the texts under the loss mask, unescaped), chars (code points of the window)."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    turn = lambda p: F.substring(p, len(BEGIN) + 1, F.length(p))
    role = lambda p: F.substring_index(turn(p), "\n", 1)
    read = F.transform(
        F.slice(parts, F.col("repeated") + 1, F.col("turns") - F.col("repeated")),
        lambda p: F.struct(unescaped(role(p)).alias("role"), unescaped(F.substring(turn(p), F.length(role(p)) + 2, F.length(p))).alias("text")),
    )
    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["begin"] + 1, s["end"] - s["begin"])))
    return windows.select("conv_id", "window", read.alias("turns"), learned.alias("learned"), F.length("formatted").alias("chars"))
