"""Preference formatting: a shared prompt and two masked completions per pair of conversations.

The longest common prefix of turns of the chosen and the rejected conversation is the prompt and is
rendered once; what follows on either side is a completion. The result is in segments, one row per
rendered turn with its place in its part, so that a conversation of any length is spread over tasks.
Only built-in DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import table

#: Turns that one range of a conversation holds.
RANGE_TURNS = 512


def rendered_header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def rendered(role: Column, text: Column) -> Column:
    """A turn as text: role marker, content (null: empty), end marker."""
    return F.concat(rendered_header(role), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def running(df: DataFrame, group: list[str], order: str | list[str], value: Column, name: str, ranges: Column | None = None) -> DataFrame:
    """Sum of ``value`` over the rows of a group that come before in ``order`` (0, 1, 2, ...), whatever the group's size.

    Ranges of RANGE_TURNS are summed by their own tasks; totals of earlier ranges are added. Any other order needs its
    ``ranges``, which are not null and follow it.
    """
    cut = df.withColumn("_value", value).withColumn("_range", F.floor(F.col(order) / RANGE_TURNS) if ranges is None else ranges)
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = cut.groupBy(*group, "_range").agg(F.sum("_value").alias("_sum")).select(
        *group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*group, "_range").orderBy(*([order] if isinstance(order, str) else order)).rowsBetween(W.unboundedPreceding, -1)
    return cut.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(
        totals, [*group, "_range"]).withColumn(name, F.col("_start") + F.col("_inside")).drop(
        "_value", "_range", "_start", "_inside")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Turns ``pair_id, position, role, text`` of either side -> segments ``pair_id, part, position, role, segment, start,
    loss_start, loss_end, prompt_turns``.

    ``position`` counts a conversation's turns from 0 without gaps. ``part`` is prompt, chosen or rejected; ``position``
    and ``start`` (characters) are the segment's place inside its part. Loss falls on characters loss_start to
    loss_end of the segment: the content and end marker of assistant turns of completions, nothing elsewhere
    (both 0). Turns are equal if role and text are, null equalling null. A pair that has only one side, or equal
    sides, keeps what it has. Pairs with a null id have no partner and are left out.
    """
    c = chosen.where("pair_id is not null").select("pair_id", "position", F.struct("role", "text").alias("c"), F.lit(True).alias("in_c"))
    r = rejected.where("pair_id is not null").select("pair_id", "position", F.struct("role", "text").alias("r"), F.lit(True).alias("in_r"))
    both = c.join(r, ["pair_id", "position"], "full")
    same = F.coalesce(F.col("in_c") & F.col("in_r"), F.lit(False)) & F.col("c").eqNullSafe(F.col("r"))
    # where a pair first differs; one small row per pair, summed up before the shuffle
    cut = both.groupBy("pair_id").agg(
        F.min(F.when(~same, F.col("position"))).alias("differs"), (F.max("position") + 1).alias("turns"))
    cut = cut.select("pair_id", F.coalesce("differs", "turns").alias("prompt_turns"))
    turn = lambda part, side: F.struct(F.lit(part).alias("part"), F.col(f"{side}.role").alias("role"), F.col(f"{side}.text").alias("text"))
    shared = F.col("position") < F.col("prompt_turns")
    sides = F.when(shared, F.array(turn("prompt", "c"))).otherwise(F.filter(
        F.array(F.when(F.col("in_c"), turn("chosen", "c")), F.when(F.col("in_r"), turn("rejected", "r"))), lambda x: x.isNotNull()))
    turns = both.join(cut, "pair_id").select("pair_id", "position", "prompt_turns", F.inline(sides)).withColumn(
        "position", F.when(F.col("part") == "prompt", F.col("position")).otherwise(F.col("position") - F.col("prompt_turns")))
    segments = turns.withColumn("segment", rendered(F.col("role"), F.col("text")))
    placed = running(segments, ["pair_id", "part"], "position", F.length("segment").cast("long"), "start")
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role") == "assistant", F.lit(False))
    return placed.select(
        "pair_id", "part", "position", "role", "segment", "start",
        F.when(trained, F.length(rendered_header(F.col("role")))).otherwise(0).alias("loss_start"),
        F.when(trained, F.length("segment") - 1).otherwise(0).alias("loss_end"), "prompt_turns")


def preference_pairs(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv_id, turn, role, text`` -> chosen and rejected turns, a pair per conversation.

    Chosen is the conversation. Rejected has its turns up to the last assistant turn, which it replaces, with what
    follows, by the turns of the neighbour (id xor 1) from that one's last assistant turn on. Without an assistant
    turn the replacement begins at the first turn. Every row is a turn, in the order of turn (null last), role and text;
    rows without a turn are ordered by a hash first, so that any number of them is spread.
    """
    rows = turns.where("conv_id is not null").groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "none": F.col("turn").isNull(), "part": F.when(F.col("turn").isNull(), F.pmod(F.xxhash64("role", "text"), F.lit(256))).otherwise(0)})
    ranges = F.struct("none", F.coalesce(F.floor(F.col("turn") / RANGE_TURNS), F.lit(0)).alias("turns"), "part")
    rows = running(rows, ["conv_id"], ["none", "turn", "part", "role", "text"], F.col("n"), "before", ranges)
    copies = rows.select("conv_id", "turn", "role", "text", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    rows = copies.select("conv_id", "turn", "role", "text", (F.col("before") + F.col("copy")).alias("position"))
    last = rows.groupBy("conv_id").agg(F.coalesce(
        F.max(F.when(F.col("role") == "assistant", F.col("position"))), F.lit(0)).alias("last"))
    cut = rows.join(last, "conv_id")
    chosen = rows.select(F.col("conv_id").alias("pair_id"), "position", "role", "text")
    head = cut.where("position < last").select(F.col("conv_id").alias("pair_id"), "position", "role", "text")
    tail = cut.where("position >= last").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), (F.col("position") - F.col("last")).alias("after"), "role", "text")
    joined = tail.join(last.select(F.col("conv_id").alias("pair_id"), "last"), "pair_id").select(
        "pair_id", (F.col("last") + F.col("after")).alias("position"), "role", "text")
    return chosen, head.unionAll(joined)


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of one preference pair per conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_preferences(*preference_pairs(turns))


ORACLE = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, role, text FROM conversations),
last AS (SELECT conv_id, coalesce(max(position) FILTER (role = 'assistant'), 0) AS last FROM turns GROUP BY conv_id),
cut AS (SELECT * FROM turns JOIN last USING (conv_id)),
rejected AS (
  SELECT conv_id, position, role, text FROM cut WHERE position < last
  UNION ALL
  SELECT l.conv_id, l.last + c.position - c.last, role, text
  FROM cut c JOIN last l ON l.conv_id = xor(c.conv_id, 1) WHERE c.position >= c.last),
sides AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS pair_id, coalesce(c.position, r.position) AS position, c.role AS c_role,
    c.text AS c_text, r.role AS r_role, r.text AS r_text, c.conv_id IS NOT NULL AS in_c, r.conv_id IS NOT NULL AS in_r
  FROM turns c FULL JOIN rejected r ON r.conv_id = c.conv_id AND r.position = c.position),
prefix AS (
  SELECT pair_id, coalesce(min(position) FILTER (NOT (in_c AND in_r AND c_role IS NOT DISTINCT FROM r_role
    AND c_text IS NOT DISTINCT FROM r_text)), max(position) + 1) AS prompt_turns FROM sides GROUP BY pair_id),
parts AS (
  SELECT pair_id, 'prompt' AS part, position, c_role AS role, c_text AS text, prompt_turns
  FROM sides JOIN prefix USING (pair_id) WHERE position < prompt_turns
  UNION ALL SELECT pair_id, 'chosen', position - prompt_turns, c_role, c_text, prompt_turns
  FROM sides JOIN prefix USING (pair_id) WHERE position >= prompt_turns AND in_c
  UNION ALL SELECT pair_id, 'rejected', position - prompt_turns, r_role, r_text, prompt_turns
  FROM sides JOIN prefix USING (pair_id) WHERE position >= prompt_turns AND in_r),
segments AS (
  SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS segment,
    part <> 'prompt' AND coalesce(role = 'assistant', false) AS trained FROM parts)
SELECT pair_id, part, position, role, segment,
  CAST(coalesce(sum(length(segment)) OVER (
    PARTITION BY pair_id, part ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  CASE WHEN trained THEN CAST(length(role) + 5 AS INT) ELSE 0 END AS loss_start,
  CASE WHEN trained THEN CAST(length(segment) - 1 AS INT) ELSE 0 END AS loss_end, prompt_turns
FROM segments
"""
