"""Chat formatting by perspective rotation.

Method: every participant of a conversation (each role but the system's) gets
a rendering of the whole dialogue in which that speaker is the assistant and
the others are named users.  The result is one row per perspective and turn:
the rendered text of the turn, where it stands in the perspective's text, and
the range the loss counts (the assistant's words and its end mark).  Places
are running sums taken in two levels, over blocks of turns and inside a block,
so one very long conversation is spread over many tasks.

Defined cases: a null role is the speaker "unknown"; a null text is empty; a
null turn comes first; rows with equal turns are ordered by role and text, and
repeated rows are repeated turns; a conversation with only system turns has no
participant and no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BLOCK_TURNS = 512


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role), F.lit("unknown")).alias("speaker"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    people = t.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    mine = F.col("speaker") == F.col("perspective")
    role_as = F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(mine, F.lit("assistant")).otherwise(F.lit("user"))
    r = (t.join(people, t.conv_id.eqNullSafe(people.conv_id)).drop(people.conv_id)
         .withColumns({"role": role_as, "mask": mine.cast("int"),
                       "block": F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))})
         .withColumn("name", F.when(F.col("role") == "user", F.col("speaker"))))
    head = F.concat(F.lit(OPEN), F.col("role"),
                    F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), "name")).otherwise(F.lit("")), F.lit("\n"))
    r = r.withColumns({"head_chars": F.length(head),
                       "rendered": F.concat(head, "text", F.lit(CLOSE + "\n"))})
    r = r.withColumn("chars", F.length("rendered").cast("long"))

    who = ["conv_id", "perspective"]
    before = Window.partitionBy(*who).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = r.groupBy(*who, "block").agg(F.sum("chars").alias("c"), F.count(F.lit(1)).alias("n")).select(
        *who, "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("turns_before"))
    inside = Window.partitionBy(*who, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    b = blocks.alias("b")
    r = r.withColumns({"end_in_block": F.sum("chars").over(upto), "nth": F.row_number().over(inside)}).alias("r")
    r = r.join(b, F.col("r.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("r.perspective") == F.col("b.perspective"))
               & (F.col("r.block") == F.col("b.block")))
    start = F.col("chars_before") + F.col("end_in_block") - F.col("chars")
    marked = F.col("mask") == 1
    return r.select(
        "r.conv_id", "r.perspective", (F.col("turns_before") + F.col("nth") - 1).cast("long").alias("position"), "turn",
        "role", "name", "rendered", start.alias("char_start"), (start + F.col("chars")).alias("char_end"),
        F.when(marked, start + F.col("head_chars")).alias("mask_start"),
        # the mask ends after the end mark, before the line break
        F.when(marked, start + F.col("chars") - 1).alias("mask_end"))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, p.perspective, CAST(t.speaker = p.perspective AS INTEGER) AS mask,
         CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.perspective THEN 'assistant'
              ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
n AS (SELECT *, CASE WHEN role = 'user' THEN speaker END AS name FROM r),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM n),
x AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM h),
s AS (
  SELECT *, CAST(sum(length(rendered)) OVER w AS BIGINT) AS char_end, row_number() OVER w - 1 AS position FROM x
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, perspective, position, turn, role, name, rendered, char_end - length(rendered) AS char_start, char_end,
       CASE WHEN mask = 1 THEN char_end - length(rendered) + length(head) END AS mask_start,
       CASE WHEN mask = 1 THEN char_end - 1 END AS mask_end
FROM s"""
