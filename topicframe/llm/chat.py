"""Chat formatting: every dialogue once from the side of each participant.

For each participant of a conversation (each speaker but the system), the
dialogue is rendered with that speaker as ``assistant`` and the others as
named users; the loss mask covers what the assistant says and its end
marker. The result has a row a segment (conversation, perspective,
position): its text and its place in the rendered dialogue, so that the
dialogue is the segments in order and no conversation has to fit into one
row or task.

Places are running sums. They are taken in blocks of ``BLOCK_TURNS`` turns,
then over the blocks' totals, so a conversation that holds a third of all
rows is dealt over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 256
END = "<|im_end|>"
COLUMNS = ["conv_id", "perspective", "position", "turn", "speaker", "as_role", "segment", "seg_start", "seg_end", "mask_start", "mask_end"]


def rotate_perspectives(turns: DataFrame, system: str = "system", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Segments of the rendered dialogues of ``turns`` (conv_id, turn, role, text).

    ``position`` counts from 0 by turn, then speaker, then text.
    ``seg_start``/``seg_end`` are code points in the rendered dialogue, end
    exclusive; ``mask_start``/``mask_end`` the part that is learnt, null for
    other speakers.

    A null role speaks as "unknown", a null text is empty, null turns come
    first, and rows without a conv_id are one conversation. Repeated rows
    are segments of their own. A conversation with only system turns has no
    perspective and gives no rows. Other columns are not read.
    """
    spoken = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("said"),
        F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 60))).alias("block"),
    )
    sides = spoken.where(F.col("speaker") != system).select(F.col("conv_id").alias("side_conv"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    as_role = F.when(F.col("speaker") == system, system).when(own, "assistant").otherwise("user")
    name = F.when((F.col("speaker") == system) | own, "").otherwise(F.concat(F.lit(" name="), F.col("speaker")))
    head = F.concat(F.lit("<|im_start|>"), as_role, name, F.lit("\n"))
    rows = spoken.join(sides, F.col("conv_id").eqNullSafe(F.col("side_conv"))).select(
        "conv_id", "perspective", "block", "turn", "speaker", as_role.alias("as_role"),
        F.concat(head, F.col("said"), F.lit(END + "\n")).alias("segment"),
        F.length(head).alias("head"), "said", own.alias("own"),
    )
    keys = ["conv_id", "perspective", "block"]
    order = Window.partitionBy(*keys).orderBy("turn", "speaker", "said")
    inside = rows.withColumns(
        {
            "seg_end": F.sum(F.length("segment").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "position": F.row_number().over(order).cast("bigint") - 1,
        }
    )
    total = rows.groupBy(*keys).agg(F.sum(F.length("segment").cast("bigint")).alias("chars"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = total.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b"))
    end = F.col("seg_end") + F.col("chars_before")
    start = end - F.length("segment")
    return inside.join(base, same).select(
        "conv_id", "perspective", (F.col("position") + F.col("rows_before")).alias("position"), "turn", "speaker", "as_role", "segment",
        start.alias("seg_start"), end.alias("seg_end"),
        F.when(F.col("own"), start + F.col("head")).alias("mask_start"), F.when(F.col("own"), end - 1).alias("mask_end"),
    )


def op1_chat_perspectives(spark, sf_dir: str) -> DataFrame:
    return rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(*COLUMNS)


OP1_SQL = f"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said FROM conversations),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.conv_id, perspective, turn, speaker, said, speaker = perspective AS own,
             CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS as_role,
             CASE WHEN speaker = 'system' OR speaker = perspective THEN '' ELSE ' name=' || speaker END AS name
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
g AS (SELECT *, '<|im_start|>' || as_role || name || chr(10) AS head,
             '<|im_start|>' || as_role || name || chr(10) || said || '{END}' || chr(10) AS segment FROM r),
n AS (SELECT *, row_number() OVER w - 1 AS position, CAST(sum(length(segment)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg_end
      FROM g WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, said))
SELECT conv_id, perspective, position, turn, speaker, as_role, segment, seg_end - length(segment) AS seg_start, seg_end,
       CASE WHEN own THEN seg_end - length(segment) + length(head) END AS mask_start, CASE WHEN own THEN seg_end - 1 END AS mask_end
FROM n
"""
