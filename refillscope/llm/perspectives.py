"""Operator 7: multi-party chat formatting by rotating the perspective.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant, all others as named users, and a loss mask on the assistant's turns. A dialogue is
returned turn by turn, with the character offsets of each turn in the rendered whole, so a
conversation of any length is never gathered in one row. Offsets are running sums within
blocks of turns and over the blocks' totals. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Speakers who set the scene and take no part: rendered as they are, in every perspective.
DEFAULT_CONTEXT = ("system",)
# Name of a speaker whose role is null.
UNNAMED = "unknown"
# Turn numbers of a block.
BLOCK_TURNS = 256

# The marks of the rendered format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame, context: Sequence[str] = DEFAULT_CONTEXT) -> DataFrame:
    """One row per conversation, perspective and turn.

    ``conv_id, perspective, position`` (from 0), ``turn, role`` (system, assistant or user),
    ``name`` (the speaker, of user turns only), ``rendered``, ``start`` and ``stop`` (code
    points of the rendered turn in its dialogue), ``loss_start`` and ``loss_stop`` (the span to
    learn: an assistant's text and closing mark, null for all other turns).

    Reads ``conv_id, turn, role, text`` alone. Participants are the distinct roles of a
    conversation outside ``context``; a null role is the speaker ``unknown``, null text is
    empty. Turns are in order of turn (nulls first), speaker and text; repeated rows are
    turns of their own. Rows with a null ``conv_id`` belong to no conversation and are left
    out; a conversation without participants has no perspective. An empty input gives an empty
    result.
    """
    said = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(UNNAMED)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62))).alias("block"),
    )
    people = said.where(~F.col("speaker").isin(list(context))).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    # Participants go to each block of the conversation, so that its turns need not meet.
    cast = said.select("conv_id", "block").distinct().join(people, "conv_id")
    seen = said.join(cast, ["conv_id", "block"])

    scene = F.col("speaker").isin(list(context))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(scene, F.col("speaker")).when(own, "assistant").otherwise("user")
    name = F.when(~scene & ~own, F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    rendered = F.concat(head, F.col("text"), F.lit(CLOSE))
    drawn = seen.select(
        "conv_id", "perspective", "block", "turn", "speaker", "text", role.alias("role"), name.alias("name"),
        rendered.alias("rendered"), F.length(rendered).cast("long").alias("size"), F.length(head).cast("long").alias("head"),
    )

    totals = drawn.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("chars"), F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        "conv_id", "perspective", "block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_ahead") for c in ("chars", "turns")],
    )
    line = Window.partitionBy("conv_id", "perspective", "block").orderBy("turn", "speaker", "text")
    placed = drawn.select(
        "*",
        (F.row_number().over(line) - 1).alias("place"),
        (F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("offset"),
    ).join(ahead, ["conv_id", "perspective", "block"])
    start = F.col("chars_ahead") + F.col("offset")
    learn = F.col("role") == "assistant"
    return placed.select(
        "conv_id",
        "perspective",
        (F.col("turns_ahead") + F.col("place")).alias("position"),
        "turn",
        "role",
        "name",
        "rendered",
        start.alias("start"),
        (start + F.col("size")).alias("stop"),
        F.when(learn, start + F.col("head")).alias("loss_start"),
        # The line end after the closing mark is not learned.
        F.when(learn, start + F.col("size") - 1).alias("loss_stop"),
    )


#: The same in SQL, over whole conversations.
SQL = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '{UNNAMED}') AS speaker, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
drawn AS (
    SELECT s.conv_id, p.perspective, s.turn, s.speaker, s.text,
           CASE WHEN s.speaker = 'system' THEN 'system' WHEN s.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS role,
           CASE WHEN s.speaker NOT IN ('system', p.perspective) THEN s.speaker END AS name
    FROM said s JOIN people p ON s.conv_id = p.conv_id
),
headed AS (SELECT *, '{OPEN}' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM drawn),
rendered AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM headed),
placed AS (
    SELECT *,
           row_number() OVER w - 1 AS position,
           CAST(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
    FROM rendered
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text)
)
SELECT conv_id, perspective, position, turn, role, name, rendered, stop - length(rendered) AS start, stop,
       CASE WHEN role = 'assistant' THEN stop - length(rendered) + length(head) END AS loss_start,
       CASE WHEN role = 'assistant' THEN stop - 1 END AS loss_stop
FROM placed
"""
