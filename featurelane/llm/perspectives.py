"""Chat formatting by multi-party perspective rotation, DataFrame operations only.

For every participant of a conversation the whole dialogue is rendered once with that speaker as the
assistant and all others as named users; only the assistant's turns carry loss.  Roles in ``CONTEXT_ROLES`` are
no participants: their turns stay as they are in every rendering.

The result has one row per rendering and turn.  In turn order the ``segment`` texts of a rendering are its text;
``start`` and ``stop`` place the segment in it, ``mask_start`` and ``mask_stop`` the characters that are trained on (the
assistant's content and end mark).  Places are running sums over ordered slices, so a conversation of
any length is spread over tasks, and no dialogue is collected into a row.

Results by case: a null text is empty; a null role is a user without a name and no participant; rows with a
null conv_id are one conversation; a conversation without participants has no rendering; turns of equal number
are ordered by role, then text; rows that repeat are turns each; an empty table gives no rows; other columns
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelane.operators.ordered import running_sums

CONTEXT_ROLES = ("system",)
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame, context_roles: Sequence[str] = CONTEXT_ROLES, conversation: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, perspective, turn, speaker, chat_role, name, content, segment, start, stop, mask_start, mask_stop."""
    said = turns.select(F.col(f"`{conversation}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("speaker"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("content"))
    people = said.where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*context_roles)).select(
        F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective")).distinct()
    each = said.join(people, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    context = F.coalesce(F.col("speaker").isin(*context_roles), F.lit(False))
    own = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    chat = F.when(context, F.col("speaker")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    name = F.when(~context & ~own, F.col("speaker"))
    each = each.withColumn("chat_role", chat).withColumn("name", name)
    head = F.concat(F.lit(BEGIN), "chat_role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    each = each.withColumn("segment", F.concat(head, "content", F.lit(END)))
    placed = running_sums(each, ["conv_id", "perspective"], ["turn", "speaker", "content"],
                          {"stop": F.length("segment").cast("long")})
    start = F.col("stop") - F.length("segment")
    trained = F.col("chat_role") == "assistant"
    body = start + F.length("segment") - F.length("content") - len(END)
    return placed.select("conv_id", "perspective", "turn", "speaker", "chat_role", "name", "content", "segment", start.alias("start"), "stop",
                         F.when(trained & (F.col("speaker") == F.col("perspective")), body).alias("mask_start"),
                         F.when(trained & (F.col("speaker") == F.col("perspective")), F.col("stop")).alias("mask_stop"))


ORACLE = """
WITH said AS (SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS content FROM conversations),
people AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM said WHERE speaker IS NOT NULL AND speaker <> 'system'),
each AS (
  SELECT conv_id, perspective, turn, speaker, content,
         CASE WHEN coalesce(speaker = 'system', false) THEN speaker WHEN coalesce(speaker = perspective, false) THEN 'assistant' ELSE 'user' END AS chat_role,
         CASE WHEN NOT coalesce(speaker = 'system', false) AND NOT coalesce(speaker = perspective, false) THEN speaker END AS name
  FROM said JOIN people ON conv_id IS NOT DISTINCT FROM c),
made AS (SELECT *, '<|im_start|>' || chat_role || coalesce(' name=' || name, '') || chr(10) || content || '<|im_end|>' || chr(10) AS segment FROM each),
placed AS (SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn, speaker, content
                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM made)
SELECT conv_id, perspective, turn, speaker, chat_role, name, content, segment, stop - length(segment) AS start, stop,
       CASE WHEN chat_role = 'assistant' AND speaker = perspective THEN stop - length(content) - 11 END AS mask_start,
       CASE WHEN chat_role = 'assistant' AND speaker = perspective THEN stop END AS mask_stop
FROM placed
"""
