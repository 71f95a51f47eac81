"""Chat formatting by perspective rotation: every participant in turn is the assistant.

For each conversation and each of its speakers, all turns are rendered with that speaker as assistant
and the others as named users; system turns stay system turns. A row is one rendered turn, with its
place in the dialogue, its character offsets, and the span that counts for the loss: the content and
end mark of the assistant's turns. The segments of one conversation and perspective, joined by place,
are the dialogue. Rows, not conversations, are the unit of work, so one very long conversation is
spread over many tasks: places come from a range-partitioned numbering, offsets from sums over
blocks of ``BLOCK`` turns.

Defined cases: a null or empty role is the speaker ``unknown``; a null text is empty; turns are ordered
by ``turn`` (null first), then speaker and text, and repeated rows follow each other; a null ``conv_id``
is one conversation; without speakers other than ``system`` nothing is rendered; offsets are code points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.skew import with_row_index

SYSTEM = "system"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
BLOCK = 1_000


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``perspective``, ``place``, ``role``, ``name``, ``segment``, ``first``, ``past``, ``loss_first``, ``loss_past``."""
    plain = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.expr(f"coalesce(nullif(`{role}`, ''), 'unknown')").alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    numbered = with_row_index(plain, ["turn", "speaker", "content"], ["conv_id"], "place")
    views = plain.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("view_of"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    shown = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    rendered = (
        numbered.join(views, F.expr("conv_id <=> view_of"))
        .select("conv_id", "perspective", "place", "content", shown.alias("role"), F.expr("case when speaker not in ('system', perspective) then speaker end").alias("name"))
        .withColumn("head", F.concat(F.lit(BEGIN), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n")))
        .withColumn("segment", F.concat("head", "content", F.lit(END)))
        .withColumn("size", F.length("segment").cast("long"))
        .withColumn("block", F.expr(f"place div {BLOCK}"))
    )
    sums = rendered.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("size"))
    bases = sums.selectExpr(
        "conv_id as base_conv",
        "perspective as base_view",
        "block as base_block",
        "sum(size) over (partition by conv_id, perspective order by block) - size as base",
    )
    placed = rendered.join(bases, F.expr("conv_id <=> base_conv and perspective = base_view and block = base_block"))
    within = "sum(size) over (partition by conv_id, perspective, block order by place)"
    return placed.withColumn("past", F.expr(f"base + {within}")).selectExpr(
        "conv_id",
        "perspective",
        "place",
        "role",
        "name",
        "segment",
        "past - size as first",
        "past",
        "case when role = 'assistant' then past - size + length(head) end as loss_first",
        "case when role = 'assistant' then past - 1 end as loss_past",
    )
