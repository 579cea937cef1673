"""Operator 10: multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered with that speaker as the assistant and all others
as named users; loss-mask spans cover exactly what that speaker says (with its end marker). The role ``system`` is an
instruction, not a participant.

A dialogue is rendered in parts of ``turns_per_part`` consecutive turn numbers, and a part in slices of about ``chars_per_slice``
characters (each message counts 64 more); a dialogue within one slice gives one row per participant. So a row is bounded
by a slice and its longest message, also where very many messages have no turn, one turn number, or no dialogue id. Where a
slice begins follows from a running sum over the messages of a part: identical messages are combined before the shuffle, messages are
range-partitioned in order and written once, summed inside each range, and the sums of the ranges before are added; no window
holds a part that lies in many ranges. Participants are joined as rows.

Defined results: identical rows (same dialogue, turn, role, text) are one message; messages that share a turn number
follow by role, then text; a null turn comes first, in a part of its own (-1); a null or empty text is an empty
message; a null role speaks as ``unknown``; a null dialogue id is a dialogue of its own; a dialogue without participants
gives one row per part with a null speaker and no span; an empty table gives no row; other columns are not read. Marker
strings inside texts are broken up with a space, so a text cannot open or close a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.llm import _store

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CHARS_PER_SLICE = 1_000_000
SYSTEM, UNKNOWN = "system", "unknown"


def _name(role: Column) -> Column:
    return F.regexp_replace(role, "[^A-Za-z0-9_-]", "_")


def _header(role: Column, speaker: Column) -> Column:
    who = (F.when(role == SYSTEM, F.lit("system"))
           .when(role.eqNullSafe(speaker), F.lit("assistant"))
           .otherwise(F.concat(F.lit("user name="), _name(role))))
    return F.concat(F.lit(OPEN), who, F.lit("\n"))


def _slices(said: DataFrame, chars: int) -> DataFrame:
    """said (distinct messages) with the number of the slice of their part."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = said.withColumn("key", F.struct("conv_id", "part")).repartitionByRange(
        int(said.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64))
    ranged = _store.land(ranged.withColumn("range", F.spark_partition_id()), "messages")
    weight = F.length("text") + 64
    sums = ranged.groupBy("key", "range").agg(F.sum(weight).alias("all"))
    ranges = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range that a part lies in
    before = sums.select("key", "range", F.coalesce(F.sum("all").over(ranges), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("key", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum(weight).over(inside)).join(before, ["key", "range"])
    return placed.withColumn("slice", F.floor((F.col("earlier") + F.col("upto") - weight) / chars).cast("long")).drop("key", "range", "upto", "earlier")


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           turns_per_part: int = 512, chars_per_slice: int = CHARS_PER_SLICE) -> DataFrame:
    """One row per dialogue, participant, part and slice: conv_id, speaker, part, slice, n_messages, n_trained, dialogue, mask_spans
    (``start:end`` in characters of the dialogue, comma-separated)."""
    said = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(UNKNOWN)).alias("role"),
        F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"<\|im_", "< |im_").alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1)).cast("long")).distinct()
    said = _slices(said, chars_per_slice)
    parts = said.groupBy("conv_id", "part", "slice").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("messages"))
    speakers = said.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    turned = (parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")), "left")
              .select("conv_id", "part", "slice", "messages", "speaker"))
    pieces = F.transform("messages", lambda m: F.struct(
        _header(m["role"], F.col("speaker")).alias("head"), F.concat(m["text"], F.lit(CLOSE)).alias("body"),
        (m["role"].eqNullSafe(F.col("speaker"))).alias("own")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct((end + 1).alias("at"),  # the line feed that ends a message
                        F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return (turned.withColumn("pieces", pieces)
            .withColumn("mask", F.aggregate("pieces", start, step)["spans"])
            .select("conv_id", "speaker", "part", "slice",
                    F.size("messages").cast("long").alias("n_messages"), F.size("mask").cast("long").alias("n_trained"),
                    F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("dialogue"),
                    F.array_join("mask", ",").alias("mask_spans")))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# Independent form: one row per (dialogue, participant, message), offsets as running sums, glued with string_agg.
OP10_SQL = r"""
WITH said AS (
  SELECT DISTINCT conv_id, coalesce(CAST(floor(turn / 512.0) AS BIGINT), -1) AS part, turn, coalesce(role, 'unknown') AS role,
         replace(coalesce(text, ''), '<|im_', '< |im_') AS text
  FROM conversations),
cut AS (
  SELECT *, CAST(floor(coalesce(sum(length(text) + 64) OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 1000000.0) AS BIGINT) AS slice FROM said),
who AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
msg AS (
  SELECT s.conv_id, w.speaker, s.part, s.slice, s.turn, s.role, s.text, coalesce(s.role = w.speaker, false) AS own,
         '<|im_start|>' || CASE WHEN s.role = 'system' THEN 'system' WHEN s.role = w.speaker THEN 'assistant'
            ELSE 'user name=' || regexp_replace(s.role, '[^A-Za-z0-9_-]', '_', 'g') END || chr(10) AS head,
         s.text || '<|im_end|>' AS body
  FROM cut s LEFT JOIN who w ON s.conv_id IS NOT DISTINCT FROM w.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY conv_id, speaker, part, slice ORDER BY turn NULLS FIRST, role, text
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begin_at
  FROM msg)
SELECT conv_id, speaker, part, slice, count(*) AS n_messages, count(*) FILTER (WHERE own) AS n_trained,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS dialogue,
       coalesce(string_agg(CAST(CAST(begin_at AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(begin_at + length(body) AS BIGINT) AS VARCHAR), ','
                  ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE own), '') AS mask_spans
FROM placed GROUP BY conv_id, speaker, part, slice
"""
