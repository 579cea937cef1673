"""Shares, grand totals, global rank with running share, and top-k share.

None of these moves all rows into one task:

* ``share_of_partition`` aggregates the partition totals (partial, map-side)
  and joins them back on the partition keys;
* ``grand_total`` is a scalar subquery over a global aggregate;
* ``rank_with_running_share`` range-partitions by the ranking order, numbers
  and accumulates rows inside each range partition with a window, then adds
  per-partition offsets (one row per partition, so the broadcast is bounded by
  the partition count, not by the data);
* ``top_k_share`` takes the top k with ``orderBy().limit(k)``
  (per-partition top-k, then a merge of k rows per partition).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.session import shared_dir


def share_of_partition(df: DataFrame, value_col: str, partition_cols: Sequence[str], out_col: str,
                       method: str = "join") -> DataFrame:
    """value / sum(value) over the partition; NULL when the total is 0 or NULL.

    ``method="join"`` (default, for any input): partition totals are a keyed,
    map-side-combined aggregate joined back on the partition keys; a hot key is
    handled by AQE (broadcast of the small totals side, or skew-join splitting).
    ``method="window"``: a window over the partition, for input that is already
    aggregated so that rows per partition are bounded by a categorical domain
    (e.g. months x a boolean flag). It reads the input once, where the join
    form's pruned totals branch plans a second pass over it.
    """
    if method == "window":
        total = F.sum(value_col).over(Window.partitionBy(*partition_cols))
        return df.withColumn(out_col, F.col(value_col) / F.nullif(total, F.lit(0)))
    keys = list(partition_cols)
    totals = df.groupBy(*keys).agg(F.sum(value_col).alias("_total")).select(*(F.col(k).alias(f"_of_{k}") for k in keys), "_total")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]  # rows with a NULL key are a group too, as in the window form
    share = F.col(value_col) / F.nullif(F.col("_total"), F.lit(0))
    return df.join(totals, same, "left").select(*df.columns, share.alias(out_col))


def grand_total(df: DataFrame, value_col: str) -> Column:
    """sum(value) over the whole frame as a one-value column (scalar subquery)."""
    return df.select(F.sum(value_col)).scalar()


def top_k_share(df: DataFrame, value_col: str, k: int, tiebreak: Sequence[str],
                count_col: str = "n", total_col: str = "total", top_col: str = "top_k",
                pct_col: str = "top_k_pct") -> DataFrame:
    """Count, total, sum of the k largest values and their percent of the total."""
    order = [F.col(value_col).desc()] + [F.col(c).asc() for c in tiebreak]
    top = df.orderBy(*order).limit(k).select(F.sum(value_col)).scalar()
    summary = df.agg(F.count(F.lit(1)).alias(count_col), F.sum(value_col).alias(total_col))
    return summary.withColumn(top_col, top).withColumn(
        pct_col, F.lit(100) * F.col(top_col) / F.nullif(F.col(total_col), F.lit(0))
    )


def rank_with_running_share(df: DataFrame, value_col: str, tiebreak: Sequence[str],
                            rank_col: str = "rank", running_col: str = "running_total",
                            num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """Row number by ``value_col`` desc (ties by ``tiebreak`` asc) and the
    running sum of ``value_col`` in that order, without a single-partition window.

    Rows are range-partitioned by the order (ties split by the tiebreak, so a hot value cannot fill one
    partition) and written once to the shared folder with the number of their partition. A window inside each
    partition, plus the totals of the partitions before it, gives the result. Decimals are summed as
    DECIMAL(38, scale), exactly; other numerics as doubles.

    With ``total_col`` the grand total is attached as well, taken from the
    per-partition sums, so callers need no second pass over ``df``.
    """
    spark = df.sparkSession
    vtype = df.schema[value_col].dataType
    acc = T.DecimalType(38, vtype.scale) if isinstance(vtype, T.DecimalType) else T.DoubleType()
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    parted = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    path = shared_dir(spark, "stayflow-rank", uuid.uuid4().hex)
    parted.write.parquet(path)
    parted = spark.read.schema(parted.schema).parquet(path)

    value = F.coalesce(F.col(value_col).cast(acc), F.lit(0).cast(acc))
    per_part = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).cast(acc).alias("_s"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off_n"),
        F.coalesce(F.sum("_s").over(w), F.lit(0)).cast(acc).alias("_off_s"),
        F.sum("_s").over(everything).cast(acc).alias("_all_s"),
    )
    inside = Window.partitionBy("_pid").orderBy(*order)
    numbered = parted.withColumn("_local_rank", F.row_number().over(inside).cast("long")).withColumn(
        "_local_cum", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)).cast(acc))
    out = numbered.join(F.broadcast(offsets), "_pid")  # bounded by the partition count
    cols = [*df.columns, (F.col("_local_rank") + F.col("_off_n")).alias(rank_col),
            (F.col("_local_cum") + F.col("_off_s")).cast(acc).alias(running_col)]
    if total_col:
        cols.append(F.col("_all_s").alias(total_col))
    return out.select(*cols)
