"""Exact distinct counts that can be merged: bitmaps over dense ids.

``dense_ids`` numbers the values of a key 0, 1, 2, ... without a global window. ``distinct_state`` keeps, per group and range of 32,768
ids, a bitmap of the ids that occur: a partial state of bounded size that is computed once, can be stored, and can be merged with
the state of other rows (another month) by a bitwise or. ``distinct_counts`` rolls it up to any coarser grain. A distinct
count cannot be rolled up itself: one listing in two months is one listing of the year.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.session import shared_dir


def dense_ids(df: DataFrame, key: str, out: str = "id") -> DataFrame:
    """key, ``out``: every distinct non-null value of the key and its number, in order of the key. Values are range-partitioned and
    written once; numbers inside a partition are added to the counts of the partitions before (one row per partition)."""
    spark = df.sparkSession
    path = shared_dir(spark, "stayflow-ids", uuid.uuid4().hex)
    parted = (df.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
              .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "k").withColumn("p", F.spark_partition_id()))
    parted.write.parquet(path)
    parted = spark.read.schema(parted.schema).parquet(path)
    before = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parted.groupBy("p").agg(F.count(F.lit(1)).alias("n")).select("p", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("p").orderBy("k")
    numbered = parted.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "p")  # bounded by the partition count
    return numbered.select(F.col("k").alias(key), (F.col("nth") + F.col("before")).cast("long").alias(out))


def distinct_state(df: DataFrame, dims: Sequence[str], ids: dict[str, str]) -> DataFrame:
    """dims, ``counted`` (a name of ``ids``), ``bucket``, ``bits``: the ids that occur per group, one scan for all counted columns
    (name -> column of dense ids; nulls are not counted)."""
    each = F.array(*(F.struct(F.lit(n).alias("counted"), F.col(c).cast("long").alias("id")) for n, c in ids.items()))
    # ids from 1: bucket 1 holds 1 .. 32768
    rows = df.select(*dims, F.explode(each).alias("e")).where("e.id IS NOT NULL").select(*dims, "e.counted", (F.col("e.id") + 1).alias("id"))
    return rows.groupBy(*dims, "counted", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of the rows of both (for instance a stored state and that of a new month)."""
    both = a.unionByName(b)
    return both.groupBy(*(c for c in both.columns if c != "bits")).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, dims: Sequence[str], names: Sequence[str]) -> DataFrame:
    """dims and one exact distinct count per name, at a grain that the state's groups add up to."""
    merged = state.groupBy(*dims, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = [F.coalesce(F.sum(F.when(F.col("counted") == n, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias(n) for n in names]
    return merged.groupBy(*dims).agg(*counts) if dims else merged.agg(*counts)
