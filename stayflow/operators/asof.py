"""As-of (point-in-time) join of a change log onto a dated fact.

For each left row, the values of the latest right row at or before the left
row's date, per key. Written as union + carry-forward window instead of a range
join: a range join compares every change with every left row of a key, while
the window is one sort per key. Changes are first reduced to the latest one
per (key, day) with a keyed aggregation, so a window partition holds at most
one change row per day plus the left rows of that key: bounded by the
calendar length, not by how many changes a key receives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.operators.dedupe import latest_per_key


def asof_join(left: DataFrame, right: DataFrame, key: str, left_date: str, right_time: str,
              values: Sequence[str], tiebreak: Sequence[str] = (), matched_col: str = "asof_time") -> DataFrame:
    """Left rows with ``values`` of the change in force on their date (NULL before the first change).

    A change at any time of day D applies from date D on.
    """
    day = right.withColumn("_day", F.to_date(F.col(right_time)))
    per_day = latest_per_key(day.select(key, "_day", right_time, *tiebreak, *values),
                             [key, "_day"], [right_time], list(tiebreak))
    payload = F.struct(F.col(right_time).alias(matched_col), *[F.col(v) for v in values])
    changes = per_day.select(F.col(key), F.col("_day").alias("_t"), F.lit(0).alias("_side"),
                             payload.alias("_payload"))
    lcols = left.columns
    # a row travels with its key and date once: the rest of its columns lie in a struct
    at_date = dict(left.dtypes)[left_date] == "date"
    given = {key: F.col(key)} | ({left_date: F.col("_t").alias(left_date)} if at_date else {})
    rest = [c for c in lcols if c not in given]
    rows = left.select(F.col(key), F.col(left_date).cast("date").alias("_t"), F.lit(1).alias("_side"),
                       F.lit(None).cast(changes.schema["_payload"].dataType).alias("_payload"),
                       F.struct(*[F.col(c) for c in rest]).alias("_left"))
    both = changes.withColumn("_left", F.lit(None).cast(rows.schema["_left"].dataType)).unionByName(rows)
    w = (Window.partitionBy(key).orderBy(F.col("_t"), F.col("_side"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = both.withColumn("_in_force", F.last("_payload", ignorenulls=True).over(w))
    out = carried.filter(F.col("_side") == 1)
    return out.select(*[given[c] if c in given else F.col(f"_left.{c}").alias(c) for c in lcols],
                      F.col(f"_in_force.{matched_col}").alias(matched_col),
                      *[F.col(f"_in_force.{v}").alias(v) for v in values])
