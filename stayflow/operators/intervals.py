"""A change log as validity intervals, and the join of dated rows to the interval in force.

``validity`` gives each change the half-open interval [valid_from, valid_to) of days through which it was in force, the last one without
end. ``interval_join`` finds the interval of each row by time buckets: an interval is entered in every bucket that it meets (up to the last
day that any row asks for), and rows meet intervals on (key, bucket), refined inside by the dates. That is an equi-join,
so a key with very many changes or rows is dealt out bucket by bucket. Choose buckets of about the usual length of an
interval: shorter ones repeat intervals, longer ones compare more pairs inside a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.dedupe import latest_per_key
from stayflow.operators.timeline import SEGMENT_DAYS, day_segment, with_next


def validity(changes: DataFrame, key: str, time: str, values: Sequence[str], tiebreak: Sequence[str] = (),
             from_col: str = "valid_from", to_col: str = "valid_to") -> DataFrame:
    """key, valid_from, valid_to, ``time`` and ``values``: the latest change of each day is in force from that day up to the day of the
    next one. A change without a time is in force never and left out."""
    day = changes.where(F.col(time).isNotNull()).withColumn(from_col, F.to_date(F.col(time)))
    per_day = latest_per_key(day.select(key, from_col, time, *tiebreak, *values), [key, from_col], [time], list(tiebreak))
    return with_next(per_day.select(key, from_col, time, *values), [key], from_col, to_col).select(key, from_col, to_col, time, *values)


def interval_join(left: DataFrame, intervals: DataFrame, key: str, date: str, values: Sequence[str],
                  from_col: str = "valid_from", to_col: str = "valid_to", bucket_days: int = SEGMENT_DAYS) -> DataFrame:
    """Left rows with ``values`` of the interval of their key that holds their date (null where there is none, or without a key or
    date). Intervals of one key do not overlap."""
    asked = left.select(F.struct(F.min(F.col(date).cast("date")).alias("lo"), F.max(F.col(date).cast("date")).alias("hi"))).scalar()
    lo, hi = asked.getField("lo"), asked.getField("hi")
    first = F.greatest(F.col(from_col), lo)
    last = F.least(F.coalesce(F.date_sub(F.col(to_col), 1), hi), hi)
    payload = F.struct(*(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))
    held = intervals.select(F.col(key).alias("_key"), F.col(from_col).alias("_from"), F.col(to_col).alias("_to"), payload.alias("_payload"),
                            first.alias("_first"), last.alias("_last")).where("_first <= _last")
    held = held.withColumn("_bucket", F.explode(F.sequence(day_segment(F.col("_first"), bucket_days), day_segment(F.col("_last"), bucket_days))))
    rows = left.withColumn("_date", F.col(date).cast("date")).withColumn("_in", day_segment(F.col("_date"), bucket_days))
    met = rows.join(held, (F.col(key) == F.col("_key")) & (F.col("_in") == F.col("_bucket")) & (F.col("_date") >= F.col("_from"))
                    & (F.col("_to").isNull() | (F.col("_date") < F.col("_to"))), "left")
    return met.select(*left.columns, *(F.col(f"_payload.v{i}").alias(v) for i, v in enumerate(values)))
