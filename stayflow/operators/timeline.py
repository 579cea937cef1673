"""Dense daily grids, and scans over an entity's rows that are cut into segments.

A scan per entity (runs, the next row) needs the entity's rows in order. Here rows are cut into segments of the order (stretches of
days); windows run inside one (entity, segment), one summary row per segment is scanned in the entity's order, and what comes out is
joined to the segment's rows. So an entity that holds a large share of all rows is spread over tasks; the summary of an
entity has one row per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_DAYS = 64


def daily_grid(entities: DataFrame, key: str, start: Column, end: Column, date_col: str = "date") -> DataFrame:
    """One row per entity per day in [start, end]; generated on the executors
    with ``sequence`` + ``explode``. ``start``/``end`` may be scalar subqueries."""
    return entities.select(key).distinct().select(key, F.explode(F.sequence(start, end)).alias(date_col))


def day_segment(date: Column, days: int = SEGMENT_DAYS) -> Column:
    """The number of the stretch of ``days`` days that a date lies in; it grows with the date."""
    return F.floor(F.date_diff(date.cast("date"), F.lit("1970-01-01").cast("date")) / days).cast("long")


def _names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that df does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def _cut(df: DataFrame, entity: Sequence[str], order: str, segment: Column | None, e: str, s: str) -> DataFrame:
    """Rows with their entity (a struct, so null keys are equal) and segment (rows without an order come first)."""
    number = day_segment(F.col(order)) if segment is None else segment
    return df.select("*", F.struct(*entity).alias(e), F.coalesce(number.cast("long"), F.lit(-(2**63))).alias(s))


def islands(df: DataFrame, entity: str, order: str, flag: str, start_col: str = "is_window_start", seq_col: str = "availability_window_seq",
            segment: Column | None = None, whole: bool = False) -> DataFrame:
    """Gap-and-island identity for runs of ``flag`` = true per entity.

    ``start_col`` is true on the first row of each run (the previous row's flag
    is false or absent); ``seq_col`` is the running count of runs started so far,
    so it is constant over one run and identifies it (0 before the first run,
    and on closed rows it carries the number of the run before them).

    Runs are counted inside each segment as if nothing came before it. The summary of a segment holds its first and last flag and
    the runs it counted; across segments, a run that only goes on over the edge is taken off, and the runs
    before are added. ``segment`` may not shrink as ``order`` grows (default: stretches of 64 days of a date).

    ``whole``: an entity's rows are few (at most one per day, say) and are scanned in one window: one shuffle of the rows instead of
    three, and none where they already lie together by entity.
    """
    if whole:
        last, = _names(df, "_last")
        on, order_of = F.coalesce(F.col(flag), F.lit(False)), Window.partitionBy(entity).orderBy(order)
        rows = df.withColumn(last, F.coalesce(F.lag(on, 1).over(order_of), F.lit(False)))
        so_far = order_of.rowsBetween(Window.unboundedPreceding, 0)
        return rows.select(*df.columns, (F.col(flag) & ~F.col(last)).alias(start_col), F.count_if(on & ~F.col(last)).over(so_far).alias(seq_col))
    e, s, last, runs, opens, closes, counted, edge, before = _names(
        df, "_entity", "_segment", "_last", "_runs", "_opens", "_closes", "_counted", "_edge", "_before")
    on, no = F.coalesce(F.col(flag), F.lit(False)), F.lit(False)
    inside, across = Window.partitionBy(e, s).orderBy(order), Window.partitionBy(e).orderBy(s)
    rows = _cut(df, [entity], order, segment, e, s).withColumn(last, F.lag(on, 1).over(inside))  # null on a segment's first row
    rows = rows.withColumn(runs, F.count_if(on & ~F.coalesce(last, no)).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    summary = rows.groupBy(e, s).agg(F.bool_or(F.col(last).isNull() & on).alias(opens), F.max_by(on, order).alias(closes), F.max(runs).alias(counted))
    summary = summary.withColumn(edge, F.coalesce(F.lag(closes, 1).over(across), no))
    goes_on = (F.col(opens) & F.col(edge)).cast("long")
    earlier = F.coalesce(F.sum(F.col(counted) - goes_on).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.join(summary.select(e, s, edge, (earlier - goes_on).alias(before)), [e, s])
    return out.select(*df.columns, (F.col(flag) & ~F.coalesce(last, edge)).alias(start_col), (F.col(before) + F.col(runs)).alias(seq_col))


def with_next(df: DataFrame, entity: Sequence[str], order: str, next_col: str, segment: Column | None = None) -> DataFrame:
    """Rows with the ``order`` of the entity's next row (null on the last). ``order`` is unique within an entity."""
    e, s, following, least, after = _names(df, "_entity", "_segment", "_following", "_least", "_after")
    cut = _cut(df, entity, order, segment, e, s)
    summary = cut.groupBy(e, s).agg(F.min(order).alias(least))
    carried = summary.select(e, s, F.lead(least, 1).over(Window.partitionBy(e).orderBy(s)).alias(after))
    out = cut.withColumn(following, F.lead(order, 1).over(Window.partitionBy(e, s).orderBy(order))).join(carried, [e, s])
    return out.select(*df.columns, F.coalesce(following, after).alias(next_col))
