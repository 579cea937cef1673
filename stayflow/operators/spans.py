"""Event-to-span roll-up and edge censoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def events_to_spans(df: DataFrame, keys: Sequence[str], date_col: str,
                    extra_aggs: Sequence[Column] = (), first_col: str = "first_date",
                    last_col: str = "last_date", count_col: str = "nights",
                    contiguous_col: str = "is_contiguous") -> DataFrame:
    """Nights -> one span per key: first, last, count, plus caller aggregates.

    ``contiguous_col`` checks the min/max collapse is honest: the span has no
    hole exactly when last - first + 1 equals the number of nights.
    """
    d = F.col(date_col)
    spans = df.groupBy(*keys).agg(
        F.min(d).alias(first_col), F.max(d).alias(last_col), F.count(F.lit(1)).alias(count_col), *extra_aggs
    )
    return spans.withColumn(
        contiguous_col, (F.date_diff(F.col(last_col), F.col(first_col)) + 1) == F.col(count_col)
    )


def censor_flags(spans: DataFrame, window_start: Column, window_end: Column,
                 first_col: str = "first_date", last_col: str = "last_date",
                 left_col: str = "is_left_censored", right_col: str = "is_right_censored") -> DataFrame:
    """A span touching either edge of the observed window is censored there.

    ``window_start``/``window_end`` are one-value columns (scalar subqueries over
    the whole fact), so no join is planned for them."""
    return spans.withColumn(left_col, F.col(first_col) == window_start).withColumn(
        right_col, F.col(last_col) == window_end
    )
