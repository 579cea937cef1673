"""One aggregate per boolean flag in a single scan (instead of a union of scans)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Gets a function that keeps a column where the flag is true (NULL elsewhere) and returns an aggregate over it.
FlagAggregate = Callable[[Callable[[Column], Column]], Column]


def flag_branches(df: DataFrame, flags: Sequence[str], label_col: str, aggs: Mapping[str, FlagAggregate]) -> DataFrame:
    """For each flag, aggregate the rows where it is true, labelled by the flag.

    All flags x aggregates are conditional aggregates of one global aggregation: each row is read once and none is
    multiplied, and every task sends one partial row. The single result row is then turned into one row per
    flag, flags without true rows included."""
    columns = [agg(lambda c, f=f: F.when(F.col(f), c)).alias(f"_{i}_{name}") for i, f in enumerate(flags) for name, agg in aggs.items()]
    rows = [F.struct(F.lit(f).alias(label_col), *(F.col(f"_{i}_{name}").alias(name) for name in aggs)) for i, f in enumerate(flags)]
    return df.agg(*columns).select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")
