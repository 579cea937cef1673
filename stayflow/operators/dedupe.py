"""Deduplicate on a grain and keep the latest row per key.

Both are written as keyed aggregations of a struct instead of a
``row_number()`` window: the aggregate is computed partially on the map side,
so a key holding a large share of all rows never has to be sorted inside one
task, and the survivor is fully determined by the row contents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols: Sequence[str | Column]) -> list[str]:
    return [c if isinstance(c, str) else c._jc.toString() for c in cols]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` then by every other
    column (NULLs first), so the pick is deterministic even when the declared
    order is constant inside a group."""
    keys = list(keys)
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by ``order_desc`` (descending), ties broken by
    ``tiebreak`` then by the remaining columns, all descending."""
    keys = list(keys)
    ordered = [c for c in list(order_desc) + list(tiebreak) if c not in keys]
    rest = ordered + [c for c in df.columns if c not in keys and c not in ordered]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
