"""Entity universe, orphan detection and entity reconstruction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_universe(ids: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None,
                    deleted_col: str = "is_deleted", unique: bool = False) -> DataFrame:
    """Distinct ids of a driving table, left-joined to the parent, with a flag
    for ids that have no parent row. Parent columns are NULL for those.

    With ``unique=True`` the driving frame is already one row per key (e.g. a
    per-key aggregate): its columns are kept and no distinct is planned."""
    parent_key = parent_key or key
    universe = ids if unique else ids.select(key).distinct()
    p = parent.withColumnRenamed(parent_key, "_pk")
    joined = universe.join(p, universe[key] == p["_pk"], "left")
    return joined.withColumn(deleted_col, F.col("_pk").isNull()).drop("_pk")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (a relationships check)."""
    pk = pk or fk
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def reconstruct_entity(df: DataFrame, key: str, attrs: Sequence[str], count_col: str | None = None) -> DataFrame:
    """Rebuild a parent from denormalised child rows: ``min`` of each attribute
    per key (deterministic when children disagree; the agreement check in
    ``plans.quality`` reports such keys)."""
    aggs = [F.min(a).alias(a) for a in attrs]
    if count_col:
        aggs = [F.count(F.lit(1)).alias(count_col)] + aggs
    return df.groupBy(key).agg(*aggs)
