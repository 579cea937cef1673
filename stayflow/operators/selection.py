"""Exact percentiles of large groups, without gathering a group.

Per group the two middle ranks (or those of any fraction) are enclosed in an open interval of values that shrinks round by round.
A round is two aggregations that combine on the map side:

1. a quantile sketch of the values still enclosed gives an evenly spaced grid, and two grid values a <= b around the ranks;
2. the values are counted exactly in five cells: below a, equal to a, between, equal to b, above b, each with its least
   and greatest value.

The exact counts say which cell holds the ranks, so the sketch decides how fast the interval shrinks, never the result. Ranks that
fall into a cell of one value, or into two neighbouring cells, are done; otherwise the cell is the next interval, of about
``4 / GRID`` of the values. Once at most ``limit`` values are enclosed, those are gathered and sorted: no task ever buffers
more than ``limit`` values of a group. A group of at most ``limit`` values takes no round.

Rows are written once, narrow, to the shared folder and not shuffled at all unless groups are too many to send their state
to every task (Spark's own size check); then rows meet the state in a join that Spark can split.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.session import shared_dir

GRID = 256
GATHERED = 65_536  # values of one group that may be sorted in one task
ACCURACY = 10_000


@dataclass(frozen=True)
class Percentile:
    """An aggregate of a metric model that is computed by ``exact_percentile``."""

    value: Column
    fraction: float = 0.5


def median(value: Column) -> Percentile:
    return Percentile(value)


def _land(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, "stayflow-select", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, fraction: float = 0.5, out: str = "percentile",
                     limit: int = GATHERED) -> DataFrame:
    """One row per group: keys and ``out`` (double), the value at rank ``fraction * (n - 1)`` of the group's n non-null values,
    between two ranks interpolated. A group without values has null; null keys are a group like any other; without
    keys the whole frame is one group, also when it has no rows."""
    if not 0 <= fraction <= 1 or limit < 1:
        raise ValueError("the fraction lies in [0, 1] and at least one value can be gathered")
    k = [f"_k{i}" for i in range(max(1, len(keys)))]
    groups = [F.col(c).alias(a) for c, a in zip(keys, k)] or [F.lit(0).alias("_k0")]
    rows = _land(df.select(*groups, F.col(value).alias("_v")), "rows")
    kind = rows.schema["_v"].dataType
    none = F.lit(None).cast(kind)
    place = (F.col("n") - 1) * fraction
    counted = rows.groupBy(*k).agg(F.count("_v").alias("n"))
    state = _land(counted.select(
        *k, "n", F.floor(place).cast("long").alias("r1"), F.ceil(place).cast("long").alias("r2"), (place - F.floor(place)).alias("w"),
        F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), none.alias("lo"), none.alias("hi"), none.alias("v1"), none.alias("v2")), "state")
    columns = state.columns

    def enclosed(some: DataFrame, *more: str) -> DataFrame:
        """The values that lie in the interval of their group, for the groups in ``some``."""
        side = some.select(*(F.col(c).alias(f"_of{c}") for c in k), "lo", "hi", *more)
        same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in k]
        inside = ((F.col("lo").isNull() | (F.col("_v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("_v") < F.col("hi"))))
        return rows.where("_v IS NOT NULL").join(side, same).where(inside)

    def rejoined(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*(F.col(c).alias(f"_of{c}") for c in k), *(c for c in b.columns if c not in k))
        return a.join(b, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in k]).drop(*(f"_of{c}" for c in k))

    grid = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))
    while True:
        wide = state.where(F.col("v1").isNull() & (F.col("inside") > limit))
        if wide.isEmpty():
            break
        sketch = enclosed(wide).groupBy(*k).agg(F.percentile_approx("_v", grid, ACCURACY).alias("q"))
        at = lambda rank: (F.col(rank) - F.col("below")) / F.col("inside") * GRID
        bounds = _land(rejoined(wide, sketch).withColumn("a", F.col("q")[F.greatest(F.floor(at("r1")) - 1, F.lit(0)).cast("int")])
                       .withColumn("b", F.col("q")[F.least(F.ceil(at("r2")) + 1, F.lit(GRID)).cast("int")]).drop("q"), "bounds")
        v, a, b = F.col("_v"), F.col("a"), F.col("b")
        cell = F.when(v < a, 0).when(v == a, 1).when(v < b, 2).when(v == b, 3).otherwise(4)
        cells = (enclosed(bounds, "a", "b").withColumn("cell", cell).groupBy(*k)
                 .agg(*(F.count_if(F.col("cell") == i).alias(f"n{i}") for i in range(5)),
                      *(f(F.when(F.col("cell") == i, v)).alias(f"{name}{i}") for i in range(5) for f, name in ((F.min, "least"), (F.max, "most")))))
        upto = [F.col("below") + sum((F.col(f"n{j}") for j in range(1, i + 1)), F.col("n0")) for i in range(5)]

        def pick(rank: str, values: Sequence[Column]) -> Column:
            """The entry of the cell that holds a rank."""
            out = F.when(F.col(rank) < upto[0], values[0])
            for i in range(1, 5):
                out = out.when(F.col(rank) < upto[i], values[i])
            return out

        number = [F.lit(i) for i in range(5)]
        one = pick("r1", number) == pick("r2", number)
        single = one & pick("r1", [F.lit(False), F.lit(True), F.lit(False), F.lit(True), F.lit(False)])
        met = rejoined(bounds, cells)
        found = met.select(
            *k, "n", "r1", "r2", "w",
            pick("r1", [F.col("below"), *upto[:4]]).alias("below"),
            pick("r1", [F.col(f"n{i}") for i in range(5)]).alias("now_inside"), F.col("inside").alias("was_inside"),
            pick("r1", [F.col("lo"), a, a, b, b]).alias("lo"), pick("r1", [a, a, b, b, F.col("hi")]).alias("hi"),
            F.when(single | ~one, pick("r1", [F.col(f"most{i}") for i in range(5)])).alias("v1"),
            F.when(single | ~one, pick("r2", [F.col(f"least{i}") for i in range(5)])).alias("v2"))
        # a type whose sketch is coarser than its values (wide decimals) may not shrink any more: then the rest is gathered
        found = found.withColumn("inside", F.when(F.col("now_inside") < F.col("was_inside"), F.col("now_inside")).otherwise(F.lit(limit).cast("long")))
        rest = state.where(F.col("v1").isNotNull() | (F.col("inside") <= limit))
        state = _land(rest.select(*columns).unionByName(found.select(*columns)), "state")

    few = state.where(F.col("v1").isNull() & (F.col("n") > 0))
    lists = enclosed(few).groupBy(*k).agg(F.sort_array(F.collect_list("_v")).alias("s"))
    picked = rejoined(few, lists).withColumn("v1", F.col("s")[(F.col("r1") - F.col("below")).cast("int")]).withColumn(
        "v2", F.col("s")[(F.col("r2") - F.col("below")).cast("int")])
    every = state.where(F.col("v1").isNotNull() | (F.col("n") == 0)).select(*k, "w", "v1", "v2").unionByName(picked.select(*k, "w", "v1", "v2"))
    low, high = F.col("v1").cast("double"), F.col("v2").cast("double")
    result = F.when(F.col("w") == 0, low).otherwise((1 - F.col("w")) * low + F.col("w") * high)
    if not keys:
        return every.agg(F.max(result).alias(out))
    return every.select(*(F.col(a).alias(c) for c, a in zip(keys, k)), result.alias(out))
