"""Many key checks in one scan of each relation and one shuffle of all of them.

Every row of a relation gives one tagged row (check, key) per check that it takes part in: as a key that must be unique, as a child's
foreign key, or as a parent's key. Equal keys of one check meet in one keyed aggregation, combined before the shuffle, so a key that
a large share of rows holds is one row per task. Keys travel as two longs: whole numbers, dates and times as they are, text and longer keys as
128 bits of hash. Two different keys of one check among 10^13 share those with a probability below 10^-12; ``Check.rows``
lists failing rows by the real keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIQUE, ORPHAN_ROWS, ORPHAN_KEYS = "unique", "orphan_rows", "orphan_keys"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


@dataclass(frozen=True)
class KeyCheck:
    """``unique``: failing are the keys (null keys included) that ``child`` holds more than once. ``orphan_rows``: failing are the
    child rows whose key is not null and not among the parent's; ``orphan_keys``: the distinct such keys."""

    name: str
    kind: str
    child: str
    child_columns: tuple[str, ...]
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()


def _parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A key as two longs: one or two whole numbers or times as they are, any other key as 128 bits of hash of its values and of
    which of them are null (the width of the surrogate keys of the build)."""
    numbers = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, _WHOLE):
            numbers.append(F.col(c).cast("long"))
        elif isinstance(kind, T.DateType):
            numbers.append(F.unix_date(F.col(c)).cast("long"))
        elif isinstance(kind, T.TimestampType):
            numbers.append(F.unix_micros(F.col(c)))
    if len(numbers) == len(columns) <= 2:
        return [*numbers, *([F.lit(None).cast("long")] * (2 - len(numbers)))]
    nulls = reduce(lambda x, y: x * 2 + y, [F.col(c).isNull().cast("long") for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (0, 1)]


def _as_made(df: DataFrame, check: KeyCheck, made: dict[str, tuple[str, ...]]) -> KeyCheck:
    """A unique check of a key that the row's other columns give, as a check of those, where they are one or two whole numbers or dates: each
    combination of such values has a key of its own."""
    parts = made.get(check.child_columns[0], ()) if check.kind == UNIQUE and len(check.child_columns) == 1 else ()
    plain = all(isinstance(df.schema[p].dataType, (*_WHOLE, T.DateType)) for p in parts)
    return replace(check, child_columns=parts) if 0 < len(parts) <= 2 and plain else check


def check_keys(relations: dict[str, DataFrame], checks: Sequence[KeyCheck], made: dict[str, dict[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """One row per check: check_name, failing_rows.

    ``made``: by relation, the surrogate keys that are made of other columns on reading, as {key: columns}. Rows share such a key where they
    share these columns, so a unique check goes by them: numbers and dates shuffle small, while 128 bits of hash have no pattern. Checks that
    ask the same of a relation are counted once."""
    if not checks:
        raise ValueError("no checks")
    asked: dict[tuple, list[str]] = {}
    for c in checks:
        same = _as_made(relations[c.child], c, (made or {}).get(c.child, {})) if c.child in relations else c
        asked.setdefault(tuple(getattr(same, f) for f in ("kind", "child", "child_columns", "parent", "parent_columns")), []).append(c.name)
    names = [(i, n) for i, group in enumerate(asked.values()) for n in group]
    checks = [KeyCheck(group[0], *what) for what, group in asked.items()]
    tagged = []
    for name, df in relations.items():
        rows = []
        for i, c in enumerate(checks):
            for role, relation, columns in ((1, c.child, c.child_columns), (0, c.parent, c.parent_columns)):
                if relation != name:
                    continue
                a, b = _parts(df, columns)
                known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in columns])
                there = F.lit(True) if c.kind == UNIQUE else known
                rows.append(F.when(there, F.struct(F.lit(i).alias("c"), a.alias("a"), b.alias("b"), F.lit(role).cast("long").alias("child"))))
        if rows:
            tagged.append(df.select(F.explode(F.array(*rows)).alias("r")).where("r IS NOT NULL").select("r.*"))
    if not tagged:
        raise ValueError("the checks name no given relation")
    met = reduce(DataFrame.unionByName, tagged).groupBy("c", "a", "b").agg(
        F.sum("child").alias("children"), F.sum(1 - F.col("child")).alias("parents"))
    kind = lambda k: F.col("c").isin([i for i, c in enumerate(checks) if c.kind == k])
    orphan = (F.col("parents") == 0) & (F.col("children") > 0)
    failing = (F.when(kind(UNIQUE), (F.col("children") > 1).cast("long")).when(kind(ORPHAN_ROWS), F.when(orphan, F.col("children")))
               .otherwise(orphan.cast("long")))
    found = met.groupBy("c").agg(F.sum(failing).alias("found"))
    return met.sparkSession.createDataFrame(names, "c int, check_name string").join(found, "c", "left").select(
        "check_name", F.coalesce("found", F.lit(0)).cast("long").alias("failing_rows"))
