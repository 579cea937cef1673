"""Pinned-vocabulary pivot and vocabulary drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.text import flag_names


def vocabulary_pivot(bridge: DataFrame, key: str, value_col: str, vocabulary: Sequence[str],
                     prefix: str, count_col: str | None = None, list_col: str | None = None,
                     count_distinct: bool = True) -> DataFrame:
    """One boolean column per vocabulary value, plus optional count and sorted list.

    Columns come only from the pinned vocabulary, never from the data, so the
    schema cannot drift with the input. A value absent for an entity gives
    ``false``; values outside the vocabulary only reach the count and list.
    """
    names = flag_names(prefix, vocabulary)
    v = F.col(value_col)
    aggs = []
    if count_col:
        aggs.append((F.count_distinct(v) if count_distinct else F.count(F.lit(1))).alias(count_col))
    if list_col:
        aggs.append(F.sort_array(F.collect_set(v) if count_distinct else F.collect_list(v)).alias(list_col))
    aggs += [F.bool_or(v == F.lit(value)).alias(name) for value, name in names.items()]
    return bridge.groupBy(key).agg(*aggs)


def vocabulary_drift(values: DataFrame, value_col: str, vocabulary: DataFrame,
                     vocab_col: str) -> tuple[DataFrame, DataFrame]:
    """(values in the data but not in the vocabulary, vocabulary entries no longer used)."""
    seen = values.select(F.col(value_col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    vocab = vocabulary.select(F.col(vocab_col).alias("value")).distinct()
    unknown = seen.join(vocab, "value", "left_anti")
    stale = vocab.join(seen, "value", "left_anti")
    return unknown, stale
