"""Lateral flatten of a JSON array held in a string column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_json_array(df: DataFrame, json_col: str, keep: Sequence[str], out_col: str,
                       distinct: bool = True) -> DataFrame:
    """One row per array element. Malformed, non-array or empty input yields no
    rows; non-string elements are kept as their JSON text."""
    parsed = F.from_json(F.col(json_col), "array<string>")
    out = df.select(*keep, F.explode(parsed).alias(out_col))
    return out.distinct() if distinct else out
