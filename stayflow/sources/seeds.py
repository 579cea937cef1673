"""Pinned vocabularies (checked-in CSV seeds).

A vocabulary is a list of allowed values that also decides a column list
(one flag per value). Seeds are small by nature and live in the repository;
reading one on the driver to name columns is the only driver-side read.

The seeds bound to the driver's tables: the amenity vocabulary is the set of
names that line items stand for (see ``sources.testdata``) and the
verification vocabulary is the set of order priorities (a customer's order
priorities form the host's verification array).
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SEED_DIR = os.path.join(os.path.dirname(__file__), "seeds")

SEEDS = {
    "amenity": ("amenity_names.csv", "amenity_name"),
    "verification": ("verification_methods.csv", "verification_method"),
}


def seed_path(family: str) -> str:
    return os.path.join(SEED_DIR, SEEDS[family][0])


def vocabulary_values(family: str, path: str | None = None) -> list[str]:
    """The pinned values in file order (RFC 4180 quoting, Unicode kept as is)."""
    path = path or seed_path(family)
    column = SEEDS[family][1]
    with open(path, newline="", encoding="utf-8") as fh:
        rows = [r[column] for r in csv.DictReader(fh)]
    if len(rows) != len(set(rows)):
        raise ValueError(f"vocabulary {family!r} has duplicate values")
    if any(r is None or r == "" for r in rows):
        raise ValueError(f"vocabulary {family!r} has empty values")
    return sorted(rows)


def load_vocabulary(spark: SparkSession, family: str, path: str | None = None) -> DataFrame:
    """The seed as a DataFrame with a fixed schema (for joins and checks). The driver reads the file, which executors
    need not have."""
    column = SEEDS[family][1]
    schema = T.StructType([T.StructField(column, T.StringType(), False)])
    return spark.createDataFrame([(v,) for v in vocabulary_values(family, path)], schema)
