"""From raw documents to packed training sequences: quality rules, quality classifier, near-duplicates, repeated strings,
packing. Every stage is a Spark job over all that the stage before kept; its output is written as Parquet and read back.

Each stage takes (spark, docs, sf_dir), docs having the columns of ``documents`` in any order, and returns those columns,
but for the last, which returns the packed pieces. Null and empty texts, repeated rows, empty tables and further
columns follow the rules in the operators' docstrings; further columns are carried along to the last stage but one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import _store, attention_mil, bwt_repeats, histogram_packing, minhash_bayes, quality_trees

#: SQL can express neither the learned stages nor the tokenizer.
ORACLE_SQL = None
#: Texts of this similarity or more are near-duplicates here.
NEAR_PERCENT = 80


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What the models learn from: the labelled documents as they came in, whatever earlier stages dropped."""
    return _store.documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the boosted trees reject go."""
    return quality_trees.keep_good(docs, quality_trees.train(*_labelled(spark, sf_dir)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 go."""
    return attention_mil.keep_good(docs, attention_mil.train(*_labelled(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) stays: the one with the
    smallest doc_id. ``op1_`` alone has its own threshold, 0.85."""
    return minhash_bayes.deduplicate(docs, NEAR_PERCENT).select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte covered by a 200-byte string that starts anywhere else goes; n_chars follows the text."""
    cut = bwt_repeats.remove_repeats(docs, 200)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie in sequences of at most 2048 tokens."""
    return histogram_packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates),
          ("repeated_strings", repeated_strings), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _store.share_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = _store.land(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
