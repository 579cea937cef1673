"""Tables landed in the shared folder, and connected components over a table of links."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.session import shared_dir

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def share_package(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of workers that start from now on, for sessions whose workers do not have it
    (a script run from another folder). On a cluster the package itself must be there, by --py-files or an image."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes, whatever the length of the rows, unless the session names a bound of its own: a batch is held
    by the executor and by its Python worker at once."""
    if ARROW_BYTES[0] not in spark.conf.getAll:
        spark.conf.set(*ARROW_BYTES)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def land(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: lineage ends here, and a lost executor costs
    only the tasks that read its part. The folder is the cluster's to clean, like any checkpoint; tables noted in
    ``scratch`` can be dropped before."""
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def give_back(*tables: DataFrame) -> None:
    """Drop landed tables whose last reader has been landed itself."""
    for table in tables:
        drop(table.sparkSession, [table._landed_at])


def drop(spark: SparkSession, scratch: list[str]) -> None:
    """Drop landed tables once what they were for has been landed itself."""
    for path in scratch:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    scratch.clear()


def maybe(df: DataFrame, key: str, wanted: DataFrame, name: str, bits: int = 24) -> DataFrame:
    """df with a boolean column: whether the row's key may be in ``wanted`` (one column). A bitmap of 2**bits hashes goes to every
    task, as a table of at most 2**(bits - 6) words; when the bitmap is full, it is true for all rows."""
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    words = (wanted.select(at(F.col(wanted.columns[0])).alias("at")).groupBy(F.shiftright("at", 6).alias("sieve_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("sieve_bits")))
    here = F.expr(f"shiftright(pmod(xxhash64(`{key}`), {1 << bits}L), 6)")
    bit = F.expr(f"coalesce(shiftright(sieve_bits, cast(pmod(xxhash64(`{key}`), {1 << bits}L) & 63 as int)) & 1L, 0L)")
    return df.withColumn("sieve_word", here).join(F.broadcast(words), "sieve_word", "left").select(*df.columns, (bit == 1).alias(name))


def sieve(df: DataFrame, key: str, wanted: DataFrame, bits: int = 24) -> DataFrame:
    """The rows of df whose key may be in ``wanted``. It only thins what a later join on the key has to shuffle."""
    return maybe(df, key, wanted, "sieve_pass", bits).where("sieve_pass").drop("sieve_pass")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (a, b): one row (v, label) per vertex, label = smallest vertex.

    Rounds of contraction. Every vertex moves to the neighbour (or itself) with the smallest hash; the links between what
    they moved to form the next, smaller graph. Hashes put the vertices of a chain in random order, so a constant share of
    them is left after each round; a star is done after two. All steps are keyed aggregations and equi-joins; a
    vertex with very many links is summed before the shuffle and its join can be split.
    """
    edges = links.where(F.col("a") != F.col("b")).select("a", "b")
    moves: list[DataFrame] = []
    rank = lambda c: F.struct(F.xxhash64(c).alias("p"), F.col(c).alias("v"))
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("v"), rank("b").alias("m")).union(edges.select(F.col("b").alias("v"), rank("a").alias("m")))
        move = both.groupBy("v").agg(F.min("m").alias("m"))
        move = land(move.select("v", F.least(F.col("m"), rank("v"))["v"].alias("to")), "moves")
        moves.append(move)
        left = move.select(F.col("v").alias("a"), F.col("to").alias("x"))
        right = move.select(F.col("v").alias("b"), F.col("to").alias("y"))
        edges = land(edges.join(left, "a").join(right, "b").where("x != y")
                     .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if edges.isEmpty():
            break
    else:
        raise RuntimeError("components: the links did not contract")
    label = moves[0].select("v", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("v").alias("root"), F.col("to").alias("next"))
        label = label.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
    smallest = label.groupBy("root").agg(F.min("v").alias("label"))
    return land(label.join(smallest, "root").select("v", "label"), "components")
