"""Hot keys: one key holding a third of all rows must give the same answers."""

import datetime as dt

from pyspark.sql import functions as F

from stayflow.operators import asof_join, dedupe, latest_per_key, rank_with_running_share, vocabulary_pivot


def hot_frame(spark, n=30000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("seq"),
        (F.col("id") % 7).cast("double").alias("v"),
    )


def test_dedupe_and_latest_with_a_hot_key(spark):
    df = hot_frame(spark)
    one = {r.k: r.seq for r in dedupe(df, ["k"], order_by=["seq"]).collect()}
    last = {r.k: r.seq for r in latest_per_key(df, ["k"], ["seq"]).collect()}
    bf = df.groupBy("k").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect()
    assert one == {r.k: r.lo for r in bf} and last == {r.k: r.hi for r in bf}


def test_pivot_with_a_hot_key(spark):
    df = hot_frame(spark).withColumn("t", F.concat(F.lit("t"), (F.col("seq") % 4).cast("string")))
    out = vocabulary_pivot(df, "k", "t", ["t0", "t1", "t9"], "has_", "n")
    hot = out.filter("k = 0").first()
    assert (hot.n, hot.has_t0, hot.has_t1, hot.has_t9) == (4, True, True, False)


def test_rank_with_a_hot_value(spark):
    # a third of the rows share one value: the range partitions split the tie by key
    df = spark.range(3000).select(F.col("id").alias("k"),
                                  F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    out = rank_with_running_share(df, "v", ["k"], num_partitions=8)
    ranks = sorted(r["rank"] for r in out.select("rank").collect())
    assert ranks == list(range(1, 3001))
    top = out.orderBy("rank").first()
    assert top.v == 2999.0 and top.running_total == 2999.0


def test_asof_with_a_hot_key(spark):
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    cal = spark.createDataFrame([(k, d) for k in range(3) for d in days], "k long, d date")
    # key 0 receives many changes per day; only the day's latest counts
    changes = [(0, dt.datetime(2021, 1, 1) + dt.timedelta(minutes=7 * i), str(i)) for i in range(5000)]
    changes += [(1, dt.datetime(2021, 1, 15), "x")]
    chg = spark.createDataFrame(changes, "k long, t timestamp, val string")
    out = {(r.k, r.d): r.val for r in asof_join(cal, chg, "k", "d", "t", ["val"]).collect()}
    last_minute = max(i for i in range(5000) if (dt.datetime(2021, 1, 1) + dt.timedelta(minutes=7 * i)).date()
                      <= dt.date(2021, 1, 10))
    assert out[(0, dt.date(2021, 1, 10))] == str(last_minute)
    assert out[(1, dt.date(2021, 1, 14))] is None and out[(1, dt.date(2021, 1, 15))] == "x"
    assert out[(2, dt.date(2021, 1, 1))] is None
