import os

from pyspark.sql import functions as F

from stayflow.sources.seeds import load_vocabulary, vocabulary_values
from stayflow.sources.sinks import diff_builds, guarded_overwrite, read_build, regenerate_vocabulary, write_build


def test_guarded_overwrite_decisions(spark):
    spark.sql("DROP TABLE IF EXISTS sink_t")
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    assert guarded_overwrite(a, "sink_t").action == "created"
    b = spark.createDataFrame([(2, "y"), (3, "z")], "id long, v string")
    r = guarded_overwrite(b, "sink_t")
    assert r.action == "overwritten" and spark.table("sink_t").count() == 2
    c = spark.createDataFrame([(4, "w", 1.0)], "id long, v string, extra double")
    r = guarded_overwrite(c, "sink_t")
    assert r.action == "rebuilt" and "signature changed" in r.reason
    assert spark.table("sink_t").columns == ["id", "v", "extra"]
    d = spark.createDataFrame([(5, "q", 2)], "id long, v string, extra int")     # same names, new type
    assert guarded_overwrite(d, "sink_t").action == "rebuilt"
    assert guarded_overwrite(d, "sink_t", full_refresh=True).reason == "full refresh"
    spark.sql("DROP TABLE IF EXISTS sink_t")


def test_regenerate_vocabulary_round_trips(spark, tmp_dir):
    vals = spark.createDataFrame([("Wifi",), ("Children’s books",), ('Pack "n" Play, crib',), ("Wifi",), (None,)],
                                 "amenity_name string")
    path = os.path.join(tmp_dir, "vocab")
    regenerate_vocabulary(vals, "amenity_name", path)
    csv_file = [f for f in os.listdir(path) if f.endswith(".csv")][0]
    back = vocabulary_values("amenity", os.path.join(path, csv_file))
    assert back == sorted(["Wifi", "Children’s books", 'Pack "n" Play, crib'])
    assert load_vocabulary(spark, "amenity", os.path.join(path, csv_file)).count() == 3


def test_build_retention_and_diff(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    b1 = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k long, v double")
    b2 = spark.createDataFrame([(1, 10.0), (2, 25.0), (4, 40.0)], "k long, v double")
    write_build(b1, path, 1)
    write_build(b2, path, 2)
    write_build(b2, path, 2)                     # re-running a build replaces only that build
    assert read_build(spark, path, 1).count() == 3
    assert sorted(r.k for r in read_build(spark, path).collect()) == [1, 2, 4]
    d = {r.k: r.change for r in diff_builds(spark, path, "k", 1, 2).collect()}
    assert d == {2: "changed", 3: "removed", 4: "added"}
    assert read_build(spark, path, 1).filter(F.col("k") == 3).count() == 1


def test_raw_csv_round_trip_drives_the_build(spark, tmp_dir):
    from stayflow.plans.warehouse import Warehouse
    from stayflow.sources.raw import read_raw
    from tests.fixtures import CONFIG, raw_frames

    paths = {}
    for name, df in raw_frames(spark).items():
        paths[name] = os.path.join(tmp_dir, name)
        df.write.option("header", True).option("quote", '"').option("escape", '"').csv(paths[name])
    raw = read_raw(spark, paths)
    assert raw["listings"].count() == 4 and raw["calendar"].count() == 42
    wh = Warehouse(spark, "unused", cfg=CONFIG, materialize=False, raw=raw)
    assert wh.dim_listings().count() == 5
    assert wh.int_listing_amenities().filter("listing_id = 3").count() == 2   # JSON with commas survived


def test_diff_sees_changes_between_null_and_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    schema = "k long, a string, b string"
    write_build(spark.createDataFrame([(1, None, "a"), (2, None, None)], schema), path, 1)
    write_build(spark.createDataFrame([(1, "a", None), (2, None, None)], schema), path, 2)
    assert [(r.k, r.change) for r in diff_builds(spark, path, "k", 1, 2).collect()] == [(1, "changed")]


def test_pointer_names_the_current_build(spark, tmp_dir):
    from stayflow.sources.sinks import point_to_build

    path = os.path.join(tmp_dir, "mart")
    for i in (1, 2):
        write_build(spark.range(i), path, i)
    assert read_build(spark, path).count() == 2
    point_to_build(spark, path, 1)
    assert read_build(spark, path).count() == 1 and read_build(spark, path).columns == ["id"]


def test_guarded_overwrite_replaces_a_view_of_another_schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_schema")
    spark.sql("DROP VIEW IF EXISTS other_schema.v")
    spark.sql("CREATE VIEW other_schema.v AS SELECT 1 AS id")
    try:
        r = guarded_overwrite(spark.range(3), "other_schema.v")
        assert r.reason == "target is a view" and spark.table("other_schema.v").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS other_schema.v")
        spark.sql("DROP DATABASE IF EXISTS other_schema")


def test_raw_csv_with_swapped_columns_fails(spark, tmp_dir):
    import pytest

    from stayflow.sources.raw import read_raw

    path = os.path.join(tmp_dir, "calendar.csv")
    with open(path, "w") as f:
        f.write("listing_id,date,available,price,reservation_id,minimum_nights,maximum_nights\n1,2024-01-01,true,150.00,NULL,1,2\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, {"calendar": path})["calendar"].collect()


def test_no_shared_folder_off_local_mode_raises():
    import pytest

    from stayflow.session import ensure_checkpoint_dir

    class Conf(dict):
        pass

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_writers_of_the_daily_table_follow_the_shuffle_partitions(spark):
    from stayflow.plans.warehouse import Warehouse

    days = spark.range(4000).select(F.col("id").alias("listing_id"), F.lit("2024-01-01").cast("date").alias("month_start_date"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = {}
        for n in (8, 160):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = Warehouse(spark, "")._get("int_listing_daily", lambda: days)
            files[n] = out.select(F.input_file_name()).distinct().count()
            assert out.count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files[8] <= 8 < 20 < files[160] <= 40


def _failing(df):
    """A frame whose job fails after it has begun to write."""
    return df.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_dir):
    import pytest

    spark.sql("DROP TABLE IF EXISTS sink_f")
    good = spark.range(5).selectExpr("id", "cast(id as string) as v")
    guarded_overwrite(good, "sink_f", location=tmp_dir + "/f")
    with pytest.raises(Exception, match="broken row"):
        guarded_overwrite(_failing(spark.range(20).selectExpr("id", "cast(id as string) as v")), "sink_f", location=tmp_dir + "/f")
    assert spark.table("sink_f").count() == 5 and len(os.listdir(tmp_dir + "/f")) == 1

    def unique(written):
        if written.count() != written.select("v").distinct().count():
            raise ValueError("v is not unique")

    with pytest.raises(ValueError, match="not unique"):
        guarded_overwrite(spark.range(9).selectExpr("id", "'same' as v"), "sink_f", location=tmp_dir + "/f", check=unique)
    assert sorted(r.v for r in spark.table("sink_f").collect()) == list("01234")
    spark.sql("DROP TABLE sink_f")


def test_readers_during_a_write_and_a_frame_that_reads_its_target(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS sink_r")
    guarded_overwrite(spark.range(5).selectExpr("id", "1 as v"), "sink_r", location=tmp_dir + "/r")
    begun = spark.table("sink_r")  # planned on the old version
    assert guarded_overwrite(spark.table("sink_r").selectExpr("id", "v + 1 as v"), "sink_r", location=tmp_dir + "/r").action == "overwritten"
    assert begun.count() == 5
    assert guarded_overwrite(spark.table("sink_r").where("id > 1"), "sink_r", location=tmp_dir + "/r").action == "overwritten"
    assert sorted((r.id, r.v) for r in spark.table("sink_r").collect()) == [(2, 2), (3, 2), (4, 2)]
    assert len(os.listdir(tmp_dir + "/r")) == 2  # the current version and the one before
    assert guarded_overwrite(spark.table("sink_r").selectExpr("id", "cast(v as string) as v"), "sink_r", compare_types=False, location=tmp_dir + "/r").action == "overwritten"
    assert dict(spark.table("sink_r").dtypes) == {"id": "bigint", "v": "int"} and spark.table("sink_r").count() == 3
    spark.sql("DROP TABLE sink_r")


def test_builds_by_time_expiry_and_all_tables_at_once(spark, tmp_dir):
    import datetime as dt

    import pytest

    from stayflow.sources.sinks import build_log, commit_build, expire_builds, point_to_build

    path = os.path.join(tmp_dir, "marts")
    hour = lambda h: dt.datetime(2024, 5, 1, h, tzinfo=dt.timezone.utc)
    frames = lambda n: {"a": spark.range(n), "b": spark.range(n).selectExpr("id", "id * 2 as v")}
    for n in (1, 2, 3):
        commit_build(spark, path, n, frames(n), at=hour(n))
    with pytest.raises(Exception, match="broken row"):
        commit_build(spark, path, 4, {"a": spark.range(9), "b": _failing(spark.range(20).selectExpr("id", "'x' as v"))}, at=hour(4))
    assert [c.build_id for c in build_log(spark, path)] == [1, 2, 3]  # neither table of the failed build is seen
    count = lambda **kw: read_build(spark, path, table="b", **kw).count()
    assert (count(), count(as_of=hour(2)), count(as_of=hour(1) + dt.timedelta(minutes=5)), count(build_id=2)) == (3, 2, 1, 2)
    with pytest.raises(LookupError, match="no build"):
        read_build(spark, path, as_of=hour(0), table="a")
    point_to_build(spark, path, 1, at=hour(5))
    assert count() == 1 and count(as_of=hour(4)) == 3
    assert expire_builds(spark, path, hour(3)) == [1, 2]  # build 1 is current again through a later entry: its rows stay
    assert expire_builds(spark, path, hour(3)) == []
    assert count() == 1 and count(as_of=hour(3)) == 3
    with pytest.raises(LookupError, match="expired"):
        read_build(spark, path, build_id=2, table="a")
    assert len(os.listdir(path + "/b")) == 2


def test_two_writers_get_two_entries(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    from stayflow.sources.sinks import build_log

    path = os.path.join(tmp_dir, "mart")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: write_build(spark.range(i), path, i), range(1, 9)))
    entries = build_log(spark, path)
    assert sorted(c.build_id for c in entries) == list(range(1, 9)) and len({c.number for c in entries}) == 8
    assert all(read_build(spark, path, i).count() == i for i in range(1, 9))


def test_diff_names_the_columns(spark):
    from stayflow.sources.sinks import diff_frames

    a = spark.createDataFrame([(1, "x", 1, None), (2, "y", 2, 2.0), (None, "n", 0, 0.0)], "k long, s string, i int, old double")
    b = spark.createDataFrame([(1, "z", 1, None, True), (2, "y", None, 2.0, None), (None, "n", 0, 0.0, None), (3, "q", 1, 1.0, None)], "k long, s string, i int, old double, new boolean")
    assert {(r.k, r.change, r.columns_changed) for r in diff_frames(a, b, "k").collect()} == {(1, "changed", "s,new"), (2, "changed", "i"), (3, "added", None)}
    assert diff_frames(a, a, "k").count() == 0
