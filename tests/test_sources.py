"""Reading, writing, publishing."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from cohortspark import session
from cohortspark.sources import scan, snapshot


def test_parquet_order_survives_splitting(spark, tmp_path):
    base = str(tmp_path)
    spark.range(5000).coalesce(1).write.parquet(f"{base}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = scan.scan_table(spark, base, "t", with_order=True)
        assert df.where(F.col("_src_ord.row") != F.col("id")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_other_formats_keep_file_order(spark, tmp_path, fmt):
    base = str(tmp_path)
    spark.range(1000).coalesce(1).write.format(fmt).save(f"{base}/t")
    df = scan.scan_table(spark, base, "t", "id long", fmt=fmt, with_order=True)
    assert [r.id for r in df.orderBy("_src_ord").collect()] == list(range(1000))


def test_scan_matching_in_folder_and_catalog(spark):
    assert sorted(scan.scan_matching_tables(spark, DATA, "^p")) == ["pages", "part"]
    spark.range(3).createOrReplaceTempView("dTask")
    assert [df.count() for df in scan.scan_matching_tables(spark, None, "(?i)^dtask").values()] == [3]
    assert scan.scan_table(spark, None, "dTask").count() == 3


def test_snapshot_publish_and_append(spark, tmp_path):
    base = str(tmp_path)
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    with pytest.raises(FileNotFoundError):
        snapshot.load_snapshot(spark, base)
    snapshot.write_snapshot({"a": a}, base, ingest_ts="2024-01-01")
    snapshot.append_tables({"a": spark.createDataFrame([("y", 2)], "v string, id int")}, base, ingest_ts="2024-02-01")
    snapshot.append_tables({"a": spark.createDataFrame([(3,)], "id int")}, base, ingest_ts="2024-01-15")
    got = snapshot.load_snapshot(spark, base)["a"]
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "x"), (2, "y"), (3, None)]
    assert str(snapshot.freshness_marker(got).first()[0]) == "2024-02-01 00:00:00"
    with pytest.raises(ValueError):
        snapshot.append_tables({"a": spark.createDataFrame([(1,)], "other int")}, base)


def test_unpublished_bundle_is_not_seen(spark, tmp_path):
    base = str(tmp_path)
    snapshot.write_snapshot({"a": spark.range(2)}, base)
    spark.range(9).write.parquet(f"{base}/data/half-written/a")
    assert snapshot.load_snapshot(spark, base)["a"].count() == 2


def test_written_goes_to_the_named_folder_and_can_be_discarded(spark):
    df = session.written(spark.range(4), "probe")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in df.inputFiles()) and df.count() == 4
    before = len(session._paths)
    assert before >= 1


def test_bucketed_tables_join_without_exchange(spark):
    from cohortspark.operators import aggs, joins
    from cohortspark.registry.standin import domain
    from cohortspark.sources import catalog

    t = domain(spark, DATA, "visit", "visit_study", "visit_action")
    spark.sql("create database if not exists bucketed")
    catalog.save_bucketed(t, 4, "bucketed")
    saved = catalog.load_catalog(spark, *t, database="bucketed")
    children = [
        aggs.count_distinct(saved["visit_study"], ["vid"], {"n": "study"}), aggs.group_max(saved["visit_action"], ["vid"], "aid")
    ]
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = joins.star_join(saved["visit"], children, ["vid"])
        assert "Exchange" not in star._jdf.queryExecution().executedPlan().toString()
        assert star.count() == t["visit"].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    catalog.append_to_catalog({"visit": spark.createDataFrame([("sched", -5)], "vstatus string, vid long")}, "bucketed")
    added = spark.table("bucketed.visit").where("vid = -5").collect()
    assert [(r.vstatus, r.pid) for r in added] == [("sched", None)]
    spark.sql("drop database bucketed cascade")
