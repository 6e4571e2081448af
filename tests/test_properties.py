"""Properties that must hold whatever the order, partitioning or size of the input."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortspark.operators import identity, joins, reshape

CALM = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("ab"))), min_size=1, max_size=40)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k int, s string").repartition(parts, "id")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_dense_key_has_no_gaps(spark, parts):
    n = 1000
    df = spark.range(n).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(7))).repartition(parts)
    got = identity.dense_surrogate_key(df, "key", ["v", "id"]).orderBy("key").collect()
    assert [r.key for r in got] == list(range(1, n + 1))
    assert [(r.v, r.id) for r in got] == sorted((r.v, r.id) for r in got)


def test_dense_key_spreads_equal_order_values(spark):
    """A value held by every row still splits, by the tie break."""
    df = spark.range(20000).withColumn("v", F.lit(1))
    assert identity.dense_surrogate_key(df, "key", ["v", "id"]).where("key = id + 1").count() == 20000


def test_dense_key_of_nothing(spark):
    assert identity.dense_surrogate_key(spark.range(0), "key", ["id"]).count() == 0


@CALM
@given(data=keyed)
def test_alias_lookup_and_remap(spark, data):
    df = frame(spark, data)
    lookup = identity.alias_key_lookup(df, ["k", "s"], "id", ["id"])
    first = {}
    for i, r in enumerate(data):
        first.setdefault(r, i)
    assert rows(lookup) == sorted(((i, first[r]) for i, r in enumerate(data) if first[r] != i), key=str)
    once = identity.remap_keys(df, lookup, "id")
    twice = identity.remap_keys(once, lookup, "id")
    assert rows(once) == rows(twice) == sorted(((first[r], *r) for r in data), key=str)


@CALM
@given(data=keyed, seed=st.integers(0, 99))
def test_keep_first_ignores_input_order(spark, data, seed):
    df = frame(spark, data)
    shuffled = df.orderBy(F.rand(seed))
    assert rows(identity.keep_first(df, ["k", "s"], ["id"])) == rows(identity.keep_first(shuffled, ["k", "s"], ["id"]))


def test_split_duplicates_partitions_rows(spark):
    df = frame(spark, [(1, "a"), (1, "a"), (None, None), (None, None), (2, "a")])
    kept, dups = identity.split_duplicates(df, ["k", "s"], "id", ["id"])
    assert sorted(r.id for r in kept.collect()) == [0, 2, 4]
    assert sorted(r.id for r in dups.collect()) == [1, 3]


def test_alias_lookup_orders_by_other_columns(spark):
    df = spark.createDataFrame([(1, "x", 9), (2, "x", 3), (3, "x", 5)], "id long, k string, ord int")
    assert rows(identity.alias_key_lookup(df, ["k"], "id", ["ord"])) == [(1, 2), (3, 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_salted_join_equals_plain_join(spark, how, null_safe):
    many = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, F.col("id") % 50).alias("k")
    )
    one = spark.createDataFrame([(None, "n"), *[(i, f"v{i}") for i in range(0, 40)]], "k long, v string")
    same = many["k"].eqNullSafe(one["k"]) if null_safe else many["k"] == one["k"]
    plain = many.join(one, same, how).drop(one["k"])
    salted = joins.skew_join(many, one, ["k"], how, null_safe, spread_by=["id"], min_rows=100)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    assert rows(joins.lookup_join(many, one, ["k"], how, null_safe)) == rows(plain)
    assert rows(joins.lookup_join(many, one, ["k"], how, null_safe, limit=0)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_copies_of_one_row_spread_and_survive(spark, how):
    many = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("k"))
    one = spark.createDataFrame([(i, f"v{i}") for i in range(0, 9000, 2)] + [(1, "hot")], "k long, v string")
    salted = joins.skew_join(many, one, ["k"], how, min_rows=100)
    assert rows(salted) == rows(many.join(one, "k", how))


def test_heavy_list_is_bounded_and_salts_follow_counts(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    heavy = joins.heavy_keys(joins.key_counts(df, ["k"]), ["k"], min_rows=30).collect()
    assert len(heavy) == 10 and {r["_salts"] for r in heavy} == {4}


def test_every_hot_key_is_salted_however_many_there_are(spark, monkeypatch):
    counts = joins.key_counts(spark.range(90_000).select((F.col("id") % 3000).alias("k")), ["k"])
    assert joins.heavy_keys(counts, ["k"], min_rows=20).count() == 3000
    monkeypatch.setattr(joins, "HEAVY_PARTS", 100)  # 30 rows are less than a hundredth of all
    assert joins.heavy_keys(counts, ["k"], min_rows=20).count() == 0


def test_hot_key_is_spread(spark):
    """A key owning a third of the rows reaches many tasks instead of one."""
    many = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    one = spark.range(-1, 30000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

        def largest(df):
            return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        plain = largest(many.join(one, "k").select("id", "v"))
        spread = largest(joins.skew_join(many, one, ["k"], spread_by=["id"], min_rows=500).select("id", "v"))
        copies = many.select("k")
        dealt = largest(joins.skew_join(copies, one, ["k"], min_rows=500).select("k", "v"))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert plain > 10000 and spread < 5500 and dealt < 8000


def test_natural_left_join_with_hot_child(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 10)
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    many = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(7).alias("k"), F.col("id").alias("x"))
    want = one.join(many, "k", "left")
    assert rows(joins.natural_left_join(one, many)) == rows(want)


def test_unpivot_then_collapse(spark):
    data = [(i, i % 2, i % 3, None if i % 5 else 1) for i in range(60)]
    df = spark.createDataFrame(data, "id int, a int, b int, c int")
    long = reshape.unpivot_flags(df, ["id"], ["a", "b", "c"], "f", lambda v: v > 0, "o")
    long_way = {r.id: r.t for r in reshape.collapse_labels(long, ["id"], "f", "o", "t").collect()}
    short_way = {r.id: r.t for r in df.select("id", reshape.collapsed_flags(["a", "b", "c"]).alias("t")).collect()}
    assert {k: v for k, v in short_way.items() if v is not None} == long_way
    assert all(short_way[i] is None for i in short_way if i not in long_way)


def test_union_fill_missing_of_many(spark):
    frames = [spark.createDataFrame([(i, i)], f"id int, c{i % 4} int") for i in range(9)]
    out = reshape.union_fill_missing(frames)
    assert sorted(out.columns) == ["c0", "c1", "c2", "c3", "id"] and out.count() == 9
