"""All keys in one exchange find what the checks of single constraints find."""

from __future__ import annotations

import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from cohortspark.operators import quality
from cohortspark.schema import TABLES, Table

SPECS = {
    "owner": Table("", pk=("k",), unique=(("a", "b"), ("at",))),
    "child": Table("", pk=("c",), refs={"k": ("owner", "k"), "other": ("owner", "k"), "d": ("owner", "x"), "own": ("child", "c")}),
    "lone": Table("", unique=(("gone",),), refs={"k": ("absent", "k")}),
}


def frames(spark, seed, n):
    draw = random.Random(seed)
    value = lambda *v: draw.choice([None, *v])
    times = [datetime(2024, 3, 31, h) for h in range(3)]
    owner = [(value(*range(9)), value("a,b", "a", ""), value("b", "b,", ""), value(*times), value(0.0, -0.0, 1.5, 2.0)) for _ in range(n)]
    # A reference may be wider than the key it names, or no whole number.
    child = [(value(*range(2 * n)), value(0, 1, 2**40), value(1.0, 1.5, 7.0, -0.0), value(0.0, -0.0, 2.0, 9.0), value(*range(5))) for _ in range(2 * n)]
    return {
        "owner": spark.createDataFrame(owner, "k int, a string, b string, at timestamp, x double"),
        "child": spark.createDataFrame(child, "c int, k long, other double, d double, own int"),
        "lone": spark.createDataFrame([(1,)], "k int"),
    }


def one_by_one(tables):
    found = {}
    for name in ("owner", "child"):
        spec, df = SPECS[name], tables[name]
        for keys in (spec.pk, *spec.unique):
            found[name, "unique", ",".join(keys)] = quality.check_unique(df, keys).count()
        for fk, (parent, pk) in spec.refs.items():
            bad = quality.check_foreign_key(df, fk, tables[parent], pk)
            found[name, "foreign_key", f"{fk}->{parent}.{pk}"] = bad.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {k: n for k, n in found.items() if n}


def test_stacked_keys_equal_single_checks(spark):
    for seed, n in ((1, 4), (2, 30), (3, 0)):
        tables = frames(spark, seed, n)
        got = {tuple(r)[:3]: r.n_bad for r in quality.check_keys(tables, SPECS).collect()}
        assert got == one_by_one(tables)


def test_a_hot_key_counts_every_row(spark):
    tables = {
        "person": spark.range(10).withColumnRenamed("id", "pid"),
        "screener": spark.range(200_000).select(F.when(F.col("id") % 3 > 0, F.lit(99)).otherwise(F.col("id") % 10).alias("pid")),
    }
    got = [tuple(r) for r in quality.check_tables(tables).collect()]
    assert got == [("screener", "foreign_key", "pid->person.pid", 133_333)]


def test_nothing_declared_or_no_rows(spark):
    assert quality.check_keys({"t": spark.range(3)}, {"t": Table("id long")}) is None
    empty = {n: spark.createDataFrame([], t.columns) for n, t in TABLES.items()}
    assert quality.check_tables(empty).count() == 0


def test_every_table_is_read_twice_and_keys_meet_once(spark, tmp_path):
    tables = {}
    for name in ("person", "visit", "visit_task", "visit_action", "note", "task"):
        spark.createDataFrame([], TABLES[name].columns).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(TABLES[name].columns).parquet(str(tmp_path / name))
    plan = quality.check_tables(tables)._jdf.queryExecution().sparkPlan().toString()
    assert 0 < len(re.findall("FileScan parquet", plan)) <= 2 * len(tables)
    assert "Join" not in plan


def test_whole_number_keys_stay_numbers(spark):
    tables = frames(spark, 2, 30)
    plan = quality.check_keys(tables, SPECS)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan  # entries are left out by a filter, not by a function over arrays
    odd = {
        **tables,
        "owner": spark.createDataFrame([(1, "1 a", "b", None, 0.0), (1, "1", " ab", None, 1.0), (2, "1 a", "b", None, 2.0)],
                                       "k int, a string, b string, at timestamp, x double"),
        "child": spark.createDataFrame([(1, 2**32 + 1, 1.5, -0.0, 1), (2, 1, 2.0, 2.5, 3)], "c int, k long, other double, d double, own int"),
    }
    got = {tuple(r)[:3]: r.n_bad for r in quality.check_keys(odd, SPECS).collect()}
    assert got == one_by_one(odd)
    assert got["child", "foreign_key", "k->owner.k"] == got["child", "foreign_key", "other->owner.k"] == 1
