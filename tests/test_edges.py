"""Hand-made edge rows, one per trap."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortspark.functions import codes, dates, jsons, text
from cohortspark.functions.bind import bound
from cohortspark.operators import aggs, identity, joins, project, quality, reshape
from cohortspark.schema import DROP_LEVELS, STATUS

TS = dt.datetime


def one(rows):
    return [(r,) for r in rows]


def test_parse_mdy_timestamp(values):
    got = values(
        one(["03/04/85 10:30:00", "03/04/65 00:00:00", "3/4/2001 1:2:3", "bad", None, "13/40/85 00:00:00", "03/04/185 0:0:0"]),
        "s string", dates.parse_mdy_timestamp("s"),
    )
    assert got == [TS(1985, 3, 4, 10, 30), TS(2065, 3, 4), TS(2001, 3, 4, 1, 2, 3), None, None, None, None]


def test_parse_is_free_of_the_session_zone(spark, values):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = values(one(["03/10/24 02:30:00"]), "s string", dates.parse_mdy_timestamp("s").cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-10 02:30:00"]


def test_correct_future_date(values):
    got = values(
        one([dt.date(2065, 3, 4), dt.date(2021, 6, 1), None]), "d date",
        dates.correct_future_date("d", "2020-01-01").cast("date"),
    )
    assert got == [dt.date(1965, 3, 4), dt.date(2021, 6, 1), None]


def test_bin_code(values):
    assert values(one([-1, 0, 1, 2, 3, None]), "c int", codes.bin_code("c")) == [None, "U", "M", "F", None, None]


def test_map_code_labels(values):
    assert values(one([-1, 1, 2, 3, 9]), "c int", codes.map_code_labels("c")) == ["U", "R", "L", "A", None]


def test_combine_date_time(values):
    day, clock = TS(2010, 1, 2, 9, 0), TS(1899, 12, 30, 13, 15)
    got = values([(day, None), (day, clock)], "d timestamp_ntz, t timestamp_ntz", dates.combine_date_time("d", "t"))
    assert got == [TS(2010, 1, 2), TS(2010, 1, 2, 13, 15)]


def test_ages(values):
    got = values(
        [(TS(2020, 1, 1, 12), dt.date(2019, 11, 1)), (TS(2019, 9, 1, 12), dt.date(2019, 11, 1))],
        "t timestamp_ntz, d date", F.round(dates.age_years_whole_days("t", "d") * 365.25).cast("int"),
    )
    assert got == [61, -60]


def test_extract_visit_number(values):
    got = values(one(["x12 ok", "scan x3", "max3", None]), "s string", text.extract_visit_number("s"))
    assert got == [12, 3, None, None]


def test_extract_score(values):
    got = values(one(["good 4.5/5", "a4", "10/5 ok", "4", "none"]), "s string", text.extract_score("s"))
    assert got == [Decimal("4.50"), None, Decimal("0.00"), Decimal("4.00"), None]


def test_clean_joined_text(values):
    got = values(
        one(["NA NA NA NA NA", "1 Main NA Town PA 15213", " PA "]), "s string",
        text.clean_joined_text("s"), text.clean_joined_text("s", faithful=False),
    )
    assert got == [(" NA NA ", ""), ("1 Main Town PA 15213", "1 Main Town PA 15213"), ("", "")]


def test_digits_only_if(values):
    got = values([("Phone1", "(412) 555-0100"), ("Email", "a1@x")], "t string, v string", text.digits_only_if("v", "t"))
    assert got == ["4125550100", "a1@x"]


def test_filter_blank_values(spark):
    df = spark.createDataFrame(one(["- -", "", None, "( )", "7"]), "v string")
    assert [r.v for r in project.filter_blank_values(df, "v").collect()] == ["7"]


def test_build_cohort_label(values):
    got = values(
        [("", 1), ("PVL", 0), ("control", 1), ("", 0), (None, 1), ("PVL", None)], "d string, c int",
        text.build_cohort_label("d", "c"),
    )
    assert got == ["control", "PVL", "control", "control", "NA_control", "PVL_NA"]


def test_strip_domain_prefix(values):
    assert values(one(["1dom\\user", "user"]), "s string", text.strip_domain_prefix("s")) == ["user", "user"]


def test_default_when_all_blank(values):
    got = values(
        [("", ""), (None, None), ("a", ""), ("", "b")], "s string, c string",
        text.default_when_all_blank(["s", "c"], "c", "OLDDB"),
    )
    assert got == ["OLDDB", "OLDDB", "", "b"]


def test_classify_drop(values):
    got = values(
        [(0, 1), (None, 1), (1, None), (1, 5)], "d int, v int", codes.classify_drop("d", "v", "S", "V")
    )
    assert got == [None, None, "S", "V"]


def test_text_null_to_int(values):
    assert values(one(["null", "12", "x", None]), "s string", codes.text_null_to_int("s")) == [None, 12, None, None]


def test_full_name(values):
    assert values([("A", None), (None, "B")], "f string, l string", text.full_name("f", "l")) == ["A ", " B"]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (None, 3), (None, 4)], "k int, ord int")
    assert sorted(r.ord for r in identity.keep_first(df, ["k"], ["ord"]).collect()) == [1, 3]


def test_keep_first_faithful_pastes(spark):
    df = spark.createDataFrame([("A B", "C", 1), ("A", "B C", 2)], "f string, l string, ord int")
    assert identity.keep_first(df, ["f", "l"], ["ord"]).count() == 2
    assert [r.ord for r in identity.keep_first(df, ["f", "l"], ["ord"], faithful=True).collect()] == [1]


def test_remap_keys(spark):
    df = spark.createDataFrame(one([7, 9]), "pid long")
    lookup = spark.createDataFrame([(7, 3)], "dup_id long, use_id long")
    assert sorted(r.pid for r in identity.remap_keys(df, lookup, "pid").collect()) == [3, 9]


def test_remap_keys_moves_rows_once_beyond_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    rows = [(k, v) for k in (1, 2, None) for v in "ab"] + [(7, "a")] * 60
    spark.createDataFrame(rows, "pid long, v string").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    spark.createDataFrame([(7, 3), (1, 2)], "dup_id long, use_id long").write.parquet(str(tmp_path / "lookup"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))
    want = {(2, "a"), (2, "b"), (None, "a"), (None, "b"), (3, "a")}
    plain = identity.remap_keys(df, lookup, "pid", distinct=True)
    assert len(plain.collect()) == 5 and set(map(tuple, plain.collect())) == want
    # To the join and to the last distinct; the lookup to the join.
    assert plain._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") <= 2
    monkeypatch.setattr(joins, "HEAVY_ROWS", 5)
    salted = identity.remap_keys(df, lookup, "pid", distinct=True)
    assert len(salted.collect()) == 5 and set(map(tuple, salted.collect())) == want


def test_bound_hands_the_value_on_without_a_copy(spark):
    df = spark.range(3).withColumn("x", F.when(F.col("id") > 0, F.col("id")))
    out = df.select(bound(F.col("x") + 1, lambda a: bound(F.struct(a.alias("a"), (a * 2).alias("b")), lambda s: F.coalesce(s["a"] + s["b"], F.lit(-1)))))
    assert [r[0] for r in out.collect()] == [-1, 6, 9]
    assert "transform" not in out._jdf.queryExecution().analyzed().toString()  # it copies what the lambda gives, whole


def test_filter_three_valued(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("", 0), ("x", None)], "Notes string, Dropped int")
    assert sorted(map(tuple, project.filter_three_valued(df).collect()), key=str) == [("x", None), (None, 1)]


def test_json_agg_distinct(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (1, 1), (2, None)], "k int, v int")
    got = {r.k: r.j for r in aggs.json_agg_distinct(df, ["k"], "v", "j").collect()}
    assert got == {1: "[1,null]", 2: "[null]"}


def test_json_agg_all(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (1, 1)], "k int, v int")
    assert aggs.json_agg_all(df, ["k"], "v", "j").first().j == "[1,1,null]"


def test_json_element(values):
    got = values(
        one(["[null,1]", "[\"a\"]", "[{\"x\":1}]", "[]", None]), "j string",
        jsons.json_element("j", 0), jsons.json_element("j", 0, as_text=True),
    )
    assert got == [("null", None), ('"a"', "a"), ('{"x":1}', '{"x":1}'), (None, None), (None, None)]


def test_max_ordinal(spark):
    df = spark.createDataFrame([(1, "family"), (1, "visit"), (1, "nodrop"), (2, None), (3, "bogus")], "k int, d string")
    got = {r.k: r.d for r in aggs.max_ordinal(df, ["k"], "d", DROP_LEVELS).collect()}
    assert got == {1: "family", 2: None, 3: None}


def test_filtered_first_is_text_order(spark):
    df = spark.createDataFrame([(1, "10", "A"), (1, "9", "A"), (1, "1", "B")], "k int, id string, t string")
    assert aggs.filtered_first(df, ["k"], "id", F.col("t") == "A", "x").first().x == "10"


def test_latest_per_key_null_first(spark):
    df = spark.createDataFrame([(1, None, "sched"), (1, TS(2020, 1, 1), "complete")], "vid int, t timestamp_ntz, a string")
    assert identity.latest_per_key(df, ["vid"], "t").first().a == "sched"


def test_check_unique_ignores_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1)], "a int, b int")
    assert [tuple(r) for r in quality.check_unique(df, ["a", "b"]).collect()] == [(2, 1, 2)]


def test_check_numeric_range(spark):
    df = spark.createDataFrame(one([4.256, 12.0, None]), "v double")
    assert [r.v for r in quality.check_numeric_range(df, "v", 3, 2).collect()] == [12.0]


def test_check_enum_and_length_and_fk(spark):
    df = spark.createDataFrame([("sched", 1), ("gone", 2), (None, None)], "s string, p long")
    assert [tuple(r) for r in quality.check_enum_domain(df, "s", STATUS).collect()] == [("gone", 1)]
    assert quality.check_length(df, {"s": 4}).first().n_too_long == 1
    parent = spark.createDataFrame(one([1]), "p long")
    assert [tuple(r) for r in quality.check_foreign_key(df, "p", parent, "p").collect()] == [(2, 1)]


def test_offset_surrogate_key(spark):
    old = spark.createDataFrame(one([3, 41]), "k long")
    new = spark.createDataFrame(one(["c", "a", "b"]), "v string")
    got = {r.v: r.k for r in identity.offset_surrogate_key(new, "k", ["v"], old).collect()}
    assert got == {"a": 42, "b": 43, "c": 44}


def test_offset_surrogate_key_on_empty(spark):
    old = spark.createDataFrame([], "k long")
    new = spark.createDataFrame(one(["a"]), "v string")
    assert identity.offset_surrogate_key(new, "k", ["v"], old).first().k == 1


def test_select_columns_matching_ignores_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, Contact1Email int, other int")
    assert project.select_columns_matching(df, "contact").columns == ["Contact1Email"]
    assert project.select_columns_matching(df, "contact", invert=True).columns == ["id", "other"]


def test_unpivot_flags_drops_unknown(spark):
    df = spark.createDataFrame([(1, 1, None, 2)], "id int, a int, b int, c int")
    assert [r.flag for r in reshape.unpivot_flags(df, ["id"], ["a", "b", "c"]).collect()] == ["a"]


def test_pack_row_json_options(spark):
    from cohortspark.operators.jsonpack import pack_row_json

    df = spark.createDataFrame([(1, 0.123456, "NA", None)], "id int, x double, t string, n int")
    assert pack_row_json(df, ["id"]).first().measures == '{"x":0.1235,"t":"NA","n":null}'
    assert pack_row_json(df, ["id"], faithful=True, digits=None).first().measures == '{"x":0.123456,"t":null,"n":null}'
    assert pack_row_json(df.select("id"), ["id"]).first().measures == "{}"
