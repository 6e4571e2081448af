"""Views refreshed by change sets equal the views built anew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortspark.plans import changes, refresh
from cohortspark.registry.standin import domain
from cohortspark.session import written

DATA = "/root/testdata/sf0.001"
AS_OF = "2020-01-01"
OPTIONS = {"person_search_view": {"as_of": AS_OF}}


@pytest.fixture(scope="module")
def tables(spark):
    """Every tenth visit and person of the smallest data, stored once."""
    t = domain(spark, DATA)
    keep = {n: df.where("pid % 10 < 4") if "pid" in df.columns else df for n, df in t.items()}
    return {n: written(df, "refresh-test") for n, df in keep.items()}


def change(spark, tables, kind):
    visit = tables["visit"].where("vid % 7 = 3")
    if kind == "register":
        req = tables["person"].where("pid % 3 = 0").select(
            F.col("pid").alias("req_id"), "pid", F.lit("MEG").alias("vtype"), F.lit(dt.datetime(2024, 6, 1)).alias("vtimestamp"), F.lit("ann").alias("ra"),
            F.lit('["a","b"]').alias("notes"), F.lit("New").alias("study"), F.lit("control").alias("cohort"))
        return changes.register_visits(req, tables, AS_OF)
    if kind == "reschedule":
        req = visit.select(F.col("vid").alias("req_id"), "vid", (F.col("vtimestamp") + F.expr("interval 3 days")).alias("vtimestamp"),
                           F.lit("bob").alias("ra"), F.lit('["moved"]').alias("notes"), F.lit("Other").alias("study"))
        return changes.reschedule_visits(req, tables, AS_OF)
    if kind == "cancel":
        return changes.cancel_visits(tables["visit"].select("vid"), tables)
    req = visit.select(F.col("vid").alias("req_id"), "vid", F.lit("checkedin").alias("action"), F.lit("eve").alias("ra"), F.col("vtimestamp").alias("vatimestamp"))
    return changes.record_actions(req, tables)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", ["register", "reschedule", "cancel", "record"])
def test_refreshed_equals_built(spark, tables, kind):
    done = change(spark, tables, kind)
    after = {n: written(df, "refresh-after") for n, df in changes.apply_changes(tables, done).items()}
    differs = set()
    for name, view in refresh.VIEWS.items():
        options = OPTIONS.get(name, {})
        stored, want = rows(view.build(tables, **options)), rows(view.build(after, **options))
        got = refresh.refresh_view(name, written(view.build(tables, **options), "stored"), done, tables, after, **options)
        assert rows(got) == want, name
        if stored != want:
            differs.add(name)
    assert differs >= {"register": set(refresh.VIEWS) - {"person_only_notes", "person_all_notes"}, "reschedule": {"visit_summary", "visits_view"},
                       "cancel": {"visit_summary"}, "record": {"visit_summary", "visits_view", "person_search_view"}}[kind]


def test_only_affected_keys(spark, tables):
    req = tables["visit"].where("vid % 100 = 3").select(F.col("vid").alias("req_id"), "vid", F.lit("checkedin").alias("action"), F.lit("eve").alias("ra"))
    done = changes.record_actions(req, tables)
    after = changes.apply_changes(tables, done)
    n = done.update["visit"][1].count()
    assert 0 < n == refresh.affected_keys("visit_summary", done, tables, after).count()
    assert refresh.affected_keys("visit_notes", done, tables, after).count() == 0
    assert 0 < refresh.affected_keys("person_search_view", done, tables, after).count() <= n
