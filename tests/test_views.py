"""Views on hand-made rows, and shapes of their plans."""

import datetime as dt
import json

import pytest
from conftest import DATA

from cohortspark.plans import views
from cohortspark.registry import QUERIES
from cohortspark.schema import TABLES

TS = dt.datetime


@pytest.fixture
def tables(spark):
    def make(name, rows):
        return spark.createDataFrame(rows, TABLES[name].columns)

    def visit(vid, pid, status):
        return (vid, pid, "Scan", None, None, None, TS(2020, 1, vid), None, None, status)

    return {
        "person": make("person", [
            (1, "A", None, dt.date(2000, 1, 1), "F", "R", None, None, None),
            (2, "C", "D", dt.date(1990, 1, 1), "M", "R", None, None, None),
        ]),
        "visit": make("visit", [visit(1, 1, "complete"), visit(2, 1, "cancelled"), visit(3, 1, "sched"), visit(4, 9, "sched")]),
        "visit_study": make("visit_study", [(1, "X", "c"), (1, "Y", "c"), (2, "Z", "c"), (4, "X", "c")]),
        "visit_task": make("visit_task", [(1, 1, "T1", None, None), (2, 1, "T2", None, None), (3, 1, "T2", None, None)]),
        "visit_action": make("visit_action", [(1, 1, "sched", "r", None), (2, 1, "complete", "r", TS(2020, 1, 1))]),
        "enroll": make("enroll", [(1, 1, "PrimaryID", "10", None), (2, 1, "PrimaryID", "9", None), (3, 1, "ScanID", "S", None)]),
        "note": make("note", [
            (1, 1, 1, "TECH_ISSUE", None, None, "n1"), (2, 1, None, "DEPRESSED", None, None, "n2"),
            (3, 1, None, None, None, None, "n3"), (4, 1, None, "NEWCODE", None, None, "n4"),
        ]),
    }


def test_person_search(tables):
    got = {r.pid: r for r in views.person_search_view(tables, "2020-01-01").collect()}
    one, two = got[1], got[2]
    assert (one.primary_id, one.fullname, one.numvisits, one.nstudies, one.ndrops) == (10, "A ", 2, 2, 3)
    assert one.maxdrop == "family" and one.curagefloor == 20.0
    assert json.loads(one.studies) == ["X", "Y", None]
    assert json.loads(two.ids) == [{"id": None, "etype": None, "edate": None}]
    assert (two.studies, two.visittypes, two.numvisits, two.maxdrop) == ("[null]", "[null]", 0, None)


def test_person_search_with_own_codes(spark, tables):
    tables["dropcode"] = spark.createDataFrame([("NEWCODE", "future")], "dropcode string, droplevel string")
    got = {r.pid: r for r in views.person_search_view(tables, "2020-01-01").collect()}
    assert got[1].maxdrop == "future" and got[1].ndrops == 3
    assert {r.maxdrop for r in views.person_all_notes(tables).collect()} == {"future"}


def test_visits_view_fanout(tables):
    once = {r.vid: r for r in views.visits_view(tables).collect()}
    many = {r.vid: r for r in views.visits_view(tables, fanout="reference").collect()}
    assert sorted(once) == [1, 2, 4]  # a visit without a study vanishes
    assert len(json.loads(once[1].actions)) == 2 and len(json.loads(once[1].enrolls)) == 3
    assert len(json.loads(many[1].actions)) == 2 * 2 * 3 * 3  # studies, tasks, ids
    assert len(json.loads(many[1].enrolls)) == 3 * 2 * 3 * 2
    assert once[1].primary_id == "9" and once[4].fname is None
    assert json.loads(once[4].enrolls) == [{"etype": None, "id": None}]
    assert once[2].notes == "null" and once[2].tasks == "[null]"
    assert once[1].subjmaxdrop == "family"


def test_visit_summary_picks_null_time_as_latest(tables):
    got = {r.vid: r for r in views.visit_summary(tables).collect()}
    assert sorted(got) == [1, 2, 3]  # inner join to person
    assert (got[1].action, got[1].study, got[1].dvisit, got[1].dperson) == ("sched", "X", "TECH_ISSUE", "family")


def test_person_only_notes(tables):
    (row,) = views.person_only_notes(tables).collect()
    assert json.loads(row.notes) == ["n2"] and row.maxpdrop == "family"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["person_search_view", "visits_view", "visit_summary", "build_note", "cancel_visits"])
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_first_row_is_limited_before_the_exchange(spark):
    plan = plan_of(QUERIES["latest_per_key"](spark, DATA))
    assert plan.count("WindowGroupLimit") == 2


def test_flagship_reads_only_what_it_needs(spark):
    plan = plan_of(QUERIES["person_search_view"](spark, DATA))
    reads = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    lines = [r for r in reads if "l_orderkey" in r]
    assert lines and all("l_comment" not in r and "l_extendedprice" not in r for r in lines)
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
