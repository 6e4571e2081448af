"""The full rebuild from files, with input order taken from the files themselves."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from cohortspark.plans.load import conform, rebuild
from cohortspark.plans.tables import Build, build_enroll, build_person, build_visit
from cohortspark.registry.standin import AS_OF, sources
from cohortspark.schema import BUILT
from cohortspark.sources import scan, snapshot
from cohortspark.sources.layout import Layout


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sources"))
    for name, df in sources(spark, DATA).items():
        df.coalesce(1).write.parquet(f"{base}/{name}")
    return base


@pytest.fixture(scope="module")
def scanned(spark, stored):
    names = scan.scan_matching_tables(spark, stored, ".")
    return {n: scan.scan_table(spark, stored, n, with_order=True) for n in names}


@pytest.fixture(scope="module")
def loaded(spark, scanned, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("target"))
    bad = rebuild(spark, scanned, base, AS_OF).collect()
    assert str(spark.read.parquet(f"{base}/last_update").first()[0]).startswith(AS_OF)
    return snapshot.load_snapshot(spark, base), bad


def test_all_tables_are_published(loaded):
    tables, _ = loaded
    assert sorted(tables) == sorted([*BUILT, "dropcode", "ra"])
    assert tables["dropcode"].count() == 23


def test_keys_are_dense(loaded):
    tables, _ = loaded
    for name, key in [("contact", "cid"), ("visit_task", "vtid"), ("enroll", "eid"), ("note", "nid"), ("visit_action", "aid")]:
        n, lo, hi, d = tables[name].agg(
            F.count("*"), F.min(key), F.max(key), F.count_distinct(key)
        ).first()
        assert (lo, hi, d) == (1, n, n), name


def test_only_known_constraints_break(loaded):
    """References between built tables hold; what breaks is what the source itself breaks."""
    _, bad = loaded
    found = {(r.table_name, r.check_name, r.subject) for r in bad}
    assert ("visit", "unique", "pid,vtimestamp,vtype") not in found
    assert ("person", "unique", "fname,lname,dob") not in found
    # Tasks without any mode are not listed, and the flag columns name studies no task has.
    dangling = {("study_task", "task->task.task"), ("visit_study", "study->study.study")}
    assert {(t, s) for t, check, s in found if check == "foreign_key"} == dangling
    assert ("visit_task", "unique", "vid,task") in found  # reported, not dropped


def test_file_order_gives_the_same_tables(spark, scanned):
    """Rows are stored in key order, so file order and key order must agree."""
    plain = sources(spark, DATA)
    for build in (build_person, build_visit):
        a = sorted(map(tuple, build(scanned, AS_OF).collect()), key=str)
        b = sorted(map(tuple, build(plain, AS_OF).collect()), key=str)
        assert a == b


def test_one_enrolment_per_person_or_per_id(spark):
    plain = sources(spark, DATA)
    b = Build(plain, AS_OF)
    one = build_enroll(plain, AS_OF, b).where("etype = 'PrimaryID'")
    every = build_enroll(plain, AS_OF, b, all_ids=True).where("etype = 'PrimaryID'")
    assert one.count() == one.select("pid").distinct().count() < every.count() == plain["subject_info"].count()


def test_faithful_ids_may_repeat_visits(spark):
    plain = sources(spark, DATA)
    strict = Build(plain, AS_OF).all_visits
    loose = Build(plain, AS_OF, faithful=True).all_visits
    assert strict.count() == plain["visit_log"].count() < loose.count()


def test_layout_names_are_the_sites_own(spark):
    plain = dict(sources(spark, DATA))
    renamed = {"people": plain.pop("subject_info").withColumnRenamed("PersonID", "Pnr"), **plain}
    for name in ("visit_log", "visit_study_flags", "scan_ids", "dLine", "dOrder", "dEvent"):
        renamed[name] = plain[name].withColumnRenamed("PersonID", "Pnr")
    layout = Layout(subjects="people", person_id="Pnr", bad_visits=(3, 5))
    got = build_visit(renamed, AS_OF, layout=layout)
    assert got.where("vid in (3, 5)").count() == 0
    assert got.where("pid is not null").count() > 0


def test_conform_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        conform("study", spark.createDataFrame([("a", 1)], "study string, other int"))
