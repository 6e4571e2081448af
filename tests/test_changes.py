"""Change sets: guards, numbering, and undoing a registration."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cohortspark.plans import changes
from cohortspark.schema import TABLES
from cohortspark.sources import snapshot

TS = dt.datetime
NOW = "2024-05-01"


@pytest.fixture
def tables(spark):
    def make(name, rows):
        return spark.createDataFrame(rows, TABLES[name].columns)

    def visit(vid, status):
        return (vid, 1, "Scan", None, 1.0, 20.0, TS(2020, 1, 1), 1, None, status)

    return {
        "person": make("person", [(1, "A", "B", dt.date(2000, 1, 1), "F", "R", None, None, None)]),
        "visit": make("visit", [visit(1, "sched"), visit(2, "resched"), visit(3, "sched"), visit(4, "complete"), visit(5, None)]),
        "visit_action": make("visit_action", [
            (1, 1, "sched", "r", TS(2020, 1, 1)), (2, 2, "sched", "r", TS(2020, 1, 1)),
            (3, 2, "resched", "r", TS(2020, 2, 1)), (4, 3, "sched", "r", None), (5, 4, "complete", "r", TS(2020, 1, 1)),
        ]),
        "visit_study": make("visit_study", [(1, "X", "control"), (1, "Y", "control"), (4, "X", "control")]),
        "visit_task": make("visit_task", [(1, 3, "T", "{}", None)]),
        "visit_enroll": make("visit_enroll", [(9, 4)]),
        "note": make("note", [(7, 1, 1, None, None, None, "n"), (8, 1, None, None, None, None, "p")]),
    }


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cancel(spark, tables):
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,), (99,)], "vid long")
    done = changes.cancel_visits(asked, tables)
    assert rows(done.delete["visit"][1]) == [(1,)]
    assert {r.vid: r.reason for r in done.rejected.collect()} == {
        2: "has other actions, enrolments or tasks", 3: "has other actions, enrolments or tasks",
        4: "has other actions, enrolments or tasks", 99: "unknown visit",
    }
    after = changes.apply_changes(tables, done)
    assert sorted(r.vid for r in after["visit"].collect()) == [2, 3, 4, 5]
    assert [r.vid for r in after["visit_study"].collect()] == [4]
    assert [r.nid for r in after["note"].collect()] == [8]


def test_register_then_cancel_restores(spark, tables):
    req = spark.createDataFrame(
        [(1, 1, "MEG", TS(2024, 6, 1, 9), "ann", '["a","b"]', "X", "control"),
         (2, 1, "MEG", TS(2024, 7, 1, 9), "ann", None, None, None),
         (3, 55, "MEG", TS(2024, 7, 1, 9), "ann", None, None, None)],
        "req_id long, pid long, vtype string, vtimestamp timestamp_ntz, ra string, notes string, study string, cohort string",
    )
    done = changes.register_visits(req, tables, NOW)
    assert rows(done.rejected) == [(3, "unknown person")]
    visits = {r.vid: r for r in done.add["visit"].collect()}
    assert sorted(visits) == [6, 7]
    assert visits[6].vstatus == "sched" and round(visits[6].age, 3) == round(8918 / 365.25, 3)
    assert rows(done.add["visit_action"]) == [(6, 6, "sched", "ann", TS(2024, 5, 1)), (7, 7, "sched", "ann", TS(2024, 5, 1))]
    assert [(r.nid, r.vid, r.note) for r in done.add["note"].orderBy("nid").collect()] == [(9, 6, "a"), (10, 6, "b")]
    after = changes.apply_changes(tables, done)
    back = changes.apply_changes(after, changes.cancel_visits(done.add["visit"].select("vid"), after))
    for name in tables:
        assert rows(back[name]) == rows(tables[name]), name


def test_given_action_happens_at_visit_time(spark, tables):
    req = spark.createDataFrame(
        [(1, 1, "MEG", TS(2024, 6, 1, 9), "complete", "ann")],
        "req_id long, pid long, vtype string, vtimestamp timestamp_ntz, action string, ra string",
    )
    done = changes.register_visits(req, tables, NOW)
    assert rows(done.add["visit_action"]) == [(6, 6, "complete", "ann", TS(2024, 6, 1, 9))]


def test_reschedule(spark, tables):
    req = spark.createDataFrame(
        [(1, 1, TS(2021, 1, 1), None, '["late"]', "Z"), (2, 4, TS(2021, 1, 1), "r2", None, None),
         (3, 5, TS(2021, 1, 2), "r2", None, None), (4, 98, TS(2021, 1, 1), "r2", None, None)],
        "req_id long, vid long, vtimestamp timestamp_ntz, ra string, notes string, study string",
    )
    done = changes.reschedule_visits(req, tables, NOW)
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {2: "not scheduled or assigned", 4: "unknown visit"}
    after = changes.apply_changes(tables, done)
    visits = {r.vid: r for r in after["visit"].collect()}
    assert visits[1].vtimestamp == TS(2021, 1, 1) and visits[1].vtype == "Scan" and visits[1].vstatus == "resched"
    assert visits[1].visitno == 1 and visits[4].vstatus == "complete" and visits[5].vstatus == "resched"
    assert rows(after["visit_study"]) == [(1, "Y", "control"), (1, "Z", "control"), (4, "X", "control")]
    added = after["visit_action"].where("aid > 5").orderBy("aid").collect()
    assert [(r.aid, r.vid, r.action, r.ra) for r in added] == [(6, 1, "resched", "r"), (7, 5, "resched", "r2")]
    assert [(r.nid, r.vid, r.note) for r in done.add["note"].collect()] == [(9, 1, "late")]


def test_reschedule_guards(spark, tables):
    """Taken places and studies are refused, and an invalid request does not stand in a valid one's way."""
    req = spark.createDataFrame(
        [(1, 1, TS(2021, 1, 1), "maybe", None), (2, 1, TS(2021, 2, 1), None, None), (3, 3, TS(2021, 2, 1), None, None),
         (4, 2, TS(2020, 1, 1), None, None), (5, 5, TS(2021, 3, 1), None, "W"), (6, 1, None, None, "Y")],
        "req_id long, vid long, vtimestamp timestamp_ntz, action string, study string",
    ).withColumn("ra", F.lit("r"))
    done = changes.reschedule_visits(req, tables, NOW)
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {1: "unknown action", 3: "visit exists", 6: "study exists"}
    assert {r.vid: r.vtimestamp for r in done.update["visit"][1].collect()} == {1: TS(2021, 2, 1), 2: TS(2020, 1, 1), 5: TS(2021, 3, 1)}
    after = changes.apply_changes(tables, done)["visit_study"]
    assert after.count() == after.select("vid", "study").distinct().count()


def test_commit_stamps_and_marks(spark, tables, tmp_path):
    base = str(tmp_path / "target")
    snapshot.append_tables(tables, base, ingest_ts="2020-01-01")
    req = spark.createDataFrame([(1, 1, TS(2021, 2, 1))], "req_id long, vid long, vtimestamp timestamp_ntz").withColumn("ra", F.lit("r"))
    after = snapshot.load_snapshot(spark, base)
    changes.commit_changes(spark, base, changes.reschedule_visits(req, after, NOW), ingest_ts="2024-05-01")
    after = snapshot.load_snapshot(spark, base)
    assert {r.vid: r.ingest_ts for r in after["visit"].collect()} == {1: TS(2024, 5, 1), **{k: TS(2020, 1, 1) for k in (2, 3, 4, 5)}}
    assert after["visit_action"].where("ingest_ts = timestamp_ntz '2024-05-01'").count() == 1
    assert spark.read.parquet(f"{base}/last_update").agg(F.max("last_update")).first()[0] == TS(2024, 5, 1)


def test_rejected_and_applied_make_up_requests(spark, tables):
    asked = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6)], "vid long")
    done = changes.cancel_visits(asked, tables)
    assert done.rejected.count() + done.delete["visit"][1].count() == 6


def test_latest_status_is_last_inserted(spark):
    visits = spark.createDataFrame([(1, "checkedin"), (2, "checkedin")], "vid long, vstatus string")
    actions = spark.createDataFrame(
        [(1, 1, "complete", TS(2021, 1, 1)), (2, 1, "resched", TS(2020, 1, 1))],
        "aid long, vid long, action string, vatimestamp timestamp_ntz",
    )
    assert rows(changes.apply_latest_status(visits, actions)) == [(1, "resched"), (2, "checkedin")]


def test_commit_publishes_all_tables_at_once(spark, tables, tmp_path):
    from cohortspark.sources import snapshot

    base = str(tmp_path)
    snapshot.write_snapshot(tables, base)
    before = snapshot.current_snapshot(spark, base)[2]
    asked = spark.createDataFrame([(1,)], "vid long")
    changes.commit_changes(spark, base, changes.cancel_visits(asked, snapshot.load_snapshot(spark, base)))
    after = snapshot.load_snapshot(spark, base)
    assert sorted(r.vid for r in after["visit"].collect()) == [2, 3, 4, 5]
    folders = snapshot.current_snapshot(spark, base)[2]
    assert folders["person"] == before["person"] and folders["visit"] != before["visit"]

    req = spark.createDataFrame(
        [(1, 1, "MEG", TS(2024, 6, 1, 9), "ann")],
        "req_id long, pid long, vtype string, vtimestamp timestamp_ntz, ra string",
    )
    changes.commit_changes(spark, base, changes.register_visits(req, after, NOW))
    grown = snapshot.load_snapshot(spark, base)
    assert sorted(r.vid for r in grown["visit"].collect()) == [2, 3, 4, 5, 6]
    assert grown["visit_action"].where("vid = 6").count() == 1
    assert len(snapshot.current_snapshot(spark, base)[2]["visit"]) == 2


def test_register_rejects_taken_slots_and_unknown_studies(spark, tables):
    tables = {**tables, "study": spark.createDataFrame([("X", "X", None, None)], TABLES["study"].columns)}
    req = spark.createDataFrame(
        [(1, 1, "Scan", TS(2020, 1, 1), "ann", None), (2, 1, "MEG", TS(2024, 1, 1), None, None),
         (3, 1, "MEG", TS(2024, 1, 1), "ann", None), (4, 1, "MEG", TS(2024, 1, 1), "ann", None),
         (5, 1, "MEG", None, "ann", None), (6, 1, "MEG", None, "ann", "Q"), (7, 1, "MEG", None, "ann", "X")],
        "req_id long, pid long, vtype string, vtimestamp timestamp_ntz, ra string, study string",
    )
    req = req.selectExpr("*", "'control' as cohort")
    done = changes.register_visits(req, tables, NOW)
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {
        1: "visit exists", 2: "missing staff", 4: "visit exists", 6: "unknown study",
    }
    assert done.add["visit"].count() == 3


def test_several_reschedules_of_a_visit_act_in_order(spark, tables):
    """Each on what the one before left: last given values stay, every one adds an action and its notes."""
    req = spark.createDataFrame(
        [(2, 1, TS(2022, 1, 1), None, "r2", '["second"]', "Q", None), (1, 1, TS(2021, 1, 1), "MEG", None, '["first"]', "Z", "late"),
         (3, 1, TS(2023, 1, 1), None, None, None, "X", None), (4, 1, None, None, None, None, "Z", None), (5, 1, TS(2019, 1, 1), None, None, None, None, None),
         (6, 1, None, None, "r6", None, None, None)],
        "req_id long, vid long, vtimestamp timestamp_ntz, vtype string, ra string, notes string, study string, cohort string",
    )
    done = changes.reschedule_visits(req, tables, NOW)
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {4: "study exists"}
    after = changes.apply_changes(tables, done)
    actions = after["visit_action"].where("aid > 5").orderBy("aid").collect()
    want = plain_reschedule(req.collect(), tables)
    assert [(r.vid, r.action, r.ra, r.vatimestamp) for r in actions] == want["actions"]
    assert rows(after["visit_study"].where("vid = 1")) == sorted(want["studies"][1], key=str)
    assert [r.note for r in done.add["note"].orderBy("nid").collect()] == ["first", "second"]
    moved = {r.vid: r for r in after["visit"].collect()}[1]
    assert (moved.vtimestamp, moved.vtype, moved.vstatus) == (TS(2019, 1, 1), "MEG", "resched")


def plain_reschedule(requests, tables):
    """One request after the other on plain rows."""
    visits = {r.vid: r.asDict() for r in tables["visit"].collect()}
    actions, studies = {}, {}
    for r in sorted(tables["visit_action"].collect(), key=lambda r: r.aid):
        actions.setdefault(r.vid, []).append((r.action, r.ra, r.vatimestamp))
    for r in tables["visit_study"].collect():
        studies.setdefault(r.vid, []).append((r.vid, r.study, r.cohort))
    out = {"actions": [], "rejected": {}, "visits": visits, "studies": studies}
    for q in sorted((r.asDict() for r in requests), key=lambda q: q["req_id"]):
        v = visits.get(q["vid"])
        if v is None:
            out["rejected"][q["req_id"]] = "unknown visit"
            continue
        own = actions.get(q["vid"], [])
        old = max(enumerate(own), key=lambda x: (x[1][2] is None, x[1][2] or TS(1, 1, 1), x[0]))[1] if own else (None, None, None)
        shown = min(studies.get(q["vid"], [(None, None, None)]), key=lambda x: (x[1] or "", x[2] or ""))
        new = {c: q.get(c) if q.get(c) is not None else v[c] for c in changes.MOVED}
        action, ra, study = q.get("action") or "resched", q.get("ra") or old[1], q.get("study")
        place = (v["pid"], new["vtimestamp"], new["vtype"])
        taken = place[1] is not None and any((w["pid"], w["vtimestamp"], w["vtype"]) == place for k, w in visits.items() if k != q["vid"])
        claims = place[1:] != (v["vtimestamp"], v["vtype"])
        reason = (
            "not scheduled or assigned" if old[0] is not None and old[0] not in ("sched", "resched", "assigned")
            else "unknown action" if action == "maybe" else "missing staff" if ra is None
            else "study exists" if study and study != shown[1] and study in [x[1] for x in studies.get(q["vid"], [])]
            else "visit exists" if claims and taken else None)
        if reason:
            out["rejected"][q["req_id"]] = reason
            continue
        v.update(new, vstatus=action)
        actions.setdefault(q["vid"], []).append((action, ra, new["vtimestamp"]))
        out["actions"].append((q["vid"], action, ra, new["vtimestamp"]))
        if study and q["vid"] in studies:
            cohort = q.get("cohort") or shown[2]
            studies[q["vid"]] = [(x[0], study, cohort) if x[1] == shown[1] else x for x in studies[q["vid"]]]
    return out


def check_replay(spark, tables, requests, together):
    schema = "req_id long, vid long, vtimestamp timestamp_ntz, vtype string, action string, ra string, study string, cohort string"
    req = spark.createDataFrame(requests, schema)
    done = changes.reschedule_visits(req, tables, NOW, together=together)
    want = plain_reschedule(req.collect(), tables)
    assert {r.req_id: r.reason for r in done.rejected.collect()} == want["rejected"]
    assert [(r.vid, r.action, r.ra, r.vatimestamp) for r in done.add["visit_action"].orderBy("aid").collect()] == want["actions"]
    after = changes.apply_changes(tables, done)
    assert {r.vid: (r.vtimestamp, r.vtype, r.vstatus) for r in after["visit"].collect()} == {
        k: (v["vtimestamp"], v["vtype"], v["vstatus"]) for k, v in want["visits"].items()}
    assert rows(after["visit_study"]) == sorted((x for own in want["studies"].values() for x in own), key=str)
    return want


@pytest.mark.parametrize("together", [256, 0])
def test_reschedule_chains_and_swaps(spark, tables, together):
    """A place is free once its visit left, taken while its visit's move is refused, and two visits swap by way of a third place."""
    visit = [(k, 1, "MEG", None, 1.0, 20.0, TS(2020, 1, k), 1, None, "sched") for k in range(1, 9)]
    tables = {**tables, "visit": spark.createDataFrame(visit, TABLES["visit"].columns),
              "visit_action": spark.createDataFrame([(k, k, "sched", "r", TS(2020, 1, k)) for k in range(1, 9)], TABLES["visit_action"].columns)}
    move = lambda n, vid, day, action=None: (n, vid, TS(2020, 1, day), None, action, None, None, None)
    want = check_replay(spark, tables, [
        move(1, 1, 20), move(2, 2, 1), move(3, 3, 2), move(4, 4, 3), move(5, 5, 4),  # each takes the place left before
        move(6, 6, 21), move(7, 7, 6), move(8, 6, 7),  # a swap
        move(9, 8, 20, "maybe"), move(10, 8, 20), move(11, 1, 8), move(12, 8, 20), move(13, 2, 20), move(14, None, 9), move(15, 77, 9),
        move(16, 3, 25, "complete"), move(17, 3, 30),
    ], together)
    assert want["rejected"] == {9: "unknown action", 10: "visit exists", 11: "visit exists", 12: "visit exists", 13: "visit exists", 14: "unknown visit",
                                15: "unknown visit", 17: "not scheduled or assigned"}


@pytest.mark.parametrize(("seed", "together"), [(1, 256), (1, 0), (2, 40)])
def test_reschedule_equals_a_replay(spark, tables, seed, together):
    import random

    draw = random.Random(seed)
    pick = lambda *xs: draw.choice(xs)
    visit = [(k, k % 3, pick("MEG", "Scan"), None, 1.0, 20.0, TS(2020, 1, 1 + k), 1, None, "sched") for k in range(20)]
    action = [(k, draw.randrange(20), pick("sched", "sched", "resched", "assigned", "complete"), pick("r", "q", None), pick(TS(2020, 1, draw.randint(1, 28)), None))
              for k in range(30)]
    study = sorted({(draw.randrange(20), pick("A", "B", "C")) for _ in range(25)})
    tables = {**tables, "visit": spark.createDataFrame(visit, TABLES["visit"].columns),
              "visit_action": spark.createDataFrame(action, TABLES["visit_action"].columns),
              "visit_study": spark.createDataFrame([(*x, pick("c", "d")) for x in study], TABLES["visit_study"].columns)}
    requests = [(k, draw.randrange(22), pick(TS(2020, 1, draw.randint(1, 12)), None), pick("MEG", "Scan", None), pick(None, None, None, "assigned", "maybe", "cancelled"),
                 pick("r", None), pick("A", "B", "C", "D", None, None), pick("e", None)) for k in range(120)]
    check_replay(spark, tables, requests, together)


ACTION = "req_id long, vid long, action string, ra string, vatimestamp timestamp_ntz, aid long"


def test_record_actions_moves_status_by_greatest_key(spark, tables):
    rows_ = [(1, 1, "checkedin", "r", TS(2020, 5, 1), None), (2, 1, "complete", "r", TS(2019, 1, 1), None), (3, 99, "sched", "r", None, None),
             (4, 2, "maybe", "r", None, None), (5, 2, None, "r", None, None), (6, 3, "noshow", None, None, None), (7, None, "sched", "r", None, None), (8, 5, "noshow", "r", None, None)]
    done = changes.record_actions(spark.createDataFrame(rows_, ACTION), tables)
    assert rows(done.add["visit_action"].select("aid", "vid", "action")) == [(6, 1, "checkedin"), (7, 1, "complete"), (8, 5, "noshow")]
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {
        3: "unknown visit", 4: "unknown action", 5: "unknown action", 6: "missing staff", 7: "unknown visit"}
    after = changes.apply_changes(tables, done)
    assert {r.vid: r.vstatus for r in after["visit"].collect()} == {1: "complete", 2: "resched", 3: "sched", 4: "complete", 5: "noshow"}


def test_record_late_actions_with_keys(spark, tables):
    """A key below those that are there changes no status, and the same batch again changes nothing."""
    rows_ = [(1, 2, "noshow", "r", None, 0), (2, 2, "other", "r", None, 3), (3, 3, "checkedin", "r", None, 50), (4, 3, "complete", "r", None, 50),
             (5, 1, "checkedin", "r", None, 40), (6, 1, "sched", "r", None, 39), (7, 1, "sched", "r", None, None)]
    batch = spark.createDataFrame(rows_, ACTION)
    done = changes.record_actions(batch, tables, key="aid")
    assert {r.req_id: r.reason for r in done.rejected.collect()} == {2: "repeated key", 4: "repeated key", 7: "missing key"}
    after = changes.apply_changes(tables, done)
    assert {r.vid: r.vstatus for r in after["visit"].collect()} == {1: "checkedin", 2: "resched", 3: "checkedin", 4: "complete", 5: None}
    again = changes.record_actions(batch, after, key="aid")
    assert again.add["visit_action"].count() == 0 and again.update["visit"][1].count() == 0


@pytest.mark.parametrize("cuts", [(3, 7, 12), (6, 12)])
def test_recorded_batches_equal_the_latest_of_all(spark, tables, cuts):
    """Batches in any cut and order of keys leave the status that one pass over all actions gives, and so does the stream's rule."""
    keys = [17, 3, 8, 40, 12, 39, 9, 2, 28, 11, 31, 6]
    log = [(k, 1 + k % 5, ("sched", "noshow", "complete", "checkedin")[k % 4], "r", None, 100 + k) for k in keys]
    now, since = tables, 0
    for until in cuts:
        now = changes.apply_changes(now, changes.record_actions(spark.createDataFrame(log[since:until], ACTION), now, key="aid"))
        since = until
    want = changes.apply_latest_status(tables["visit"], now["visit_action"])
    touched = {1 + k % 5 for k in keys}
    status = lambda df: {r.vid: r.vstatus for r in df.collect() if r.vid in touched}
    assert status(now["visit"]) == status(want)
    from cohortspark.streaming.status import latest_status_of

    assert status(now["visit"]) == {r.vid: r.status for r in latest_status_of(now["visit_action"]).collect() if r.vid in touched}


def test_of_two_writers_one_gets_an_error(spark, tables, tmp_path):
    base = str(tmp_path)
    snapshot.write_snapshot(tables, base)
    at, seen = snapshot.sequence(spark, base), snapshot.load_snapshot(spark, base)
    action = lambda vid: changes.record_actions(spark.createDataFrame([(1, vid, "noshow", "r", None, None)], ACTION), seen)
    one, two = action(1), action(2)
    changes.commit_changes(spark, base, one, based_on=at)
    with pytest.raises(snapshot.ConcurrentWrite):
        changes.commit_changes(spark, base, two, based_on=at)
    after = snapshot.load_snapshot(spark, base)
    assert {r.vid: r.vstatus for r in after["visit"].collect()} == {1: "noshow", 2: "resched", 3: "sched", 4: "complete", 5: None}
    assert snapshot.sequence(spark, base) == at + 1
    # A claim without an entry, as a writer in the midst of publishing leaves it, is an error too.
    claim = f"{base}/published/_claim-{at + 2:012d}"
    open(claim, "w").close()
    with pytest.raises(snapshot.ConcurrentWrite, match="remove"):
        changes.commit_changes(spark, base, two)
    os.remove(claim)
    changes.commit_changes(spark, base, two)
    assert {r.vid: r.vstatus for r in snapshot.load_snapshot(spark, base)["visit"].collect()}[2] == "noshow"
