"""Grouping children before joining gives what joining everything first gives, nulls included."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortspark.plans import views
from cohortspark.schema import TABLES

maybe = lambda s: st.one_of(st.none(), s)
ids = st.integers(1, 4)
data = st.fixed_dictionaries({
    "visit": st.lists(st.tuples(maybe(ids), maybe(st.sampled_from("ST")), st.sampled_from(["sched", "complete", "noshow"])), max_size=8),
    "visit_study": st.lists(st.tuples(st.integers(0, 8), maybe(st.sampled_from("XY")), st.just("c")), max_size=8),
    "enroll": st.lists(st.tuples(ids, st.sampled_from(["PrimaryID", "ScanID"]), st.sampled_from(["1", "22", "3"])), max_size=5),
    "visit_task": st.lists(st.tuples(st.integers(0, 8), st.sampled_from("ab")), max_size=6),
    "visit_action": st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["sched", "complete"])), max_size=6),
    "note": st.lists(st.tuples(maybe(ids), maybe(st.integers(0, 8)), maybe(st.sampled_from(["METAL", "LOWIQ", "NOT", "?"]))), max_size=6),
})


def frames(spark, d):
    def make(name, rows):
        return spark.createDataFrame(rows, TABLES[name].columns)

    return {
        "person": make("person", [(i, f"f{i}", None, None, "F", "R", None, None, None) for i in (1, 2, 3)]),
        "visit": make("visit", [(i, p, t, None, None, None, None, None, None, s) for i, (p, t, s) in enumerate(d["visit"])]),
        "visit_study": make("visit_study", d["visit_study"]),
        "enroll": make("enroll", [(i, p, t, v, None) for i, (p, t, v) in enumerate(d["enroll"])]),
        "visit_task": make("visit_task", [(i, v, t, None, None) for i, (v, t) in enumerate(d["visit_task"])]),
        "visit_action": make("visit_action", [(i, v, a, "r", None) for i, (v, a) in enumerate(d["visit_action"])]),
        "note": make("note", [(i, p, v, c, None, None, "n") for i, (p, v, c) in enumerate(d["note"])]),
    }


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(d=data)
def test_views_equal_star_joins(spark, d):
    t = frames(spark, d)
    for name, df in t.items():
        df.createOrReplaceTempView(f"s_{name}")
    want = spark.sql("""
        select p.pid, count(distinct v.vid) as numvisits, count(distinct s.study) as nstudies,
            count(distinct n.nid) as ndrops, size(collect_set(struct(s.study))) as n_s,
            size(collect_set(struct(v.vtype))) as n_t, size(collect_set(struct(e.id, e.etype))) as n_i,
            min(case when e.etype = 'PrimaryID' then e.id end) as first
        from s_person p
        left join s_visit v on v.pid = p.pid and v.vstatus in ('sched', 'checkedin', 'complete')
        left join s_enroll e on e.pid = p.pid left join s_visit_study s on s.vid = v.vid
        left join s_note n on n.pid = p.pid and n.dropcode is not null group by p.pid""").collect()
    got = views.person_search_view(t, "2020-01-01").selectExpr(
        "pid", "numvisits", "nstudies", "ndrops", "json_array_length(studies)", "json_array_length(visittypes)",
        "json_array_length(ids)", "cast(primary_id as string)",
    ).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))

    want = spark.sql("""
        select v.vid, size(collect_list(struct(e.id))) as n_e, size(collect_list(struct(a.aid))) as n_a,
            size(collect_set(struct(s.study, s.cohort))) as n_s, size(collect_set(struct(k.task))) as n_t
        from s_visit v join s_visit_study s on s.vid = v.vid left join s_visit_task k on k.vid = v.vid
        left join s_enroll e on e.pid = v.pid left join s_visit_action a on a.vid = v.vid group by v.vid""").collect()
    got = views.visits_view(t, fanout="reference").selectExpr(
        "vid", "json_array_length(enrolls)", "json_array_length(actions)", "json_array_length(studies)",
        "json_array_length(tasks)",
    ).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_search_view_keeps_unnamed_study(spark):
    t = frames(spark, {
        "visit": [(1, "S", "sched"), (2, "S", "sched")], "visit_study": [(0, None, "c"), (0, "X", "c"), (1, None, "c")],
        "enroll": [(1, "ScanID", "1")], "visit_task": [(0, "a")], "visit_action": [(0, "sched")], "note": [(1, 0, None)],
    })
    got = views.person_search_view(t, "2020-01-01").select("pid", "numvisits", "nstudies", "studies").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, '["X",null]'), (2, 1, 0, "[null]"), (3, 0, 0, "[null]")]
