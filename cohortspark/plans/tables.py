"""Building the twelve output tables from the source tables.

``Build`` holds the frames several tables share (numbered people, visits, the two key lookups);
they are written once and then read back narrow. Every ``build_*`` function takes the sources
and gives its table; pass ``build`` to share work between them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import codes, dates, text
from ..operators import aggs, identity, jsonpack, project, reshape
from ..operators.joins import anti_join_missing, left_join_lookup, lookup_join
from ..session import written
from ..sources.layout import Layout, source_order
from ..sources.scan import SRC_ORD


@dataclass
class Build:
    sources: Mapping[str, DataFrame]
    as_of: str
    layout: Layout = field(default_factory=Layout)
    faithful: bool = False  # join person ids without their origin; compare pasted screening names

    def _source(self, role: str, *key: str) -> DataFrame:
        """A source table with its order as ``_ord``."""
        df = self.sources[getattr(self.layout, role)]
        return df.withColumn("_ord", source_order(df, *key)[0]).drop(SRC_ORD)

    @cached_property
    def numbered(self) -> DataFrame:
        """People of both sources, one row per (id, origin), with a dense ``own_pid``."""
        lay = self.layout
        subj = self._source("subjects", lay.person_id).withColumnRenamed(lay.person_id, "ID")
        screened = self._source("screened", lay.screen_id).withColumnRenamed(lay.screen_id, "ID")
        screened = identity.keep_first(
            project.filter_nonblank(screened, ["SubjectLastName"]),
            ["SubjectFirstName", "SubjectLastName"], ["_ord"], faithful=self.faithful,
        )
        people = reshape.union_by_name(
            project.tag_source(subj, origin="subj", _rank=0), project.tag_source(screened, origin="screen", _rank=1)
        )
        people = identity.keep_first(people, ["ID", "origin"], ["_ord"]).withColumns(
            {
                "sex": codes.bin_code("SexID"),
                "hand": codes.map_code_labels("HandID"),
                "dob": dates.correct_future_date(dates.parse_mdy_timestamp("DateOfBirth"), self.as_of).cast("date"),
            }
        )
        people = people.withColumnsRenamed({"SubjectFirstName": "fname", "SubjectLastName": "lname"})
        return identity.dense_surrogate_key(people, "own_pid", ["_rank", "_ord"])

    @cached_property
    def person_lookup(self) -> DataFrame:
        lookup = identity.alias_key_lookup(self.numbered, ["fname", "lname", "dob"], "own_pid", ["own_pid"])
        return written(lookup, "person-lookup")

    @cached_property
    def people(self) -> DataFrame:
        """Every source row under the ``pid`` of the person it belongs to."""
        rows = self.numbered.withColumn("pid", F.col("own_pid"))
        return identity.remap_keys(rows, self.person_lookup, "pid", spread_by=["own_pid"])

    @cached_property
    def person_ids(self) -> DataFrame:
        """(source id, pid, dob): ids of the subject table, or of both when ``faithful``."""
        ids = self.people if self.faithful else self.people.where(F.col("origin") == "subj")
        return ids.select(F.col("ID").alias(self.layout.person_id), "pid", "dob")

    def with_person(self, df: DataFrame, spread_by: list[str]) -> DataFrame:
        """Left join rows naming a source id to ``pid`` and ``dob``."""
        size = self.numbered.select("ID", "own_pid", "dob")
        return lookup_join(df, self.person_ids, [self.layout.person_id], "left", spread_by=spread_by, bound_by=[size])

    @cached_property
    def visit_log(self) -> DataFrame:
        lay = self.layout
        return project.exclude_keys(self._source("visits", lay.visit_id), lay.visit_id, lay.bad_visits)

    @cached_property
    def all_visits(self) -> DataFrame:
        """Every logged visit with its person. Type, time and scores come from the row itself."""
        lay = self.layout
        log = self.visit_log.select(
            F.col(lay.visit_id).alias("vid"),
            lay.person_id,
            "_ord",
            dates.parse_mdy_timestamp("VisitDate").alias("_day"),
            dates.parse_mdy_timestamp("VisitTime").alias("_time"),
            reshape.collapsed_flags(S.VISIT_TYPES).alias("vtype"),
            text.extract_visit_number("Notes").alias("visitno"),
            text.extract_score("Notes").alias("vscore"),
        )
        joined = self.with_person(log, ["vid"])
        return written(
            joined.select(
                "vid", "_ord",
                dates.combine_date_time("_day", "_time").alias("vtimestamp"),
                "vtype", "pid",
                dates.age_years_exact(F.col("_day").cast("date"), "dob").alias("age"),
                "visitno", "vscore",
                F.lit(S.LOADED_STATUS).alias("vstatus"),
            ),
            "visits",
        )

    @cached_property
    def visit_lookup(self) -> DataFrame:
        keys = ["pid", "vtype", "vtimestamp"]
        return written(identity.alias_key_lookup(self.all_visits, keys, "vid", ["_ord"]), "visit-lookup")

    @cached_property
    def visit(self) -> DataFrame:
        repeats = self.visit_lookup.select(F.col("dup_id").alias("vid"))
        return lookup_join(self.all_visits.drop("_ord"), repeats, ["vid"], "left_anti", unique=True)

    @cached_property
    def scan_enroll(self) -> DataFrame:
        """Scanner ids with their own dense key, still naming the visit."""
        lay = self.layout
        scans = self._source("scan_ids", lay.visit_id)
        ids = self.with_person(scans, [lay.scan_id])
        keyed = identity.dense_surrogate_key(ids, "eid", ["_ord", lay.scan_id])
        return keyed.select(
            "eid", "pid",
            F.lit(lay.scan_type).alias("etype"),
            F.col(lay.scan_id).cast("string").alias("id"),
            dates.parse_mdy_timestamp("VisitDate").cast("date").alias("edate"),
            F.col(lay.visit_id).alias("vid"),
        )


def _build(sources, as_of, build, **options) -> Build:
    return build or Build(sources, as_of, **options)


def build_person(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """One row per person: the first row of each name and birth date."""
    b = _build(sources, as_of, build, **options)
    first = b.people.where(F.col("pid") == F.col("own_pid"))
    return first.select("pid", "fname", "lname", "sex", "hand", "dob")


def build_contact(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """Contact families to (pid, relation, who, ctype, cvalue), cleaned, each once."""
    b = _build(sources, as_of, build, **options)
    wide = project.select_columns_matching(b.people, "Contact.*", keep=["pid"])
    fam = reshape.ungroup_column_families(wide, "^Contact[0-9]", "relation", ["pid"])
    name_parts = ["FirstName", "LastName"]
    address_parts = ["Address1", "Address2", "City", "State", "ZipCode"]
    absent = [c for c in name_parts + address_parts if c not in fam.columns]
    fam = fam.withColumns({c: F.lit(None).cast("string") for c in absent})
    joined = fam.withColumns(
        {"who": text.concat_fields(name_parts), "Address": text.concat_fields(address_parts)}
    ).drop(*name_parts, *address_parts)
    long = reshape.unpivot_values(joined, ["pid", "relation", "who"], "ctype", "cvalue")
    cleaned = long.withColumn("cvalue", text.digits_only_if(text.clean_joined_text("cvalue"), "ctype"))
    return identity.keep_first_all_columns(project.filter_blank_values(cleaned, "cvalue"))


def build_visit(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    return _build(sources, as_of, build, **options).visit


def build_visit_study(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """(vid, study, cohort). The cohort joins the wide row, before its flags fan out."""
    b = _build(sources, as_of, build, **options)
    lay = b.layout
    disorders = b.sources[lay.disorders].select(
        "DisorderID", F.replace("Disorder", F.lit("None"), F.lit("")).alias("Disorder")
    )
    log = b.visit_log.select(F.col(lay.visit_id).alias("vid"), "DisorderID", "Control")
    cohort = left_join_lookup(log, disorders, ["DisorderID"], spread_by=["vid"]).select(
        "vid", text.build_cohort_label("Disorder", "Control").alias("cohort")
    )
    flags = project.exclude_keys(b.sources[lay.visit_studies], lay.visit_id, lay.bad_visits)
    wide = flags.withColumnRenamed(lay.visit_id, "vid").drop("VisitDate", lay.person_id, SRC_ORD)
    both = wide.join(cohort, "vid", "left")  # one row per visit on both sides
    long = reshape.unpivot_dynamic_flags(both, ["vid", "cohort"], [], "study").select("vid", "study", "cohort")
    return identity.remap_keys(long, b.visit_lookup, "vid", distinct=True)


def build_visit_task(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """(vid, measures, task) over all task tables."""
    b = _build(sources, as_of, build, **options)
    lay = b.layout
    drop = [lay.person_id, "VisitDate", SRC_ORD]
    return jsonpack.pack_all_tables(lay.task_tables(b.sources), lay.visit_id, drop, b.visit_lookup, faithful=b.faithful)


def build_enroll(sources, as_of: str, build: Build | None = None, all_ids: bool = False, **options) -> DataFrame:
    """Scanner ids, then one primary id per person dated by the first visit.

    ``all_ids`` keeps every id of a merged person instead of the first.
    """
    b = _build(sources, as_of, build, **options)
    scans = b.scan_enroll
    own = b.people.where(F.col("origin") == "subj")
    if not all_ids:
        own = own.where(F.col("pid") == F.col("own_pid"))
    first_visit = b.visit.where(F.col("pid").isNotNull()).groupBy("pid").agg(F.min("vtimestamp").alias("edate"))
    primary = own.select("pid", "own_pid", F.col("ID").cast("string").alias("id")).join(first_visit, "pid", "left")
    keyed = identity.offset_surrogate_key(primary, "eid", ["pid", "own_pid"], scans)
    primary = keyed.select(
        "eid", "pid", F.lit(b.layout.primary_type).alias("etype"), "id", F.col("edate").cast("date").alias("edate")
    )
    return reshape.union_by_name(scans.drop("vid"), primary)


def build_visit_enroll(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """(eid, vid); enrolment keys are unique, so remapping leaves no equal rows."""
    b = _build(sources, as_of, build, **options)
    return identity.remap_keys(b.scan_enroll.select("eid", "vid"), b.visit_lookup, "vid", spread_by=["eid"])


def build_note(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """Person notes, then visit notes, numbered after empty ones are dropped."""
    b = _build(sources, as_of, build, **options)
    lay = b.layout
    nothing = {"vid": F.lit(None).cast("long"), "ndate": F.lit(None).cast("timestamp_ntz"), "_rank": F.lit(0)}
    if b.faithful:
        subj = b._source("subjects", lay.person_id)
        own = b.with_person(subj, ["_ord"])
    else:  # subject rows already carry their person
        own = b.people.where(F.col("origin") == "subj")
    own = own.withColumns(nothing).select("pid", "vid", "ndate", "Dropped", "Notes", "_rank", "_ord")

    log = b.visit_log.select(F.col(lay.visit_id).alias("vid"), "Dropped", "Notes", "_ord")
    merged = identity.remap_keys(log, b.visit_lookup, "vid", spread_by=["_ord"]).groupBy("vid", "Dropped", "Notes").agg(
        F.min("_ord").alias("_ord")
    )
    known = b.visit.select("vid", "pid", F.col("vtimestamp").alias("ndate"))
    visits = lookup_join(merged, known, ["vid"], "left", spread_by=["_ord"])
    visits = project.tag_source(visits, _rank=1)

    both = reshape.union_by_name(own, visits.select(*own.columns))
    told = project.filter_three_valued(both)
    keyed = identity.dense_surrogate_key(told, "nid", ["_rank", "_ord", "pid"])
    code = codes.classify_drop("Dropped", "vid", S.SUBJECT_DROP, S.VISIT_DROP)
    return keyed.select("nid", "pid", "vid", code.alias("dropcode"), "ndate", F.col("Notes").alias("note"))


def build_task(
    sources, as_of: str, build: Build | None = None, visit_task: DataFrame | None = None, **options
) -> DataFrame:
    """(task, modes, measures), with tasks that only occur in visits added empty."""
    b = _build(sources, as_of, build, **options)
    lay = b.layout
    tables = lay.task_tables(b.sources)
    listed = b.sources[lay.tasks].withColumnRenamed("Task", "task")
    marks = reshape.unpivot_flags(listed, ["task"], S.TASK_MODES, "mode", order="_pos")
    modes = aggs.collect_json_array(marks, ["task"], "mode", "_pos", "modes")
    catalogue = jsonpack.measure_catalogue(tables, f"{lay.visit_id}|{lay.person_id}|VisitDate|{SRC_ORD}")
    known = left_join_lookup(modes, catalogue, ["task"]).select("task", "modes", "measures")
    if visit_task is None:
        visit_task = jsonpack.pack_all_tables(tables, lay.visit_id, [lay.person_id, "VisitDate", SRC_ORD])
    seen = aggs.tally_groups(visit_task, ["task"]).select("task")
    missing = anti_join_missing(seen, known, ["task"])
    return reshape.union_by_name(known, project.tag_source(missing, modes="[]", measures="[]"))


def build_study_task(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    b = _build(sources, as_of, build, **options)
    listed = b.sources[b.layout.tasks].withColumnRenamed("Task", "task")
    return reshape.unpivot_flags(listed, ["task"], S.STUDY_FLAGS, "study").select("study", "task")


def build_study(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """Studies of any task and the fixed ones, each once; the grant is named like the study."""
    used = build_study_task(sources, as_of, build, **options)
    studies = aggs.distinct_values(used, "study", S.FIXED_STUDIES)
    return studies.withColumn("grantname", F.col("study"))


def build_visit_action(sources, as_of: str, build: Build | None = None, **options) -> DataFrame:
    """Scheduling rows, then check-in rows, numbered in that order; accounts without domain.

    The key is unique, so remapping leaves no equal rows.
    """
    b = _build(sources, as_of, build, **options)
    log = b.visit_log.select(
        F.col(b.layout.visit_id).alias("vid"), "_ord",
        F.col("ScheduledBy").alias("sched"),
        text.default_when_all_blank(["ScheduledBy", "CheckedInBy"], "CheckedInBy", S.NO_STAFF).alias("checkedin"),
    )
    rows = reshape.unpivot_actions(log, ["vid", "_ord"], ["sched", "checkedin"])
    keyed = identity.dense_surrogate_key(rows, "aid", ["_col_ord", "_ord"])
    named = keyed.select("aid", "vid", "action", text.strip_domain_prefix("value").alias("ra"))
    return identity.remap_keys(named, b.visit_lookup, "vid", spread_by=["aid"])


def build_all(sources, as_of: str, **options) -> dict[str, DataFrame]:
    """All twelve tables, sharing people, visits and lookups; parents before children."""
    b = Build(sources, as_of, **options)
    visit_task = written(build_visit_task(sources, as_of, b), "visit-task")
    tables = {
        "person": build_person(sources, as_of, b),
        "visit": build_visit(sources, as_of, b),
        "study": build_study(sources, as_of, b),
        "task": build_task(sources, as_of, b, visit_task),
        "contact": build_contact(sources, as_of, b),
        "visit_study": build_visit_study(sources, as_of, b),
        "visit_task": visit_task,
        "enroll": build_enroll(sources, as_of, b),
        "visit_enroll": build_visit_enroll(sources, as_of, b),
        "note": build_note(sources, as_of, b),
        "study_task": build_study_task(sources, as_of, b),
        "visit_action": build_visit_action(sources, as_of, b),
    }
    return {name: tables[name] for name in S.BUILT}
