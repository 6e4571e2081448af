"""Target schema: columns, keys, references and domains.

The enum labels and drop codes below are fixed values: results depend on them literally.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Enum labels in rank order.
STATUS = ["sched", "resched", "assigned", "complete", "checkedin", "cancelled", "noshow", "unknown", "other"]
DROP_LEVELS = ["nodrop", "future", "sometasks", "visit", "somevisits", "mostvisits", "subject", "family"]
CONTACT_STATUS = ["update_info", "bad_info", "realtime", "sent_waiting", "replied"]

# Drop codes with their level.
DROP_CODES = [
    ("OLDDBDSUBJ", "subject"),
    ("OLDDBDVIST", "visit"),
    ("IMPORTANT", "nodrop"),
    ("NOT", "nodrop"),
    ("NOINTEREST", "future"),
    ("SUPPLEMENT", "future"),
    ("HARD_SUBJ", "future"),
    ("TASK_ISSUE", "sometasks"),
    ("TECH_ISSUE", "visit"),
    ("EYE_ISSUE", "visit"),
    ("SUBJ_ISSUE", "visit"),
    ("CLAUSTROPHOBIC", "somevisits"),
    ("BAD_VEIN", "somevisits"),
    ("LOWIQ", "subject"),
    ("EXCLDCRTRA", "subject"),
    ("DEPRESSED", "family"),
    ("MRI_UNCOMFY", "somevisits"),
    ("INATTENTIVE", "subject"),
    ("PSYCH_CLINICAL", "subject"),
    ("METAL", "somevisits"),
    ("MOVER", "somevisits"),
    ("BADSUBJ", "subject"),
    ("NO_ADULT", "somevisits"),
]

# Staff rows are site data; these seven are invented.
STAFF = [
    ("staff01", "AA"),
    ("staff02", "BB"),
    ("staff03", "CC"),
    ("staff04", "DD"),
    ("staff05", "EE"),
    ("staff06", "FF"),
    ("staff07", "GG"),
]

# Task flag columns, study flag columns, studies that always exist.
TASK_MODES = ["Behavioral", "Scan", "MEG", "Questionnaire"]
VISIT_TYPES = ["Behavioral", "MEG", "Scan"]
STUDY_FLAGS = ["Cannabis", "MEGEmo", "CogR01", "RewardR01", "EBS", "PVL", "SlotReward", "RingReward"]
FIXED_STUDIES = ["SlotReward", "RingReward", "RewardR21"]

# Defaults written for history that lacks them.
SUBJECT_DROP = "OLDDBDSUBJ"
VISIT_DROP = "OLDDBDVIST"
NO_STAFF = "OLDDB"
LOADED_STATUS = "checkedin"


@dataclass(frozen=True)
class Table:
    """What the target declares about one table; ``columns`` is a Spark DDL string."""

    columns: str
    pk: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    refs: dict[str, tuple[str, str]] = field(default_factory=dict)
    enums: dict[str, list[str]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    numerics: dict[str, tuple[int, int]] = field(default_factory=dict)


TABLES: dict[str, Table] = {
    "person": Table(
        "pid long, fname string, lname string, dob date, sex string, hand string,"
        " nick string, adddate date, source string",
        pk=("pid",),
        unique=(("fname", "lname", "dob"),),
        not_null=("fname", "lname", "dob", "sex", "hand"),
        lengths={"fname": 50, "lname": 50, "sex": 1, "hand": 1, "nick": 50, "source": 50},
    ),
    "person_score": Table(
        "pid long, ra string, stimestamp timestamp_ntz, pscore double",
        not_null=("pid",),
        refs={"pid": ("person", "pid")},
        lengths={"ra": 50},
    ),
    "contact": Table(
        "cid long, pid long, ctype string, cvalue string, relation string, who string, added timestamp_ntz",
        pk=("cid",),
        unique=(("who", "ctype", "cvalue", "relation", "pid"),),
        not_null=("ctype", "cvalue"),
        refs={"pid": ("person", "pid")},
        lengths={"ctype": 50, "cvalue": 200, "relation": 50, "who": 50},
    ),
    "enroll": Table(
        "eid long, pid long, etype string, id string, edate date",
        pk=("eid",),
        unique=(("etype", "id"),),
        not_null=("pid", "etype", "id"),
        refs={"pid": ("person", "pid")},
        lengths={"etype": 50, "id": 20},
    ),
    "screener": Table(
        "pid long, stimestamp timestamp_ntz, measures string",
        not_null=("pid",),
        refs={"pid": ("person", "pid")},
    ),
    "family": Table(
        "pidy long, pido long, gendist int, nucdist int, fdesc string",
        not_null=("pidy", "pido", "gendist", "nucdist"),
        refs={"pidy": ("person", "pid"), "pido": ("person", "pid")},
        lengths={"fdesc": 50},
    ),
    "visit": Table(
        "vid long, pid long, vtype string, vscore decimal(3,2), dur_hr double, age double,"
        " vtimestamp timestamp_ntz, visitno int, googleuri string, vstatus string",
        pk=("vid",),
        unique=(("pid", "vtimestamp", "vtype"),),
        not_null=("pid", "vtype"),
        refs={"pid": ("person", "pid")},
        enums={"vstatus": STATUS},
        lengths={"vtype": 20, "googleuri": 255},
        numerics={"vscore": (3, 2)},
    ),
    "task": Table(
        "task string, tdesc string, measures string, files string, settings string, modes string",
        pk=("task",),
        lengths={"task": 50},
    ),
    "study": Table(
        "study string, grantname string, cohorts string, visit_types string",
        pk=("study",),
        lengths={"study": 50, "grantname": 50},
    ),
    "visit_action": Table(
        "aid long, vid long, action string, ra string, vatimestamp timestamp_ntz",
        pk=("aid",),
        not_null=("vid", "action", "ra"),
        refs={"vid": ("visit", "vid")},
        enums={"action": STATUS},
        lengths={"ra": 50},
    ),
    "visit_study": Table(
        "vid long, study string, cohort string",
        unique=(("vid", "study"),),
        not_null=("vid", "study", "cohort"),
        refs={"vid": ("visit", "vid"), "study": ("study", "study")},
        lengths={"study": 50, "cohort": 50},
    ),
    "visit_task": Table(
        "vtid long, vid long, task string, measures string, files string",
        pk=("vtid",),
        unique=(("vid", "task"),),
        not_null=("vid", "task"),
        refs={"vid": ("visit", "vid"), "task": ("task", "task")},
        lengths={"task": 50},
    ),
    "vt_analysed": Table(
        "vtid long, name string, data string",
        not_null=("vtid", "name", "data"),
        refs={"vtid": ("visit_task", "vtid")},
        lengths={"name": 50},
    ),
    "visit_old": Table(
        "vid long, ovid int",
        not_null=("vid", "ovid"),
        refs={"vid": ("visit", "vid")},
    ),
    "study_task": Table(
        "study string, task string",
        unique=(("study", "task"),),
        refs={"study": ("study", "study"), "task": ("task", "task")},
        lengths={"study": 50, "task": 50},
    ),
    "diag": Table(
        "pid long, diag string, onset timestamp_ntz, better timestamp_ntz, known timestamp_ntz, isrx boolean",
        not_null=("pid", "diag"),
        refs={"pid": ("person", "pid")},
        lengths={"diag": 50},
    ),
    "dropcode": Table(
        "dropcode string, droplevel string",
        pk=("dropcode",),
        not_null=("droplevel",),
        enums={"droplevel": DROP_LEVELS},
        lengths={"dropcode": 15},
    ),
    "note": Table(
        "nid long, pid long, vid long, dropcode string, ra string, ndate timestamp_ntz, note string",
        pk=("nid",),
        not_null=("pid", "note"),
        refs={"pid": ("person", "pid"), "vid": ("visit", "vid"), "dropcode": ("dropcode", "dropcode")},
        lengths={"dropcode": 15, "ra": 50},
    ),
    "contact_note": Table(
        "cnid long, cid long, cstatus string, ctimestamp timestamp_ntz, detail string",
        pk=("cnid",),
        not_null=("cid",),
        refs={"cid": ("contact", "cid")},
        enums={"cstatus": CONTACT_STATUS},
    ),
    "visit_enroll": Table(
        "eid long, vid long",
        not_null=("eid", "vid"),
        refs={"eid": ("enroll", "eid"), "vid": ("visit", "vid")},
    ),
    "ra": Table(
        "ra string, orgid string, abbr string, start_date timestamp_ntz, end_date timestamp_ntz,"
        " bday timestamp_ntz, studies string",
        not_null=("ra",),
        lengths={"ra": 50, "orgid": 50, "abbr": 4},
    ),
}

# The twelve tables a full build produces, parents before children.
BUILT = [
    "person", "visit", "study", "task", "contact", "visit_study",
    "visit_task", "enroll", "visit_enroll", "note", "study_task", "visit_action",
]
