"""Chat formatting: find a source's layout by a fingerprint of its field paths, turn it into turns, render and read back.

A layout is a declarative mapping. The fingerprint is a hash of the field paths that a layout needs; the paths
come from the table's schema, or for JSON records from the keys of each record. Of the layouts whose paths are all there, the one that needs
most is taken (the first in the list of several); other fields don't matter. Everything here is DataFrame expressions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<turn:bigint,role:string,text:string>"
START, END = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class Layout:
    """``kind`` is rows (a row is a turn), list (an array of turns) or pairs (a column is a turn)."""

    kind: str
    role: str = ""
    text: str = ""
    turn: str = ""
    items: str = ""
    columns: tuple[tuple[str, str], ...] = ()

    def paths(self) -> tuple[str, ...]:
        if self.kind == "rows":
            return tuple(sorted((self.role, self.text, self.turn)))
        if self.kind == "list":
            return tuple(sorted((self.items, f"{self.items}[].{self.role}", f"{self.items}[].{self.text}")))
        return tuple(sorted({name for _, names in self.columns for name in names.split("+")}))


LAYOUTS = (
    Layout("rows", role="role", text="text", turn="turn"),
    Layout("list", items="messages", role="role", text="content"),
    Layout("list", items="conversations", role="from", text="value"),
    Layout("pairs", columns=(("user", "prompt"), ("assistant", "response"))),
    Layout("pairs", columns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("pairs", columns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("pairs", columns=(("user", "instruction+input"), ("assistant", "output"))),
    Layout("pairs", columns=(("user", "instruction"), ("assistant", "output"))),
    Layout("pairs", columns=(("user", "question"), ("assistant", "answer"))),
)
# Names for roles in other layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _hash(paths: tuple[str, ...]) -> str:
    return hashlib.sha256("|".join(paths).encode()).hexdigest()


BY_FINGERPRINT = {_hash(x.paths()): x for x in LAYOUTS}
KNOWN = tuple(sorted({p for x in LAYOUTS for p in x.paths()}))
#: The layouts that need most fields first.
RANKED = tuple(sorted(LAYOUTS, key=lambda x: -len(x.paths())))
LISTS = tuple(sorted({x.items for x in LAYOUTS if x.items}))


def paths_of(schema: T.StructType, under: str = "") -> list[str]:
    """The path of every field, nested ones included; ``[]`` marks an array's items."""
    out = []
    for f in schema:
        path, kind = under + f.name, f.dataType
        out.append(path)
        while isinstance(kind, T.ArrayType):
            path, kind = path + "[]", kind.elementType
        if isinstance(kind, T.StructType):
            out += paths_of(kind, path + ".")
    return out


def fingerprint(schema: T.StructType) -> str:
    """Hash of the paths of the table's layout; other columns don't change it. Without a layout, of all paths that layouts know."""
    paths = set(paths_of(schema))
    return _hash(next((x.paths() for x in RANKED if paths.issuperset(x.paths())), tuple(sorted(paths & set(KNOWN)))))


def _role(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for other, name in ROLES.items():
        out = F.when(c == other, name).otherwise(out)
    return out


def _pair_turns(columns: tuple[tuple[str, str], ...], get) -> Column:
    """One turn for each column or group of columns that is not null; parts of a group join by a blank line."""
    turns = []
    for k, (role, names) in enumerate(columns):
        parts = [get(n) for n in names.split("+")]
        text = F.concat_ws("\n\n", parts[0], *(F.when(p != "", p) for p in parts[1:]))
        turn = F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), text.alias("text"))
        turns.append(F.when(F.coalesce(*parts).isNotNull(), turn))
    return F.filter(F.array(*turns), lambda x: x.isNotNull()).cast(f"array<{TURN}>")


def _list_turns(items: Column, get_role, get_text) -> Column:
    turn = F.transform(items, lambda x, i: F.struct(
        i.cast("long").alias("turn"), _role(get_role(x)).alias("role"), F.coalesce(get_text(x), F.lit("")).alias("text")))
    return F.coalesce(turn, F.array()).cast(f"array<{TURN}>")


def to_turns(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id`` and ``turns`` (array of turn, role, text) from a table in any known layout.

    Rows of one conversation are ordered by turn, then role, then text (null first); repeated rows stay as
    turns of their own. Null text is empty, null role is empty. A conversation is one row of the result, so
    its turns meet in one place by definition. An unknown layout is an error.
    """
    layout = BY_FINGERPRINT.get(fingerprint(df.schema))
    if layout is None:
        raise ValueError(f"no layout for the fields {sorted(set(paths_of(df.schema)) & set(KNOWN))}")
    if layout.kind == "rows":
        one = F.struct(F.col(layout.turn).cast("long").alias("turn"), F.coalesce(layout.role, F.lit("")).alias("role"),
                       F.coalesce(layout.text, F.lit("")).alias("text"))
        return df.groupBy(conv_id).agg(F.array_sort(F.collect_list(one)).cast(f"array<{TURN}>").alias("turns"))
    if layout.kind == "list":
        turns = _list_turns(F.col(layout.items), lambda x: x[layout.role], lambda x: x[layout.text])
    else:
        turns = _pair_turns(layout.columns, F.col)
    return df.select(conv_id, turns.alias("turns"))


def json_to_turns(df: DataFrame, record: str, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id``, ``fingerprint`` and ``turns`` from JSON records, each in a layout of its own.

    ``turns`` is null for a record that is null, broken or in no known layout. The paths below a list are the keys of all its items.
    """
    fields = F.from_json(record, "map<string,string>")
    found = df.select(conv_id, fields.alias("_f"))
    for k, name in enumerate(LISTS):
        found = found.withColumn(f"_i{k}", F.from_json(F.col("_f")[name], "array<map<string,string>>"))
    paths = [F.coalesce(F.map_keys("_f"), F.array())]
    for k, name in enumerate(LISTS):
        keys = F.array_distinct(F.flatten(F.filter(F.transform(F.col(f"_i{k}"), F.map_keys), lambda x: x.isNotNull())))
        under = F.transform(keys, lambda x: F.concat(F.lit(f"{name}[]."), x))  # noqa: B023
        paths.append(F.coalesce(under, F.array()))
    known = F.array_intersect(F.concat(*paths), F.array(*map(F.lit, KNOWN)))
    found = found.withColumn("_known", known)
    mark = F.sha2(F.array_join(F.array_sort("_known"), "|"), 256)
    for layout in reversed(RANKED):
        whole = F.size(F.array_except(F.array(*map(F.lit, layout.paths())), "_known")) == 0
        mark = F.when(whole & F.lit(layout.kind != "rows"), F.lit(_hash(layout.paths()))).otherwise(mark)
    found = found.withColumn("fingerprint", mark)
    turns = F.lit(None).cast(f"array<{TURN}>")
    for mark, layout in BY_FINGERPRINT.items():
        if layout.kind == "list":
            items = F.col(f"_i{LISTS.index(layout.items)}")
            own = _list_turns(items, lambda x, r=layout.role: x[r], lambda x, t=layout.text: x[t])
        elif layout.kind == "pairs":
            own = _pair_turns(layout.columns, lambda n: F.col("_f")[n])
        else:
            continue
        turns = F.when(F.col("fingerprint") == mark, own).otherwise(turns)
    return found.select(conv_id, "fingerprint", turns.alias("turns"))


def escape(text: Column) -> Column:
    """No ``<|`` is left: a backslash goes between, one more for every one that is there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stays on one line."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(conversations: DataFrame) -> DataFrame:
    """``formatted`` and its loss mask for each row of ``turns``.

    ``segments`` are the consecutive parts of ``formatted``, each with ``loss`` true (an assistant's text) or
    false; their lengths are the mask's runs. A conversation without turns is formatted as an empty string.
    """
    parts = F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))))
    out = conversations.withColumn("segments", F.flatten(parts)).drop("turns")
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text (array of role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p.startswith(START))

    def turn(p: Column) -> Column:
        feed = F.instr(p, "\n")
        role = F.substr(p, F.lit(len(START) + 1), feed - F.lit(len(START) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(p, feed + 1)).alias("text"))

    return F.transform(pieces, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def format_chats(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id``, ``segments`` and ``formatted`` of a table in any known layout."""
    return render(to_turns(df, conv_id))
