"""Text cleaning and extraction expressions.

The patterns are fixed values: what they match defines the results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import _col

# Patterns.
VISIT_NUMBER = r"(^| )x[0-9]+"
SCORE = r"([^0-9-]|^)[0-5](\.[0-9])?(/5)?$|[0-5](\.[0-9])?/5"
NA_WORD = r"(^| )NA( |$)"
BLANK_VALUE = r"^[-() ,]*$"
DEFAULT_STATE = "PA"


def extract_visit_number(col: Column | str) -> Column:
    """The number of an ``x12`` mark at the start of the text or after a space."""
    mark = F.regexp_substr(_col(col), F.lit(VISIT_NUMBER))
    return F.trim(F.replace(mark, F.lit("x"), F.lit(""))).try_cast("int")


def extract_score(col: Column | str) -> Column:
    """A 0-5 score ending the text, or written ``n/5``; a mark glued to a letter gives null."""
    mark = F.regexp_substr(_col(col), F.lit(SCORE))
    return F.trim(F.replace(mark, F.lit("/5"), F.lit(""))).try_cast("decimal(3,2)")


def concat_fields(cols: Sequence[Column | str], sep: str = " ") -> Column:
    """Join fields; a missing one shows as the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c), F.lit("NA")) for c in cols])


def clean_joined_text(col: Column | str, faithful: bool = True, default_state: str = DEFAULT_STATE) -> Column:
    """Drop ``NA`` words, squeeze spaces, blank a value that is only the default state.

    ``faithful`` removes alternate words of a run of ``NA`` (each match uses up the space the
    next would need) and keeps outer spaces; otherwise every ``NA`` goes and the ends are trimmed.
    """
    c = _col(col)
    if faithful:
        c = F.regexp_replace(c, NA_WORD, " ")
    else:
        c = F.trim(F.regexp_replace(c, r"(^| )NA(?= |$)", ""))
    return F.regexp_replace(F.regexp_replace(c, " +", " "), f"^ ?{default_state} ?$", "")


def digits_only_if(value: Column | str, type_name: Column | str, marker: str = "Phone") -> Column:
    """Keep only digits when the type name contains ``marker``."""
    v = _col(value)
    return F.when(_col(type_name).contains(marker), F.regexp_replace(v, "[^0-9]", "")).otherwise(v)


def is_blank_value(col: Column | str) -> Column:
    """Null, empty, or nothing but ``- ( ) ,`` and spaces."""
    return F.coalesce(_col(col).rlike(BLANK_VALUE), F.lit(True))


def build_cohort_label(disorder: Column | str, is_control: Column | str) -> Column:
    """Disorder plus a ``_control`` mark; nothing at all means ``control``."""
    ctl = _col(is_control)
    mark = F.when(ctl.isNull(), F.lit("NA")).when(ctl == 1, F.lit("control")).otherwise(F.lit(""))
    label = F.concat_ws("_", F.coalesce(_col(disorder), F.lit("NA")), mark)
    label = F.regexp_replace(label, "^_|_$", "")
    label = F.replace(label, F.lit("control_control"), F.lit("control"))
    return F.when(label == "", F.lit("control")).otherwise(label)


def strip_domain_prefix(col: Column | str) -> Column:
    """Text after the last backslash."""
    return F.regexp_replace(_col(col), r".*\\", "")


def strip_table_prefix(name: Column | str, prefix: str = "d") -> Column:
    return F.regexp_replace(_col(name), f"^{prefix}", "")


def default_when_all_blank(cols: Sequence[Column | str], target: Column | str, default: str) -> Column:
    """``default`` when all of ``cols`` are blank, else ``target``."""
    joined = F.concat(*[F.coalesce(_col(c), F.lit("")) for c in cols])
    return F.when(joined == "", F.lit(default)).otherwise(_col(target))


def full_name(first: Column | str, last: Column | str) -> Column:
    """First, space, last; a missing part is empty."""
    blank = F.lit("")
    return F.concat(F.coalesce(_col(first), blank), F.lit(" "), F.coalesce(_col(last), blank))
