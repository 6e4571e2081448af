"""Recoding expressions: bins, label maps, ordered enums, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import _col

# Code tables for sex (right-closed bins) and handedness.
SEX_BREAKS = (-1, 0, 1, 2)
SEX_LABELS = ("U", "M", "F")
HAND_LABELS = {-1: "U", 1: "R", 2: "L", 3: "A"}


def _cases(pairs: Sequence[tuple[Column, Column]]) -> Column:
    first, *rest = pairs
    return reduce(lambda acc, p: acc.when(*p), rest, F.when(*first))


def bin_code(col: Column | str, breaks: Sequence[float] = SEX_BREAKS, labels: Sequence[str] = SEX_LABELS) -> Column:
    """Label of the right-closed bin ``(breaks[i], breaks[i+1]]`` holding the value, else null."""
    c = _col(col)
    return _cases([((c > lo) & (c <= hi), F.lit(lab)) for lo, hi, lab in zip(breaks, breaks[1:], labels)])


def map_code_labels(col: Column | str, mapping: Mapping = HAND_LABELS) -> Column:
    """Label by code value; an unknown code gives null."""
    c = _col(col)
    return _cases([(c == code, F.lit(label)) for code, label in mapping.items()])


def enum_rank(col: Column | str, levels: Sequence[str]) -> Column:
    """1-based position in an ordered enum; null for null or unknown labels."""
    return F.nullif(F.array_position(F.array(*map(F.lit, levels)), _col(col)), F.lit(0)).cast("int")


def enum_label(rank: Column | str, levels: Sequence[str]) -> Column:
    return F.get(F.array(*map(F.lit, levels)), _col(rank) - 1)


def classify_drop(dropped: Column | str, vid: Column | str, subject_code: str, visit_code: str) -> Column:
    """Drop code: none when not dropped (or unknown), by whether the row names a visit otherwise."""
    code = F.when(_col(vid).isNull(), F.lit(subject_code)).otherwise(F.lit(visit_code))
    return F.when(_col(dropped) != 0, code)


def text_null_to_int(col: Column | str) -> Column:
    return F.nullif(_col(col), F.lit("null")).try_cast("int")


def patch_coalesce(new: str, old: str, cols: Sequence[str]) -> list[Column]:
    """For each column the value of frame alias ``new`` if given, else that of ``old``."""
    return [F.coalesce(F.col(f"{new}.{c}"), F.col(f"{old}.{c}")).alias(c) for c in cols]


def in_list(col: Column | str, values: Sequence) -> Column:
    """Literal membership; null stays unknown."""
    return _col(col).isin(list(values))


def not_in_list(col: Column | str, values: Sequence) -> Column:
    return ~_col(col).isin(list(values))
