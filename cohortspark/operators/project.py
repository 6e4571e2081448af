"""Projections, constant columns and row filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import _col
from ..functions.text import is_blank_value


def project_rename(df: DataFrame, mapping: Mapping[str, str], drop: Sequence[str] = (), rest: bool = False) -> DataFrame:
    """Select ``{new: old}``; with ``rest`` keep the other columns too, but for ``drop``."""
    out = [F.col(f"`{old}`").alias(new) for new, old in mapping.items()]
    if rest:
        used = {*mapping.values(), *drop}
        out += [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*out)


def select_columns_matching(
    df: DataFrame, regex: str, invert: bool = False, keep: Sequence[str] = (), case_sensitive: bool = False
) -> DataFrame:
    """Columns whose name matches (or, inverted, does not match) a regex, after those in ``keep``."""
    rx = re.compile(regex, 0 if case_sensitive else re.IGNORECASE)
    names = [c for c in df.columns if c not in keep and bool(rx.search(c)) != invert]
    return df.select(*[F.col(f"`{c}`") for c in [*keep, *names]])


def tag_source(df: DataFrame, **values) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def cast_all_to_string(df: DataFrame, back: Mapping[str, str] | None = None) -> DataFrame:
    """Every column as text, then those in ``back`` parsed to a type (bad text gives null)."""
    back = back or {}
    out = []
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        out.append((text.try_cast(back[c]) if c in back else text).alias(c))
    return df.select(*out)


def filter_nonblank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where all ``cols`` are non-empty; missing drops too."""
    for c in cols:
        df = df.where(F.col(c) != "")
    return df


def filter_three_valued(df: DataFrame, text: str = "Notes", flag: str = "Dropped") -> DataFrame:
    """Rows with text or a set flag; rows where neither is known are dropped."""
    return df.where((F.col(text) != "") | (F.col(flag) != 0))


def filter_blank_values(df: DataFrame, col: Column | str) -> DataFrame:
    return df.where(~is_blank_value(_col(col)))


def exclude_keys(df: DataFrame, key: str, bad_keys: Sequence) -> DataFrame:
    """Drop known-bad keys, given as a short list; rows without a key drop too."""
    return df.where(~F.col(key).isin(list(bad_keys))) if bad_keys else df
