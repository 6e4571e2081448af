"""Packing rows and whole table families into JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import _col
from ..functions.jsons import json_array_items, json_text
from .identity import remap_keys
from .reshape import union_fill_missing

_REAL = (T.FloatType, T.DoubleType, T.DecimalType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _measure(field: T.StructField, digits: int | None, faithful: bool) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _REAL) and digits is not None:
        c = F.round(c, digits)
    elif isinstance(field.dataType, _TIME):
        c = c.cast("string")
    elif isinstance(field.dataType, T.StringType) and faithful:
        c = F.nullif(c, F.lit("NA"))
    return c.alias(field.name)


def pack_row_json(
    df: DataFrame,
    keys: Sequence[str],
    out: str = "measures",
    drop: Sequence[str] = (),
    digits: int | None = 4,
    faithful: bool = False,
) -> DataFrame:
    """All columns but keys and ``drop`` of a row as one JSON object; missing becomes ``null``.

    Real numbers are rounded to ``digits``; ``faithful`` also reads the text ``NA`` as missing.
    """
    skip = {*keys, *drop}
    measures = [_measure(f, digits, faithful) for f in df.schema.fields if f.name not in skip]
    packed = json_text(F.struct(*measures)) if measures else F.lit("{}")
    return df.select(*keys, packed.alias(out))


def task_name(table: str, prefix: str = "d") -> str:
    return re.sub(f"^{prefix}", "", table)


def pack_all_tables(
    tables: Mapping[str, DataFrame],
    key: str,
    drop: Sequence[str] = (),
    lookup: DataFrame | None = None,
    out_key: str = "vid",
    **options,
) -> DataFrame:
    """Every task table to (key, measures, task), stacked; repeated keys replaced by ``lookup``."""
    packed = [
        pack_row_json(df, [key], drop=drop, **options)
        .select(F.col(key).alias(out_key), "measures")
        .withColumn("task", F.lit(task_name(name)))
        for name, df in tables.items()
    ]
    stacked = union_fill_missing(packed)
    return stacked if lookup is None else remap_keys(stacked, lookup, out_key, distinct=True)


def measure_catalogue(tables: Mapping[str, DataFrame], drop_regex: str) -> DataFrame:
    """Per task table, the JSON array of its measure columns. Reads schemas only.

    One row per table, so a local frame is bounded by the number of tables.
    """
    rx = re.compile(drop_regex)
    rows = [
        (task_name(n), json.dumps([c for c in df.columns if not rx.search(c)], separators=(",", ":")))
        for n, df in tables.items()
    ]
    return next(iter(tables.values())).sparkSession.createDataFrame(rows, "task string, measures string")


def explode_json_array(df: DataFrame, col: str, out: str, keep: Sequence[Column | str]) -> DataFrame:
    """One row per element of a JSON array of text; null or empty arrays give none."""
    return df.select(*[_col(k) for k in keep], F.explode(json_array_items(col)).alias(out))
