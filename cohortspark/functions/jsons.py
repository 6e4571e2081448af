"""JSON expressions. JSON is computed as structs and arrays and kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import _col

KEEP_NULLS = {"ignoreNullFields": "false"}


def json_text(col: Column | str) -> Column:
    """JSON text that keeps null fields and elements."""
    return F.to_json(_col(col), KEEP_NULLS)


def struct_to_json(*cols: Column | str) -> Column:
    return json_text(F.struct(*cols))


def json_array_items(col: Column | str) -> Column:
    """The elements of a JSON array of text, unquoted, as an array column."""
    return F.from_json(_col(col), "array<string>")


def json_element(col: Column | str, i: int, as_text: bool = False) -> Column:
    """Element ``i`` of a JSON array: as text (null for JSON null) or as JSON.

    As JSON, a JSON null stays the text ``null`` while a missing element is null.
    """
    doc, path = F.try_parse_json(_col(col)), f"$[{i}]"
    item = F.try_variant_get(doc, path, "variant")
    as_json = F.when(item.isNotNull(), F.to_json(item))
    if not as_text:
        return as_json
    return F.coalesce(F.try_variant_get(doc, path, "string"), F.when(~F.is_variant_null(item), as_json))


def json_contains(col: Column | str, **fields: str) -> Column:
    """Whether a JSON array holds an object having all given text fields."""
    shape = "array<struct<" + ",".join(f"`{k}`:string" for k in fields) + ">>"
    items = F.from_json(_col(col), shape)

    def match(item: Column) -> Column:
        hit = F.lit(True)
        for key, value in fields.items():
            hit = hit & item[key].eqNullSafe(F.lit(value))
        return hit

    return F.exists(items, match)
