"""Seed dimensions: a fixed, small number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import DROP_CODES, DROP_LEVELS, STAFF


def seed_dimensions(spark: SparkSession, staff=STAFF) -> dict[str, DataFrame]:
    """``dropcode`` (code, level, rank of the level) and ``ra`` (account, initials)."""
    codes = [(code, level, DROP_LEVELS.index(level) + 1) for code, level in DROP_CODES]
    return {
        "dropcode": spark.createDataFrame(codes, "dropcode string, droplevel string, droprank int"),
        "ra": spark.createDataFrame(staff, "ra string, abbr string"),
    }
