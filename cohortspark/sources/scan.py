"""Reading source tables, from a folder of files or from the session catalog."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import names_in

SRC_ORD = "_src_ord"


def _table_name(file_name: str, fmt: str) -> str:
    return re.sub(rf"\.{fmt}$", "", file_name)


def scan_table(
    spark: SparkSession,
    base: str | None,
    name: str,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    with_order: bool = False,
    **options: str,
) -> DataFrame:
    """One named table: ``base/name`` or ``base/name.fmt``, or a catalog table when ``base`` is None.

    ``with_order`` adds ``_src_ord``, the place of a row in its files. It depends on file names and
    row positions only, so it is the same however the scan is split or repeated.
    """
    if base is None:
        if with_order or schema is not None:
            raise ValueError("a catalog table has its own schema and no file order")
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    found = [f for f in (f"{name}.{fmt}", name) if f in names_in(spark, base)]
    df = reader.load(f"{base}/{(found or [name])[0]}")
    if not with_order:
        return df
    if fmt == "parquet":
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    else:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    return df.select("*", place.alias(SRC_ORD))


def scan_matching_tables(
    spark: SparkSession, base: str | None, regex: str, fmt: str = "parquet", **options
) -> dict[str, DataFrame]:
    """All tables whose name matches, by name. Only names are listed; rows are read when used."""
    if base is None:
        names = [t.name for t in spark.catalog.listTables()]
    else:
        names = [_table_name(f, fmt) for f in names_in(spark, base) if not f.startswith(("_", "."))]
    return {n: scan_table(spark, base, n, fmt=fmt, **options) for n in sorted(names) if re.search(regex, n)}
