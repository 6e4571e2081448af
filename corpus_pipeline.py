"""A corpus pipeline over ``documents``: quality rules, line dedup, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage works on all rows that the one before it kept. :func:`run` writes each result as Parquet to the shared folder
and reads it as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import line_dedup, minhash, packing, pii, quality
from cohortspark.session import written


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, ``n_chars`` after what the stage made of the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns) if "n_chars" in columns else docs.select(*columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or blank text has under ten words and goes. A null or unlisted language is compared with all such texts; long texts are
    judged whole, and repeated rows alike. An empty table gives no rows.
    """
    return quality.quality_rules(docs).filter("kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs are deleted; a document of which no line is left goes.

    Null and empty texts have nothing to lose and stay. Repeated rows are one document and lose the same words, so both stay. A
    null number comes first. An empty table gives no rows.
    """
    out = line_dedup.line_dedup(docs).filter("n_removed = 0 OR n_removed < n_lines")
    return _sized(out, docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the one with the least number (a null number comes last).

    Numbers may be null or repeat, so rows are told apart by a key of their own. Null and empty texts are like no other and stay; of
    repeated rows one stays. Texts are compared whole, whatever their length. An empty table gives no rows; all columns come out as they were.
    """
    keyed = written(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "near-rows")
    found = minhash.near_duplicates(keyed.select("row", "doc.doc_id", "doc.text"), id_col="row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    stays = found.groupBy("component_id").agg(least.alias("least")).select("least.row")
    return keyed.join(stays, "row", "left_semi").select("doc.*")


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind.

    Null texts stay null, empty ones empty; long texts are searched whole, repeated rows alike. No row goes; an empty table gives none.
    """
    return _sized(pii.redact_pii(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts with their places in sequences of at most 1024 tokens.

    A null or empty text is one piece of the end token. Long texts are cut, repeated rows each packed. An empty table gives no pieces.
    """
    settings = packing.Settings(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs.select("doc_id", "text"), settings)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_stage),
    ("personal_data", private_stage),
    ("packing", packing_stage),
]

#: Distances and token ids are beyond SQL; tests compare the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
