"""The status stream gives what the batch job gives, over several micro-batches and on replay."""

import os

from pyspark.sql import functions as F

from cohortspark.streaming import status


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stream_equals_batch(spark, tmp_path):
    log = spark.range(500).select(
        F.col("id").alias("aid"), (F.col("id") * 7 % 60).alias("vid"),
        F.concat(F.lit("s"), (F.col("id") % 9).cast("string")).alias("action"),
    )
    src, out, mark = (str(tmp_path / n) for n in ("log", "out", "mark"))
    for lo in (0, 200, 400):
        log.where((F.col("aid") >= lo) & (F.col("aid") < lo + 200)).coalesce(1).write.mode("append").parquet(src)
        stream = status.read_action_log(spark, src, log.schema, maxFilesPerTrigger="1")
        status.stream_latest_status(stream, out, mark).awaitTermination()
        seen = log.where(F.col("aid") < lo + 200)
        want = rows(status.latest_status_of(seen).select("vid", "status"))
        assert rows(status.read_latest_status(spark, out)) == want

    # A late row with a lower key changes nothing.
    log.where("aid = 3").withColumn("action", F.lit("late")).coalesce(1).write.mode("append").parquet(src)
    stream = status.read_action_log(spark, src, log.schema)
    status.stream_latest_status(stream, out, mark).awaitTermination()
    assert rows(status.read_latest_status(spark, out)) == want

    # Starting over from the beginning writes the same batches again.
    stream = status.read_action_log(spark, src, log.schema, maxFilesPerTrigger="1")
    status.stream_latest_status(stream, out, str(tmp_path / "again")).awaitTermination()
    assert rows(status.read_latest_status(spark, out)) == want

    assert status.compact_status(spark, out) > 0 and status.compact_status(spark, out) == 0
    assert rows(status.read_latest_status(spark, out)) == want
    assert names(spark, out) == ["compacted=000000000001"]

    # Later batches join the table; batches that were folded and are written again change nothing.
    log.where("aid = 7").withColumns({"aid": F.lit(900).cast("long"), "action": F.lit("new")}).coalesce(1).write.mode("append").parquet(src)
    stream = status.read_action_log(spark, src, log.schema)
    status.stream_latest_status(stream, out, str(tmp_path / "again")).awaitTermination()
    after = rows(status.read_latest_status(spark, out))
    assert after == sorted([r for r in want if r[0] != 49] + [(49, "new")])
    stream = status.read_action_log(spark, src, log.schema, maxFilesPerTrigger="1")
    status.stream_latest_status(stream, out, str(tmp_path / "third"), compact_every=2).awaitTermination()
    assert rows(status.read_latest_status(spark, out)) == after
    assert sum(n.startswith("compacted=") for n in names(spark, out)) == 1

    # A compaction that broke off leaves an incomplete table, which nobody reads.
    spark.createDataFrame([(49, 10_000, "broken")], status.STATUS_ROW).write.parquet(f"{out}/compacted=000000000099")
    os.remove(f"{out}/compacted=000000000099/_SUCCESS")
    assert rows(status.read_latest_status(spark, out)) == after
    assert rows(status.read_latest_status(spark, str(tmp_path / "nothing"))) == []


def test_many_batches_read_as_one_table(spark, tmp_path):
    out = str(tmp_path)
    for k in range(40):
        spark.range(1).select((F.col("id") + k % 7).alias("vid"), F.lit(k).cast("long").alias("aid"), F.lit(f"s{k}").alias("status")).write.parquet(f"{out}/batch={k:012d}")
    want = rows(status.read_latest_status(spark, out))
    assert status.compact_status(spark, out) == 40
    assert rows(status.read_latest_status(spark, out)) == want and names(spark, out) == ["compacted=000000000001"]


def names(spark, folder):
    from cohortspark.sources.files import names_in

    return sorted(names_in(spark, folder))
