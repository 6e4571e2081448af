"""Sharding by jump consistent hashing: a key and the number of shards decide, there is no table of shards.

The hash draws one number after another from the key; each draw names the next count of shards at which the key
would jump to the newest one, and the last jump below the present count is the key's shard. When a shard is
appended, a key therefore stays or goes to the new shard, and one in ``shards + 1`` goes. Everything is a DataFrame
expression: a 64-bit product modulo 2**64 is put together from parts that no bigint operation overflows on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..session import written

# The multiplier of the published jump hash, and its halves.
MULTIPLIER = 2862933555777941757
HIGH, LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
LOW_32 = 0xFFFFFFFF
LAW = "key"


def _and(c: Column, mask: int) -> Column:
    return c.bitwiseAND(F.lit(mask))


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """``key * MULTIPLIER + 1`` modulo 2**64, for a key given as two halves of 32 bits."""
    upper, lower = F.shiftright(lo, 16) * F.lit(LOW), _and(lo, 0xFFFF) * F.lit(LOW) + F.lit(1)
    middle = F.shiftleft(_and(upper, 0xFFFF), 16) + lower
    crossed = hi * F.lit(LOW & 0xFFFF) + F.shiftleft(_and(hi * F.lit(LOW >> 16), 0xFFFF), 16)
    high = F.shiftright(upper, 16) + F.shiftright(middle, 32) + _and(lo * F.lit(HIGH), LOW_32) + _and(crossed, LOW_32)
    return _and(high, LOW_32), _and(middle, LOW_32)


def jump(key: Column, shards: int) -> Column:
    """The shard, from 0, of a bigint ``key``; a null key goes where 0 goes.

    Jumps grow, so ``shards`` draws are always enough; after the last needed one nothing is drawn any more.
    """
    if shards < 1:
        raise ValueError(f"{shards} shards")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    none = F.lit(0).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), _and(key, LOW_32).alias("lo"), none.alias("at"), none.alias("to"))

    def draw(s: Column, _: Column) -> Column:
        hi, lo = _next(s["hi"], s["lo"])
        to = F.floor((s["to"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["to"].alias("at"), to.alias("to"))
        return F.when(s["to"] >= shards, s).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, draw, lambda s: s["at"].cast("int"))


def key_of(df: DataFrame, key: str) -> Column:
    """The bigint that stands for a key: a whole number itself, anything else its hash."""
    whole = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.col(f"`{key}`").cast("long") if whole else F.xxhash64(F.col(f"`{key}`"))


def moved(df: DataFrame, key: str, shards: int, grown: int) -> DataFrame:
    """The rows that change their shard when there are ``grown`` instead of ``shards``: only these need be copied.

    All of them move to shards from ``shards`` on. The new column ``grown_shard`` replaces an input column of that name.
    """
    if grown < shards:
        raise ValueError("shards are appended, not taken away")
    new = df.withColumn("grown_shard", jump(key_of(df, key), grown))
    return new.filter(F.col("grown_shard") >= shards)


def shard_documents(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    ``size`` is the text's bytes in UTF-8 plus 16, ``text_crc32`` its unsigned checksum (null: as for an empty text),
    ``shard`` is the key's among ``shards``, ``grown_shard`` its among one more. ``slot`` numbers the rows of a shard
    from 0 without a gap, in the order of key (null first), checksum and size; equal rows take any order.

    Rows with one key share a shard, however many they are, but no task holds them together: texts are read once,
    and what is numbered are narrow rows, cut into ranges by shard, key and a number of each row's own. An empty
    table gives no rows; other input columns are left out, whatever their names.
    """
    value, id_ = F.coalesce(F.encode(F.col(f"`{text}`").cast("string"), "UTF-8"), F.lit(b"")), F.col(f"`{key}`")
    narrow = df.select(
        id_.alias("id"), (F.octet_length(value) + 16).cast("long").alias("size"), F.crc32(value).alias("text_crc32"),
        jump(key_of(df, key), shards).alias("shard"), jump(key_of(df, key), shards + 1).alias("grown_shard"))
    rows = written(narrow.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    order = [F.col(c).asc_nulls_first() for c in ("shard", "id", "text_crc32", "size", "row")]
    place = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place)
    ranged = written(ranged.withColumn("part", F.shiftright("place", 33)).drop("row"), "shard-ranges")
    # A range holds neighbouring shards, so there are at most (ranges + shards) rows here.
    counts = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("shard", "part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    out = ranged.join(F.broadcast(starts), ["shard", "part"])
    return out.select(
        F.col("id").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("before") + F.col("place") - F.col("first")).alias("slot"), "grown_shard")


def write_shards(df: DataFrame, folder: str, shards: int, key: str = "doc_id", files: int = 1) -> None:
    """Write every row to the folder ``shard=<number>`` of its shard, each shard in about ``files`` files.

    A shard's rows are dealt to its files by their place in the input, so rows of one key, or equal rows, spread over
    them. The input must not have a column named ``shard``.
    """
    if "shard" in df.columns:
        raise ValueError("the input has a column named shard")
    deal = F.monotonically_increasing_id() % files
    placed = df.select("*", jump(key_of(df, key), shards).alias("shard"), deal.alias(f"{folder}/deal"))
    placed.repartition(shards * files, F.col("shard"), F.col(f"`{folder}/deal`")).drop(f"{folder}/deal").write.partitionBy("shard").parquet(folder)
