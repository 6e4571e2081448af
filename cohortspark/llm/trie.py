"""Prefix trie of conversations as a z-fast trie: compacted nodes in a table, found by a hash of one prefix each.

A compacted node stands for the prefixes of depths (lo, depth] on an edge without a branch or an end between them.
Its handle is the prefix at the two-fattest depth of that interval, the number in it that is divisible by the greatest
power of two. A conversation finds the deepest node that it passes in full by a fat binary search: of the depths still
open it asks for the two-fattest one, and goes on below or above, so the number of look-ups grows with the logarithm
of the number of turns. It leaves the trie on that node's child with its next prefix, somewhere along the child's edge.

Conversations are inserted in batches in the order of a hash, each batch several times as large as all before. Edges are
cut where conversations leave or end. What is new below a place is grouped by the first prefix that is not in the
trie; a prefix that many conversations share is in the trie after the first batches, so those groups stay small.
The first batch has a bounded size; its trie, the crown, is broadcast and answers first, so that common prefixes
are no hot keys of the later look-ups. Last, edges are expanded to a node for each depth.

A prefix is known by a 128-bit hash that its turns are chained into; two prefixes with one hash are taken for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
#: Bytes of decimal numbers that are joined before they are brought together.
CHUNK = 1 << 16


@dataclass(frozen=True)
class Settings:
    """``group``: conversations whose numbers share the same multiple borrow turns of the first one. ``most``: they borrow fewer than so many.

    ``first``: expected conversations of the first batch. ``growth``: how many times all before it a later batch has.
    """

    group: int = 20
    most: int = 4
    first: int = 4096
    growth: int = 8


def conversations(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id`` and ``turns`` (array of digest and words) in the order of turn (null first); equal turns go by their digest.

    Null roles and texts are empty. Rows without a ``conv_id`` belong to no conversation and are left out. Texts are
    digested before they are moved: what meets is 24 bytes a turn.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(told, 256), 1, 32))
    one = F.struct(F.col("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    turns = F.transform(F.array_sort(F.collect_list(one)), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return df.filter(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(turns.alias("turns"))


def rebuilt(stored: DataFrame, settings: Settings) -> DataFrame:
    """Each conversation with its first turns taken from the first one of its group; none if that is absent."""
    base = F.col("conv_id") - F.col("conv_id") % settings.group
    n = (F.crc32(F.col("conv_id").cast("string")) % settings.most).cast("int")
    heads = stored.filter(F.col("conv_id") % settings.group == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, settings.most - 1).alias("head"))
    own = stored.select("conv_id", "turns", base.alias("base"), n.alias("n"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("n")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("n") + 1, F.greatest(F.size("turns") - F.col("n"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def prefixes(convs: DataFrame) -> DataFrame:
    """``conv_id``, ``p`` (hashes of its prefixes from depth 1 on) and ``w`` (words up to there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_p, all_w = [], []
            for turns in batch.column("turns").to_pylist():
                now, words, p, w = ROOT, 0, [], []
                for t in turns:
                    now = hashlib.blake2b(now + t["digest"], digest_size=16).digest()
                    words += t["words"]
                    p.append(now)
                    w.append(words)
                all_p.append(p)
                all_w.append(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(all_p, pa.list_(pa.binary())), pa.array(all_w, pa.list_(pa.int64()))], names=["conv_id", "p", "w"])

    return convs.mapInArrow(run, "conv_id long, p array<binary>, w array<long>")


def fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that is divisible by the greatest power of two, for 0 <= a < b below 2**31.

    It is b without the bits below the highest one in which a and b differ.
    """
    x = a.bitwiseXOR(b)
    for k in (1, 2, 4, 8, 16):
        x = x.bitwiseOR(F.shiftright(x, k))
    return b.bitwiseAND(F.bitwise_not(F.shiftright(x, 1)))


def _at(p: str, depth: Column) -> Column:
    """The prefix at a depth; the root's at 0."""
    return F.when(depth > 0, F.get(F.col(p), depth - 1)).otherwise(F.lit(ROOT))


def _handled(nodes: DataFrame) -> DataFrame:
    """Nodes by their handles."""
    handle = F.get("edge", fattest(F.col("lo"), F.col("depth")) - F.col("lo") - 1)
    return nodes.select(handle.alias("handle"), F.col("lo").alias("parent"), F.col("depth").alias("to"), F.element_at("edge", -1).alias("end"))


def search(rows: DataFrame, nodes: DataFrame, rounds: int, small: bool = False) -> DataFrame:
    """Fat binary search: ``a`` of each row grows to the depth of the deepest node that the row passes in full.

    ``rows`` have ``p``, ``m`` (its size) and ``a``, the depth of such a node. ``small`` nodes are broadcast.
    """
    handled = F.broadcast(_handled(nodes)) if small else _handled(nodes)
    now = rows.withColumn("b", F.col("m"))
    for _ in range(rounds):
        going = F.col("a") < F.col("b")
        # A row that is done asks for its own last prefix, so that it doesn't make a hot key, and ignores the answer.
        f = F.when(going, fattest(F.col("a"), F.col("b"))).otherwise(F.col("m"))
        asked = now.withColumn("f", f).withColumn("handle", _at("p", F.col("f")))
        met = asked.join(handled, "handle", "left")
        passed = F.coalesce((F.col("to") <= F.col("m")) & (_at("p", F.col("to")) == F.col("end")), F.lit(False))
        # A handle that is found on an edge which the row leaves: its parent is the deepest that is passed.
        left = going & ~passed & F.col("to").isNotNull()
        up = F.when(going & passed, F.col("to")).when(left, F.col("parent")).otherwise(F.col("a"))
        down = F.when(~going | passed, F.col("b")).when(left, F.col("parent")).otherwise(F.col("f") - 1)
        now = met.select(*[c for c in rows.columns if c != "a"], up.alias("a"), down.alias("b"))
    return now.drop("b")


def _cut(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows with ``child`` (first prefix of the edge on which they leave; null: at a node) and ``d``, the depth to which they are in the trie."""
    edges = nodes.select(F.get("edge", F.lit(0)).alias("child"), "edge")
    asked = rows.withColumn("child", F.coalesce(_at("p", F.least(F.col("a") + 1, F.col("m"))), F.lit(ROOT)))
    met = asked.join(edges, "child", "left")
    open_ = F.slice("p", F.col("a") + 1, F.greatest(F.col("m") - F.col("a"), F.lit(0)))
    # Prefix hashes differ from the first unlike turn on, so the common part is where both arrays are equal.
    common = F.size(F.filter(F.zip_with(open_, "edge", lambda x, y: x == y), lambda same: F.coalesce(same, F.lit(False))))
    on = F.col("edge").isNotNull() & (F.col("a") < F.col("m"))
    met = met.withColumn("d", F.col("a") + F.when(on, common).otherwise(0))
    return met.withColumn("child", F.when(on, F.col("child"))).withColumn("edge_end", F.col("a") + F.when(on, F.size("edge")).otherwise(0))


def _split(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes cut at the depths inside their edges where rows leave or end: at most one cut for each depth."""
    cuts = rows.filter("child IS NOT NULL AND d < edge_end").select("child", "d").distinct()
    cuts = cuts.groupBy(F.col("child").alias("first")).agg(F.array_sort(F.collect_set("d")).alias("cuts"))
    met = nodes.withColumn("first", F.get("edge", F.lit(0))).join(cuts, "first", "left")
    inner = F.coalesce("cuts", F.array().cast("array<int>"))
    ends = F.concat(inner, F.array("depth"))
    starts = F.concat(F.array("lo"), inner)
    parts = met.withColumn("starts", starts).select("*", F.posexplode(ends).alias("nth", "to"))
    since, to, base = F.get("starts", F.col("nth")), F.col("to"), F.col("lo")
    slice_ = lambda c: F.slice(c, since - base + 1, to - since)
    before = lambda c, top: F.when(since == base, F.col(top)).otherwise(F.get(F.col(c), since - base - 1))
    return parts.select(
        since.alias("lo"), to.alias("depth"), before("edge", "up").alias("up"), before("words", "words_up").alias("words_up"),
        slice_("edge").alias("edge"), slice_("words").alias("words"))


NODE = "lo int, depth int, up binary, words_up long, edge array<binary>, words array<long>"


def grown(rows: DataFrame) -> DataFrame:
    """The compacted nodes of what is new: rows below one place, sorted, so that neighbours share the longest prefixes.

    Rows have ``p``, ``w``, ``d`` and are dealt by their first new prefix. A task holds one row's path at a time, not a group.
    """

    def node(p: list, w: list, lo: int, depth: int) -> tuple:
        up, words_up = (p[lo - 1], w[lo - 1]) if lo else (ROOT, 0)
        return lo, depth, up, words_up, p[lo:depth], w[lo:depth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_p, last_w, path, out = [], [], [], []  # path: depths of the nodes along the last row, the place first

        def leave(to: int) -> None:
            """Nodes of the last row below depth ``to`` are complete; a branch at ``to`` becomes a node."""
            while len(path) > 1 and path[-1] > to:
                depth = path.pop()
                if path[-1] < to:
                    path.append(to)
                out.append(node(last_p, last_w, path[-1], depth))

        for batch in batches:
            for p, w, d in zip(*(batch.column(c).to_pylist() for c in ("p", "w", "d")), strict=True):
                if path and path[0] == d and last_p[d] == p[d]:
                    same = d + 1
                    while same < min(len(p), len(last_p)) and p[same] == last_p[same]:
                        same += 1
                    leave(same)
                else:
                    leave(-1)
                    path[:] = [d]
                if path[-1] < len(p):
                    path.append(len(p))
                last_p, last_w = p, w
            yield arrow(out)
            out.clear()
        leave(-1)
        yield arrow(out)

    def arrow(out: list) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lo", "depth", "up", "words_up", "edge", "words"])

    new = rows.filter("d < m").withColumn("first", F.get("p", F.col("d")))
    return new.select("first", "p", "w", "d").repartition("first").sortWithinPartitions("first", "p").select("p", "w", "d").mapInArrow(run, NODE)


def build(classes: DataFrame, settings: Settings) -> DataFrame:
    """Compacted nodes of all ``classes`` (distinct rows of ``p`` and ``w``), but for the root; every end of a class is a node."""
    spark = classes.sparkSession
    rows = classes.select("p", "w", F.size("p").alias("m"), F.lit(0).alias("a")).filter("m > 0")
    n, deepest = rows.agg(F.count("*"), F.max("m")).first()
    nodes = spark.createDataFrame([], NODE)
    if not n:
        return nodes
    rounds = deepest.bit_length() + 1
    draw = F.pmod(F.xxhash64(F.element_at("p", -1)), F.lit(1 << 30))
    since, size, crown = 0.0, settings.first, None
    while since < 1:
        until = min(1.0, size / n)
        batch = rows.filter((draw >= int(since * (1 << 30))) & (draw < int(until * (1 << 30))))
        if crown is not None:
            batch = written(search(batch, crown, rounds, small=True), "trie-crown")
            batch = search(batch, nodes, rounds)
        batch = written(_cut(batch, nodes), "trie-batch")
        nodes = written(_split(nodes, batch).unionByName(grown(batch)), "trie-nodes")
        crown = nodes if crown is None else crown
        since, size = until, size * (1 + settings.growth)
    return nodes


def _meet(rows: DataFrame, on: str, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join of rows to a table of unique keys. Rows of the ``hot`` keys, at most 1,000, meet their table rows by broadcast."""
    marked = rows.join(F.broadcast(hot.select(F.col("hot").alias(on), F.lit(True).alias("is_hot"))), on, "left")
    few = F.broadcast(table.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left_semi"))
    asked = marked.filter("is_hot IS NULL").drop("is_hot")
    return asked.join(table, F.col(on) == F.col(key), "left").unionByName(marked.filter("is_hot").drop("is_hot").join(few, F.col(on) == F.col(key), "left"))


def summed(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``key``, ``n`` (conversations), ``least`` (number), ``sw``, ``dw``, ``leaves``, ``children`` and ``parent_least`` of each node and the root.

    ``sw`` adds up the words of all conversations below, ``dw`` the words of the edges below and its own. Sums go
    up by doubling: a node hands what it has to an ancestor twice as far in every round, so rounds grow with the logarithm
    of the depth. What goes to one ancestor is added up before it moves.
    """
    spark = nodes.sparkSession
    edges = nodes.select(F.element_at("edge", -1).alias("key"), "up", F.element_at("words", -1).alias("until"), "words_up")
    root = spark.createDataFrame([(ROOT, None, 0, 0)], "key binary, up binary, until long, words_up long")
    children = edges.groupBy("up").agg(F.count("*").alias("children")).withColumnRenamed("up", "key")
    own = edges.union(root).join(ends.select("end", "n", "least"), F.col("key") == F.col("end"), "left").join(children, "key", "left")
    many, n = F.coalesce("children", F.lit(0)).cast("long"), F.coalesce("n", F.lit(0)).cast("long")
    now = written(own.select(
        "key", "up", F.col("up").alias("anc"), n.alias("n"), "least", (n * F.col("until")).alias("sw"), (F.col("until") - F.col("words_up")).alias("dw"),
        F.when(many == 0, 1).otherwise(0).cast("long").alias("leaves"), many.alias("children")), "trie-sums")
    share = now.count() // 1000 + 1
    hot_up = written(now.filter(F.col("children") > share).select(F.col("key").alias("hot")), "trie-hot")
    while not now.filter("anc IS NOT NULL").isEmpty():
        sent = now.filter("anc IS NOT NULL").groupBy(F.col("anc").alias("to")).agg(
            F.sum("n").alias("add_n"), F.min("least").alias("add_least"), F.sum("sw").alias("add_sw"), F.sum("dw").alias("add_dw"),
            F.sum("leaves").alias("add_leaves"), F.count("*").alias("askers"))
        sent = written(sent, "trie-sent")
        plus = lambda c: F.col(c) + F.coalesce(f"add_{c}", F.lit(0))
        new = now.join(sent, F.col("key") == F.col("to"), "left").select(
            "key", "up", "anc", plus("n").alias("n"), F.least("least", "add_least").alias("least"), plus("sw").alias("sw"), plus("dw").alias("dw"),
            plus("leaves").alias("leaves"), "children")
        hot = sent.filter(F.col("askers") > share).select(F.col("to").alias("hot"))
        further = now.select(F.col("key").alias("via"), F.col("anc").alias("next"))
        last = F.col("anc").isNull() | (F.col("anc") == F.lit(ROOT))
        higher = _meet(new.filter(~last), "anc", further, "via", hot).withColumn("anc", F.col("next")).select(*new.columns)
        now = written(new.filter(last).withColumn("anc", F.lit(None).cast("binary")).unionByName(higher), "trie-sums")
    tops = now.select(F.col("key").alias("over"), F.col("least").alias("parent_least"))
    return _meet(now.drop("anc"), "up", tops, "over", hot_up).drop("over", "up")


def digests(ends: DataFrame) -> DataFrame:
    """``end`` and ``ends_sha256``, of the decimal numbers of the conversations that end there, in order, joined by commas.

    One digest reads its numbers one after the other. Numbers are joined to long pieces where they lie, in ranges, so
    the task that ends a digest reads few rows, and holds one piece at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, first, held, size = None, None, [], 0

        def piece() -> list[tuple]:
            return [(end, first, ",".join(held))] if held else []

        for batch in batches:
            out = []
            for e, c in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if e != end or size > CHUNK:
                    out += piece()
                    end, first, held, size = e, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            yield arrow(out, pa.int64(), pa.string())
        yield arrow(piece(), pa.int64(), pa.string())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, sha = None, None
        for batch in batches:
            out = []
            for e, text in zip(batch.column("end").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if e != end:
                    out += [(end, sha.hexdigest())] if sha else []
                    end, sha = e, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
            yield arrow(out, pa.string())
        yield arrow([(end, sha.hexdigest())] if sha else [], pa.string())

    def arrow(out: list[tuple], *kinds: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * (len(kinds) + 1)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), *kinds), strict=True)], names=["end", "first", "text"][: len(kinds) + 1])

    ranged = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    joined = ranged.mapInArrow(pieces, "end binary, first long, text string").repartition("end").sortWithinPartitions("end", "first")
    return joined.select("end", "text").mapInArrow(lambda b: (x.rename_columns(["end", "ends_sha256"]) for x in whole(b)), "end binary, ends_sha256 string")


def conversation_trie(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The nodes of the prefix trie of rebuilt conversations, the root included.

    ``df`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Null roles and texts are empty,
    equal turns are ordered by a digest of role and text, repeated rows are turns of their own, rows without a
    ``conv_id`` are left out, an empty table gives no rows. Columns: ``conv_id`` (the least that starts with the node),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    The turns of one conversation meet in one task, as 24 bytes each, since each prefix depends on all turns before.
    """
    pre = prefixes(rebuilt(conversations(df), settings)).withColumn("end", F.when(F.size("p") > 0, F.element_at("p", -1)).otherwise(F.lit(ROOT)))
    pre = written(pre, "trie-prefixes")
    if pre.isEmpty():
        return df.sparkSession.createDataFrame([], OUT)
    classes = written(pre.groupBy("end").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.any_value("p").alias("p"), F.any_value("w").alias("w")), "trie-classes")
    nodes = build(classes, settings)
    sums = summed(nodes, classes)
    none = F.lit(hashlib.sha256().hexdigest())
    sums = sums.join(digests(pre), F.col("key") == F.col("end"), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)).drop("end")
    sums = written(sums, "trie-nodes")
    root = sums.filter(F.col("key") == F.lit(ROOT)).select(
        F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("sw") - F.col("dw")).alias("saved_tokens"), "ends_sha256")
    edges = nodes.select(F.element_at("edge", -1).alias("key"), "lo", "words_up", F.posexplode("words").alias("nth", "until"), "words")
    edges = edges.withColumn("before", F.when(F.col("nth") == 0, F.col("words_up")).otherwise(F.get("words", F.col("nth") - 1))).withColumn("last", F.col("nth") == F.size("words") - 1)
    rest = edges.drop("words").join(sums, "key").select(
        F.col("least").alias("conv_id"), (F.col("lo") + F.col("nth") + 1).cast("long").alias("depth"),
        F.when(F.col("nth") == 0, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("last"), F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("sw") - F.col("n") * F.col("before") - F.col("dw") + F.col("before") - F.col("words_up")).alias("saved_tokens"),
        F.when(F.col("last"), F.col("ends_sha256")).otherwise(none).alias("ends_sha256"))
    return root.unionByName(rest)


OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
