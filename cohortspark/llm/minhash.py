"""Near-duplicate documents: MinHash bands propose pairs, signatures and full shingle sets confirm them.

Documents with equal shingle sets form a class and are compared as one. In a bucket of a band, every class is
first compared with the least class of the bucket only, and components are formed from the links. Then only
classes outside the largest component of their bucket are compared with the bucket's other classes. Pairs inside a
component need no test, since one more link would not change the components. Where few classes are left around a
component, they are joined as pairs. Around a large one they are a query set, held against its classes block by
block inside tasks on full shingle sets, and only the links found leave the task. So no group of copies is
expanded into all its pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .components import connected_components
from .words import flat, hashes, joined, lowered, map_text, mix, slices, spans

#: Shingles hashed at once when the minima of a text are taken.
CHUNK = 4096
#: Cells of the table of shingles and sets that are counted at once, and sets held against it at once.
TABLE = 32 << 20
ROWS = 256


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity. ``crowd``: classes around a component from which they are compared in blocks of
    ``block`` shingles rather than joined; that changes the work, never the result. A pair at 0.8 misses all 32 bands of 4 with probability 5e-8.

    ``least_matches``: of all minima of a signature; a pair at 0.8 has fewer with probability 1e-8.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    least_matches: int = 76
    crowd: int = 64
    block: int = 400_000
    seed: int = 7


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. A text with fewer words is one shingle; one without words has none."""
    low = lowered(data)
    start, end, _ = spans(low, offsets)
    each = hashes(low, start, end)
    cut = np.searchsorted(start, offsets)
    window = joined([each[k: len(each) - words + 1 + k] for k in range(words)]) if len(each) >= words else each[:0]
    out = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(window[a: b - words + 1]))
        else:
            out.append(joined([*each[a:b, None], np.array([b - a], np.uint64)]) if b > a else each[:0])
    return out


def digests(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits that tell sets apart; None for an empty one."""
    out: list[bytes | None] = []
    for s in sets:
        if not len(s):
            out.append(None)
            continue
        with np.errstate(over="ignore"):
            parts = [mix(s + np.uint64(k)).sum(dtype=np.uint64) for k in (1, 2)]
        out.append(b"".join(int(p).to_bytes(8, "big") for p in parts))
    return out


def _family(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    n = settings.bands * settings.rows
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of every hash function a * x + b (mod 2^64, upper half)."""
    a, b = family
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), CHUNK):
        least = np.minimum(least, (shingles[k: k + CHUNK, None] * a + b).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """``docs`` with ``n_shingles``, ``node`` (digest of the set), ``signature`` and ``bands`` (a key per band)."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        sets = shingle_sets(*flat(part.column(text)), settings.words)
        family = _family(settings)
        rows = np.stack([signature(s, family) for s in sets])
        keys = rows.reshape(len(sets), settings.bands, settings.rows).astype(np.uint64)
        keys = joined([np.broadcast_to(np.arange(settings.bands, dtype=np.uint64), keys.shape[:2]).ravel(),
                       *(keys[:, :, k].ravel() for k in range(settings.rows))]).view(np.int64)
        offsets = np.arange(0, len(sets) + 1, dtype=np.int32)
        return [
            pa.array([len(s) for s in sets], pa.int64()), pa.array(digests(sets), pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets * rows.shape[1]), pa.array(rows.ravel().view(np.int32))),
            pa.ListArray.from_arrays(pa.array(offsets * settings.bands), pa.array(keys)),
        ]

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()),
              T.StructField("signature", T.ArrayType(T.IntegerType())), T.StructField("bands", T.ArrayType(T.LongType()))]
    return map_text(docs, text, fields, work, keep=[c for c in docs.columns if c != text])


def with_sets(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """``node`` and ``shingles`` of each text that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = [s for s in shingle_sets(*flat(part.column(text)), settings.words) if len(s)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests(sets), pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["node", "shingles"])

    return docs.select(text).mapInArrow(run, "node binary, shingles array<bigint>")


def _likely(settings: Settings) -> Column:
    """Whether sizes and signatures of a pair allow the least similarity."""
    sizes = 100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b")
    same = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x))
    return sizes & (same >= settings.least_matches)


def sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """``node`` and ``shingles`` of the given nodes, made again from the text of one document of each."""
    ids = classes.join(nodes.distinct(), "node", "left_semi").select(F.col("first_id").alias("_first")).distinct()
    texts = docs.join(ids, F.col("id").eqNullSafe(F.col("_first")), "left_semi").select("text")
    return written(with_sets(texts, "text", settings).dropDuplicates(["node"]), "shingles")


def likely_pairs(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of nodes that their sizes and signatures allow."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("signature").alias(f"sig_{s}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").filter(_likely(settings))
    return written(likely.select("a", "b", "n_a", "n_b"), "likely")


def confirmed(likely: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = likely.join(side("a"), "a").join(side("b"), "b").withColumn("shared", shared)
    return both.filter(100 * F.col("shared") >= settings.percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def first_pairs(buckets: DataFrame) -> DataFrame:
    """Every class of a bucket with the least one."""
    least = buckets.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z").select("band", "a")
    return buckets.join(least, "band").filter("node != a").select("a", F.col("node").alias("b")).distinct()


def rest_groups(buckets: DataFrame, components: DataFrame) -> DataFrame:
    """For buckets that hold several components: ``hub`` (the largest one), ``node``, and ``asks`` (whether the node is outside it)."""
    placed = buckets.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    split = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("k")).filter("k > 1")
    placed = placed.join(split.select("band", F.col("most.component").alias("hub")), "band")
    return placed.select("hub", "node", "component", (F.col("component") != F.col("hub")).alias("asks"), "band")


def rest_pairs(groups: DataFrame) -> DataFrame:
    """Every class that asks, with each class of its bucket in another component."""
    few = groups.filter("asks").select("band", F.col("node").alias("a"), F.col("component").alias("own"))
    # Two classes that ask would meet twice; the lesser one as a is enough.
    pairs = groups.join(few, "band").filter((F.col("component") != F.col("own")) & (~F.col("asks") | (F.col("a") < F.col("node"))))
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def rest_blocks(groups: DataFrame, classes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) of the classes that ask with any class around their hub.

    Both sides of a hub are cut into blocks of about ``block`` shingles, and each pair of blocks is a unit of work. In
    a unit, the links are reduced to ones that connect the same classes.
    """
    nodes = groups.groupBy("hub", "node").agg(F.max("asks").alias("asks")).join(classes.select("node", "n_shingles"), "node")
    sizes = nodes.groupBy("hub").agg(
        F.ceil(F.sum("n_shingles") / settings.block).cast("int").alias("rows"),
        F.ceil(F.sum(F.when(F.col("asks"), F.col("n_shingles"))) / settings.block).cast("int").alias("columns"))
    nodes = nodes.join(sizes, "hub")
    held = nodes.select("hub", "node", F.lit(True).alias("held"), F.pmod(F.xxhash64("node"), "rows").cast("int").alias("i"),
                        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"))
    asking = nodes.filter("asks").select("hub", "node", F.lit(False).alias("held"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
                                         F.pmod(F.xxhash64("node"), "columns").cast("int").alias("j"))
    dealt = held.select("hub", "node", "held", "i", "j").union(asking.select("hub", "node", "held", "i", "j")).join(sets, "node")
    percent = settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, asked = None, ([], [])
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("hub", "i", "j", "held")), strict=True))
            names = np.array(batch.column("node").to_pylist(), object)
            lists = batch.column("shingles")
            cut = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            change = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for s, e in zip(change[:-1], change[1:], strict=True):
                if keys[s][:3] != unit:
                    unit, asked = keys[s][:3], ([], [])
                own = [values[cut[k]: cut[k + 1]] for k in range(s, e)]
                if not keys[s][3]:
                    asked = ([*asked[0], *names[s:e]], [*asked[1], *(x.copy() for x in own)])
                    continue
                for a, b in links_between(asked[0], asked[1], names[s:e], own, percent):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    parts = dealt.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "held")
    return parts.mapInArrow(run, "a binary, b binary")


def links_between(left_names, left: list[np.ndarray], right_names, right: list[np.ndarray], percent: int) -> Iterator[tuple[list, list]]:
    """Links between sets of two sides, as ones that connect the same names: the shared shingles of all pairs are counted at once."""
    left_names, right_names = np.array(left_names, object), np.array(right_names, object)
    right_size = np.array([len(x) for x in right])
    right_start = np.cumsum(right_size) - right_size
    all_right = np.concatenate(right)
    at = 0
    while at < len(left):
        to, total = at, 0
        while to < len(left) and (to == at or (total + len(left[to])) * (to + 1 - at) <= TABLE):
            total += len(left[to])
            to += 1
        part = left[at:to]
        size = np.array([len(x) for x in part])
        known, place = np.unique(np.concatenate(part), return_inverse=True)
        table = np.zeros((len(known) + 1, len(part)), np.uint8)
        table[place, np.repeat(np.arange(len(part)), size)] = 1
        where = np.minimum(np.searchsorted(known, all_right), len(known) - 1)
        where[known[where] != all_right] = len(known)  # the last row is empty
        for r in range(0, len(right), ROWS):
            a, b = right_start[r], right_start[min(r + ROWS, len(right)) - 1] + right_size[min(r + ROWS, len(right)) - 1]
            shared = np.add.reduceat(table[where[a:b]], right_start[r: r + ROWS] - a, axis=0, dtype=np.int32)
            union = right_size[r: r + ROWS, None] + size[None] - shared
            p, q = np.nonzero(100 * shared >= percent * union)
            x, y = left_names[at:to][q], right_names[r: r + ROWS][p]
            some = x != y
            if some.any():
                yield _forest(x[some], y[some])
        at = to


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """Each name with the least of its component."""
    parent: dict = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            parent[n] = n = parent[parent[n]]
        return n

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    pairs = [(n, root(n)) for n in parent if root(n) != n]
    return [n for n, _ in pairs], [r for _, r in pairs]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row for each row of ``docs``: its columns but the text, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the least ``id_col`` among the documents that can be reached by links, the row's own included;
    ``kept`` is whether it is the row's own. A null text or one without words has no shingles and is linked with
    nothing; rows with a null number are compared too, but never name a component: alone, they have a null
    ``component_id`` and are kept. Rows with one number and one text are equal copies and all carry the same
    ``kept``. An empty table gives no rows; input columns named ``n_shingles``,
    ``component_id`` or ``kept`` are replaced, all others come out as they were.
    """
    columns = [c for c in docs.columns if c not in ("n_shingles", "component_id", "kept")]
    docs = docs.select(F.struct(*columns).alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    signs = written(signed(docs.withColumn("row", F.col("row").dropFields(text)), "text", settings), "signatures")
    classes = signs.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature"),
        F.any_value("bands").alias("bands"))
    classes = written(classes, "classes")
    buckets = written(_shared_buckets(classes.select("node", F.explode("bands").alias("band"))), "buckets")
    likely = likely_pairs(first_pairs(buckets), classes, settings)
    sets = sets_of(likely.select(F.col("a").alias("node")).union(likely.select("b")), classes, docs, settings)
    components = connected_components(written(confirmed(likely, sets, settings), "links"), "a", "b")

    groups = written(rest_groups(buckets, components), "rest")
    crowd = groups.select("hub", "node").distinct().groupBy("hub").agg(F.count("*").alias("n")).filter(F.col("n") > settings.crowd).select("hub")
    crowded = groups.join(crowd, "hub", "left_semi").select("hub", "node", "asks").distinct()
    likely = likely_pairs(rest_pairs(groups.join(crowd, "hub", "left_anti")), classes, settings)
    nodes = crowded.select("node").union(likely.select("a")).union(likely.select("b"))
    sets = sets_of(nodes, classes, docs, settings)
    more = written(confirmed(likely, sets, settings).union(rest_blocks(crowded, classes, sets, settings)), "links")
    edges = components.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    components = connected_components(edges, "a", "b")

    named = classes.select("node", "first_id").join(components, "node")
    names = named.groupBy("component").agg(F.min("first_id").alias("_group"))
    groups = named.join(names, "component").select("node", "_group")
    own = classes.join(groups, "node", "left").select("node", F.coalesce("_group", "first_id").alias("_group"))
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("_group"))
    out = signs.select("row", "id", "n_shingles", "node").join(own, "node", "left").withColumn("component_id", component)
    shown = [F.col("row")[c].alias(c) for c in columns if c != text]
    return out.select(*shown, "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _shared_buckets(bands: DataFrame) -> DataFrame:
    """Without buckets of a single class, which most are."""
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    return bands.join(shared, "band", "left_semi")
