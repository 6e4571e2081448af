"""Embedding near-duplicates: an exact metric range join.

Vectors are scaled to length 1; a cosine of at least c is then a distance of at most r = sqrt(2 - 2c).

Dense groups become balls: all vectors within r/2 of a center are linked with each other by the triangle
inequality and need no comparison. A vector outside a ball can have links into it only within r of its rim, and
visits the ball then. All other vectors go to the cell of their nearest pivot. One is also sent to the cells whose
boundary lies within r of it, so every link has both ends in the home cell of each of them, and cells are joined
independently. Centers and pivots come from a bounded sample; that choice changes the work, never the result.
Crowded cells are split into blocks that each meet all vectors of the cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import connected_components

#: Added to every bound, far above rounding and far below any distance that matters.
SLACK = 1e-9
#: Vectors compared with as many others at once.
TILE = 1024


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors from which pivots and centers are chosen. ``home``: vectors of a block. ``pivots``, ``balls``: at most so many."""

    cosine: float = 0.95
    sample: int = 2048
    home: int = 8192
    pivots: int = 1024
    balls: int = 256
    ball_least: int = 3


@dataclass(frozen=True)
class Space:
    """Where vectors go: pivots, ball centers (with their row numbers), the rows in each ball, the blocks of each cell."""

    reach: float
    cosine: float
    pivots: np.ndarray
    centers: np.ndarray
    center_rows: np.ndarray
    n_in_ball: np.ndarray
    blocks: np.ndarray

    @property
    def half(self) -> float:
        return self.reach / 2 - SLACK


def unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a usable vector, and these as double-precision vectors of length 1."""
    rows = column.to_numpy(zero_copy_only=False)
    sizes = {len(x) for x in rows if x is not None}
    if len(sizes) > 1:
        raise ValueError(f"vectors of unlike lengths {sorted(sizes)[:5]}")
    ok = np.array([x is not None and len(x) > 0 for x in rows], bool)
    if not ok.any():
        return ok, np.zeros((0, 0))
    x = np.stack([np.asarray(v, float) for v in rows[ok]])
    with np.errstate(all="ignore"):
        top = np.abs(x).max(1, keepdims=True)
        x = x / top  # so that squares neither overflow nor vanish
        norm = np.sqrt((x * x).sum(1))
        good = np.isfinite(norm) & (norm > 0) & np.isfinite(top[:, 0])
    ok[ok] = good
    return ok, x[good] / norm[good, None]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between vectors of length 1."""
    return np.maximum(2 - 2 * (a @ b.T), 0)


def choose(rows: np.ndarray, sample: np.ndarray, n: int, settings: Settings) -> Space:
    """Ball centers where the sample is dense, pivots among the rest."""
    reach = float(np.sqrt(2 - 2 * settings.cosine))
    half = reach / 2 - SLACK
    near = squares(sample, sample) <= half * half
    left, centers = np.ones(len(sample), bool), []
    while len(centers) < settings.balls and left.any():
        degree = (near & left).sum(1) * left
        best = int(degree.argmax())
        if degree[best] <= settings.ball_least:
            break
        centers.append(best)
        left &= ~near[best]
    n_pivots = max(1, min(settings.pivots, -(-n // settings.home), int(left.sum()) or 1))
    loose = np.flatnonzero(left)[:n_pivots] if left.any() else np.zeros(1, int)
    cells = len(centers) + len(loose)
    return Space(reach, settings.cosine, sample[loose], sample[centers], rows[centers], np.zeros(len(centers), np.int64), np.ones(cells, np.int64))


def homes(space: Space, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home cell of each vector (balls first, then pivots), and its squared distances from centers and pivots."""
    to_center, to_pivot = squares(x, space.centers), squares(x, space.pivots)
    home = len(space.centers) + to_pivot.argmin(1)
    if len(space.centers):
        ball = to_center.argmin(1)
        inside = to_center[np.arange(len(x)), ball] <= space.half**2
        home[inside] = ball[inside]
    return home, to_center, to_pivot


def visits(space: Space, home: np.ndarray, to_center: np.ndarray, to_pivot: np.ndarray) -> np.ndarray:
    """Which cells each vector visits besides its own (a matrix of flags)."""
    n_balls = len(space.centers)
    out = np.zeros((len(home), n_balls + len(space.pivots)), bool)
    if n_balls:  # pairs of balls meet in the one listed first
        out[:, :n_balls] = to_center <= (space.reach + space.half + SLACK) ** 2
        out[:, :n_balls] &= np.arange(n_balls) < home[:, None]
    loose = np.flatnonzero(home >= n_balls)
    own = home[loose] - n_balls
    apart = np.sqrt(squares(space.pivots, space.pivots))[own]
    over = to_pivot[loose] - to_pivot[loose, own][:, None]
    out[np.ix_(loose, np.arange(n_balls, out.shape[1]))] = over <= 2 * (space.reach + SLACK) * apart + SLACK
    out[np.arange(len(home)), home] = False
    return out


def block_of(rows: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of each row among its cell's; depends on the row number alone."""
    return ((rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % blocks


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same rows as the given ones: each row with the least of its component."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(names))
    return names[away], names[label[away]]


ROUTED = "cell long, block long, visitor boolean, row long, x array<double>"
FOUND = "a long, b long, n long"


def route(vectors: DataFrame, space: Space) -> DataFrame:
    """Each vector at home in one block of its cell, and as a visitor in all blocks where it may have links."""
    n_balls = len(space.centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                ok, x = unit(part.column("x"))
                if not len(x):
                    continue
                row = part.column("row").to_numpy()[ok]
                home, to_center, to_pivot = homes(space, x)
                own = block_of(row, space.blocks[home])
                out = [(home, own, np.zeros(len(row), bool), np.arange(len(row)))]
                who, cell = np.nonzero(visits(space, home, to_center, to_pivot))
                # Loose vectors of one cell also visit each other's blocks; in a ball they are linked already.
                other = np.flatnonzero((home >= n_balls) & (space.blocks[home] > 1))
                who, cell = np.concatenate([who, other]), np.concatenate([cell, home[other]])
                times = space.blocks[cell]
                who, cell = np.repeat(who, times), np.repeat(cell, times)
                block = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times)
                new = (cell != home[who]) | (block != own[who])
                out.append((cell[new], block[new], np.ones(int(new.sum()), bool), who[new]))
                cell, block, visitor, who = (np.concatenate(c) for c in zip(*out, strict=True))
                for k in range(0, len(who), 16 * TILE):
                    w = who[k: k + 16 * TILE]
                    flat = pa.array(x[w].ravel())
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * x.shape[1]), flat)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[k: k + len(w)]), pa.array(block[k: k + len(w)]), pa.array(visitor[k: k + len(w)]), pa.array(row[w]), lists],
                        names=["cell", "block", "visitor", "row", "x"])

    return vectors.mapInArrow(run, ROUTED)


def join_blocks(routed: DataFrame, space: Space, partitions: int) -> DataFrame:
    """Links found in each block: rows (a, null, n) say that a has n of them, rows (a, b, 0) that both are connected.

    A block's home vectors come first and are kept; visitors pass by batch after batch.
    """
    n_balls = len(space.centers)

    def emit(a, b, n) -> pa.RecordBatch:
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, n)]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.concat_arrays(b), pa.array(columns[1], pa.int64())], names=["a", "b", "n"])

    def meet(cell: int, home: tuple[np.ndarray, np.ndarray], rows: np.ndarray, x: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        """Home vectors against others (``same``: against themselves)."""
        for i in range(0, len(home[0]), TILE):
            own_rows, own = home[0][i: i + TILE], home[1][i: i + TILE]
            n_own, a, b, n = np.zeros(len(own_rows), np.int64), [], [], []
            for j in range(0, len(rows), 4 * TILE):
                linked = own @ x[j: j + 4 * TILE].T >= space.cosine
                if same:
                    linked &= own_rows[:, None] != rows[None, j: j + 4 * TILE]
                n_own += linked.sum(1)
                p, q = np.nonzero(linked)
                if len(p):
                    u, v = forest(own_rows[p], rows[j: j + 4 * TILE][q])
                    a, b, n = [*a, u], [*b, pa.array(v, pa.int64())], [*n, np.zeros(len(u), np.int64)]
                    if cell < n_balls:  # members don't visit others for this link
                        met = linked.sum(0)
                        some = np.flatnonzero(met)
                        a, b, n = [*a, rows[j: j + 4 * TILE][some]], [*b, pa.nulls(len(some), pa.int64())], [*n, met[some]]
            some = np.flatnonzero(n_own)
            a, b, n = [*a, own_rows[some]], [*b, pa.nulls(len(some), pa.int64())], [*n, n_own[some]]
            yield emit(a, b, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, closed = None, [], None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal closed
            closed = tuple(np.concatenate([k[i] for k in kept]) for i in (0, 1)) if kept else None
            if closed is None:
                return
            if now[0] >= n_balls:
                yield from meet(now[0], closed, *closed, True)
            else:
                size = np.full(len(closed[0]), space.n_in_ball[now[0]] - 1)
                center = pa.array(np.full(len(size), space.center_rows[now[0]]))
                yield emit([closed[0], closed[0]], [pa.nulls(len(size), pa.int64()), center], [size, np.zeros(len(size), np.int64)])

        for batch in batches:
            cell, block = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            visitor, row = batch.column("visitor").to_numpy(zero_copy_only=False), batch.column("row").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(len(row), -1)
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(visitor.astype(int)) != 0)) + 1
            for s, e in zip([0, *change], [*change, len(row)], strict=True):
                if s == e:
                    continue
                if now != (cell[s], block[s]):
                    if now is not None and closed is None:
                        yield from close()
                    now, kept, closed = (cell[s], block[s]), [], None
                if not visitor[s]:
                    kept.append((row[s:e].copy(), x[s:e].copy()))
                    continue
                if closed is None:
                    yield from close()
                if closed is not None:
                    yield from meet(now[0], closed, row[s:e], x[s:e], False)
        if now is not None and closed is None:
            yield from close()

    dealt = routed.repartition(partitions, "cell", "block").sortWithinPartitions("cell", "block", "visitor")
    return dealt.mapInArrow(run, FOUND)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows that are equal in
    number and vector are one vector, and each gets its result; a null number is allowed and never names a component.
    Vectors of unlike lengths are an error. An empty table gives no rows.
    """
    spark = df.sparkSession
    distinct = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("x")).distinct()
    vectors = written(distinct.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = vectors.filter("x IS NOT NULL AND size(x) > 0").select("row", "x")
    n = usable.count()
    names = vectors.select("row", "id", "x")
    if n:
        drawn = usable.withColumn("_draw", F.xxhash64("row")).orderBy("_draw", "row").limit(settings.sample).drop("_draw").toArrow()
        column = drawn.column("x").combine_chunks()
        ok, sample = unit(column)
        rows = drawn.column("row").to_numpy()[ok]
    if n and len(rows):
        space = choose(rows, sample, n, settings)
        space = _counted(usable, space, settings)
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(space.blocks.sum()))
        found = written(join_blocks(route(usable, space), space, partitions), "links")
    else:
        found = spark.createDataFrame([], FOUND)
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    components = connected_components(found.filter("b IS NOT NULL"), "a", "b").withColumnRenamed("node", "row")
    named = names.join(counts, "row", "left").join(components, "row", "left")
    named = written(named.withColumn("component", F.coalesce("component", "row")).select(
        "id", "x", "component", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "named")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    out = named.join(least, "component").select("id", "x", "n_links", "component_id")
    source = df.select(F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_x"))
    out = source.join(out, F.col("_id").eqNullSafe(F.col("id")) & F.col("_x").eqNullSafe(F.col("x")), "left")
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _counted(vectors: DataFrame, space: Space, settings: Settings) -> Space:
    """With the number of vectors at home in each cell: at most pivots + balls numbers reach the driver."""
    cells = len(space.blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                _, x = unit(batch.column("x").slice(at, TILE))
                if len(x):
                    total += np.bincount(homes(space, x)[0], minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], names=["cell", "n"])

    total = np.zeros(cells, np.int64)
    for r in vectors.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r["cell"]] = r["n"]
    n_balls = len(space.centers)
    return Space(space.reach, space.cosine, space.pivots, space.centers, space.center_rows, total[:n_balls], np.maximum(1, -(-total // settings.home)))
