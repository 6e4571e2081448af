"""Centroid clustering, conversation trie and sharding against plain versions, with edge rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as quick
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortspark.llm import centroids, sharding, trie


# centroids

def plain_clusters(vectors, k, rounds, seed="2:"):
    """{row: (cluster, distance, cluster inertia, inertia, hash)} with Python's whole numbers."""
    usable = {r: [math.floor(256 * x) for x in v] for r, (_, v) in enumerate(vectors)
              if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)}
    told = lambda r: hashlib.sha256(f"{seed}{'' if vectors[r][0] is None else vectors[r][0]}".encode()).hexdigest()
    centers = [usable[r] for r in sorted(usable, key=lambda r: (told(r), usable[r]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(rounds + 1):
        best = {r: min((far(v, c), n) for n, c in enumerate(centers)) for r, v in usable.items()}
        if step == rounds:
            break
        for n in range(len(centers)):
            own = [usable[r] for r, (_, c) in best.items() if c == n]
            if own:
                centers[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    inertia = Counter()
    for d, c in best.values():
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((vectors[r][0], c, d, inertia[c], sum(inertia.values()), sha[c]) for r, (d, c) in best.items())


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, w string, id string"


def vector_rows(rows):
    return [(i, v, 0, "x", "y", "z") for i, v in rows]


def test_centroids_match_plain(spark):
    draw = random.Random(5)
    near = lambda c: [c + draw.gauss(0, 0.2) for _ in range(64)]
    rows = [(i, [float(np.float32(x)) for x in near(i % 7)]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (301, None), (302, []), (303, [0.0] * 63), (304, [0.0] * 64),
             (305, [math.nan] + [0.0] * 63), (306, [math.inf] + [0.0] * 63), (307, [None] + [0.0] * 63), (308, [0.5, -0.5] * 32), (309, [0.5, -0.5] * 32)]
    df = spark.createDataFrame(vector_rows(rows), VECTORS).repartition(5)
    for k, rounds in ((40, 5), (3, 2), (1, 0)):
        got = centroids.cluster_vectors(df, settings=centroids.Settings(clusters=k, rounds=rounds))
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert Counter(map(tuple, got.collect())) == plain_clusters(rows, k, rounds)


def test_centroids_few_and_none(spark):
    rows = [(1, [1.0] * 64), (2, [-3.25] * 64)]
    df = spark.createDataFrame(vector_rows(rows), VECTORS)
    assert Counter(map(tuple, centroids.cluster_vectors(df).collect())) == plain_clusters(rows, 40, 5)
    empty = centroids.cluster_vectors(df.limit(0))
    assert empty.columns[1:] == ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_centroids_refuse_what_does_not_fit(spark):
    df = spark.createDataFrame(vector_rows([(1, [70_000.0] * 64)]), VECTORS)
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster_vectors(df).collect()


@quick(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 50), st.sampled_from([1, 3, 1000, (1 << 24) - 1]))
def test_nearest_is_exact(seed, k, top):
    draw = np.random.default_rng(seed)
    x, c = draw.integers(-top, top, (30, 64), endpoint=True), draw.integers(-top, top, (k, 64), endpoint=True)
    c[draw.integers(0, k)] = x[3]
    c[draw.integers(0, k)] = x[3]  # ties
    h = centroids.matrix(64)
    to, far = centroids.nearest(x @ h.T, c @ h.T)
    want = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (to == want.argmin(1)).all() and (far == 64 * want.min(1)).all()


@pytest.mark.parametrize("size", [1, 2, 4, 64])
def test_transform_orders_by_sign_changes(size):
    h = centroids.matrix(size)
    assert (h @ h.T == size * np.eye(size)).all()
    assert [(np.diff(r) != 0).sum() for r in h] == list(range(size))
    assert [s.stop for s in centroids.levels(size)][-1] == size


# trie

def plain_trie(rows, group=20, most=4):
    by_conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            by_conv.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(x[3], x[4]) for x in sorted(t)] for c, t in by_conv.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        made[c] = tuple(turns.get(c - int(math.fmod(c, group)), [])[:h] + own[h:])
    members = {}
    for c, t in made.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        words = len(brute.WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * words
    return Counter((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                    brute.sha(",".join(map(str, sorted(c for c in who if made[c] == p))))) for p, who in members.items())


TURNS = "conv_id long, turn long, role string, text string, p string, key string, least string"


def turn_rows(rows):
    return [(*r, "a", "b", "c") for r in rows]


def check_trie(spark, rows, **settings):
    df = spark.createDataFrame(turn_rows(rows), TURNS)
    got = trie.conversation_trie(df, trie.Settings(**settings))
    assert Counter(map(tuple, got.collect())) == plain_trie(rows, settings.get("group", 20), settings.get("most", 4))


def test_trie_edge_rows(spark):
    rows = [(0, 0, "user", "a b"), (0, 1, "bot", "c"), (0, None, "system", "x y z"), (1, 0, None, None), (1, 0, None, None), (1, 0, "", ""),
            (2, 5, "user", "a b"), (None, 0, "user", "lost"), (25, 0, "u", "only"), (26, 0, "u", "only"), (-3, 0, "u", "é 漢字 🦆"), (-3, 1, "u", "w " * 50_000),
            (45, 7, "ab", "c"), (46, 7, "a", "bc"), (2**62, 0, "u", "far")]
    check_trie(spark, rows)
    check_trie(spark, rows, first=2, growth=1)
    empty = trie.conversation_trie(spark.createDataFrame(turn_rows(rows), TURNS).limit(0))
    assert empty.columns == [c.split()[0] for c in trie.OUT.split(", ")] and empty.count() == 0


def test_trie_long_paths_and_copies(spark):
    """A long conversation, prefixes of it that end inside its edge, late branches, and many copies of one."""
    turn = lambda k: ("u", f"turn {k}")
    texts = [[turn(k) for k in range(130)]]
    texts += [[turn(k) for k in range(n)] for n in (1, 2, 3, 64, 65, 100)]
    texts += [[turn(k) for k in range(n)] + [("b", f"branch {n}"), ("b", "tail")] for n in (1, 63, 64, 128)]
    texts += [[turn(0), turn(1), ("c", "copy")]] * 40
    rows = [(c, t, *x) for c, own in enumerate(texts) for t, x in enumerate(own)]
    check_trie(spark, rows, first=3, growth=1, group=1_000_000, most=1)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_in_small_batches(spark, seed):
    """Few different turns, so that later batches cut edges, end inside them and branch everywhere."""
    draw = random.Random(seed)
    rows = [(c, t, "u", draw.choice("ab")) for c in range(150) for t in range(draw.randint(1, 12))]
    check_trie(spark, rows, first=4, growth=1, group=7)


@quick(max_examples=300, deadline=None)
@given(st.integers(0, 4000), st.integers(1, 4000))
def test_fattest(a, more):
    b = a + more
    best = max(range(a + 1, b + 1), key=lambda f: f & -f)
    x = a ^ b
    for k in (1, 2, 4, 8, 16):
        x |= x >> k
    assert b & ~(x >> 1) == best


def test_fattest_column(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(rows, "a int, b int").select(trie.fattest(F.col("a"), F.col("b")).alias("f")).collect()
    assert [r["f"] for r in got] == [max(range(a + 1, b + 1), key=lambda f: f & -f) for a, b in rows]


# sharding

def plain_jump(key, n):
    key %= 1 << 64
    at, to = -1, 0
    while to < n:
        at, key = to, (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


KEYS = [0, 1, -1, 2**63 - 1, -(2**63), *range(2, 300), *(random.Random(3).randrange(-(2**63), 2**63) for _ in range(700))]


@pytest.mark.parametrize("n", [1, 2, 40, 41, 1000])
def test_jump_matches_plain(spark, n):
    rows = spark.createDataFrame([(k,) for k in KEYS], "k long").select("k", sharding.jump(F.col("k"), n).alias("s")).collect()
    assert [r["s"] for r in rows] == [plain_jump(r["k"], n) for r in rows]


def test_growth_moves_only_into_new_shards(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("grown_shard"))
    for key in ("k", "grown_shard"):
        out = sharding.moved(df.withColumn("own", F.col(key)), "own", 10, 12)
        assert {r["grown_shard"] for r in out.select("grown_shard").distinct().collect()} == {10, 11}
        assert abs(out.count() / 5000 - 2 / 12) < 0.03
    assert sharding.moved(df, "k", 10, 10).count() == 0
    with pytest.raises(ValueError, match="appended"):
        sharding.moved(df, "k", 10, 9)
    with pytest.raises(ValueError, match="0 shards"):
        sharding.jump(F.col("k"), 0)


def test_sharding_edge_rows(spark):
    texts = [(k, f"text {k % 7}" if k % 3 else None, "x", "y") for k in range(200)]
    texts += [(None, "none", "x", "y"), (3, "", "x", "y"), (3, "é🦆\x00", "x", "y"), (5, "z" * 300_000, "x", "y")] + [(9, "hot", "x", "y")] * 400
    df = spark.createDataFrame(texts, "doc_id long, text string, shard string, slot string").repartition(6)
    rows = sharding.shard_documents(df, 40).collect()
    assert len(rows) == len(texts)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), plain_jump(i or 0, 40), plain_jump(i or 0, 41)) for i, t, _, _ in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows) == want
    for s in {r["shard"] for r in rows}:
        own = sorted((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"]) for r in rows if r["shard"] == s)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1:] for x in own] == sorted(x[1:] for x in own)
    assert sharding.shard_documents(df.limit(0), 40).count() == 0


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(k, f"t{k}") for k in KEYS] + [(1, "hot")] * 500, "k long, deal string")
    folder = f"{tmp_path}/shards"
    sharding.write_shards(df, folder, 5, key="k", files=3)
    back = spark.read.parquet(folder)
    assert Counter(map(tuple, back.select("k", "deal").collect())) == Counter(map(tuple, df.collect()))
    assert all(r["shard"] == plain_jump(r["k"], 5) for r in back.collect())
    hot = back.filter("deal = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 1
