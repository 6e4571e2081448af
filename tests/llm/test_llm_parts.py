"""Small parts by property: merges, packing and bounds, distances, hashes."""

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortspark.llm import line_dedup, lm, lookup, minhash, packing, pieces, quality, words

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.one_of(st.text(max_size=60), st.text("ab the ▁\n<é漢0'", max_size=80), st.text("aeinst", max_size=120))


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_pieces_as_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    lib, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.model(PIECES)
    ids, lengths = own.encode(pa.array(texts, pa.string()))
    want = [lib.encode(t) for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert own.decode(ids, lengths).to_pylist() == [lib.decode(w) for w in want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(TEXT, st.text(" a.,\n\té'sÃ×<|endoftext|>1", max_size=60)), max_size=12))
def test_bytes_as_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, lengths = packing.encoder(BYTES).encode(pa.array(texts, pa.string()))
    want = [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def fewest(sizes, capacity):
    """The least number of bins, by trying everything."""
    best = [len(sizes)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(room)
            return
        for k in {r: j for j, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, [*room[:k], room[k] - sizes[i], *room[k + 1:]])
        place(i + 1, [*room, capacity - sizes[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_bounds_never_exceed_the_best_packing(sizes):
    sizes = sorted(sizes, reverse=True)
    bound = packing.needed(packing.lower_bound(np.bincount(np.array(sizes, int), minlength=21), 20))
    bins, offsets, room = packing.best_fit(np.array(sizes, np.int64), 20)
    assert bound <= fewest(sizes, 20) <= len(room)
    for b in range(len(room)):
        own = sorted((int(o), s) for k, o, s in zip(bins, offsets, sizes, strict=True) if k == b)
        assert [o for o, _ in own] == np.cumsum([0, *(s for _, s in own)]).tolist()[:-1]
        assert sum(s for _, s in own) == 20 - room[b]


def test_bounds_of_large_items():
    counts = np.zeros(1025, int)
    counts[600] = 100
    assert packing.needed(packing.lower_bound(counts, 1024)) == 100
    counts[400] = 100
    assert packing.needed(packing.lower_bound(counts, 1024)) == 100
    assert packing.lower_bound(np.zeros(1025, int), 1024) == 0


def test_pack_exchanges_between_partitions(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1025, 3000).tolist() + [1024] * 50
    df = spark.createDataFrame([(k, s, "x") for k, s in enumerate(sizes)], "k long, length long, offset string")
    few, one = (packing.pack(df, pack_rows=n).select("sequence_id").distinct().count() for n in (250, 50_000))
    assert -(-sum(sizes) // 1024) <= one <= few <= 1.02 * one
    with pytest.raises(ValueError):
        packing.pack(df.withColumn("length", F.lit(2000)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab \n\t\x0bé漢", max_size=40), max_size=10))
def test_words_and_lines(texts):
    data, offsets = words.flat(pa.array(texts, pa.string()))
    start, end, of = words.spans(data, offsets)
    got = [[] for _ in texts]
    for a, b, k in zip(start, end, of, strict=True):
        got[k].append(data[a:b].tobytes().decode())
    assert got == [brute.WORD.findall(t) for t in texts]
    start, end, of = words.lines(data, offsets)
    got = [[] for _ in texts]
    for a, b, k in zip(start, end, of, strict=True):
        got[k].append(data[a:b].tobytes().decode())
    assert got == [t.split("\n") for t in texts]
    m = quality.measures(data, offsets)
    assert [tuple(int(m[k][i]) for k in quality.MEASURES) for i in range(len(texts))] == [brute.quality_base(t)[:5] for t in texts]


def test_hashes_do_not_depend_on_place():
    data, offsets = words.flat(pa.array(["abc", "x abc", "abc abd", None, ""]))
    start, end, _ = words.spans(data, offsets)
    h = words.hashes(data, start, end)
    assert h[0] == h[2] == h[3] and len({int(x) for x in h}) == 3


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"k": list(range(7)), "text": ["a" * 10, None, "b" * 100, "", "c" * 3, "d" * 3, "e" * 30]})
    parts = list(words.slices(batch, "text", 20))
    assert [x for p in parts for x in p.column("k").to_pylist()] == list(range(7))
    assert len(parts) == 4


def test_distance():
    p = np.array([[1, 0, 0], [1, 1, 0], [2, 2, 4], [0, 0, 0]])
    q = np.array([[0, 5, 5], [3, 3, 0], [1, 1, 2], [1, 1, 1]])
    got = quality.distance(p, q)
    assert got[0] == pytest.approx(1) and got[1:] == pytest.approx([0, 0, 0], abs=1e-6)


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 62, 5000, np.uint64))
    table = lookup.Lookup(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == [{int(k): i for i, k in enumerate(keys)}.get(int(k) + 1, -1) for k in keys]).all()
    assert (lookup.Lookup(keys[:0]).find(keys) == -1).all()


def test_signatures_estimate_similarity():
    s = minhash.Settings()
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 1000, np.uint64)
    b = np.concatenate([a[:889], rng.integers(0, 1 << 63, 111, np.uint64)])  # 889 of 1111: 0.8
    same = (minhash.signature(a, minhash._family(s)) == minhash.signature(b, minhash._family(s))).mean()
    assert 0.65 < same < 0.95


def test_words_with_weights_grow_with_the_counted_words(spark):
    """More distinct words give more words, classes and words a class; a corpus of a few has the least size."""

    def known(n):
        counts = spark.range(n).selectExpr("id AS word", "int(id % 32) AS kind", f"bigint(1 + {n} / (id + 1)) AS n")
        return lm.known_words(counts, lm.Settings())

    small, large = known(2048 * 64), known(8192 * 64)
    assert (len(small.class_of), len(small.class_start) - 1) == (2048, 48)
    assert (len(large.class_of), len(large.class_start) - 1) == (8192, 96)
    assert large.class_start[-1] == 8192 and large.class_of.max() == 95
    assert lm.Net(large, lm.Settings()).p["ww"].shape == (8192, lm.Settings().hidden)
    assert len(known(100).class_of) == 100


def _net(top: int = 400, **more) -> lm.Net:
    counts = 1 + 4000 // np.arange(1, top + 101)
    share = np.cumsum(np.sqrt(counts[:top])) / np.sqrt(counts[:top]).sum()
    class_of = np.minimum((share * 12 - 1e-9).astype(np.int64), 11)
    words = lm.Words(np.arange(top + 100, dtype=np.uint64), counts, class_of, np.searchsorted(class_of, np.arange(13)), np.full(32, 3.0), int(counts.sum()), top + 100)
    return lm.Net(words, lm.Settings(**more))


def test_probabilities_of_all_words_add_up():
    """At the start they are the shares by count; after learning they add up to 1 still."""
    net, s = _net(), lm.Settings()
    rng = np.random.default_rng(5)
    ids, kind = rng.integers(-1, 400, 3000), rng.integers(0, 32, 3000)
    of_word = np.append(net.words.class_of, net.classes + np.arange(s.kinds))
    every = np.append(np.arange(400), np.full(s.kinds, -1))
    for learned in range(2):
        state = rng.standard_normal(s.hidden).astype(np.float32)
        lp, _, _ = net._output(np.tile(state, (len(every), 1)) * learned, of_word, every, False)
        assert abs(np.exp(lp).sum() - 1) < 1e-4
        if not learned:
            share = np.append(net.words.counts[:400] + 0.1, net.words.kind_mass)
            assert np.allclose(np.exp(lp), share / share.sum(), rtol=1e-3)
        net.run(ids, kind, np.full(30, 100), True)


def test_output_gradients():
    """Against differences of the log probability."""
    net, rng = _net(), np.random.default_rng(6)
    for name in ("wg", "wc", "ww", "bw"):
        net.p[name] += rng.standard_normal(net.p[name].shape).astype(np.float32) * np.float32(0.3)
    ids = rng.integers(-1, 400, 60)
    classes = np.where(ids >= 0, net.words.class_of[ids], net.classes + rng.integers(0, 32, 60))
    states = rng.standard_normal((60, net.settings.hidden)).astype(np.float32)
    _, grad, d_states = net._output(states, classes, ids, True)
    node, rows, odds = grad["words"]
    full = {"ww": np.zeros_like(net.p["ww"]), "bw": np.zeros_like(net.p["bw"]), **{k: grad[k] for k in ("wg", "bg", "wc", "bc")}}
    full["ww"][node], full["bw"][node] = rows, odds
    for name, g in [*full.items(), ("states", d_states)]:
        values = states if name == "states" else net.p[name]
        way = rng.standard_normal(values.shape).astype(np.float32)
        kept, lost = values.copy(), []
        for step in (np.float32(0.01), np.float32(-0.01)):
            values[...] = kept + step * way
            lost.append(-net._output(states, classes, ids, False)[0].sum())
        values[...] = kept
        assert np.isclose((g * way).sum(), (lost[0] - lost[1]) / 0.02, rtol=0.02, atol=0.02), name


def test_a_window_changes_few_weights():
    """Only splits on the way to words that occurred: their number grows with the depth, not with the words of a class."""
    net = _net()
    before = net.p["ww"].copy()
    net.run(np.array([399, 5, 399]), np.zeros(3, np.int64), np.array([3]), True)
    changed = np.flatnonzero((net.p["ww"] != before).any(1))
    assert 0 < len(changed) <= net.tree.depth[399] + net.tree.depth[5]
    deepest = np.bincount(net.words.class_of).max()
    assert net.tree.depth.max() <= 2 * np.log2(deepest) + 1


def test_network_without_top_words():
    counts = np.zeros(0, np.int64)
    words = lm.Words(np.zeros(0, np.uint64), counts, counts, np.zeros(49, np.int64), np.full(32, 0.1), 0, 0)
    net = lm.Net(words, lm.Settings())
    lp = net.run(np.full(7, -1), np.arange(7), np.array([3, 4]), True)
    assert np.isfinite(lp).all()


def test_only_changed_parameters_move(spark):
    """A word that one task alone reads is not drawn back by the others; one that none reads stays."""
    net = _net()
    start = net.values()
    names = [f"w{k}" for k in range(400)]
    texts = pa.array([" ".join(names)])
    hashes = lm.tokens(texts, 32)[0][:400]
    words = lm.Words(hashes, net.words.counts[:400], net.words.class_of, net.words.class_start, net.words.kind_mass, 9999, 400)
    of = np.concatenate([np.repeat(np.arange(400), 16), np.full(len(start) - 6400, -1)])  # embeddings come first
    alone = lm.train_round(spark.createDataFrame([("w7 w8 " * 50,)], "text string").coalesce(1), "text", words, net.settings, start)
    both = spark.createDataFrame([("w7 w8 " * 50,), ("w300 w301 " * 50,)], "text string").repartitionByRange(2, "text")
    made = lm.train_round(both, "text", words, net.settings, start)
    assert (made[of == 7] == alone[of == 7]).all() and (made[of == 7] != start[of == 7]).any()
    assert (made[of == 300] != start[of == 300]).any() and (made[of == 301] != start[of == 301]).any()
    assert (made[of == 9] == start[of == 9]).all()


def test_lines_with_odd_blanks_equal_plain_ones(spark):
    """Lines and windows are the same however words are set apart; lines are made without arrays of words, windows are hashed as rows."""
    plain = ["\n".join(f"{k} " + " ".join(f"x{k * j % 97}" for j in range(1, 14)) for k in range(a, a + 12)) for a in (0, 3, 40, 6)]
    odd = [f" \t{t}\r\n \x0b\n".replace(" ", "  ", 9).replace("x5 ", "x5\t").replace("\n", " \n\x0c ", 3) for t in plain]

    def both(texts):
        keyed = line_dedup._keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").withColumn("_text", F.lit(0))
        lines = line_dedup.text_lines(keyed, 50)
        return lines, line_dedup.near_words(keyed, lines, 50)

    shown = [both(plain), both(odd)]
    for a, b, columns in [(*[x[0] for x in shown], ["_id", "words", "since", "until", "hash"]), (*[x[1] for x in shown], ["_id", "start", "end", "key", "check"])]:
        rows = sorted(map(tuple, a.select(columns).collect()))
        assert len(rows) > 30 and rows == sorted(map(tuple, b.select(columns).collect()))
    plan = shown[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "explode(starts" in plan
