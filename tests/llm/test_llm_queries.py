"""The registered queries against SQL, or against plain versions where SQL can't say them."""

import json
import math
import zlib
from collections import Counter

import brute
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from conftest import DATA
from tokenizers import Tokenizer

import corpus_pipeline
from cohortspark.llm.queries import ORACLE, QUERIES
from cohortspark.session import written
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def docs():
    frame = pd.read_parquet(f"{DATA}/documents.parquet")
    return dict(zip(frame["doc_id"], frame["text"], strict=True))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    assert compare(spark, connect(DATA), DATA, name) is None


def test_names():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 14)]


def test_pieces(spark, docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op2_sentencepiece"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(lib.decode(ids)))


def test_quality(spark, docs):
    rows = QUERIES["op4_quality_rules"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute.quality_base(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_quality_keeps_good_and_drops_bad(spark):
    labels = pd.read_parquet(f"{DATA}/labels.parquet").set_index("doc_id")["quality"]
    kept = {r["doc_id"]: (r["kept"], r["base_failed"]) for r in QUERIES["op4_quality_rules"](spark, DATA).collect()}
    good = [kept[d][0] for d, q in labels.items() if q == 1 and not kept[d][1]]
    bad = [kept[d][0] for d, q in labels.items() if q == 0]
    assert sum(good) == len(good) and sum(bad) < len(bad) / 2


def test_scores(spark, docs):
    tokens = {i: [*brute.WORD.findall(brute.lower(t or "")), None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, distinct = sum(count.values()), len(count)
    rows = QUERIES["op6_lm_score"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(count[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
    model, base = (sum(r[c] for r in rows if r["held_out"]) for c in ("score", "base_score"))
    assert model > base


def packed_right(rows, texts):
    """Pieces are those of the texts, and sequences are gapless; returns the number of sequences over the plain bound."""
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for i, got in by_doc.items():
        ids = [*lib.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert sorted(got) == [(k, *p) for k, p in enumerate(brute.pieces(ids))]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by_sequence) - math.ceil(sum(r["length"] for r in rows) / 1024)


def test_packing(spark, docs):
    assert packed_right(QUERIES["op7_packing"](spark, DATA).collect(), docs) <= 2


def test_personal_data(spark, docs):
    rows = QUERIES["op10_pii"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = brute.pii_base(docs[r["doc_id"]])
        n = Counter(k for k, _, _ in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == (n["email"], n["ip"], n["card"], n["phone"], brute.sha(text))
        assert set(text.split(",")) <= set(r["spans"].split(",")) or not text


def test_pipeline_stage_by_stage(spark):
    """Each stage against the plain version of its operator, on its own input."""
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    names = frame.columns
    read = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = read(frame), None
        frame = written(stage(spark, frame, DATA), "stage")
        assert frame.columns == names
        after = read(frame)
        if name == "quality_rules":
            assert after == {i: before[i] for i in after}
            assert all(brute.quality_base(before[i])[5] is False for i in after)
        elif name == "line_dedup":
            want = brute.line_dedup(before)
            assert after == {i: t for i, (n, gone, t) in want.items() if gone == 0 or gone < n}
        elif name == "near_duplicates":
            assert after == {i: before[i] for i, (_, least) in brute.near(before, 5).items() if i == least}
        else:
            assert set(after) == set(before)
            for i, t in before.items():
                assert (after[i] == t) == (not brute.pii_base(t))
                assert not brute.pii_base(after[i])
        sizes = {r["doc_id"]: r["n_chars"] for r in frame.select("doc_id", "n_chars").collect()}
        assert name == "quality_rules" or all(sizes[i] == len(t) for i, t in after.items())
    packed_right(corpus_pipeline.STAGES[-1][1](spark, frame, DATA).collect(), read(frame))


def test_pipeline_runs_as_one(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert json.dumps(sorted({r["doc_id"] for r in rows}))[:1] == "["
    assert len(rows) >= len({r["doc_id"] for r in rows}) > 100
