"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import chat, components, line_dedup, lm, minhash, packing, pieces, pii, quality, urls, vectors
from cohortspark.session import get_session  # noqa: F401

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = packing.Settings(public_tokenizers.path("byte_bpe_50k.json"))
PASSAGE = " ".join(f"word{k}" for k in range(60))
OTHER = " ".join(f"term{k}" for k in range(80))
LONG = "\n".join(" ".join(f"w{k}x{j}" for k in range(40)) for j in range(800))
ROWS = [
    (1, PASSAGE, "en"), (2, OTHER + "\n" + PASSAGE, "en"), (3, None, None), (4, "", "xx"), (5, " \t\n ", "fr"), (6, "one", "de"),
    (7, LONG, "en"), (8, "a" * 60_000, "en"), (9, "one", "de"), (None, PASSAGE, "en"), (2, OTHER + "\n" + PASSAGE, "en"),
    (10, "漢字 🦆 \x00 ▁ é", "zz"), (11, "1.2.3.4 " * 3000, None), (12, "9" * 50_000 + " a@b." + "c." * 20_000, "en"),
]
SCHEMA = "doc_id long, text string, lang string"
CLASH = ["kept", "n_words", "ids", "decoded", "pii", "component_id", "node", "n_shingles", "n_lines", "n_removed", "sequence_id", "offset", "length",
         "piece", "host", "verdict", "signature", "bands", "again", "row"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_pieces(docs, clashing, none):
    rows = pieces.decode(pieces.encode(docs, PIECES), PIECES).collect()
    for r in rows:
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    assert by_id(rows)[3]["ids"] == [] and by_id(rows)[4]["ids"] == []
    assert pieces.encode(clashing, PIECES).select(F.sum(F.size("ids"))).first() == pieces.encode(docs, PIECES).select(F.sum(F.size("ids"))).first()
    assert pieces.decode(pieces.encode(none, PIECES), PIECES).count() == 0


def test_decode_odd_lists(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lists = [[], [3 + 0xC3, 300], [3 + 0xE6, 3 + 0xBC, 3 + 0xA2], [259, 300], [1, 2]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)] + [(9, None), (10, [300, None])], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in pieces.decode(df, PIECES).collect()}
    assert [got[k] for k in range(len(lists))] == [lib.decode(x) if x else "" for x in lists]
    assert got[9] == "" and got[10] == lib.decode([300])


def test_quality(docs, clashing, none):
    rows = by_id(quality.quality_rules(docs).collect())
    for i, text, _ in ROWS:
        got = tuple(rows[i][c] for c in (*quality.MEASURES, "base_failed"))
        assert got == brute.quality_base(text)
    assert rows[3]["kept"] is False
    assert quality.quality_rules(clashing).count() == len(ROWS)
    assert quality.quality_rules(none).count() == 0


def test_line_dedup(docs, clashing, none):
    rows = line_dedup.line_dedup(docs).collect()
    assert len(rows) == len(ROWS)
    got = by_id(rows)
    assert got[None]["text"] == PASSAGE  # a null number comes first
    assert got[1]["n_removed"] == 1 and got[1]["text"] == ""
    assert [r["text"] for r in rows if r["doc_id"] == 2] == [OTHER, OTHER]
    assert got[3]["text"] is None and got[3]["n_lines"] == 0
    assert got[7]["text"] == LONG and got[5]["text"] == " \t\n "
    out = line_dedup.line_dedup(clashing)
    assert out.columns == [c for c in clashing.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert out.count() == len(ROWS)
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_runs(spark):
    """Runs over several lines, blank lines inside, heads and tails shorter than a window, repeats within a text."""
    line = lambda k, n: " ".join(f"l{k}w{j}" for j in range(n))
    run = [line(1, 5), line(2, 30), "", line(3, 10), line(4, 30), line(5, 4)]
    texts = {
        1: "\n".join([line(4, 30), line(9, 60)]), 2: "\n".join([line(6, 3), *run, line(7, 9)]), 3: "\n".join([line(8, 2), *run, line(7, 9)]),
        4: "\n".join([line(10, 20)] * 9), 5: "\n".join(["  " + run[1], run[3] + " ", *run[4:], line(5, 4)]), 6: line(9, 60) + "\n" + line(9, 60), 7: line(5, 4),
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.line_dedup(df).collect()}
    assert got == brute.line_dedup(texts)
    assert got[3][2] == line(8, 2) and got[4][2] == line(10, 20)


def test_line_dedup_cut_lines(spark):
    """Passages that begin and end inside lines, with blanks of every kind, against all windows of all texts."""
    say = lambda a, n: " ".join(f"p{k}" for k in range(a, a + n))
    texts = {
        1: f"start here {say(0, 20)}\n{say(20, 12)}\n{say(32, 30)} and on\nlast one",
        2: f"other {say(0, 20)}\n\n  {say(20, 12).replace(' ', '  ')}\n{say(32, 30)} differs\nclosing words \n",
        3: f"{say(0, 20)} x\n{say(20, 12)}\ny {say(32, 30)}", 4: f"{say(0, 20)}\n{say(20, 12)}\n{say(32, 30)}",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    read = lambda out: {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in out.collect()}
    got = read(line_dedup.line_dedup(df))
    assert got == brute.line_dedup(texts)
    assert got[1][2] == texts[1] and got[2][2] == "other\ndiffers\nclosing words \n" and got[3][2] == texts[3] and got[4][2] == ""
    rng = np.random.default_rng(7)
    stock = [" ".join(rng.choice(["a", "b", "c", "d", "e"], rng.integers(0, 7))) for _ in range(12)]
    many = {}
    for i in range(60):
        lines = [stock[k] + ("" if rng.random() < 0.7 else " z") for k in rng.integers(0, 12, rng.integers(0, 12))]
        many[i] = str(rng.choice(["\n", "\n\n ", " \r\n"])).join(lines) + str(rng.choice(["", " ", "\n"]))
    df = spark.createDataFrame(list(many.items()), "doc_id long, text string").repartition(5)
    assert read(line_dedup.line_dedup(df, least_words=9)) == brute.line_dedup(many, 9)


def test_line_dedup_keeps_columns(docs):
    names = ["_id", "_text", "row", "kept", "cut", "flags", "runs", "hash", "since"]
    out = line_dedup.line_dedup(docs.withColumns({c: F.lit("mine") for c in names})).select(*names).distinct().collect()
    assert [tuple(r) for r in out] == [("mine",) * len(names)]


def test_near_duplicates(docs, clashing, none):
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = by_id(rows)
    assert got[1]["component_id"] == 1 and got[None]["component_id"] == 1 and got[None]["kept"] is False
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] == 2] == [(2, True)] * 2
    assert got[9]["component_id"] == 6 and got[9]["n_shingles"] == 1
    assert all(got[i]["component_id"] == i and got[i]["n_shingles"] == 0 and got[i]["kept"] for i in (3, 4, 5))
    out = minhash.near_duplicates(clashing)
    assert out.count() == len(ROWS) and out.columns[-3:] == ["n_shingles", "component_id", "kept"]
    assert minhash.near_duplicates(none).count() == 0
    names = ["node", "signature", "bands", "row", "id", "_group", "first_id"]
    out = minhash.near_duplicates(docs.withColumns({c: F.lit("mine") for c in names})).select(*names).distinct().collect()
    assert [tuple(r) for r in out] == [("mine",) * len(names)]


@pytest.mark.parametrize("crowd", [64, 2])
def test_near_duplicates_chain(spark, crowd):
    """Texts that each share enough with the next only: one group, as links lead on."""
    words = [f"v{k}" for k in range(400)]
    chain = {k: " ".join(words[12 * k: 12 * k + 140]) for k in range(20)}
    rng = np.random.default_rng(4)  # a cloud of copies with unlike numbers of edits
    base = [f"c{k}" for k in range(150)]
    for k in range(90):
        copy = list(base)
        for at in rng.integers(0, 150, k % 9):
            copy[at] = f"e{rng.integers(1 << 30)}"
        chain[300 + k] = " ".join(copy)
    apart = {100 + k: " ".join(words[30 * k: 30 * k + 60]) for k in range(10)}
    texts = chain | apart | {200: " ".join(words[:140]).upper(), 201: "x " + " ".join(words[:140])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = minhash.Settings(words=4, crowd=crowd, block=64_000 if crowd > 2 else 700)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, settings=settings).collect()}
    assert got == brute.near(texts, 4)
    assert got[19][1] == 0 and got[201][1] == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2050)]
    df = spark.createDataFrame([*edges, (5, 5), (None, 3), *edges[:9]], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df, "a", "b").collect()}
    edges = [(a, b) for a, b in edges if a != b]
    assert got == brute.groups({n for e in edges for n in e}, edges)
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


def test_scores(docs, clashing, none):
    rows = lm.lm_scores(docs).collect()
    assert len(rows) == len(ROWS)
    got = by_id(rows)
    assert got[3]["n_tokens"] == 1 and got[3]["base_score"] == got[4]["base_score"]
    assert all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in rows)
    assert lm.lm_scores(clashing).count() == len(ROWS)
    assert lm.lm_scores(none).count() == 0


def test_packing(docs, clashing, none):
    rows = packing.pack_documents(docs, BYTES, with_ids=True)
    held = packing.sequences(rows).collect()
    assert sum(len(r["ids"]) for r in held) == rows.agg(F.sum("length")).first()[0]
    assert max(len(r["ids"]) for r in held) <= 1024
    got = [(r["length"], r["piece"]) for r in rows.filter("doc_id IN (3, 4)").collect()]
    assert got == [(1, 0)] * 2
    assert packing.pack_documents(clashing, BYTES).count() == rows.count()
    assert packing.pack_documents(none, BYTES).count() == 0


def test_personal_data(docs, clashing, none):
    rows = pii.find_pii(docs).collect()
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["pii"] if s["kind"] in pii.BASE] == brute.pii_base(r["text"])
    assert by_id(rows)[3]["pii"] == []
    assert pii.find_pii(clashing).count() == len(ROWS)
    assert pii.find_pii(none).count() == 0
    red = by_id(pii.redact_pii(docs).collect())
    assert red[3]["text"] is None and red[11]["text"] == "<IP> " * 3000 and red[7]["text"] == LONG


def test_personal_data_cases(spark):
    texts = [
        "account DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01", "amex card 3782 822463 10005", "3782 822463 10005", "ssn 123-45-6789 or 000-45-6789",
        "123-45-6789", "a@b.c@d.e _x@y.com", "a..b@c..d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255", "4111 1111-1111 1111 4111111111111112",
        "+1 (555) 000-1234 +1 2 +(1) 555", "漢 x@y.z é 1.1.1.1", "+4111111111111111",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in pii.find_pii(df).collect()}
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == brute.pii_base(text)
    added = {i: [text[a:b] for k, a, b in got[i] if k not in pii.BASE] for i, text in enumerate(texts)}
    assert added[0] == ["DE89 3704 0044 0532 0130 00"]
    assert added[1] == ["3782 822463 10005"] and added[2] == []
    assert added[3] == ["123-45-6789"] and added[4] == []


def test_urls(spark):
    given = [
        None, "", "no-scheme.com/x", "http://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/2?x", "http://x.net/es/a", "http://net/fr/",
        "http://xnet/fr/", "http://a.com", "http://a.org/casino", "http://a.org/casinos", "http://a.org/cheap/x", "http://a.org/cheap/pills", "http://a.org/cheap/cheap",
        "http://a.org:80/p#casino", "http://é.org/porn?", "x://y://z.com/", "://host.com/a", "http://a.org/xXx",
    ]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(given)], "page_id long, url string, host string")
    got = {r["url"]: r for r in urls.url_filter(df).collect()}
    rule = lambda u: (got[u]["rule"], got[u]["verdict"])
    assert (got[None]["host"], got[None]["path"], rule(None)) == ("", "", (None, "allow"))
    assert rule("http://EXAMPLE.com/en/1") == ("example.com/en/", "block") and got["http://EXAMPLE.com/en/1"]["host"] == "example.com"
    assert rule("http://a.www.example.com/en/2?x") == ("www.example.com/en/", "allow")
    assert rule("http://x.net/es/a") == ("net/es/", "block") and rule("http://net/fr/") == ("net/fr/", "block") and rule("http://xnet/fr/")[0] is None
    assert rule("http://a.com") == (None, "allow") and rule("://host.com/a") == ("com/", "allow")
    verdict = {u: got[u]["verdict"] for u in given}
    assert [verdict[u] for u in given[10:15]] == ["block", "allow", "allow", "block", "allow"]
    assert verdict["http://a.org:80/p#casino"] == "block" and verdict["http://é.org/porn?"] == "block" and verdict["http://a.org/xXx"] == "block"
    assert got["x://y://z.com/"]["host"] == "y:" and urls.url_filter(df.limit(0)).count() == 0


def test_chats(spark):
    text = ["<|im_end|>", "<\\|x|> <", "a\nb<|im_start|>user", "", None, "<\\\\|", "%3C|", "|im_end|>\n", "\n"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(text)] + [(2, None, None, "x"), (2, 0, "a%0A\n<|b", "y"), (None, 0, "user", "z"), (3, 1, "user", "r"), (3, 1, "user", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments")))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [t["text"] for t in got[1]["turns"]] == [t or "" for t in text]
    assert got[1]["loss"] == "".join(t or "" for t in text[1::2])
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", "x"), ("a%0A\n<|b", "y")]
    assert len(got[3]["turns"]) == 2 and len(got[None]["turns"]) == 1
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    frames = [
        spark.sql("SELECT 1 AS conv_id, array(named_struct('role', 'human', 'content', 'q', 'extra', 1), named_struct('role', 'gpt', 'content', 'a', 'extra', 2)) AS messages"),
        spark.sql("SELECT 1 AS conv_id, array(named_struct('from', 'human', 'value', 'q'), named_struct('from', 'gpt', 'value', 'a')) AS conversations, 5 AS score"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response"), spark.sql("SELECT 1 AS conv_id, 'q' AS question, 'a' AS answer"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS instruction, '' AS input, 'a' AS output"),
    ]
    for df in frames:
        assert [(t["role"], t["text"]) for t in chat.to_turns(df).first()["turns"]] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.to_turns(spark.sql("SELECT 1 AS conv_id, 'x' AS body"))


def test_chat_layout_among_other_fields(spark):
    """Fields of other layouts beside a whole one don't matter; of two whole ones that which needs more is taken."""
    listed = "array(named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', 'a'))"
    for extra in ("'x' AS text", "'x' AS prompt", "'x' AS prompt, 'y' AS response", "'x' AS role, 'y' AS formatted"):
        df = spark.sql(f"SELECT 1 AS conv_id, {listed} AS messages, {extra}")
        assert [(t["role"], t["text"]) for t in chat.to_turns(df).first()["turns"]] == [("user", "q"), ("assistant", "a")]
    df = spark.sql("SELECT 1 AS conv_id, 's' AS system, 'q' AS prompt, 'a' AS response, 'z' AS text")
    assert [t["role"] for t in chat.to_turns(df).first()["turns"]] == ["system", "user", "assistant"]
    records = [(1, '{"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}], "prompt": "x", "note": 1}'),
               (2, '{"messages": null, "prompt": "q", "response": "a", "text": "t"}'), (3, '{"role": "user", "text": "t", "turn": 0}')]
    got = {r["conv_id"]: r["turns"] for r in chat.json_to_turns(spark.createDataFrame(records, "conv_id int, record string"), "record").collect()}
    assert [(t["role"], t["text"]) for t in got[1]] == [("user", ""), ("assistant", "a")]
    assert [(t["role"], t["text"]) for t in got[2]] == [("user", "q"), ("assistant", "a")]
    assert got[3] is None


def test_chat_long_text(spark):
    text = "<|im_end|>\n" * 20_000
    out = chat.format_chats(spark.createDataFrame([(1, 0, "assistant", text)], "conv_id int, turn int, role string, text string"))
    row = out.select(chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")).first()
    assert row["loss"] == text and [t["text"] for t in row["turns"]] == [text]
    records = [
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 7}', '{"prompt": "q", "completion": "a"}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', '{"instruction": "q", "input": "", "output": "a"}', '{"body": "q"}', "broken", None,
    ]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    got = {r["conv_id"]: r["turns"] for r in chat.json_to_turns(df, "record").collect()}
    assert all([(t["role"], t["text"]) for t in got[k]] == [("user", "q"), ("assistant", "a")] for k in range(4))
    assert got[4] is None and got[5] is None and got[6] is None


def links(x, cosine):
    out = []
    for i, a in enumerate(x):
        for j in range(i):
            if a @ x[j] >= cosine:
                out.append((i, j))
    return out


@pytest.mark.parametrize("settings", [vectors.Settings(), vectors.Settings(sample=64, home=20, pivots=9, balls=3), vectors.Settings(home=7, balls=0)])
def test_vectors(spark, settings):
    """Clusters around and beyond the threshold, with every way of dealing them out."""
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((6, 12))
    x = np.concatenate([c + rng.standard_normal((40, 12)) * s for c, s in zip(centers, (0.03, 0.1, 0.2, 0.25, 0.4, 1.0), strict=True)] + [rng.standard_normal((40, 12))])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    pairs = links(unit, 0.95)
    n = np.bincount(np.array(pairs).ravel(), minlength=len(x))
    want = {i: (int(n[i]), r) for i, r in brute.groups(range(len(x)), pairs).items()}
    odd = [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [None] + [1.0] * 11), (1004, [float("nan")] + [1.0] * 11), (1005, [float("inf")] * 12)]
    want |= {i: (0, i) for i, _ in odd}
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + odd
    df = spark.createDataFrame([*rows, rows[3], (None, [1e-200] * 12)], "vec_id long, embedding array<double>").withColumn("row", F.lit(1))
    got = vectors.near_vectors(df, settings=settings).collect()
    assert len(got) == len(rows) + 2
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert [tuple(r)[1:] for r in vectors.near_vectors(df.filter("vec_id >= 1000")).orderBy("vec_id").collect()] == [(0, i, True) for i, _ in odd]


def test_quality_without_common_words(spark):
    """A long text without a common word goes; a short one, and one in a table without common words at all, stays."""
    some = "the of and to in is that it for was".split()
    noun = lambda *k: "noun" + "".join(chr(97 + x % 26) for x in k)
    texts = [" ".join(f"{some[(i + k) % 10]} {noun(i, k, k // 26)} {noun(k, i, 1)} {noun(k, 2, i)}" for k in range(20 + i)) for i in range(26)]
    bare = lambda n: " ".join(f"key{chr(97 + k // 26)}{chr(97 + k % 26)} noun{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))
    rows = [*((i, t, "en") for i, t in enumerate(texts)), (100, bare(40), "en"), (101, bare(10), "en"), (102, bare(40), "xx"), (103, bare(40) + " the", "xx")]
    got = by_id(quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect())
    assert all(got[i]["kept"] for i in range(len(texts)))
    assert got[100]["word_distance"] < 0.5 and not got[100]["base_failed"] and not got[100]["kept"]
    assert got[101]["kept"] and got[102]["kept"] and got[103]["kept"]


def test_account_numbers_before_a_short_word(spark):
    numbers = ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BE68 5390 0754 7034", "NO93 8601 1117 947",
               "GB29 NWBK 6016 1331 9268 19", "MT84MALT011000012345MTLCAST001S"]
    texts = [f"{n}{after}" for n in numbers for after in (" BIC CAIX", " EUR 50", " X", " 2024", ".", "")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        assert [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["pii"] if s["kind"] == "iban"] == [numbers[r["doc_id"] // 6]]
    assert all(r["text"].startswith("<IBAN>") for r in pii.redact_pii(df, kinds=tuple(k for k in pii.KINDS if k.name == "iban")).collect())


def test_near_stage_keeps_one_row_of_each_group(spark):
    """Null numbers, repeated rows, and two texts under one number."""
    import corpus_pipeline

    rows = [(None, PASSAGE + " end", 0), (5, PASSAGE, 0), (6, OTHER, 0), (6, OTHER, 0), (7, PASSAGE + " more", 0), (7, LONG, 0), (None, "x y z " + "q " * 9, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({"_row": F.lit("r"), "row": F.lit("s")})
    got = corpus_pipeline.near_stage(spark, df, "")
    assert got.columns == df.columns and [tuple(r) for r in got.select("_row", "row").distinct().collect()] == [("r", "s")]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == sorted([(5, PASSAGE), (6, OTHER), (7, LONG), (0, rows[-1][1])])
