"""The queries of this subpackage: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, line_dedup, lm, minhash, packing, pieces, pii, quality, sharding, trie, urls, vectors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def sha256(text) -> F.Column:
    return F.sha2(text, 256)


_LEAST = line_dedup.LEAST_WORDS


@query("op1_line_dedup", rf"""
    WITH words AS (
        SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{line_dedup.PIECE}') AS pieces FROM documents)
    ), tokens AS (
        SELECT *, regexp_extract(piece, '{line_dedup.WORD}') AS word, contains(piece, chr(10)) AS broken, (i = 0 OR contains(piece, chr(10)))::INT AS fresh FROM words
    ), numbered AS (
        SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS line FROM tokens
    ), lines AS (
        SELECT doc_id, min(i) AS since, max(i) + 1 AS until, string_agg(word, ' ' ORDER BY i) AS body FROM numbered GROUP BY doc_id, line
    ), windows AS (
        SELECT doc_id, min(since) OVER w AS a, max(until) OVER w - 1 AS z, array_to_string(list(body) OVER w, chr(10)) AS body, 'lines' AS kind, TRUE AS valid
        FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY since RANGE BETWEEN CURRENT ROW AND {_LEAST - 1} FOLLOWING)
        UNION
        SELECT doc_id, min(since) OVER w, max(until) OVER w - 1, array_to_string(list(body) OVER w, chr(10)), 'lines', TRUE
        FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY until RANGE BETWEEN {_LEAST - 1} PRECEDING AND CURRENT ROW)
        UNION ALL
        SELECT doc_id, i, i + {_LEAST - 1}, word || ' ' || array_to_string(list(CASE WHEN fresh = 1 THEN chr(10) ELSE '' END || word) OVER w, ' '),
            'words', sum(fresh) OVER w >= 2
        FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND {_LEAST - 1} FOLLOWING)
    ), counted AS (
        SELECT w.* FROM windows w JOIN (SELECT doc_id, count(*) AS total FROM tokens GROUP BY doc_id) t USING (doc_id) WHERE valid AND z < total AND z - a + 1 >= {_LEAST}
    ), repeats AS (
        SELECT doc_id, a, z FROM (SELECT *, row_number() OVER (PARTITION BY kind, body ORDER BY doc_id, a) AS nth FROM counted) WHERE nth > 1
    ), stepped AS (
        SELECT *, a > coalesce(max(z) OVER (PARTITION BY doc_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -2) + 1 AS new FROM repeats
    ), runs AS (
        SELECT doc_id, min(a) AS a, max(z) AS z
        FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS run FROM stepped) GROUP BY doc_id, run
    ), judged AS (
        SELECT t.*, r.doc_id IS NOT NULL AS gone FROM tokens t LEFT JOIN runs r ON r.doc_id = t.doc_id AND t.i BETWEEN r.a AND r.z
    ), placed AS (
        SELECT *, lag(gone, 1, FALSE) OVER (PARTITION BY doc_id ORDER BY i) AS after_run,
            sum((NOT gone)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS nth, max(i) OVER (PARTITION BY doc_id) AS final
        FROM judged
    ), joined AS (
        SELECT doc_id, count(*) FILTER (gone) AS n_gone, bool_or(gone AND i = final) AS ends_gone, string_agg(
            CASE WHEN nth = 1 AND after_run THEN word WHEN after_run AND NOT broken THEN chr(10) || word ELSE piece END, '' ORDER BY i) FILTER (NOT gone) AS text
        FROM placed GROUP BY doc_id
    ), made AS (
        SELECT doc_id, d.text AS old, CASE WHEN coalesce(n_gone, 0) = 0 THEN d.text
            ELSE coalesce(j.text, '') || CASE WHEN ends_gone THEN '' ELSE regexp_extract(d.text, '[\x20\x09-\x0D]*$') END END AS text
        FROM documents d LEFT JOIN joined j USING (doc_id)
    ), sized AS (
        SELECT *, len(list_filter(string_split(coalesce(old, ''), chr(10)), lambda x: regexp_matches(x, '{line_dedup.WORD}'))) AS n_lines,
            len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{line_dedup.WORD}'))) AS left_lines
        FROM made
    )
    SELECT doc_id, n_lines, n_lines - left_lines AS n_removed, length(text) AS n_chars, sha256(text) AS text_sha256 FROM sized
""")
def line_dedup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without later copies of runs of 50 words or more."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"), sha256("text").alias("text_sha256"))


@query("op2_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the 32k piece model, and the text decoded from them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = pieces.encode(table(spark, sf_dir, "documents", "doc_id", "text"), path).select("doc_id", "ids")
    return pieces.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256(F.array_join("ids", ",")).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


@query("op3_chat_format", r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    ), measured AS (
        SELECT *, length('<|im_start|>' || replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') || chr(10) || text || '<|im_end|>' || chr(10))
            + len(regexp_extract_all(text, '<\\*\|')) AS written
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(written) AS BIGINT) AS formatted_chars
    FROM measured GROUP BY conv_id
""")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the control strings; the numbers are read back from the output."""
    bad = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.array(
        F.struct(F.lit("user").alias("role"), bad.alias("content")),
        F.struct(F.lit("assistant").alias("role"), bad.alias("content"))).alias("messages"))
    stored = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    out = chat.render(chat.to_turns(stored).union(chat.to_turns(extra)))
    out = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha256(told).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), sha256("loss").alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op4_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances and the verdict on every text."""
    out = quality.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.drop("text", "lang")


_TERM = r"(^|[^a-z0-9]){}($|[^a-z0-9])"


def _soft_sql() -> str:
    return " + ".join(f"regexp_matches(rest, '{_TERM.format(t)}')::int" for t in urls.SOFT)


@query("op5_minhash", r"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM worded
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
    ), reached AS (
        SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON other = a
    ), named AS (
        SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM named LEFT JOIN sizes USING (doc_id)
""")
def minhash_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on shingles of four words."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), settings=minhash.Settings(words=4))


@query("op6_lm_score")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every text; nine tenths of the documents train."""
    return lm.lm_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_packing")
def packing_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as pieces in sequences of at most 1024 tokens."""
    settings = packing.Settings(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), settings)


@query("op8_url_filter", rf"""
    WITH parts AS (
        SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
            contains(coalesce(url, ''), '://') AS whole,
            CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
        FROM pages
    ), split AS (
        SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path,
            CASE WHEN whole THEN substr(low, strpos(low, '://') + 3) ELSE low END AS rest
        FROM parts
    ), judged AS (
        SELECT page_id, host, path,
            CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                 WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
            CAST({" + ".join(f"regexp_matches(rest, '{_TERM.format(t)}')::int" for t in urls.STRICT)} AS BIGINT) AS strict_hits,
            CAST({_soft_sql()} AS BIGINT) AS soft_hits
        FROM split
    )
    SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN strict_hits > 0 OR soft_hits >= {urls.SOFT_HITS} THEN 'block' ELSE 'allow' END AS verdict
    FROM judged
""")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return urls.url_filter(table(spark, sf_dir, "pages", "page_id", "url")).drop("url")


@query("op9_near_vectors", """
    WITH RECURSIVE usable AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95
    ), reached AS (
        SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reached JOIN links ON other = a
    )
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
    FROM reached GROUP BY vec_id
""")
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.95 or more, and groups, of all vectors."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op10_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base kinds, and all spans, of every text."""
    out = pii.find_pii(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "pii")
    counts = [pii.count_kind(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE]
    base = pii.spans_text(pii.only(F.col("pii"), pii.BASE))
    added = [pii.count_kind(F.col("pii"), k.name).alias(f"n_{k.name}") for k in pii.KINDS if k.name not in pii.BASE]
    return out.select("doc_id", *counts, sha256(base).alias("base_sha256"), pii.spans_text(F.col("pii")).alias("spans"), *added)


def _rounds_sql(n: int) -> str:
    """Common table expressions of ``n`` rounds and a last assignment, over ``vectors`` and ``centroids0`` in long form."""
    out = []
    for k in range(n + 1):
        out.append(f"""measured{k} AS MATERIALIZED (
        SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS distance FROM vectors JOIN centroids{k} USING (d) GROUP BY rid, c
    ), assigned{k} AS MATERIALIZED (
        SELECT rid, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM measured{k} GROUP BY rid
    )""")
        if k < n:
            out.append(f"""means{k} AS (
        SELECT c, d, sum(x)::BIGINT AS s, count(*) AS m FROM vectors JOIN assigned{k} USING (rid) GROUP BY c, d
    ), centroids{k + 1} AS MATERIALIZED (
        SELECT c, d, coalesce((s - (s % m + m) % m) // m, y) AS y FROM centroids{k} LEFT JOIN means{k} USING (c, d)
    )""")
    return ", ".join(out)


@query("op11_centroids", f"""
    WITH usable AS (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS w FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    ), vectors AS MATERIALIZED (
        SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS d FROM usable
    ), centroids0 AS MATERIALIZED (
        SELECT nth - 1 AS c, unnest(w) AS y, generate_subscripts(w, 1) AS d
        FROM (SELECT w, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), w) AS nth FROM usable) WHERE nth <= 40
    ), {_rounds_sql(5)}, told AS (
        SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM centroids5 GROUP BY c
    )
    SELECT vec_id, c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
    FROM assigned5 JOIN usable USING (rid) JOIN told USING (c)
""")
def centroids_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters after five rounds."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


#: What each bit of a byte adds to a checksum, and 2**64.
_BYTE_BITS = (1996959894, 3993919788, 124634137, 249268274, 498536548, 997073096, 1994146192, 3988292384)
_WHOLE = 1 << 64


def _crc32_sql(data: str) -> str:
    """The unsigned checksum of a blob, byte after byte."""
    folded = "c >> 8"
    for k, v in enumerate(_BYTE_BITS):
        folded = f"xor({folded}, ((xor(c, x) >> {k}) & 1) * {v})"
    octets = f"list_transform(range(0, length(hex({data})), 2), lambda i: ('0x' || hex({data})[i + 1:i + 2])::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, x: {folded}), 4294967295)"


@query("op13_sharding", rf"""
    WITH RECURSIVE jumps AS (
        SELECT doc_id, shards, (coalesce(doc_id, 0)::HUGEINT + {_WHOLE}) % {_WHOLE} AS key, 0::BIGINT AS now, 0::BIGINT AS goes
        FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (40), (41)) AS counts(shards)
        UNION ALL
        SELECT doc_id, shards, drawn, goes, floor((goes + 1) * (2147483648::DOUBLE / ((drawn >> 33) + 1)::DOUBLE))::BIGINT
        FROM (SELECT *, (key * {sharding.MULTIPLIER} + 1) % {_WHOLE} AS drawn FROM jumps WHERE goes < shards)
    ), placed AS (
        SELECT doc_id, CAST(max(now) FILTER (shards = 40) AS INT) AS shard, CAST(max(now) FILTER (shards = 41) AS INT) AS grown_shard FROM jumps GROUP BY doc_id
    ), sized AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {_crc32_sql("encode(coalesce(text, ''))")} AS text_crc32 FROM documents
    )
    SELECT d.doc_id, size, text_crc32, 'key' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
    FROM sized d JOIN placed p ON d.doc_id IS NOT DISTINCT FROM p.doc_id
""")
def sharding_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by their number, and where each would be with one shard more."""
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), 40)


@query("op12_prefix_trie", rf"""
    WITH told AS (
        SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS told,
            len(regexp_extract_all(coalesce(text, ''), '{trie.WORD}')) AS words
        FROM conversations WHERE conv_id IS NOT NULL
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, told) AS pos FROM told
    ), ids AS (
        SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32_sql("encode(conv_id::VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM told)
    ), taken AS (
        SELECT i.conv_id, 0 AS part, pos, told, words FROM ids i JOIN placed p ON p.conv_id = base AND pos <= h
        UNION ALL SELECT i.conv_id, 1, pos, told, words FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND pos > h
    ), rebuilt AS (
        SELECT i.conv_id, coalesce(list(told ORDER BY part, pos) FILTER (told IS NOT NULL), []) AS t, list(words ORDER BY part, pos) AS w
        FROM ids i LEFT JOIN taken USING (conv_id) GROUP BY i.conv_id
    ), members AS (
        SELECT conv_id, d, array_to_string(t[1:d], '') AS prefix, t, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words, len(t) = d AS ends
        FROM rebuilt, unnest(generate_series(0, len(t))) AS depths(d)
    ), nodes AS (
        SELECT prefix, d, min(conv_id) AS conv_id, any_value(t[1:d]) AS path, any_value(words) AS words, count(*) AS n_convs,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM members GROUP BY prefix, d
    ), parents AS (
        SELECT n.*, array_to_string(path[1:d - 1], '') AS up FROM nodes n
    ), children AS (
        SELECT up AS prefix, count(*) AS n_children FROM parents WHERE d > 0 GROUP BY up
    ), whole AS (
        SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children USING (prefix)
    ), below AS (
        SELECT array_to_string(path[1:k], '') AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
        FROM whole, unnest(generate_series(0, d)) AS depths(k) GROUP BY 1
    )
    SELECT n.conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN u.conv_id END AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM whole n JOIN below USING (prefix) JOIN nodes u ON u.prefix = n.up
""")
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
