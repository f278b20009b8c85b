"""Registered queries of the training-data operators: thin functions that read whole
tables, call the operator with production parameters and keep the contract's columns."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgtriage.llm import crosstok, hilbert, html_text, langid, merkle, nbsvm, pii, token_files
from msgtriage.llm.decontaminate import report, scan
from msgtriage.llm.mixing import copies
from msgtriage.llm.ngram_join import jaccard_components
from msgtriage.llm.va_topk import search
from msgtriage.llm.warc import read_archives, write_archives
from msgtriage.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZERS = "/opt/tokenizers"  # vocabulary files of public tokenizers; only the driver reads them

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import the package from the folder the driver has it in, where they
    can see that folder (a local run, a shared installation); elsewhere the package
    is shipped with ``--py-files`` as usual."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=5, threshold=80)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)).drop("longest")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("size") * F.col("n_copies")).alias("taken")
    return copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken)


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    held_out = F.coalesce(rest == 0, F.lit(False))
    model = langid.fit(docs.where(rest != 0), langid.vocabulary_pieces(f"{TOKENIZERS}/piece_bpe_32k.model"))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(rest != 1)
    chosen = F.broadcast(nbsvm.sample(labels, "doc_id"))  # MAX_ROWS ids or so
    model = nbsvm.fit(docs.join(chosen, "doc_id"))
    scored = nbsvm.score(docs.select("doc_id", "text", F.coalesce(rest == 1, F.lit(False)).alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


ORACLE_SQL["op9_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
WHERE rank <= 10
"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages"), min_bytes=1000), html=False).drop("html", "url")


ORACLE_SQL["op2_warc"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_files.read_ranks(f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken")
    return token_files.count_tokens(table(spark, sf_dir, "documents"), ranks, separator=50256)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.verify(docs, tampered, F.replace("text", F.lit("\n"), F.lit("")))


ORACLE_SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE
d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, source,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 2 = 0 AS tampered,
    list_reduce(list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
      lambda v: CASE WHEN v IS NULL THEN '-' ELSE concat(octet_length(encode(v)), ':', v) END), lambda a, b: a || b) AS head,
    text, replace(text, chr(10), '') AS cut
  FROM documents),
h AS MATERIALIZED (
  SELECT row, doc_id, source,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE concat(octet_length(encode(text)), ':', text) END) AS leaf,
    CASE WHEN tampered THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE concat(octet_length(encode(cut)), ':', cut) END) END AS copy
  FROM d),
p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM h),
nodes AS (
  SELECT tree, CAST(0 AS BIGINT) AS level, rank AS i, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM p
  UNION ALL
  SELECT tree, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3, n),
above AS (
  SELECT CAST(0 AS BIGINT) AS level, tree AS i, digest, (SELECT max(tree) + 1 FROM p) AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3
  FROM above WHERE n > 1 GROUP BY level, i // 3, n),
ups AS MATERIALIZED (SELECT *, i // 3 AS run FROM above WHERE n > 1),
downs AS MATERIALIZED (SELECT *, i // 3 AS run FROM nodes WHERE n > 1),
levels AS (SELECT DISTINCT tree, level, CAST(3 AS BIGINT) ** level AS w FROM downs),
steps AS (
  SELECT row, 0 AS part, l.level, string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < rank // w) AS a, string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > rank // w) AS b
  FROM (SELECT row, p.tree, rank, level, CAST(w AS BIGINT) AS w FROM p JOIN levels ON levels.tree = p.tree) l
  JOIN downs s ON s.tree = l.tree AND s.level = l.level AND s.run = rank // (w * 3) GROUP BY ALL
  UNION ALL
  SELECT row, 1, l.level, string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < tree // w), string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > tree // w)
  FROM (SELECT row, tree, level, CAST(CAST(3 AS BIGINT) ** level AS BIGINT) AS w FROM p, (SELECT DISTINCT level FROM ups) x) l
  JOIN ups s ON s.level = l.level AND s.run = tree // (w * 3) GROUP BY ALL),
paths AS (
  SELECT p.row, doc_id, leaf, copy, tree,
    coalesce(list([coalesce(a, ''), coalesce(b, '')] ORDER BY part, steps.level) FILTER (part IS NOT NULL), []) AS path
  FROM p LEFT JOIN steps ON steps.row = p.row GROUP BY ALL),
folded AS (
  SELECT *, coalesce(list_reduce(list_concat([[coalesce(copy, leaf), '']], path), lambda x, s: [sha256(s[1] || x[1] || s[2]), '']), [leaf])[1] AS folded_root,
    sha256(array_to_string(list_transform(path, lambda s: s[1] || s[2]), '')) AS proof_sha256
  FROM paths),
root AS (SELECT digest AS root FROM above WHERE n = 1)
SELECT doc_id, leaf, t.digest AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM folded JOIN (SELECT tree, digest FROM nodes WHERE n = 1) t ON t.tree = folded.tree, root
"""


@query
def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hilbert.measured(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "size", "text_crc32")
    out = hilbert.assign(materialize(docs, "shard-rows"), ties=("text_crc32", "doc_id"), shards=24)
    unlike_key = F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", unlike_key)


_STEPS = 1 << hilbert.BITS

ORACLE_SQL["op12_hilbert_shards"] = rf"""
WITH b AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, source, lang, encode(coalesce(text, '')) AS bytes FROM documents),
chars AS MATERIALIZED (SELECT row, list_transform(regexp_extract_all(hex(bytes), '..'), lambda h: CAST(concat('0x', h) AS BIGINT)) AS l FROM b),
crc AS MATERIALIZED (
  SELECT row, xor(list_reduce(list_concat([4294967295], l),
    lambda c, x: list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS text_crc32 FROM chars),
s AS MATERIALIZED (
  SELECT row, octet_length(bytes) + 8 AS size FROM b),
x AS (SELECT min(ln(1 + CAST(size AS DOUBLE))) AS low, max(ln(1 + CAST(size AS DOUBLE))) AS high, count(*) AS n FROM s),
c AS (
  SELECT b.row, doc_id, size, n,
    (dense_rank() OVER (ORDER BY source NULLS FIRST) - 1) * {_STEPS} // (SELECT count(DISTINCT coalesce(source, chr(0))) FROM b) AS p,
    (dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1) * {_STEPS} // (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM b) AS q,
    CASE WHEN high > low THEN least(CAST(floor((ln(1 + CAST(size AS DOUBLE)) - low) / (high - low) * {_STEPS}) AS BIGINT), {_STEPS - 1}) ELSE 0 END AS r
  FROM b JOIN s ON s.row = b.row, x),
h AS (
  SELECT row, list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform({list(range(hilbert.BITS))[::-1]}, lambda k: ((p >> k) & 1) + 2 * ((q >> k) & 1) + 4 * ((r >> k) & 1))),
    lambda a, v: (a >> 8) * 2048 + {hilbert.curve_table(3)}[(a & 255) * 8 + v + 1]) >> 8 AS curve FROM c),
o AS (
  SELECT doc_id, size, text_crc32, n, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS FIRST) - 1 AS place
  FROM c JOIN h ON h.row = c.row JOIN crc ON crc.row = c.row)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 24 // n AS INTEGER) AS shard,
  place - (place * 24 // n * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM o
"""


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = crosstok.read_vocabularies(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    aligned = crosstok.align(table(spark, sf_dir, "documents"), *files)
    return crosstok.report(aligned, crosstok.pair_counts(aligned, crosstok.piece_count(files[1])))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op4_decontamination"] = rf"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0) x),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM win) s WHERE len(w) >= k) x),
hits AS MATERIALIZED (SELECT doc_id, p, grams.k AS k, item FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) x GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

ORACLE_SQL["op8_ngram_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' '))) END AS s FROM w),
u AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * i >= 80 * (len(a.s) + len(b.s) - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS root, doc_id AS d FROM documents UNION SELECT root, e.y FROM r JOIN e ON r.d = e.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT d, min(root) AS component_id FROM r GROUP BY d) c ON c.d = s.doc_id
"""
