"""The registered queries of this subpackage: thin applications of its operators to the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import discriminant, fixity, mixing, negatives, neighbours, packing, rules, simhash, suffix, topk, toxicity, trie, urls
from tidelake.llm.shared import WORD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, mod: int):
    """crc32 of an id as text, modulo ``mod`` (null ids: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def damaged(records: DataFrame) -> DataFrame:
    """A second replica that lost some records and changed others, by the MD5 of their ids."""
    lot = F.substring(F.md5(F.col("record_id").cast("string").cast("binary")), 1, 2)
    flipped = F.concat(F.lit(b"X"), F.expr("substring(block, 2)"))
    cut = F.expr("substring(block, 1, octet_length(block) - 2)")
    return records.where(lot != "01").withColumn("block", F.when(lot == "00", flipped).when(lot == "02", cut).otherwise(F.col("block")))


def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two replicas of the WARC records of all pages, one of them damaged, and the audit of both."""
    records = fixity.warc_records(table(spark, sf_dir, "pages"))
    found = fixity.audit(records, damaged(records))
    return found.select(F.col("record_id").alias("page_id"), "kind", "length", "other_length")


#: op1 in DuckDB: which records the replica lost or changed, and their lengths.
OP1_SQL = r"""
WITH sizes AS (
  SELECT page_id, substr(md5(page_id::VARCHAR), 1, 2) AS lot,
         (101 + strlen(coalesce(url, '')) + strlen(page_id::VARCHAR) + strlen(strlen(coalesce(html, ''))::VARCHAR) + strlen(coalesce(html, '')) + 4)::BIGINT AS length
  FROM pages
)
SELECT page_id, CASE lot WHEN '00' THEN 'changed' WHEN '01' THEN 'missing' ELSE 'resized' END AS kind, length,
       CASE lot WHEN '00' THEN length WHEN '02' THEN length - 2 END AS other_length
FROM sizes WHERE lot IN ('00', '01', '02')
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document; null texts have fingerprint 0."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without what a 400-byte string covers that also starts elsewhere; kept is what is
    left as text.  Null texts count as empty."""
    out = suffix.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), suffix.readable(F.col("kept")).alias("kept"))


def op4_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; null texts are scored by their zeros, null ids are not held out."""
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2)
    out = discriminant.scored(table(spark, sf_dir, "documents"), labels)
    return out.select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= discriminant.ACCEPT).cast("int").alias("predicted"),
    )


def toxic_model(docs: DataFrame, labels: DataFrame) -> dict:
    """The model of op5: nothing is learned from held-out rows."""
    return toxicity.learn(docs, labels.where(crc_mod("doc_id", 3) != 1))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; null texts get the base score, null ids are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector id; vectors that are null, zero or not finite take no part."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


#: Rules of op7: host, path, verdict (fixed values).
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
#: Words in a host's name that put the host on op7's list (fixed values).
LISTED_WORDS = ("spam", "pills", "casino")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages under the rules; where none fits, hosts named after spam are listed."""
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_replace(urls.host_of(F.coalesce("url", F.lit(""))), r"^(www|blog|m)\.", "")
    listed = pages.select(host.alias("host"), F.lit("").alias("path")).where(F.col("host").rlike("|".join(LISTED_WORDS))).distinct()
    return urls.judged(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), listed)


#: op7 in DuckDB.
OP7_SQL = r"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ruled AS (
  SELECT rid, arg_max(rhost || rpath, strlen(rhost || rpath)) AS rule, arg_max(verdict, strlen(rhost || rpath)) AS verdict
  FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid
), listed AS (
  SELECT DISTINCT regexp_replace(host, '^(www|blog|m)\.', '') AS lhost FROM urls WHERE regexp_matches(host, 'spam|pills|casino')
), hit AS (
  SELECT DISTINCT rid FROM urls JOIN listed ON host = lhost OR ends_with(host, '.' || lhost)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN hit.rid IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN ruled USING (rid) LEFT JOIN hit USING (rid)
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in chunks, length buckets and batches; null texts take one empty chunk."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rule and the decision list's verdict; null texts have no words."""
    out, _ = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document; null sources are one source, null texts have size 0."""
    out = mixing.copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: op10 in DuckDB: the level of the targets, then the same running sums in whole millionths.
OP10_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_rows,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS nth FROM sizes GROUP BY source
), room AS (
  SELECT *, CASE nth WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap FROM sources
), leveled AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM room WINDOW w AS (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), settled AS (
  SELECT min(level) AS level FROM (SELECT level FROM leveled WHERE level <= ratio ORDER BY ratio, source IS NULL, encode(source) LIMIT 1)
), goals AS (
  SELECT source, source_size, source_rows, coalesce(least(cap, settled.level * weight), 0.0) AS target FROM leveled, settled
), rated AS (
  SELECT doc_id, size, source_size, target, s.source,
         CASE WHEN source_size > 0 AND target > 0 THEN round(target / source_size * 1000000)::BIGINT ELSE 0 END AS rate,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 7))::BIGINT % ceil(source_rows / 50000.0)::BIGINT AS shard
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), run AS (
  SELECT *, sum(rate) OVER (PARTITION BY source, shard ORDER BY size DESC, digest ROWS UNBOUNDED PRECEDING)::BIGINT + 500000 AS upto FROM rated
)
SELECT doc_id, size, source_size, target, size * (upto // 1000000 - (upto - rate) // 1000000) AS taken FROM run
"""

def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector id; every seventh id's label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, moved)


#: op11 in DuckDB: all scores of the anchors, then both rankings.
OP11_SQL = r"""
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vecs a JOIN vecs b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
"""


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each of which begins as the first of its five does."""
    own = trie.turns_of(table(spark, sf_dir, "conversations"))
    heads = own.where(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    held = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left").withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(F.slice("turns", 1, 0))
    return trie.nodes(held.select("conv_id", F.concat(head, rest).alias("turns")))


#: op12 in DuckDB: a node for each different path, CRC-32 by its bits.
OP12_SQL = r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id
), heads AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
             lambda c, x: list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda b, z: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) % 9 AS h
  FROM sizes
), rebuilt AS (
  SELECT heads.conv_id, r AS place, role, text FROM heads JOIN own ON own.conv_id = base AND r <= h
  UNION ALL
  SELECT heads.conv_id, r - h + least(h, coalesce(s.n, 0)), role, text FROM heads JOIN own ON own.conv_id = heads.conv_id AND r > h LEFT JOIN sizes s ON s.conv_id = base
), paths AS (
  SELECT conv_id, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY place) AS path, strlen(text) AS size FROM rebuilt
  UNION ALL SELECT conv_id, [], 0 FROM sizes
), ended AS (
  SELECT conv_id, max(len(path)) AS n FROM paths GROUP BY conv_id
), node AS (
  SELECT path, len(path) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = len(path)), '')) AS ends_sha256
  FROM paths JOIN ended USING (conv_id) GROUP BY path
), kids AS (SELECT path[:-2] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
), full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (path)
), subtree AS (
  SELECT top.path, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.size)::BIGINT AS saved_tokens
  FROM full_node top JOIN full_node below ON below.path[:top.depth] = top.path GROUP BY top.path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_node n JOIN subtree USING (path) LEFT JOIN node up ON n.depth > 0 AND up.path = n.path[:-2]
"""


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest scores of every twentieth vector id; vectors that are null or not finite take no part."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


#: op13 in DuckDB.
OP13_SQL = r"""
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score FROM vecs a JOIN vecs b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fixity": op1_fixity,
    "op2_simhash": op2_simhash,
    "op3_suffix": op3_suffix,
    "op4_discriminant": op4_discriminant,
    "op5_toxicity": op5_toxicity,
    "op6_neighbours": op6_neighbours,
    "op7_urls": op7_urls,
    "op8_packing": op8_packing,
    "op9_rules": op9_rules,
    "op10_mixing": op10_mixing,
    "op11_negatives": op11_negatives,
    "op12_trie": op12_trie,
    "op13_topk": op13_topk,
}

ORACLE_SQL: dict[str, str] = {"op1_fixity": OP1_SQL, "op7_urls": OP7_SQL, "op10_mixing": OP10_SQL, "op11_negatives": OP11_SQL, "op12_trie": OP12_SQL, "op13_topk": OP13_SQL}

assert WORD in OP10_SQL
