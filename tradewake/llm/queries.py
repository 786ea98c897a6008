"""Registered queries over the language-model tables, each through its operator, with SQL twins where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.llm import byte_bpe, cross_tokenizer, decontaminate, html_text, licenses, line_dedup, lm_score, near_vectors, packing, sharding, shingle_join, source_divergence, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package; where it is not installed they find it beside the caller's
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: DuckDB: a line's key as in ``line_dedup.line_key``.
SQL_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_lines(source: str) -> str:
    """DuckDB: the lines of ``source`` (doc_id, text) with the mark whether line deduplication drops them."""
    return f"""
    lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
      FROM {source}),
    keyed AS (SELECT *, {SQL_KEY} AS k FROM lines),
    common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS dropped FROM keyed LEFT JOIN common USING (k))"""


@query("op7_line_dedup", f"""
WITH {sql_lines("documents")}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: DuckDB: the words of a text, and its set of five-word shingles.
SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL_SHINGLES = """list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)"""


@query("op8_shingle_join")
def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = shingle_join.similar_groups(table(spark, sf_dir, "documents"), "doc_id", "text", percent=75, size=5)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    models = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, models)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


#: Score from which a document counts as toxic.
TOXIC = 0.3


@query("op4_decontaminate", f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 5) AS k FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
dg AS (SELECT DISTINCT doc_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g
       FROM d, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
ig AS (SELECT DISTINCT item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g FROM items),
n AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, n_shingles FROM dg JOIN ig USING (k, g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= 75 * n_shingles""")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=75, size=5)
    return found.withColumnRenamed("id", "doc_id")


@query("op6_pack")
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), capacity=2048, vocabulary="byte_bpe_50k")
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: Bytes that a shard of documents may hold.
SHARD_BYTES = 1 << 20


@query("op2_shards", f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 10))::BIGINT AS h, coalesce(strlen(text), 0) AS bytes FROM documents),
levels AS (SELECT depth, h >> (40 - depth)::INT AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
           FROM d, (SELECT unnest(range(0, 41)) AS depth) GROUP BY ALL),
whole AS (SELECT doc_id, l.*, row_number() OVER (PARTITION BY doc_id ORDER BY l.depth) AS k
          FROM d JOIN levels l ON l.prefix = d.h >> (40 - l.depth)::INT WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard, depth, shard_bytes, shard_rows FROM whole WHERE k = 1""")
def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"))
    return sharding.assign(docs, "doc_id", F.col("n_bytes"), SHARD_BYTES).drop("n_bytes")


#: Least cosine of a line to a licence template.
LICENSE_COSINE = 0.8
#: The documents as files of three directory levels by source and id; one id in ten names a licence file, in the
#: directory of its tens, hundreds of tens or source. Good in Spark SQL and DuckDB alike.
SQL_PATH = """concat(source, CASE WHEN doc_id % 10000 = 0 THEN '' WHEN doc_id % 1000 = 0 THEN concat('/', CAST(floor(doc_id / 1000) AS BIGINT))
  ELSE concat('/', CAST(floor(doc_id / 1000) AS BIGINT), '/', CAST(floor(doc_id / 10) AS BIGINT) % 100) END,
  CASE WHEN doc_id % 10 = 0 THEN concat('/LICENSE.', doc_id) ELSE concat('/', doc_id, '.txt') END)"""


def sql_licenses() -> str:
    known, other = licenses.weights()
    values = lambda rows: ", ".join(f"({', '.join(map(repr, r))})" for r in rows)
    parts = [(name, t) for name, text in licenses.TEMPLATES.items() for t in licenses.terms(text)]
    return f"""
WITH known(term, w) AS (VALUES {values(known.items())}), templates(name, term) AS (VALUES {values(parts)}),
mass AS (SELECT name, sum(w) AS mass FROM templates JOIN known USING (term) GROUP BY name),
files AS (SELECT doc_id AS id, {SQL_PATH} AS path, text FROM documents),
lines AS (SELECT id, row_number() OVER () AS line, list_distinct(regexp_extract_all(
            translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS terms
          FROM (SELECT id, unnest(string_split(text, chr(10))) AS part FROM files)),
t AS (SELECT id, line, unnest(terms) AS term FROM lines),
whole AS (SELECT id, line, sum(coalesce(w, {other})) AS whole FROM t LEFT JOIN known USING (term) GROUP BY id, line),
dots AS (SELECT id, line, name, sum(w) AS dot FROM t JOIN known USING (term) JOIN templates USING (term) GROUP BY id, line, name),
scored AS (SELECT id, name, round(dot::DOUBLE / sqrt(whole::DOUBLE * mass::DOUBLE), 6) AS score FROM dots JOIN whole USING (id, line) JOIN mass USING (name)),
best AS (SELECT id, name AS license, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, name) AS k FROM scored WHERE score >= {LICENSE_COSINE}),
own AS (SELECT files.id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, license, score FROM files LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON b.id = files.id),
holders AS (SELECT dir AS origin_dir, license AS given, score AS given_score, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) AS k
            FROM own WHERE license IS NOT NULL AND regexp_matches(path, '/LICENSE[.][^/]*$')),
nearest AS (SELECT o.id, h.*, row_number() OVER (PARTITION BY o.id ORDER BY length(h.origin_dir) DESC) AS n
            FROM own o JOIN holders h ON h.k = 1 AND (o.dir = h.origin_dir OR starts_with(o.dir, h.origin_dir || '/')) WHERE o.license IS NULL)
SELECT own.id AS doc_id, path, coalesce(license, given) AS license, coalesce(score, given_score) AS score,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' END AS origin, origin_dir
FROM own LEFT JOIN (SELECT * FROM nearest WHERE n = 1) x ON x.id = own.id"""


@query("op9_licenses", sql_licenses())
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", F.expr(SQL_PATH).alias("path"), "text")
    return licenses.scan(files, "doc_id", "path", "text", LICENSE_COSINE).withColumnRenamed("id", "doc_id")


@query("op5_lm_score")
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality; background: all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_score.train(docs, table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))
    return lm_score.score(docs, model).withColumnRenamed("id", "doc_id")


@query("op10_near_vectors")
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_groups(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.95).withColumnRenamed("id", "vec_id")


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks="byte_bpe_multi_50k.tiktoken")
    both = byte_bpe.decode(encoded.select("doc_id", "ids"), ranks="byte_bpe_multi_50k.tiktoken")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: DuckDB: the share p of a count among ``total`` occurrences of ``v`` kept terms.
SQL_SHARE = "(1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + v))"


@query("op12_source_divergence", rf"""
WITH t AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS item FROM documents),
kept AS (SELECT lang, item, count(*)::HUGEINT AS lang_n FROM t GROUP BY lang, item HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, item, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, item) GROUP BY lang, source, item),
every AS (SELECT lang, source, item, lang_n, coalesce(n, 0) AS n, v, lang_total, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source)::HUGEINT AS total
          FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, item)),
shares AS (SELECT lang, source, item, n, {SQL_SHARE.format(n="n", total="total")} AS p, {SQL_SHARE.format(n="lang_n", total="lang_total")} AS q FROM every),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM shares a JOIN shares b ON b.lang = a.lang AND b.item = a.item AND b.source <> a.source GROUP BY ALL),
parts AS (
  SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source WHERE a.source <> b.source
  UNION ALL SELECT lang, source, 'term', item, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts QUALIFY part = 'pair' OR rank <= 200""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


@query("op13_cross_tokenizer")
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda groups: hashlib.sha256(groups.encode()).hexdigest() if groups else ""
    scored = cross_tokenizer.alignment(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model", digest)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
