"""One query per operator over its whole table, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import divergence, language_id, secrets
from plumbline.llm.exact_dedup import LOWER, UPPER, exact_groups
from plumbline.llm.line_dedup import line_dedup
from plumbline.llm.near_dedup import near_components
from plumbline.llm.packing import pack
from plumbline.llm.sampled_pieces import sample_encode
from plumbline.llm.shared import read
from plumbline.llm.sharding import shard_rows
from plumbline.llm.spelling import spelling_variants
from plumbline.llm.substring_dedup import substring_dedup
from plumbline.llm.url_filter import RULES, filter_urls
from plumbline.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents")).drop("repeats")


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


@query(
    "op3_exact_dedup",
    f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"), keep="largest")


@query("op4_distribution_divergence")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.fit_references(docs))


@query("op5_partenum_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read(spark, sf_dir, "documents")).drop("text_id")


_FITS = lambda host, path: f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


@query(
    "op6_url_filter",
    f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE WHEN {_FITS("example.net", "/en/")} THEN 'example.net/en/'
                 WHEN {_FITS("example.com", "/de/")} THEN 'example.com/de/'
                 WHEN {_FITS("org", "/fr/")} THEN 'org/fr/'
                 WHEN {_FITS("net", "/")} THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES.items()), "rule string, verdict string")
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op7_histogram_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read(spark, sf_dir, "documents"), shards=8)


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = language_id.predict_languages(docs.select("doc_id", "text"), language_id.fit(docs))
    return predicted.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op9_dominance_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


@query("op10_sampled_pieces")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_encode(read(spark, sf_dir, "documents"))


@query(
    "op11_line_dedup",
    f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
     g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN g USING (key) GROUP BY doc_id
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents")).drop("keep")


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
