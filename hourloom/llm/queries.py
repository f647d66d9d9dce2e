"""One query per operator over the given tables, with production parameters, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import compression, conversations, fingerprints, hard_negatives, licenses, mixing, near_dup, packing, suffix_dedup, suffix_trees, token_store, toxicity, url_filter
from hourloom.llm.workers import share_package
from hourloom.sources.workspace import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]):
    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return make(spark, sf_dir)

    QUERIES[make.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op7_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_folder(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.token_report(token_store.read_tokens(spark, path))


@query
def op8_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_plan(table(spark, sf_dir, "documents"))


@query
def op9_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_signals(table(spark, sf_dir, "documents"))


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Parts of host names that make a host a listed one.
HOST_WORDS = ("casino", "malware", "phish", "phishing", "pills", "porn", "spam", "warez", "xxx")


@query
def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES), url_filter.hosts_with_words(pages, HOST_WORDS))
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


ORACLES["op1_url_cascade"] = f"""
WITH located AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
fitting AS (
  SELECT l.page_id, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY l.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS place
  FROM located l JOIN rules r
    ON (l.host = r.rule_host OR right(l.host, length(r.rule_host) + 1) = '.' || r.rule_host) AND left(l.path, length(r.rule_path)) = r.rule_path)
SELECT l.page_id, l.host, l.path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(l.host, '(^|[.-])({"|".join(HOST_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM located l LEFT JOIN fitting f ON f.page_id = l.page_id AND f.place = 1"""


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.NearSpec(words=4))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


@query
def op11_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.repeated_windows(table(spark, sf_dir, "documents"))


ORACLES["op11_suffix_trees"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS w FROM places),
repeats AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(13)) AS i FROM windows JOIN repeats USING (w) WHERE least < doc_id),
spelled AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.i) AS body, count(*) AS n FROM spelled s ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i GROUP BY 1)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)"""


@query
def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    )
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op12_multi_index"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5"""


@query
def op13_conversation_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_all(rows, conversations.damage(rows))
