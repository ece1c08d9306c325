"""The registered queries of the numbered operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise.llm import decontaminate, lexical, lines, mixing, near, negatives, pii, quality, recompress, sharding, suffixes, topk, urls

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the five rules on every page's URL."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return (urls.url_verdicts(pages, urls.rule_table(spark, URL_RULES))
            .select("page_id", "host", "path", "rule", "verdict"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.match_items(docs, _read(spark, sf_dir, "benchmark"))
    hits = F.col("__hits")
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        ((hits["n_hit"] > 0) & (20 * hits["n_hit"] >= hits["n_words"])).alias("contaminated"),
        hits["longest"].alias("longest_match"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates of each vector whose id is divisible by 20."""
    rows = topk.integer_vectors(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.where(F.col("id") % 20 == 0), 20)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 400-byte string which occurs elsewhere."""
    found = suffixes.drop_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.drop_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", "text")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85."""
    found = near.near_groups(_read(spark, sf_dir, "documents").select("doc_id", "text"), 85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 13-word window which an earlier document holds."""
    found = recompress.drop_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found, spans = pii.find_pii(docs), F.col("spans")
    base = tuple(k.name for k in pii.KINDS if k.base)
    return found.select("doc_id", *[pii.count_of(spans, k).alias(f"n_{k}") for k in base],
                        F.sha2(pii.span_list(spans, base), 256).alias("base_sha256"),
                        pii.span_list(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"),
                        pii.count_of(spans, "secret").alias("n_secret"), pii.score_list(spans).alias("scores"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, _read(spark, sf_dir, "labels")).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors and mixing rate of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.mix_documents(docs, _read(spark, sf_dir, "labels"), columns=["doc_id"])


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight equal ones by its id, its place there, and its shard if there were nine."""
    docs = sharding.measure(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    placed = sharding.number(sharding.place(docs), ties=("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", "grown_shard")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank_documents(docs, _read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five positives of each anchor, a vector whose id is divisible by 100, and five hard negatives of each."""
    vec, label = F.col("vec_id"), F.col("label")
    rows = negatives.labelled_vectors(_read(spark, sf_dir, "embeddings"),
                                      label=F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(rows, rows.where(F.col("id") % 100 == 0))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_decontamination, op3_topk_search, op4_suffix_dedup, op5_line_dedup,
    op6_minhash_dedup, op7_substring_dedup, op8_pii, op9_quality, op10_mixing, op11_sharding, op12_lexical_search,
    op13_hard_negatives)}

ORACLE = {
    "op1_url_filters": """
WITH cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS verdict
  FROM (SELECT DISTINCT host, path FROM cut) JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path)
SELECT c.page_id, c.host, c.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN best b ON c.host = b.host AND c.path = b.path
""",
    "op3_topk_search": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
""",
    "op5_line_dedup": lines.boilerplate_sql(),
    "op11_sharding": sharding.shards_sql(),
    "op12_lexical_search": lexical.RANKED_SQL,
    "op13_hard_negatives": negatives.NEGATIVES_SQL,
}
