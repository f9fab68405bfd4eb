"""Recovery queries: orders stand for queued documents, pages for what is archived."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritrail.operators import recovery
from veritrail.plans.log_queries import table


def recovery_queue(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    queue = o.select(
        F.concat(F.lit("https://docs.example.org/"), "o_orderkey").alias("url"), F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("2024-"), F.col("o_custkey"))).alias("document_number"),
        F.when(F.col("o_orderstatus") == "F", "PENDING").when(F.col("o_orderstatus") == "O", "RETRY_LATER").otherwise("RECOVERED_WEB_ARCHIVE").alias("state"), (F.col("o_orderkey") % 3).cast("long").alias("attempts"),
    )
    c = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    archived = c.select(F.concat(F.lit("https://mirror.example.org/2024-"), F.col("c_custkey"), F.lit(".pdf")).alias("url"), F.lit("application/pdf").alias("content_type"), F.sha2("c_name", 256).alias("sha256"), F.col("c_custkey").alias("seq"))
    passed = recovery.recover_offline(queue, archived, "mirror.example", "2026-01-01")
    return passed.groupBy("state", "next_retry_after").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").alias("attempts"), F.count_distinct("link_key").alias("links"))


def ocr_bands(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    rows = p.select("url", F.when(F.col("page_id") % 3 == 0, "DOJ").otherwise("OTHER").alias("family"), (F.col("page_id") % 5).cast("int").alias("pages"), (F.col("page_id") % 2 == 0).alias("high_value"))
    return recovery.ocr_priority(rows).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


OCR_SQL = """WITH p AS (SELECT url, page_id, CASE WHEN len(string_split(url, '/')) > 4 THEN array_to_string(string_split(url, '/')[1:len(string_split(url, '/')) - 2], '/') ELSE url END AS parent FROM pages), d AS (SELECT parent, count(*) AS n FROM p GROUP BY 1),
  s AS (SELECT CASE WHEN page_id % 2 = 0 THEN 2 ELSE 0 END + CASE WHEN regexp_matches(lower(url), 'owner|shell|indict|settle|exhibit') THEN 3 WHEN regexp_matches(lower(url), 'report|order|filing|testimony') THEN 1 ELSE 0 END + CASE WHEN page_id % 3 = 0 THEN 2 ELSE 0 END
    + CASE WHEN page_id % 5 BETWEEN 3 AND 200 THEN 1 ELSE 0 END + CASE WHEN n > 50 THEN 2 WHEN n > 10 THEN 1 ELSE 0 END AS score FROM p JOIN d ON d.parent = p.parent)
  SELECT CASE WHEN score >= 6 THEN 'HIGH' WHEN score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS band, count(*) AS n FROM s GROUP BY 1"""


QUERIES = {f.__name__: f for f in (recovery_queue, ocr_bands)}
ORACLES = {
    "ocr_bands": OCR_SQL,
    "recovery_queue": """WITH q AS (SELECT 'https://docs.example.org/' || o_orderkey AS url, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS doc, CASE o_orderstatus WHEN 'F' THEN 'PENDING' WHEN 'O' THEN 'RETRY_LATER' ELSE 'RECOVERED_WEB_ARCHIVE' END AS st, o_orderkey % 3 AS a FROM orders),
      j AS (SELECT q.*, c.c_custkey AS m, st <> 'RECOVERED_WEB_ARCHIVE' AS is_open FROM q LEFT JOIN customer c ON c.c_custkey = q.doc AND c.c_custkey % 2 = 0),
      s AS (SELECT *, CASE WHEN NOT is_open THEN st WHEN doc IS NULL THEN 'NO_DOCUMENT_IDENTITY' WHEN m IS NOT NULL THEN 'RECOVERED_OFFICIAL_MIRROR' ELSE 'RETRY_LATER' END AS state FROM j)
      SELECT state, CASE WHEN state = 'RETRY_LATER' THEN '2026-01-08' END AS next_retry_after, count(*) AS n, sum(a + CASE WHEN is_open AND doc IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS attempts, count(DISTINCT CASE WHEN state = 'RECOVERED_OFFICIAL_MIRROR' THEN url END) AS links FROM s GROUP BY 1, 2""",
}
