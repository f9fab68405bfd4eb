"""Queries that attach stored facts: customers stand for documents, orders for observations, lines for edges, suppliers for sitemaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritrail.operators import attach, sitemaps
from veritrail.plans.log_queries import table


def orders_of(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    stated = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("on "), day)).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy"))
    return o.select(F.col("o_orderkey").alias("observation_id"), F.col("o_custkey").alias("source_sha256"), stated.alias("date_raw"), F.concat(F.lit("  order\n "), "o_orderpriority", F.lit("\t of "), day, F.lit(" "), F.repeat(F.lit("x"), F.lit(300))).alias("raw_text"))


def dated_observations(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0")
    event = F.col("c_custkey") % 2 == 0
    dates = c.select(
        F.col("c_custkey").alias("sha256"), F.lit("2020-01-02").alias("publication_date"), F.col("c_mktsegment").alias("publication_basis"),
        F.when(event, "2019-05-06").alias("event_date"), F.when(event, "report-period").alias("event_basis"),
    )
    return attach.dated(orders_of(spark, sf_dir), dates).drop("raw_text", "date_raw")


def edge_quotes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), "l_linenumber")
    return attach.quoted(li, orders_of(spark, sf_dir).where("observation_id % 5 <> 0"))


def document_identities(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    url = F.concat(F.lit("https://docs.example.org/a/"), F.when(F.col("c_custkey") % 2 == 0, F.lit("ANNUAL-report_")).otherwise(F.lit("x")), F.col("c_custkey"), F.lit(".pdf"))
    observed = c.select(url.alias("url"), F.lit("doj").alias("family"))
    number = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("N-"), F.col("c_custkey")))
    told = c.where("c_custkey % 7 < 5").select(url.alias("url"), number.alias("document_number"), F.when(F.col("c_custkey") % 7 < 2, F.col("c_name")).alias("title"), F.lit("2020-01-01").alias("publication_date"), F.lit(2).alias("seq"))
    older = c.select(url.alias("url"), F.lit(None).cast("string").alias("document_number"), F.lit("older").alias("title"), F.lit(None).cast("string").alias("publication_date"), F.lit(1).alias("seq")).where("url like '%5.pdf'")
    return attach.identities(observed, told.unionByName(older)).select("url", "title", "document_number", "publication_date", "identity_key")


def object_titles(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    statuses = p.select(F.col("page_id").alias("sha256"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Page "), "page_id")).when(F.col("page_id") % 3 == 1, F.lit("")).alias("title"))
    return attach.titled(p.select(F.col("page_id").alias("source_sha256"), F.col("url").alias("source_url")), statuses)


def stored_bodies(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    stored = p.where("page_id % 3 <> 0").select(F.col("page_id").alias("sha256"), F.col("html").alias("content"))
    return attach.with_bodies(p.select(F.col("page_id").alias("sha256")), stored).select("sha256", F.col("content").isNotNull().alias("found"), F.coalesce(F.length("content"), F.lit(-1)).cast("long").alias("n_chars"))


def family_candidates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("sha256"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sha256"), F.col("c_mktsegment").alias("family"), "c_nationkey")
    classes = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("sha256"), F.array(F.lit("A"), F.col("c_mktsegment")).alias("classes"))
    found = attach.with_inventory(attach.of_families(o, c, ["BUILDING", "MACHINERY"]), c, ["c_nationkey"])
    return attach.with_classes(found, classes).select("o_orderkey", "family", "c_nationkey", F.array_join("classes", ",").alias("classes"))


def sitemap_pages(spark, sf_dir):
    """Each nation's host has an index that lists a sitemap for each of its suppliers, each with three pages and one on a host that may not be read."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.format_string("h%d.example.org", F.col("s_nationkey")).alias("host"))
    locs = lambda tag, urls: F.concat(F.lit(f'<?xml version="1.0"?><{tag} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.transform(urls, lambda u: F.concat(F.lit("<a><loc> "), u, F.lit("</loc></a>"))), ""), F.lit(f"</{tag}>"))
    page = F.concat(F.lit("https://"), "host", F.lit("/p/"), F.col("s_suppkey"), F.lit("-"))
    leaf = s.select(F.format_string("https://%s/s%d.xml", F.col("host"), F.col("s_suppkey")).alias("url"), "host", "s_suppkey", locs("urlset", F.array(*(F.concat(page, F.lit(k)) for k in "abc"), F.lit("https://elsewhere.test/x"))).alias("content"))
    index = leaf.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "url"))).alias("l"))
    index = index.select(F.concat(F.lit("https://"), "host", F.lit("/index.xml")).alias("url"), locs("sitemapindex", F.col("l.url")).alias("content"))
    hosts = s.select("host").distinct().withColumn("robots", F.lit("User-agent: *\nSitemap: /index.xml\n"))
    saved = leaf.select("url", "content").unionByName(index).withColumn("content", F.encode("content", "UTF-8"))
    return sitemaps.closure(hosts, saved, hosts.select("host"))


QUERIES = {f.__name__: f for f in (dated_observations, edge_quotes, document_identities, object_titles, stored_bodies, family_candidates, sitemap_pages)}
ORACLES = {
    "dated_observations": """SELECT o_orderkey AS observation_id, o_custkey AS source_sha256, CASE WHEN c_custkey IS NOT NULL THEN '2020-01-02' END AS source_date, c_mktsegment AS source_date_basis,
      CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN c_custkey % 2 = 0 THEN '2019-05-06' END AS valid_from, CASE WHEN o_orderkey % 3 = 0 THEN 'sentence-stated' WHEN c_custkey % 2 = 0 THEN 'report-period' END AS valid_from_basis
      FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 4 <> 0""",
    "edge_quotes": """SELECT l_orderkey AS source_id, l_linenumber, CASE WHEN o_orderkey IS NULL THEN '' ELSE left('order ' || o_orderpriority || ' of ' || strftime(o_orderdate, '%Y-%m-%d') || ' ' || repeat('x', 300), 260) END AS quote
      FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 5 <> 0""",
    "document_identities": """WITH u AS (SELECT *, 'https://docs.example.org/a/' || CASE WHEN c_custkey % 2 = 0 THEN 'ANNUAL-report_' ELSE 'x' END || c_custkey || '.pdf' AS url FROM customer),
      t AS (SELECT *, CASE WHEN c_custkey % 7 < 5 AND c_custkey % 3 = 0 THEN 'N-' || c_custkey END AS num, CASE WHEN c_custkey % 7 < 2 THEN c_name END AS tit FROM u), f AS (SELECT *, num IS NOT NULL OR tit IS NOT NULL AS told, num IS NULL AND tit IS NULL AND c_custkey % 10 = 5 AS older FROM t)
      SELECT url, CASE WHEN told AND tit IS NOT NULL THEN tit WHEN older THEN 'older' WHEN c_custkey % 2 = 0 THEN 'Annual report ' || c_custkey END AS title, num AS document_number, CASE WHEN told THEN '2020-01-01' END AS publication_date, coalesce(num, url) AS identity_key FROM f""",
    "object_titles": "SELECT page_id AS source_sha256, url AS source_url, CASE WHEN page_id % 3 = 0 THEN 'Page ' || page_id ELSE left(url, 100) END AS title FROM pages",
    "stored_bodies": "SELECT page_id AS sha256, page_id % 3 <> 0 AS found, CASE WHEN page_id % 3 <> 0 THEN length(html) ELSE -1 END AS n_chars FROM pages",
    "family_candidates": "SELECT o_orderkey, c_mktsegment AS family, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'A,' || c_mktsegment ELSE '' END AS classes FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "sitemap_pages": """WITH s AS (SELECT *, 'h' || s_nationkey || '.example.org' AS host, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier)
      SELECT 'https://' || host || '/p/' || s_suppkey || '-' || k AS url, 'sitemap:' || host AS discovered_via, false AS truncated FROM s, (VALUES ('a'), ('b'), ('c')) v(k) WHERE r <= 49""",
}
