"""What the sitemaps of hosts lead to, over sitemaps that are already stored."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.functions.scalars import host
from veritrail.session import cut, ship_package
from veritrail.sources.readers import robots_sitemaps, sanitize_url

PARSED = "parsed boolean, children array<string>, pages array<string>"


def parse_sitemap(raw: bytes) -> tuple[bool, list[str], list[str]]:
    """(parsed, sitemaps, pages): the loc entries of an index are sitemaps, those of any other root are pages. Broken XML is not parsed."""
    try:
        root = ET.fromstring(raw)
    except ET.ParseError:
        return False, [], []
    local = [(e.tag.rpartition("}")[2], (e.text or "").strip()) for e in root.iter() if isinstance(e.tag, str)]
    entries = [text for tag, text in local if tag == "loc" and text]
    return (True, entries, []) if local[0][0] == "sitemapindex" else (True, [], [sanitize_url(u) for u in entries])


def parsed_sitemaps(saved: DataFrame) -> DataFrame:
    """saved(url, content) to url, children, pages; what is no XML goes."""
    ship_package(saved.sparkSession)

    @F.pandas_udf(PARSED)
    def parse(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_sitemap(bytes(c) if c is not None else b"") for c in contents], columns=["parsed", "children", "pages"])

    return saved.select("url", parse("content").alias("s")).where("s.parsed").select("url", "s.children", "s.pages")


def closure(hosts: DataFrame, saved: DataFrame, allowed: DataFrame, max_sitemaps: int = 50, max_urls: int = 5000) -> DataFrame:
    """(url, discovered_via, truncated): pages that the sitemaps of hosts(host, robots) lead to.

    saved(url, content) are the stored sitemaps, allowed(host) the hosts that may be read. A host starts with the sitemaps of its
    robots text, else with /sitemap.xml, and reads in the order of discovery, each sitemap once, max_sitemaps at most that parse.
    Of a host the first max_urls pages stay (both bounds are the feature; truncated tells where the second one cut); a page that several
    hosts lead to counts for the least of them. A round reads one level; each level reads a sitemap at least, so there are max_sitemaps rounds at most.
    """
    may = allowed.select("host").distinct()

    def within(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_h", host(F.col("url"))).join(may.withColumnRenamed("host", "_h"), "_h", "left_semi").drop("_h")

    documents = cut(parsed_sitemaps(within(saved.dropDuplicates(["url"]))))
    named = F.transform(robots_sitemaps(F.coalesce("robots", F.lit(""))), lambda u: F.when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), u).otherwise(F.concat(F.lit("https://"), "host", F.lit("/"), F.ltrim(u, F.lit("/")))))
    start = F.when(F.size(named) > 0, named).otherwise(F.array(F.concat(F.lit("https://"), "host", F.lit("/sitemap.xml"))))
    frontier = hosts.dropDuplicates(["host"]).select("host", F.posexplode(start).alias("at", "url")).select("host", "url", F.lit(0).alias("parent"), "at")
    read = None
    for _ in range(max_sitemaps):
        first = within(frontier).groupBy("host", "url").agg(F.min(F.struct("parent", "at")).alias("o"))
        fresh = first if read is None else first.join(read.select("host", "url"), ["host", "url"], "left_anti")
        got = fresh.join(documents, "url").withColumn("n", F.row_number().over(Window.partitionBy("host").orderBy("o.parent", "o.at")))
        if read is not None:
            got = got.join(read.groupBy("host").agg(F.max("n").alias("before")), "host", "left").withColumn("n", F.col("n") + F.coalesce("before", F.lit(0))).drop("before")
        level = cut(got.where(F.col("n") <= max_sitemaps).select("host", "url", "n", "children", "pages"))
        if level.isEmpty():
            break
        read = level if read is None else cut(read.unionByName(level))
        frontier = level.select("host", F.col("n").alias("parent"), F.posexplode("children").alias("at", "url"))
    if read is None:
        return hosts.sparkSession.createDataFrame([], "url string, discovered_via string, truncated boolean")
    pages = within(read.select("host", "n", F.posexplode("pages").alias("at", "url")))
    unique = pages.groupBy("host", "url").agg(F.min(F.struct("n", "at")).alias("o"))
    ranked = unique.withColumn("r", F.row_number().over(Window.partitionBy("host").orderBy("o.n", "o.at")))
    kept = ranked.where(F.col("r") <= max_urls)
    over = ranked.where(F.col("r") == max_urls + 1).select("host", F.lit(True).alias("truncated"))
    least = kept.groupBy("url").agg(F.min("host").alias("host")).join(over, "host", "left")
    return least.select("url", F.concat(F.lit("sitemap:"), "host").alias("discovered_via"), F.coalesce("truncated", F.lit(False)).alias("truncated"))
