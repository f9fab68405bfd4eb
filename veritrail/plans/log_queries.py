"""Log-to-state queries; events stand for a retrieval log: a user is a url, an error event a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.functions import scalars
from veritrail.operators import logstate, respond


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    status = F.when(~failed, 200).when(F.col("user_id") % 4 == 0, 404).when(F.col("user_id") % 4 == 1, 403).when(F.col("user_id") % 4 == 2, 429).otherwise(500)
    return e.select(
        F.format_string("https://h%d.example.org/u/%d", F.col("user_id") % 7, F.col("user_id")).alias("url"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("retrieved_at"), F.col("event_id").alias("seq"),
        F.when(~failed, F.sha2("event_type", 256)).alias("sha256"), status.alias("http_status"), F.when(failed & (F.col("user_id") % 5 == 0), F.lit("robots_disallowed")).alias("error"), F.lit("text/html").alias("content_type"),
        F.floor("value").alias("content_length"), F.format_string("h%d.example.org", F.col("user_id") % 7).alias("host"), "event_type",
    )


LOG_SQL = """log AS (
  SELECT 'https://h' || (user_id % 7) || '.example.org/u/' || user_id AS url, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS retrieved_at, event_id AS seq,
    CASE WHEN event_type <> 'error' THEN sha256(event_type) END AS sha256,
    CASE WHEN event_type <> 'error' THEN 200 WHEN user_id % 4 = 0 THEN 404 WHEN user_id % 4 = 1 THEN 403 WHEN user_id % 4 = 2 THEN 429 ELSE 500 END AS http_status,
    CASE WHEN event_type = 'error' AND user_id % 5 = 0 THEN 'robots_disallowed' END AS error, floor(value)::BIGINT AS content_length, 'h' || (user_id % 7) || '.example.org' AS host, event_type
  FROM events)"""
LEDGER_SQL = f"""WITH {LOG_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY retrieved_at DESC, seq DESC) AS r, row_number() OVER (PARTITION BY url, sha256 IS NOT NULL ORDER BY retrieved_at DESC, seq DESC) AS k FROM log
), folded AS (
  SELECT url, max(sha256) FILTER (WHERE k = 1 AND sha256 IS NOT NULL) AS last_ok, max(sha256) FILTER (WHERE k = 2 AND sha256 IS NOT NULL) AS before, max(http_status) FILTER (WHERE r = 1) AS http_status,
    bool_or(sha256 IS NOT NULL) FILTER (WHERE r = 1) AS ok, min(retrieved_at) FILTER (WHERE sha256 IS NOT NULL) AS first_seen, max(retrieved_at) FILTER (WHERE sha256 IS NOT NULL) AS last_seen
  FROM ranked GROUP BY url
), ledger AS (
  SELECT url, CASE WHEN ok THEN before ELSE last_ok END AS previous_sha256, CASE WHEN ok THEN last_ok END AS current_sha256, first_seen, last_seen, http_status,
    CASE WHEN NOT ok AND last_ok IS NULL THEN 'UNAVAILABLE' WHEN NOT ok THEN 'REMOVED' WHEN before IS NULL THEN 'ADDED' WHEN before <> last_ok THEN 'MODIFIED' ELSE 'UNCHANGED' END AS change_type
  FROM folded)"""


def ledger_rows(spark, sf_dir):
    return logstate.ledger(log(spark, sf_dir))


def ledger_change_types(spark, sf_dir):
    return ledger_rows(spark, sf_dir).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


def latest_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return logstate.latest_per_key(e, "user_id", ["event_id"])


def known_urls(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.format_string("https://h%d.example.org/u/%d", F.col("c_custkey") % 7, F.col("c_custkey")).alias("url"), F.lit("SEED").alias("provenance"), F.col("c_mktsegment").alias("source"), F.lit("seed").alias("origin"))


def queue_state(spark, sf_dir):
    rows = log(spark, sf_dir)
    challenged = rows.where("event_type = 'view' and seq % 3 = 0").select("url")
    return logstate.work_queue(known_urls(spark, sf_dir), rows, challenged)


QUEUE_SQL = f"""WITH {LOG_SQL}, known AS (SELECT 'https://h' || (c_custkey % 7) || '.example.org/u/' || c_custkey AS url, c_mktsegment AS source FROM customer),
tried AS (SELECT url, count(*) AS attempts, arg_max(http_status, seq) AS st, arg_max(coalesce(sha256, ''), seq) AS sha, arg_max(coalesce(error, ''), seq) AS err, arg_max(retrieved_at, seq) AS seen FROM log GROUP BY url),
challenged AS (SELECT DISTINCT url FROM log WHERE event_type = 'view' AND seq % 3 = 0),
queue AS (SELECT url, CASE WHEN attempts IS NULL THEN 'DISCOVERED' WHEN sha <> '' AND c THEN 'NON_CONTENT_TECHNICAL_RESPONSE' WHEN sha <> '' THEN 'ARCHIVED' WHEN err = 'robots_disallowed' THEN 'ROBOTS_DISALLOWED' WHEN err = 'host_not_allowlisted' THEN 'MANUAL_REVIEW'
    WHEN st IN (401, 403) THEN 'ACCESS_RESTRICTED' WHEN st IN (404, 410) THEN 'NOT_FOUND' WHEN st = 429 THEN 'RATE_LIMITED' ELSE 'TEMPORARY_ERROR' END AS state, coalesce(attempts, 0) AS attempts, st AS last_http_status, seen AS last_attempt_at, is_known, source
  FROM (SELECT coalesce(k.url, t.url) AS url, t.attempts, t.st, t.sha, t.err, t.seen, k.url IS NOT NULL AS is_known, k.source, x.url IS NOT NULL AS c FROM known k FULL OUTER JOIN tried t ON k.url = t.url LEFT JOIN challenged x ON x.url = t.url) j)"""


def retry_eligible_topk(spark, sf_dir):
    return logstate.pending(queue_state(spark, sf_dir), 100).select("url", "state", "turn")


def inventory_upsert(spark, sf_dir):
    known = known_urls(spark, sf_dir).select("url", F.lit("2026-01-01").alias("first_discovered"), F.lit("2026-01-01").alias("last_confirmed"), F.lit("seed").alias("discovered_via"))
    found = log(spark, sf_dir).select("url", F.col("event_type").alias("discovered_via"))
    return logstate.upsert(known, found, "2026-02-01")


def append_merge_by_id(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey").cast("string")).alias("id"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))
    base, other = o.where("cust % 2 = 0"), o.where("cust % 3 = 0").withColumn("status", F.lit("X"))
    return logstate.merge_by_id(base, other).select("merge_key", "id", "cust", "status")


def left_anti_unprocessed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


def host_histogram(spark, sf_dir):
    return log(spark, sf_dir).groupBy("host", "http_status").agg(F.count(F.lit(1)).alias("n"))


def host_coverage_percentiles(spark, sf_dir):
    return logstate.host_latency(table(spark, sf_dir, "documents"), "source", "n_chars")


def two_level_topn(spark, sf_dir):
    counts = log(spark, sf_dir).groupBy("host", "url").agg(F.count(F.lit(1)).alias("n"))
    return logstate.top_within(counts, "host", "url", 5).select("host", "url", "n", F.col("place").cast("long").alias("place"))


def distinct_ratio_having(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(scalars.host(F.col("url")).alias("host"), F.lit("text/html").alias("content_type"), F.sha2("html", 256).alias("sha256"), F.length("html").alias("content_length"))
    return respond.host_anomalies(pages, least=2, ratio=0.5, largest=4096)


def unique_object_bytes(spark, sf_dir):
    rows = log(spark, sf_dir).where(logstate.succeeded())
    first = rows.groupBy("sha256").agg(F.min_by("content_length", "seq").alias("bytes"))
    return first.agg(F.count(F.lit(1)).alias("objects"), F.sum("bytes").alias("bytes"))


def distinct_counts(spark, sf_dir):
    return log(spark, sf_dir).agg(F.count_distinct("url").alias("attempted"), F.count_distinct(F.when(logstate.succeeded(), F.col("url"))).alias("archived"), F.count_distinct("sha256").alias("objects"), F.count_distinct(F.coalesce("sha256", "url")).alias("documents"))


def many_histograms(spark, sf_dir):
    """Several histograms in one pass: columns unpivoted, then counted."""
    rows = log(spark, sf_dir).select("event_type", F.col("http_status").cast("string").alias("http_status"), "host")
    return rows.select(F.explode(F.create_map(*(x for c in rows.columns for x in (F.lit(c), F.col(c))))).alias("metric", "key")).groupBy("metric", "key").agg(F.count(F.lit(1)).alias("n"))


def integrity_audit(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 11 != 0, F.sha2("html", 256)).otherwise(F.sha2("url", 256)).alias("sha256"), F.col("html").cast("binary").alias("content"))
    return logstate.audit(p).groupBy("intact").agg(F.count(F.lit(1)).alias("n"))


def chunk_packing(spark, sf_dir):
    """Hosts whole into chunks of 1,500 lines; a driver-side pass over one row for each host, MAX_HOSTS at most."""
    sizes = log(spark, sf_dir).groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy("host").limit(logstate.MAX_HOSTS + 1).collect()
    return spark.createDataFrame(sorted(logstate.pack_hosts([(r["host"], r["n"]) for r in sizes], 1500).items()), "host string, chunk int")


def host_metrics(spark, sf_dir):
    rows = log(spark, sf_dir)
    seeds = known_urls(spark, sf_dir).select("url", scalars.host(F.col("url")).alias("host"), F.when(F.col("source") == "BUILDING", "sitemap:x").otherwise("seed").alias("discovered_via"))
    return logstate.host_metrics(seeds, rows, rows.where("event_type = 'view' and seq % 50 = 0").select("host"), sitemap_cap=40)


def source_precedence(spark, sf_dir):
    """Seeds before the inventory before what the log alone knows; within the seeds the last line wins."""
    seeds = table(spark, sf_dir, "orders").select(F.format_string("https://h%d.example.org/u/%d", F.col("o_custkey") % 7, F.col("o_custkey")).alias("url"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("source"))
    inventory = known_urls(spark, sf_dir).select("url", F.lit(0).cast("long").alias("seq"), "source")
    return logstate.first_source(seeds, inventory, log(spark, sf_dir).select("url", "seq", F.lit("crawl").alias("source")))


def capped_hosts(spark, sf_dir):
    """The latest attempts of each host up to the host's cap; hosts without a cap go."""
    caps = {"h0.example.org": 3, "h1.example.org": 5, "h2.example.org": 8}
    return logstate.capped_groups(log(spark, sf_dir).select("host", "url", "retrieved_at", "seq"), "host", [F.desc("retrieved_at"), F.desc("seq")], caps).select("host", "seq", F.col("place").cast("long").alias("place"))


def duplicate_ids(spark, sf_dir):
    return logstate.duplicate_ids(table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("id")), "id")


def recovered_urls(spark, sf_dir):
    """Urls that a link with a hash already recovers, of those in the log."""
    from veritrail.operators import recovery

    links = log(spark, sf_dir).select(F.col("url").alias("original_url"), F.when(F.col("seq") % 3 == 0, "SAME_DOCUMENT").when(F.col("seq") % 3 == 1, "RELATED").otherwise("ARCHIVED_VERSION").alias("relation"), "sha256")
    return recovery.recovered(links)


def log_rows(spark, sf_dir):
    """Rows of a log and of its continuation, as they are counted before a rebuild."""
    rows = log(spark, sf_dir)
    return rows.where("seq % 2 = 0").unionByName(rows.where("seq % 2 = 1")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.trim("url") != "", 1)).alias("with_url"))


def coverage_state(spark, sf_dir):
    q = log(spark, sf_dir).groupBy("url").agg(F.max("http_status").alias("http_status"))
    obs = q.withColumn("classification", F.when(F.col("http_status") == 200, "APPLICATION_SHELL").otherwise("ERROR_RESPONSE"))
    links = log(spark, sf_dir).where("seq % 4 = 0").select(F.col("url").alias("original_url"), F.when(F.col("seq") % 8 == 0, F.col("url")).otherwise(F.lit("m")).alias("alternative_url"), F.when(F.col("seq") % 12 == 0, "ARCHIVED_VERSION").when(F.col("seq") % 8 == 0, "SAME_DOCUMENT").otherwise("OFFICIAL_MIRROR").alias("relation"), "sha256", "seq")
    return respond.coverage_states(obs, links)


def idempotent_links(spark, sf_dir):
    """Links appended once by their hashed key."""
    links = log(spark, sf_dir).where("sha256 is not null").select(scalars.short_id("", F.col("url"), F.col("sha256")).alias("link_key"), "seq")
    return links.groupBy("link_key").agg(F.min("seq").alias("first_seq"))


QUERIES = {
    f.__name__: f
    for f in (
        ledger_rows, ledger_change_types, latest_per_key, queue_state, retry_eligible_topk, inventory_upsert, append_merge_by_id, left_anti_unprocessed, host_histogram, host_coverage_percentiles, two_level_topn,
        distinct_ratio_having, unique_object_bytes, distinct_counts, many_histograms, integrity_audit, chunk_packing, host_metrics, source_precedence, capped_hosts, duplicate_ids, recovered_urls, log_rows, coverage_state, idempotent_links,
    )
}
KNOWN_SQL = "known AS (SELECT 'https://h' || (c_custkey % 7) || '.example.org/u/' || c_custkey AS url FROM customer)"
HOST_SQL = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1))"
ORACLES = {
    "ledger_rows": LEDGER_SQL + " SELECT * FROM ledger",
    "ledger_change_types": LEDGER_SQL + " SELECT change_type, count(*) AS n FROM ledger GROUP BY change_type",
    "latest_per_key": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
    "queue_state": QUEUE_SQL + " SELECT url, state, attempts, state IN ('RATE_LIMITED', 'TEMPORARY_ERROR') AND attempts < 5 AS retry_eligible, last_http_status, last_attempt_at, CASE WHEN is_known THEN 'SEED' ELSE 'UNCLASSIFIED' END AS provenance, source, CASE WHEN is_known THEN 'seed' ELSE 'crawl' END AS origin FROM queue",
    "retry_eligible_topk": QUEUE_SQL + " SELECT url, state, CASE WHEN state = 'DISCOVERED' THEN 0 ELSE 1 END AS turn FROM queue WHERE state = 'DISCOVERED' OR (state IN ('RATE_LIMITED', 'TEMPORARY_ERROR') AND attempts < 5) ORDER BY turn, url LIMIT 100",
    "inventory_upsert": f"WITH {LOG_SQL}, {KNOWN_SQL}, found AS (SELECT url, min(event_type) AS via FROM log GROUP BY url) SELECT coalesce(k.url, f.url) AS url, CASE WHEN k.url IS NULL THEN '2026-02-01' ELSE '2026-01-01' END AS first_discovered, CASE WHEN f.url IS NULL THEN '2026-01-01' ELSE '2026-02-01' END AS last_confirmed, CASE WHEN k.url IS NULL THEN via ELSE 'seed' END AS discovered_via FROM known k FULL OUTER JOIN found f ON k.url = f.url",
    "append_merge_by_id": """WITH o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey::VARCHAR END AS id, o_custkey AS cust, o_orderstatus AS status FROM orders),
      u AS (SELECT 0 AS turn, id, cust, status FROM o WHERE cust % 2 = 0 UNION ALL SELECT 1, id, cust, 'X' FROM o WHERE cust % 3 = 0),
      k AS (SELECT coalesce(id, '{"cust":' || cust || ',"status":"' || status || '"}') AS merge_key, * FROM u)
      SELECT merge_key, min(id) AS id, arg_min(cust, turn) AS cust, arg_min(status, turn) AS status FROM k GROUP BY merge_key""",
    "left_anti_unprocessed": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "host_histogram": f"WITH {LOG_SQL} SELECT host, http_status, count(*) AS n FROM log GROUP BY host, http_status",
    "host_coverage_percentiles": "SELECT source, count(*) AS n, trunc(round(quantile_cont(n_chars, 0.5), 6))::BIGINT AS median, trunc(round(quantile_cont(n_chars, 0.95), 6))::BIGINT AS p95 FROM documents GROUP BY source",
    "two_level_topn": f"WITH {LOG_SQL}, c AS (SELECT host, url, count(*) AS n FROM log GROUP BY host, url), r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, url) AS place FROM c) SELECT host, url, n, place FROM r WHERE place <= 5",
    "distinct_ratio_having": f"WITH p AS (SELECT {HOST_SQL} AS host, sha256(html) AS sha FROM pages WHERE length(html) BETWEEN 1 AND 4095) SELECT host, count(*) AS n, count(DISTINCT sha) AS distinct_hashes FROM p GROUP BY host HAVING count(*) >= 2 AND count(DISTINCT sha) >= 0.5 * count(*)",
    "unique_object_bytes": f"WITH {LOG_SQL}, f AS (SELECT sha256, arg_min(content_length, seq) AS b FROM log WHERE sha256 IS NOT NULL GROUP BY sha256) SELECT count(*) AS objects, sum(b)::BIGINT AS bytes FROM f",
    "distinct_counts": f"WITH {LOG_SQL} SELECT count(DISTINCT url) AS attempted, count(DISTINCT url) FILTER (WHERE sha256 IS NOT NULL) AS archived, count(DISTINCT sha256) AS objects, count(DISTINCT coalesce(sha256, url)) AS documents FROM log",
    "many_histograms": f"WITH {LOG_SQL} SELECT 'event_type' AS metric, event_type AS key, count(*) AS n FROM log GROUP BY event_type UNION ALL SELECT 'http_status', http_status::VARCHAR, count(*) FROM log GROUP BY http_status UNION ALL SELECT 'host', host, count(*) FROM log GROUP BY host",
    "integrity_audit": "SELECT page_id % 11 <> 0 AS intact, count(*) AS n FROM pages GROUP BY 1",
    "coverage_state": f"""WITH {LOG_SQL}, o AS (SELECT url, max(http_status) AS st FROM log GROUP BY url),
      l AS (SELECT url, seq, CASE WHEN seq % 12 = 0 THEN 'A' WHEN seq % 8 = 0 THEN 'S' ELSE 'M' END AS rel FROM log WHERE seq % 4 = 0 AND sha256 IS NOT NULL),
      d AS (SELECT url, arg_min(rel, seq) FILTER (WHERE rel <> 'A') AS direct, bool_or(rel = 'A') AS archived FROM l GROUP BY url)
      SELECT o.url, CASE WHEN direct = 'S' THEN 'ARCHIVED_CONTENT' WHEN direct IS NOT NULL THEN 'RECOVERED_OFFICIAL_MIRROR' WHEN archived THEN 'RECOVERED_WEB_ARCHIVE' WHEN st IN (401, 403) THEN 'ACCESS_RESTRICTED' WHEN st = 200 THEN 'UNRESOLVED_CHALLENGE' ELSE 'NON_CONTENT_TECHNICAL_RESPONSE' END AS state FROM o LEFT JOIN d ON o.url = d.url""",
    "host_metrics": f"""WITH {LOG_SQL}, d AS (SELECT 'h' || (c_custkey % 7) || '.example.org' AS host, count(*) AS n, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS s FROM customer GROUP BY 1),
      u AS (SELECT host, url, arg_max(content_length, seq) FILTER (WHERE sha256 IS NOT NULL) AS size FROM log GROUP BY 1, 2), a AS (SELECT host, count(*) AS attempted, count(size) AS archived, coalesce(sum(size), 0)::BIGINT AS bytes, trunc(round(quantile_cont(size, 0.5), 6))::BIGINT AS median, trunc(round(quantile_cont(size, 0.95), 6))::BIGINT AS p95 FROM u GROUP BY 1),
      e AS (SELECT host, count(*) AS n FROM log WHERE event_type = 'view' AND seq % 50 = 0 GROUP BY 1)
      SELECT coalesce(d.host, a.host) AS host, coalesce(d.n, 0) AS urls_discovered, coalesce(attempted, 0) AS urls_attempted, coalesce(archived, 0) AS urls_archived, coalesce(e.n, 0) AS non_content_captures, coalesce(archived, 0) - coalesce(e.n, 0) AS urls_with_content, coalesce(s, 0) >= 40 AS ceiling_hit, coalesce(bytes, 0) AS bytes,
        median AS median_object_bytes, p95 AS p95_object_bytes FROM d FULL OUTER JOIN a ON a.host = d.host LEFT JOIN e ON e.host = coalesce(d.host, a.host)""",
    "source_precedence": f"""WITH {LOG_SQL}, s AS (SELECT 'https://h' || (o_custkey % 7) || '.example.org/u/' || o_custkey AS url, arg_max(o_orderstatus, o_orderkey) AS source, 0 AS t FROM orders GROUP BY 1 UNION ALL SELECT 'https://h' || (c_custkey % 7) || '.example.org/u/' || c_custkey, c_mktsegment, 1 FROM customer UNION ALL SELECT DISTINCT url, 'crawl', 2 FROM log)
      SELECT url, arg_min(source, t) AS source, min(t) AS source_number FROM s GROUP BY url""",
    "capped_hosts": f"WITH {LOG_SQL}, r AS (SELECT host, seq, row_number() OVER (PARTITION BY host ORDER BY retrieved_at DESC, seq DESC) AS place FROM log) SELECT * FROM r WHERE place <= CASE host WHEN 'h0.example.org' THEN 3 WHEN 'h1.example.org' THEN 5 WHEN 'h2.example.org' THEN 8 ELSE 0 END",
    "duplicate_ids": "SELECT 'c' || o_custkey AS id, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    "recovered_urls": f"WITH {LOG_SQL} SELECT DISTINCT url FROM log WHERE sha256 IS NOT NULL AND seq % 3 <> 1",
    "log_rows": "SELECT count(*) AS n, count(*) AS with_url FROM events",
    "chunk_packing": f"""WITH RECURSIVE {LOG_SQL}, s AS (SELECT host, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, host) AS i FROM log GROUP BY host),
      p AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS load, ''::VARCHAR AS host, -1 AS chunk UNION ALL
        SELECT q.i, CASE WHEN c <= len(q.load) THEN list_transform(q.load, lambda x, k: CASE WHEN k = c THEN x + n ELSE x END) ELSE list_append(q.load, n) END, q.host, c - 1 FROM (SELECT s.i, s.n, s.host, p.load, coalesce(list_filter(range(1, len(p.load) + 1), lambda k: p.load[k] + s.n <= 1500)[1], len(p.load) + 1) AS c FROM p JOIN s ON s.i = p.i + 1) q)
      SELECT host, chunk::INTEGER AS chunk FROM p WHERE i > 0""",
    "idempotent_links": f"WITH {LOG_SQL} SELECT substr(sha256(url || '|' || sha256), 1, 16) AS link_key, min(seq) AS first_seq FROM log WHERE sha256 IS NOT NULL GROUP BY 1",
}


def stream_ledger(spark, sf_dir):
    """The ledger by Structured Streaming over the same log, as a file source read to its end."""
    import uuid

    from veritrail.session import remove_folder, shared_folder, ship_package
    from veritrail.streaming import incremental

    ship_package(spark)
    place, name = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}", f"ledger_{uuid.uuid4().hex}"
    log(spark, sf_dir).select("url", "retrieved_at", "seq", "sha256", "http_status").write.parquet(f"{place}/in")
    rows = spark.readStream.schema("url string, retrieved_at string, seq long, sha256 string, http_status int").parquet(f"{place}/in")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{place}/out")

    incremental.stream_ledger(rows).writeStream.queryName(name).outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    for done in ("in", "state"):
        remove_folder(spark, f"{place}/{done}")
    return logstate.latest_per_key(spark.read.parquet(f"{place}/out"), "url", ["batch"]).drop("batch")


QUERIES["stream_ledger"] = stream_ledger
ORACLES["stream_ledger"] = ORACLES["ledger_rows"]
