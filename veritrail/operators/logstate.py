"""From append-only logs to state: ledger, queue, coverage, merges and audits.

A log has url, retrieved_at, seq (its place in file order), sha256 (null or empty: a failure), http_status, error.
Folds are grouped aggregates, which combine before the shuffle, so a key with most of the rows doesn't weigh on
one task; no window is laid over a key's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETRYABLE = ("RATE_LIMITED", "TEMPORARY_ERROR")
MAX_ATTEMPTS = 5


def succeeded(sha: str = "sha256") -> Column:
    return F.coalesce(F.col(sha), F.lit("")) != ""


def ledger(log: DataFrame) -> DataFrame:
    """One row per url: previous and current hash, first and last success, last status, change type.

    Order is retrieved_at, then seq. Failures are passed over when the previous success is looked for.
    """
    at = F.struct("retrieved_at", "seq")
    folded = log.groupBy("url").agg(F.max(F.struct(at.alias("at"), succeeded().alias("ok"), F.col("http_status").alias("http_status"))).alias("latest"), F.min(F.when(succeeded(), F.col("retrieved_at"))).alias("first_seen"), F.max(F.when(succeeded(), F.col("retrieved_at"))).alias("last_seen"))
    # the two latest successes: a window of which each task keeps two rows a url before the shuffle
    turn = F.row_number().over(Window.partitionBy("url").orderBy(F.desc("retrieved_at"), F.desc("seq"), F.desc("sha256")))
    two = log.where(succeeded()).select("url", "retrieved_at", "seq", "sha256").withColumn("turn", turn).where("turn <= 2")
    two = two.groupBy("url").agg(F.max(F.when(F.col("turn") == 1, F.struct("sha256"))).alias("last_ok"), F.max(F.when(F.col("turn") == 2, F.struct("sha256"))).alias("before"))
    ok = F.col("latest.ok")
    current = F.when(ok, F.col("last_ok.sha256"))
    previous = F.when(ok, F.col("before.sha256")).otherwise(F.col("last_ok.sha256"))
    change = (
        F.when(~ok & F.col("last_ok").isNull(), "UNAVAILABLE").when(~ok, "REMOVED").when(F.col("before").isNull(), "ADDED").when(previous != current, "MODIFIED").otherwise("UNCHANGED")
    )
    return folded.join(two, "url", "left").select("url", previous.alias("previous_sha256"), current.alias("current_sha256"), "first_seen", "last_seen", F.col("latest.http_status").alias("http_status"), change.alias("change_type"))


def latest_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key, all columns, without a window."""
    rest = [c for c in rows.columns if c != key and c not in order]
    last = rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return last.select(key, *(F.col(f"r.{c}").alias(c) for c in rows.columns if c != key))


def attempts(log: DataFrame) -> DataFrame:
    """Per url in file order: attempts, last status, error, hash and time, whether it ever succeeded."""
    last = F.max(F.struct("seq", "http_status", "error", "sha256", "retrieved_at"))
    return log.groupBy("url").agg(last.alias("last"), F.count(F.lit(1)).alias("attempts"), F.bool_or(succeeded()).alias("ever_archived"))


def queue_state(last: Column, challenged: Column) -> Column:
    """State of an attempted url, the first rule that holds."""
    status = last.getField("http_status")
    ok = F.coalesce(last.getField("sha256"), F.lit("")) != ""
    return (
        F.when(ok & challenged, "NON_CONTENT_TECHNICAL_RESPONSE").when(ok, "ARCHIVED").when(last.getField("error") == "robots_disallowed", "ROBOTS_DISALLOWED")
        .when(last.getField("error") == "host_not_allowlisted", "MANUAL_REVIEW").when(status.isin(401, 403), "ACCESS_RESTRICTED").when(status.isin(404, 410), "NOT_FOUND").when(status == 429, "RATE_LIMITED").otherwise("TEMPORARY_ERROR")
    )


def work_queue(known: DataFrame, log: DataFrame, challenged: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """known(url, provenance, source, origin) full-outer the log's attempts; never attempted: DISCOVERED; unknown: origin crawl."""
    flagged = challenged.select("url").distinct().withColumn("challenged", F.lit(True))
    tried = attempts(log).join(flagged, "url", "left")
    state = F.when(F.col("attempts").isNull(), "DISCOVERED").otherwise(queue_state(F.col("last"), F.coalesce("challenged", F.lit(False))))
    count = F.coalesce("attempts", F.lit(0)).cast("long")
    out = known.join(tried, "url", "full_outer").withColumn("state", state)
    return out.select(
        "url", "state", count.alias("attempts"), (F.col("state").isin(*RETRYABLE) & (count < max_attempts)).alias("retry_eligible"), F.col("last.http_status").alias("last_http_status"), F.col("last.retrieved_at").alias("last_attempt_at"),
        F.coalesce("provenance", F.lit("UNCLASSIFIED")).alias("provenance"), "source", F.coalesce("origin", F.lit("crawl")).alias("origin"),
    )


def pending(queue: DataFrame, limit: int) -> DataFrame:
    """What to fetch next: new urls first, then those to retry, by url; limit is the feature."""
    ranked = queue.where("state = 'DISCOVERED' or retry_eligible").withColumn("turn", F.when(F.col("state") == "DISCOVERED", 0).otherwise(1))
    return ranked.orderBy("turn", "url").limit(limit)


def upsert(existing: DataFrame, found: DataFrame, now: str) -> DataFrame:
    """Inventory merge: known urls get last_confirmed only, new ones enter, none go."""
    seen = found.groupBy("url").agg(F.min("discovered_via").alias("found_via"))
    joined = existing.join(seen.withColumn("is_found", F.lit(True)), "url", "full_outer")
    hit = F.coalesce("is_found", F.lit(False))
    return joined.select("url", F.coalesce("first_discovered", F.lit(now)).alias("first_discovered"), F.when(hit, F.lit(now)).otherwise(F.col("last_confirmed")).alias("last_confirmed"), F.coalesce("discovered_via", "found_via").alias("discovered_via"))


def merge_by_id(base: DataFrame, other: DataFrame) -> DataFrame:
    """Append-only union by id; base wins, a row without an id is its own key."""
    rest = [c for c in base.columns if c != "id"]

    def keyed(rows: DataFrame, turn: int) -> DataFrame:
        return rows.select(F.coalesce(F.col("id"), F.to_json(F.struct(*rest))).alias("merge_key"), F.lit(turn).alias("turn"), F.struct(*base.columns).alias("r"))

    both = keyed(base, 0).unionByName(keyed(other.select(*base.columns), 1))
    return both.groupBy("merge_key").agg(F.min_by("r", F.struct("turn", F.to_json("r"))).alias("r")).select("merge_key", "r.*")


def host_latency(log: DataFrame, by: str, value: str) -> DataFrame:
    """Rows, median and interpolated 95th percentile, truncated, per host."""
    return log.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.round(F.percentile(value, F.lit(0.5)), 6).cast("long").alias("median"), F.round(F.percentile(value, F.lit(0.95)), 6).cast("long").alias("p95"))


def top_within(counts: DataFrame, outer: str, inner: str, n: int) -> DataFrame:
    """The n most frequent inner values of each outer one; counts has one row for each pair (outer, inner, n)."""
    place = F.row_number().over(Window.partitionBy(outer).orderBy(F.desc("n"), inner))
    return counts.withColumn("place", place).where(F.col("place") <= n)


#: Hosts that pack_hosts() takes at most, one row each.
MAX_HOSTS = 1_000_000


def pack_hosts(sizes: list[tuple[str, int]], target: int) -> dict[str, int]:
    """Hosts whole into chunks of target lines: the largest first (ties by name), each into the first chunk that has room, else into a new one, which a host beyond target overfills."""
    if len(sizes) > MAX_HOSTS:
        raise ValueError(f"more than {MAX_HOSTS} hosts")
    load: list[int] = []
    placed = {}
    for name, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        k = next((i for i, used in enumerate(load) if used + n <= target), len(load))
        if k == len(load):
            load.append(0)
        placed[name] = k
        load[k] += n
    return placed


def host_metrics(discovered: DataFrame, log: DataFrame, non_content: DataFrame, sitemap_cap: int = 5000) -> DataFrame:
    """Per host of any input: urls discovered, attempted and archived, captures without content, bytes, median and 95th percentile (cut to whole numbers) of the latest objects, ceiling_hit.

    discovered(url, host, discovered_via), log(url, host, sha256, content_length, seq), non_content(host).
    """
    by_sitemap = F.coalesce(F.col("discovered_via"), F.lit("")).startswith("sitemap:")
    found = discovered.groupBy("host").agg(F.count(F.lit(1)).alias("urls_discovered"), F.count(F.when(by_sitemap, 1)).alias("_by_sitemap"))
    tried = log.groupBy("host", "url").agg(F.max(F.when(succeeded(), F.struct("seq", F.coalesce("content_length", F.lit(0)).alias("size")))).alias("ok"))
    sized = tried.groupBy("host").agg(
        F.count(F.lit(1)).alias("urls_attempted"), F.count("ok").alias("urls_archived"), F.coalesce(F.sum("ok.size"), F.lit(0)).alias("bytes"), F.round(F.percentile("ok.size", F.lit(0.5)), 6).cast("long").alias("median_object_bytes"),
        F.round(F.percentile("ok.size", F.lit(0.95)), 6).cast("long").alias("p95_object_bytes"),
    )
    empty = non_content.groupBy("host").agg(F.count(F.lit(1)).alias("non_content_captures"))
    # captures without content describe hosts, they don't add any
    both = found.join(sized, "host", "full_outer").join(empty, "host", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    content = F.coalesce("urls_archived", F.lit(0)) - F.coalesce("non_content_captures", F.lit(0))
    return both.select("host", *map(count, ("urls_discovered", "urls_attempted", "urls_archived", "non_content_captures")), content.alias("urls_with_content"), (F.coalesce("_by_sitemap", F.lit(0)) >= sitemap_cap).alias("ceiling_hit"), count("bytes"), "median_object_bytes", "p95_object_bytes")


def first_source(*sources: DataFrame) -> DataFrame:
    """Rows (url, ...) of several sources, the first source that knows a url wins; within one, the last row (by seq)."""
    columns = [c for c in sources[0].columns if c not in ("url", "seq")]
    ranked = [s.select("url", F.struct(F.lit(-k).alias("turn"), "seq", *columns).alias("r")) for k, s in enumerate(sources)]
    every = ranked[0]
    for s in ranked[1:]:
        every = every.unionByName(s)
    return every.groupBy("url").agg(F.max("r").alias("r")).select("url", *(F.col(f"r.{c}").alias(c) for c in columns), (-F.col("r.turn")).alias("source_number"))


# Hosts of congress, and the provenance of all others.
CONGRESS_HOSTS = ("oversight.house.gov", "judiciary.house.gov", "www.congress.gov")


def provenance_of(host: Column) -> Column:
    return F.when(host.isin(*CONGRESS_HOSTS), "CONGRESS").otherwise("GOV-PUBLIC")


def capped_groups(rows: DataFrame, group: str, order: list[Column], caps: dict[str, int]) -> DataFrame:
    """rows of each group up to its cap, in order; groups without a cap go. The cap is the feature."""
    limit = F.create_map(*(F.lit(x) for kv in caps.items() for x in kv))
    most = max(caps.values())
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= most)
    return ranked.where(F.col("place") <= F.coalesce(F.try_element_at(limit, F.col(group)), F.lit(0)))


def reason_counts(rows: DataFrame, column: str) -> DataFrame:
    """How often each reason occurs, without what follows a semicolon."""
    return rows.groupBy(F.split_part(F.col(column), F.lit(";"), F.lit(1)).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_ids(rows: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once, and how often."""
    return rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def audit(objects: DataFrame) -> DataFrame:
    """objects(sha256, content): whether the content still has its hash."""
    return objects.select("sha256", (F.sha2("content", 256) == F.col("sha256")).alias("intact"))
