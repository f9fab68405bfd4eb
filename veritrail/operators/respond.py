"""Classification of stored responses, host anomalies and recovery coverage.

A response is never a challenge by its size alone. Rules run in order over features that are computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.functions.scalars import html_title, url_extension, visible_text

# Marks of protection vendors (the first vendor with any mark counts), phrases of challenge pages, marks of script-only pages.
VENDORS = {
    "akamai": ("_abck", "bm-verify", "ak_bmsc", "bazadebezolkohpepadr", "/akam/", "akamai", "sec-cpt", "bm_sz"),
    "cloudflare": ("cf-browser-verification", "__cf_chl", "challenge-platform", "checking your browser", "just a moment", "cf_chl_opt", "turnstile", "cdn-cgi/challenge"),
    "perimeterx": ("_pxhd", "px-captcha", "perimeterx", "_pxvid"), "imperva": ("_incapsula_resource", "incapsula", "imperva"), "datadome": ("datadome",), "aws-waf": ("awswaf", "aws-waf-token", "challenge.js#"),
}
PHRASES = (
    "access denied", "request unsuccessful", "pardon our interruption", "verify you are human", "verifying you are human", "are you a robot", "unusual traffic", "enable javascript and cookies to continue",
    "please enable cookies", "captcha", "bot detection", "automated access to this site has been blocked", "your request has been blocked", "browser check", "checking if the site connection is secure",
)
SHELLS = ('id="root"', 'id="app"', "id='root'", "id='app'", "<app-root", 'id="__next"')
#: Marks anywhere in a host.
INTERSTITIAL = r"(?i)^https?://[^/?#]*(?:unblock\.|block\.|challenge\.|captcha\.|validate\.perfdrive\.com)"
DOCUMENTS = ("pdf", "xml", "json", "zip", "csv", "xlsx", "docx")
#: Markup of which an article page of the doj family has some.
ARTICLE = ("<article", 'property="og:title"', "usa-banner", "node--", "field--name-body", "press-release")
CONTENT = ("REAL_CONTENT", "THIN_REAL_CONTENT")
CHALLENGED = ("BOT_CHALLENGE", "ACCESS_INTERSTITIAL", "APPLICATION_SHELL", "REDIRECT_STUB")


def _any(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m)
    return out


def features(responses: DataFrame) -> DataFrame:
    """responses(url, final_url, status, content_type, body string, error, host_pattern) with what the rules read."""
    body = F.coalesce("body", F.lit(""))
    low = F.lower(body)
    visible = visible_text(body)
    vendor = F.coalesce(*(F.when(_any(low, marks), F.lit(v)) for v, marks in VENDORS.items()))
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    refresh = F.regexp_extract(body, r"(?is)<meta[^>]+http-equiv=[\"']?refresh[\"']?[^>]*>", 0)
    target = F.coalesce(F.col("final_url"), F.nullif(F.regexp_extract(F.coalesce("error", F.lit("")), r"^redirect escaped allowlist: (\S+)", 1), F.lit("")))
    return responses.withColumns(
        {
            "is_html": kind.contains("html") | F.left(low, F.lit(2000)).contains("<html"), "text_bytes": F.octet_length(visible), "vendor": vendor, "phrase": _any(low, PHRASES), "has_refresh": refresh != "",
            "refresh_out": F.regexp_extract(refresh, r"(?i)url=['\"]?([^'\">\s]+)", 1).rlike(INTERSTITIAL), "scripts": F.regexp_count(low, F.lit("<script")), "mount": _any(low, SHELLS), "has_title": html_title(body) != "",
            "is_out": F.coalesce(target.rlike(INTERSTITIAL), F.lit(False)), "extension": url_extension(F.col("url")), "is_pdf": body.startswith("%PDF-"), "size": F.octet_length(body),
        }
    )


def classify(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """url, kind, confidence, vendor, signals in order of the rules."""
    f = features(responses)
    status, n, html = F.col("status"), F.col("text_bytes"), F.col("is_html")
    hit = F.col("vendor").isNotNull() | F.col("phrase")
    promised = F.col("extension").isin(*DOCUMENTS)
    shell = ((n < 400) & F.col("mount")) | ((F.col("scripts") >= 2) & (n < 300))
    pattern = F.coalesce("host_pattern", F.lit(False))
    rules = [
        (F.col("is_out"), "ACCESS_INTERSTITIAL", "HIGH"), (status.isNull() & (F.col("size") == 0), "ERROR_RESPONSE", "HIGH"), (status.isin(401, 403) & hit, "ACCESS_INTERSTITIAL", "HIGH"), (status >= 400, "ERROR_RESPONSE", "HIGH"),
        ((F.col("extension") == "pdf") & F.col("is_pdf"), "REAL_CONTENT", "HIGH"), (html & hit & (n < 600), "BOT_CHALLENGE", "HIGH"), (html & F.col("vendor").isNotNull() & (n < 1500), "BOT_CHALLENGE", "MEDIUM"),
        (html & F.col("has_refresh") & (n < 300) & F.col("refresh_out"), "ACCESS_INTERSTITIAL", "HIGH"), (html & F.col("has_refresh") & (n < 300), "REDIRECT_STUB", "HIGH"), (promised & html & (n < 600), "BOT_CHALLENGE", "MEDIUM"),
        (html & shell, "APPLICATION_SHELL", "MEDIUM"), (pattern & html & (n < 600), "BOT_CHALLENGE", "MEDIUM"), (~html & (F.col("size") > 0), "REAL_CONTENT", "MEDIUM"), (html & (n >= 600), "REAL_CONTENT", "HIGH"),
        (html & (n >= 150) & F.col("has_title"), "THIN_REAL_CONTENT", "MEDIUM"),
    ]
    kind, confidence = F.lit("UNKNOWN_RESPONSE"), F.lit("LOW")
    for test, k, c in reversed(rules):
        test = F.coalesce(test, F.lit(False))
        kind, confidence = F.when(test, F.lit(k)).otherwise(kind), F.when(test, F.lit(c)).otherwise(confidence)
    signals = F.array_compact(
        F.array(
            F.when(F.col("vendor").isNotNull(), F.concat(F.lit("vendor:"), F.col("vendor"))), F.when(F.col("phrase"), F.lit("challenge_phrase")), F.when(F.col("has_refresh"), F.lit("meta_refresh")),
            F.when((F.col("extension") == "pdf") & F.col("is_pdf"), F.lit("pdf_magic_bytes")), F.when((F.col("extension") == "pdf") & ~F.col("is_pdf"), F.lit("expected_pdf_not_pdf")), F.when(pattern, F.lit("host_challenge_pattern")),
        )
    )
    return f.select(*(keep or []), "url", kind.alias("kind"), confidence.alias("confidence"), "vendor", signals.alias("signals"), "text_bytes")


def gate_content(responses: DataFrame) -> DataFrame:
    """classify() with ok, by source family: a PDF must have its signature, a thin doj page some article markup, a federal_register API answer JSON; who fails is no content.

    responses needs family (see recovery.family) besides the columns of classify().
    """
    keyed = responses.withColumn("_row", F.monotonically_increasing_id())
    body, low = F.coalesce("body", F.lit("")), F.lower(F.coalesce("body", F.lit("")))
    html, json_like = F.lower(F.coalesce("content_type", F.lit(""))).contains("html"), F.col("url").endswith(".json") | F.lower(F.coalesce("content_type", F.lit(""))).contains("json")
    promised = url_extension(F.col("url")) == "pdf"
    plain = (F.col("family") == "doj") & html & ~_any(low, ARTICLE)
    checks = [
        (promised & ~body.startswith("%PDF-"), "family_check:pdf_signature_missing", True), (~promised & plain, "family_check:doj_article_markup_missing", F.octet_length(visible_text(body)) < 600),
        (~promised & (F.col("family") == "federal_register") & json_like & ~F.ltrim(low).rlike(r"^[\{\[]"), "family_check:fr_api_not_json", True),
    ]
    failed, added = F.lit(False), []
    for test, signal, fatal in checks:
        test = F.coalesce(test, F.lit(False))
        added.append(F.when(test, F.lit(signal)))
        failed = failed | (test & fatal)
    content = F.col("kind").isin(*CONTENT)
    found = classify(keyed.select("*"), keep=["_row"]).join(keyed.select("_row", failed.alias("_failed"), F.array_compact(F.array(*added)).alias("_added")), "_row")
    return found.select(
        "url", F.when(content & F.col("_failed"), "UNKNOWN_RESPONSE").otherwise(F.col("kind")).alias("kind"), "confidence", "vendor",
        F.when(content, F.concat("signals", "_added")).otherwise(F.col("signals")).alias("signals"), (content & ~F.col("_failed")).alias("ok"),
    )


def classify_unread(records: DataFrame) -> DataFrame:
    """records(url, content_type, content_length, family, host_pattern) whose bytes are not at hand: url, kind, confidence, signals."""
    html = F.lower(F.coalesce("content_type", F.lit(""))).contains("html")
    small = html & F.col("content_length").between(1, 4095)
    pattern = F.coalesce("host_pattern", F.lit(False))
    size = F.concat(F.lit("small_html_success:"), F.col("content_length").cast("string"))
    base = F.array_compact(F.array(F.lit("detection_mode:metadata_only"), F.when(pattern, F.lit("host_challenge_pattern"))))
    rules = [
        (pattern & small, "BOT_CHALLENGE", "MEDIUM", [size, F.lit("expected_document_body_missing")]), ((F.col("family") == "gao") & small, "UNKNOWN_RESPONSE", "LOW", [size, F.lit("host_size_outlier")]),
        (F.lower("url").endswith(".pdf") & html, "UNKNOWN_RESPONSE", "LOW", [F.lit("expected_document_got_html")]),
    ]
    kind, confidence, signals = F.lit("REAL_CONTENT"), F.lit("LOW"), base
    for test, k, c, more in reversed(rules):
        test = F.coalesce(test, F.lit(False))
        kind, confidence, signals = F.when(test, F.lit(k)).otherwise(kind), F.when(test, F.lit(c)).otherwise(confidence), F.when(test, F.concat(base, F.array(*more))).otherwise(signals)
    return records.select("url", kind.alias("kind"), confidence.alias("confidence"), signals.alias("signals"))


def after_fetch(route: Column, kind: Column, found: Column) -> Column:
    """The state of a queued document after a route was tried: found tells whether the archive has a capture (null: the lookup said nothing, the state stays)."""
    content = kind.isin(*CONTENT)
    return F.when((route == "same_agency_probe") & content, "RECOVERED_SAME_AGENCY").when((route == "web_archive") & ~found, "NO_WEB_ARCHIVE_CAPTURE").when(
        (route == "web_archive") & found, F.when(content, "RECOVERED_WEB_ARCHIVE").otherwise("WEB_ARCHIVE_NON_CONTENT")
    )


def fingerprint(kind: Column, vendor: Column, signals: Column) -> Column:
    """kind|vendor:v|signals in order, all joined by bars."""
    return F.concat_ws("|", kind, F.concat(F.lit("vendor:"), vendor), F.array_join(F.array_sort(signals), "|"))


def host_anomalies(log: DataFrame, least: int = 50, ratio: float = 0.9, largest: int = 4096) -> DataFrame:
    """Hosts with many small html successes that hardly ever repeat a hash."""
    small = log.where((F.coalesce("sha256", F.lit("")) != "") & F.lower("content_type").contains("html") & F.col("content_length").between(1, largest - 1))
    counts = small.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha256").alias("distinct_hashes"))
    return counts.where((F.col("n") >= least) & (F.col("distinct_hashes") >= ratio * F.col("n")))


def coverage_states(observations: DataFrame, links: DataFrame) -> DataFrame:
    """observations(url, classification, http_status), links(original_url, alternative_url, relation, sha256, seq): the state of each url.

    Links without a hash do not count; the first direct one decides, else an archived version.
    """
    good = links.where(F.coalesce("sha256", F.lit("")) != "")
    direct = F.col("relation").isin("SAME_DOCUMENT", "OFFICIAL_MIRROR")
    per_url = good.groupBy(F.col("original_url").alias("url")).agg(F.min(F.when(direct, F.struct("seq", "relation", "alternative_url"))).alias("direct"), F.bool_or(F.col("relation") == "ARCHIVED_VERSION").alias("archived"))
    same = (F.col("direct.relation") == "SAME_DOCUMENT") & (F.col("direct.alternative_url") == F.col("url"))
    state = (
        F.when(same, "ARCHIVED_CONTENT").when(F.col("direct").isNotNull(), "RECOVERED_OFFICIAL_MIRROR").when(F.col("archived"), "RECOVERED_WEB_ARCHIVE")
        .when((F.col("classification") == "ERROR_RESPONSE") & F.col("http_status").isin(401, 403), "ACCESS_RESTRICTED").when(F.col("classification").isin("BOT_CHALLENGE", "ACCESS_INTERSTITIAL", "APPLICATION_SHELL"), "UNRESOLVED_CHALLENGE").otherwise("NON_CONTENT_TECHNICAL_RESPONSE")
    )
    return observations.join(per_url, "url", "left").select("url", state.alias("state"))
