"""Offline recovery: families, tiers, routes, mirrors of known documents, carried queue state, priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.functions.scalars import parent_folder, short_id

# Host marks of source families, in order; marks of urls of the first two tiers; routes of each family.
FAMILIES = (
    ("justice.gov", "doj"), ("federalregister.gov", "federal_register"), ("govinfo.gov", "govinfo"), ("congress.gov", "congress"), ("gao.gov", "gao"), ("fincen.gov", "fincen"), ("treasury.gov", "treasury"), ("sec.gov", "sec"),
    ("fbi.gov", "fbi"), ("archive.org", "web_archive"),
)
TIER0 = ("fincen", "beneficial-ownership", "beneficial_ownership", "corporate-transparency", "corporate_transparency", "/boi", "boi-", "bank-secrecy", "bank_secrecy", "boss-", "ctareporting")
TIER1 = (
    "money-launder", "moneylaunder", "enforcement", "opa/pr", "usao", "fraud", "forfeiture", "kleptocracy", "sanctions", "shell-compan", "criminal", "tax-division", "financial-crime", "fcpa", "bribery", "corruption", "oig",
    "inspector-general",
)
ROUTES = {
    "federal_register": ("federal_register_api", "govinfo_pdf", "web_archive", "later_ordinary_retry"), "doj": ("same_agency_retry_probe", "web_archive", "later_ordinary_retry"),
    "congress": ("govinfo_package", "web_archive", "later_ordinary_retry"), "gao": ("same_agency_retry_probe", "gao_product_pdf", "web_archive", "later_ordinary_retry"),
}
OTHER_ROUTES = ("web_archive", "later_ordinary_retry")
OPEN_STATES = ("PENDING", "RETRY_LATER")
NON_CONTENT = ("BOT_CHALLENGE", "ACCESS_INTERSTITIAL", "APPLICATION_SHELL", "REDIRECT_STUB", "ERROR_RESPONSE", "UNKNOWN_RESPONSE")


def family(host: Column) -> Column:
    """Source family by the first mark that the host holds."""
    out = F.lit("other")
    for mark, name in reversed(FAMILIES):
        out = F.when(host.contains(mark), F.lit(name)).otherwise(out)
    return out


def tier(url: Column, source_family: Column) -> Column:
    """0 for the families and urls of the core evidence, 1 for urls about enforcement, else 2."""
    low = F.lower(F.coalesce(url, F.lit("")))
    core, next_ = F.lit(False), F.lit(False)
    for mark in TIER0:
        core = core | low.contains(mark)
    for mark in TIER1:
        next_ = next_ | low.contains(mark)
    return F.when(F.coalesce(source_family.isin("fincen", "federal_register"), F.lit(False)) | core, 0).when(next_, 1).otherwise(2)


def routes(source_family: Column) -> Column:
    out = F.array(*(F.lit(s) for s in OTHER_ROUTES))
    for name, steps in ROUTES.items():
        out = F.when(source_family == name, F.array(*(F.lit(s) for s in steps))).otherwise(out)
    return out


def to_observe(classified: DataFrame) -> DataFrame:
    """What recovery looks at: no content, and no plain 404 or 410."""
    plain_gone = (F.col("kind") == "ERROR_RESPONSE") & F.coalesce(F.col("status").isin(404, 410), F.lit(False))
    return classified.where(F.col("kind").isin(*NON_CONTENT) & ~plain_gone)


def mirrors(queue: DataFrame, archived: DataFrame, host_mark: str) -> DataFrame:
    """queue(url, document_number, ...) with the first archived PDF named after the document on a host that holds host_mark.

    The name is cut out of the archived url, which makes the suffix search an equi-join.
    """
    named = archived.where(F.col("url").contains(host_mark) & F.lower("content_type").contains("pdf")).withColumn("document_number", F.regexp_extract("url", r"/([^/]+)\.pdf$", 1))
    first = named.where("document_number <> ''").groupBy("document_number").agg(F.min_by(F.struct(F.col("url").alias("mirror_url"), F.col("sha256").alias("mirror_sha256")), "seq").alias("m"))
    return queue.join(first, "document_number", "left").select(*queue.columns, "m.mirror_url", "m.mirror_sha256")


def recover_offline(queue: DataFrame, archived: DataFrame, host_mark: str, now: str) -> DataFrame:
    """The queue after a pass without network: open documents with a mirror are recovered, without one retried in seven days."""
    found = mirrors(queue, archived, host_mark)
    is_open = F.col("state").isin(*OPEN_STATES)
    unnamed = F.coalesce("document_number", F.lit("")) == ""
    state = F.when(~is_open, F.col("state")).when(unnamed, "NO_DOCUMENT_IDENTITY").when(F.col("mirror_url").isNotNull(), "RECOVERED_OFFICIAL_MIRROR").otherwise("RETRY_LATER")
    later = F.date_format(F.to_timestamp(F.lit(now)) + F.expr("INTERVAL 7 DAYS"), "yyyy-MM-dd")
    return found.select(
        "url", "document_number", state.alias("state"), (F.col("attempts") + F.when(is_open & ~unnamed, 1).otherwise(0)).alias("attempts"), F.when(is_open & (state == "RETRY_LATER"), later).alias("next_retry_after"),
        F.when(is_open & (state == "RECOVERED_OFFICIAL_MIRROR"), F.col("mirror_url")).alias("mirror_url"), F.when(is_open & (state == "RECOVERED_OFFICIAL_MIRROR"), short_id("", F.col("url"), F.col("mirror_url"), F.lit("OFFICIAL_MIRROR"))).alias("link_key"),
    )


def carry(fresh: DataFrame, prior: DataFrame, columns: list[str]) -> DataFrame:
    """fresh with the prior values of columns where the url was queued before; urls that are not in fresh go."""
    old = prior.select("url", *(F.col(c).alias(f"_{c}") for c in columns))
    return fresh.join(old, "url", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))


# Families and urls of high value.
HIGH_VALUE_FAMILIES = ("FBI_VAULT", "DOJ", "CONGRESS_OVERSIGHT", "CONGRESS_JUDICIARY", "CONGRESS_GOV", "GAO", "GOVINFO", "TREASURY_OIG", "FINCEN", "SEC")
HIGH_VALUE_URL = r"(?i)enforcement|complaint|indictment|exhibit|report|hearing|testimony|assessment|consent|order|vault"


def high_value(source_family: Column, url: Column) -> Column:
    return F.coalesce(source_family, F.lit("")).isin(*HIGH_VALUE_FAMILIES) | F.coalesce(url, F.lit("")).rlike(HIGH_VALUE_URL)


def text_status(text: Column, is_pdf: Column) -> Column:
    """Of an extracted text (pages end in form feeds): status, pages and whether it should be read by OCR. A PDF with under 200 characters, or under 20 a page, is NO_TEXT."""
    bare = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", ""))
    pages = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("\f")) + 1
    scanned = is_pdf & ((bare < 200) | (bare < 20 * pages))
    status = F.when(scanned, "NO_TEXT").when(bare == 0, "EMPTY").otherwise("OK")
    return F.struct(status.alias("status"), pages.cast("int").alias("pages"), scanned.alias("ocr_candidate"))


def recovered(links: DataFrame) -> DataFrame:
    """The urls that a link with a hash already recovers."""
    return links.where((F.coalesce("sha256", F.lit("")) != "") & F.col("relation").isin("SAME_DOCUMENT", "OFFICIAL_MIRROR", "ARCHIVED_VERSION")).select(F.col("original_url").alias("url")).distinct()


def save_queue(queue: DataFrame) -> DataFrame:
    """The queue in the order in which it is stored: by tier (none counts as 9), then url."""
    return queue.orderBy(F.coalesce("tier", F.lit(9)), "url")


def ocr_priority(rows: DataFrame) -> DataFrame:
    """rows(url, family, pages, high_value): additive score, band and reasons; siblings are rows of the same parent folder."""
    parent = parent_folder(F.col("url"))
    density = rows.groupBy(parent.alias("parent")).agg(F.count(F.lit(1)).alias("siblings"))
    joined = rows.withColumn("parent", parent).join(density, "parent")
    high, medium = F.lower("url").rlike("owner|shell|indict|settle|exhibit"), F.lower("url").rlike("report|order|filing|testimony")
    parts = (
        (F.col("high_value"), 2, "high_value"), (high, 3, "url_high"), (~high & medium, 1, "url_medium"), (F.col("family").isin("FBI_VAULT", "DOJ", "CONGRESS_OVERSIGHT", "GOVINFO"), 2, "family"), (F.col("pages").between(3, 200), 1, "pages"), (F.col("siblings") > 50, 2, "dense_folder"), ((F.col("siblings") > 10) & (F.col("siblings") <= 50), 1, "folder"),
    )
    score = F.lit(0)
    for test, points, _ in parts:
        score = score + F.when(F.coalesce(test, F.lit(False)), points).otherwise(0)
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, _, name in parts)))
    return joined.select("url", score.alias("score"), F.when(score >= 6, "HIGH").when(score >= 3, "MEDIUM").otherwise("LOW").alias("band"), reasons.alias("reasons"))


# Weights of provenance, family and category, and the patterns that are looked for in a span's paragraph.
PROVENANCE_WEIGHTS = {"CONGRESS": 3, "COURT": 3, "FOIA": 2, "GOV-PUBLIC": 2}
FAMILY_WEIGHTS = {"DOJ": 2, "SEC": 2, "CONGRESS_OVERSIGHT": 2, "CONGRESS_JUDICIARY": 2, "CONGRESS_GOV": 2, "GAO": 2, "FBI_VAULT": 2, "GOVINFO": 1, "FINCEN": 1, "TREASURY_OIG": 1}
CATEGORY_WEIGHTS = {
    "OWNERSHIP_EXPLICIT": 5, "PARENT_SUBSIDIARY": 4, "CONTROL_EXPLICIT": 4, "SHELL_NOMINEE": 4, "FINANCIAL_FLOW": 3, "BOI_CTA": 3, "SAR_BSA": 3, "FORMATION_DISSOLUTION": 2, "ROLE_TITLE": 2, "STRUCTURED": 5,
}
URL_HINT = r"(?i)press-release|enforcement|complaint|indictment|plea|sentenc|consent-order|cease|charged|convicted|guilty|opa/pr"
DEFINITIONAL = "(?iU)\\b(?:means|is\\s+defined\\s+as|definition\\s+of|for\\s+purposes\\s+of\\s+this|the\\s+term\\s+[\"“'])"
AMOUNT = r"(?iU)\$\s?[\d,]{3,}(?:\.\d{2})?|\b(?:million|billion)\b"
PERCENT = r"(?iU)\b\d{1,3}(?:\.\d+)?\s?(?:%|percent)\b"
DATE_NEARBY = r"(?iU)\b(?:19|20)\d{2}\b|\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2}\b"
PERSON_NAME = r"(?U)\b[A-Z][a-z]{2,}\s+(?:[A-Z]\.?\s+)?[A-Z][a-z]{2,}\b"
ENTITY_SUFFIX = r"(?U)\b(?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Ltd\.?|LP|LLP|PLLC|Company|Co\.)\b"
LEADERS = r"(?U)\.{5,}|\bTable\s+\d+:"
WEIGHTS = ("provenance_weight", "family_weight", "category_weight")


def rank_spans(spans: DataFrame) -> DataFrame:
    """spans(id, seq, provenance, family, url, category, matched_text, paragraph) with review_priority and the features that made it."""

    def weight(column: str, table: dict[str, int], other: int) -> Column:
        return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), F.coalesce(column, F.lit(""))), F.lit(other))

    paragraph, match = F.coalesce("paragraph", F.lit("")), F.coalesce("matched_text", F.lit(""))
    entity = paragraph.rlike(ENTITY_SUFFIX)

    def worth(test: Column, points: int) -> Column:
        return F.when(test, points).otherwise(0)

    features = {
        "provenance_weight": weight("provenance", PROVENANCE_WEIGHTS, 0), "family_weight": weight("family", FAMILY_WEIGHTS, 0), "url_enforcement_hint": worth(F.coalesce("url", F.lit("")).rlike(URL_HINT), 2),
        "category_weight": weight("category", CATEGORY_WEIGHTS, 1), "has_percentage": worth(paragraph.rlike(PERCENT), 3), "has_amount": worth(paragraph.rlike(AMOUNT), 2), "person_and_entity": worth(paragraph.rlike(PERSON_NAME) & entity, 3),
        "has_date": worth(paragraph.rlike(DATE_NEARBY), 1), "definitional": worth(match.rlike(DEFINITIONAL) | F.left(paragraph, F.lit(200)).rlike(DEFINITIONAL), -2), "short_generic": worth((F.length(match) < 40) & ~entity, -1),
        "table_or_toc": worth(paragraph.rlike(LEADERS), -2),
    }
    total = F.lit(0)
    for c in features.values():
        total = total + c
    kept = F.map_filter(F.create_map(*(x for k, c in features.items() for x in (F.lit(k), c))), lambda k, v: (v != 0) | k.isin(*WEIGHTS))
    return spans.withColumn("review_priority", total.cast("double")).withColumn("ranking_features", kept)


def document_dates(documents: DataFrame, filings: DataFrame) -> DataFrame:
    """documents(id, url, head) to date and basis: filing metadata by (cik, accession) of the url, a filing header, the head's first date, the url.

    filings(cik, accession, filed) has one row for each filing.
    """
    from veritrail.functions.scalars import iso_date

    keyed = documents.withColumns({"cik": F.ltrim(F.regexp_extract("url", r"/data/([0-9]+)/", 1), F.lit("0")), "accession": F.regexp_extract("url", r"([0-9]{10}-[0-9]{2}-[0-9]{6})", 1)})
    known = filings.select(F.ltrim(F.col("cik").cast("string"), F.lit("0")).alias("cik"), "accession", "filed")
    header = F.regexp_extract("head", r"FILED AS OF DATE:\s+([0-9]{8})", 1)
    steps = (
        (F.col("filed"), "filing_metadata"), (F.when(header != "", F.concat_ws("-", F.substring(header, 1, 4), F.substring(header, 5, 2), F.substring(header, 7, 2))), "filing_header"),
        (F.when(F.length(iso_date(F.left("head", F.lit(1500)))) == 10, iso_date(F.left("head", F.lit(1500)))), "head"), (F.nullif(F.regexp_extract("url", r"((?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})", 1), F.lit("")), "url"), (F.nullif(F.regexp_extract("url", r"/((?:19|20)[0-9]{2})/", 1), F.lit("")), "url_year"),
    )
    first = F.coalesce(*(F.when(c.isNotNull(), F.struct(c.alias("date"), F.lit(b).alias("basis"))) for c, b in steps))
    return keyed.join(known, ["cik", "accession"], "left").select("id", first["date"].alias("date"), first["basis"].alias("basis"))
