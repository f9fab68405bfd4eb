"""Queries of the rules over cases: each document stands for one case of a list (by its id), whose outcome is written down beside it from the rule, not computed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.functions import scalars
from veritrail.operators import corpus, evidence, logstate, recovery, respond
from veritrail.plans.log_queries import table

#: query: (columns of a case, rows of (case..., expected outcome), function from the frame of cases to (k, out))
CASES: dict[str, tuple[str, list[tuple], object]] = {}


def rule(schema: str, rows: list[tuple]):
    def register(apply):
        CASES[apply.__name__] = (schema, rows, apply)
        return apply

    return register


def cases(spark, sf_dir, schema: str, rows: list[tuple]) -> DataFrame:
    listed = spark.createDataFrame([(k, *r[:-1]) for k, r in enumerate(rows)], f"k long, {schema}")
    return table(spark, sf_dir, "documents").select((F.col("doc_id") % len(rows)).alias("k")).join(F.broadcast(listed), "k")


def run_cases(name: str):
    def query(spark, sf_dir):
        schema, rows, apply = CASES[name]
        return apply(cases(spark, sf_dir, schema, rows)).groupBy(F.col("out").cast("string").alias("out")).agg(F.count(F.lit(1)).alias("n"))

    query.__name__ = name
    return query


def cases_sql(name: str) -> str:
    rows = CASES[name][1]
    text = lambda v: "NULL" if v is None else "'" + (str(v).lower() if isinstance(v, bool) else str(v)).replace("'", "''") + "'"
    listed = ", ".join(f"({k}, {text(r[-1])})" for k, r in enumerate(rows))
    return f"SELECT out, count(*) AS n FROM documents JOIN (VALUES {listed}) c(k, out) ON doc_id % {len(rows)} = k GROUP BY out"


@rule("url string, family string", [
    ("https://www.fincen.gov/x", "fincen", 0), ("https://www.federalregister.gov/d/1", "federal_register", 0), ("https://a.gov/Beneficial-Ownership/q", "other", 0), ("https://a.gov/boi-faq", "other", 0), ("https://a.gov/boiler", "other", 0), ("https://a.gov/opa/pr/1", "doj", 1),
    ("https://a.gov/money-laundering", "doj", 1), ("https://a.gov/OIG/2", "other", 1), ("https://a.gov/news", "doj", 2), (None, "gao", 2), ("https://a.gov/x", None, 2),
])
def url_tiers(c):
    return c.select("k", recovery.tier(F.col("url"), F.col("family")).alias("out"))


@rule("url string", [
    ("https://www.justice.gov/a", "doj>same_agency_retry_probe"), ("https://www.federalregister.gov/a", "federal_register>federal_register_api"), ("https://www.govinfo.gov/a", "govinfo>web_archive"), ("https://www.congress.gov/a", "congress>govinfo_package"),
    ("https://www.gao.gov/a", "gao>same_agency_retry_probe"), ("https://www.fincen.gov/a", "fincen>web_archive"), ("https://home.treasury.gov/a", "treasury>web_archive"), ("https://www.sec.gov/a", "sec>web_archive"), ("https://vault.fbi.gov/a", "fbi>web_archive"),
    ("https://web.archive.org/a", "web_archive>web_archive"), ("https://example.org/www.sec.gov", "other>web_archive"),
])
def recovery_routes(c):
    family = recovery.family(scalars.host(F.col("url")))
    return c.select("k", F.concat(family, F.lit(">"), F.element_at(recovery.routes(family), 1)).alias("out"))


@rule("host string", [
    ("www.fincen.gov", "FINCEN GOV-PUBLIC"), ("bsaaml.ffiec.gov", "FFIEC GOV-PUBLIC"), ("oig.treasury.gov", "TREASURY_OIG GOV-PUBLIC"), ("oversight.house.gov", "CONGRESS_OVERSIGHT CONGRESS"), ("www.congress.gov", "CONGRESS_GOV CONGRESS"), ("vault.fbi.gov", "FBI_VAULT GOV-PUBLIC"),
    ("sec.gov", "OTHER_GOV GOV-PUBLIC"), (None, "OTHER_GOV GOV-PUBLIC"),
])
def host_families(c):
    return c.select("k", F.concat_ws(" ", scalars.host_family(F.col("host")), logstate.provenance_of(F.col("host"))).alias("out"))


@rule("present boolean, claimed string, sniffed string", [
    (True, "text/html", "text/html", False), (True, "text/html", "text/plain", False), (True, "application/xhtml+xml", "text/html", False), (True, "text/html", "application/pdf", True), (True, "application/pdf", "text/html", True), (False, "application/pdf", "text/html", False),
    (True, "", "text/html", False), (True, None, "text/html", False), (True, "text/csv", "text/plain", False), (True, "application/zip", "application/octet-stream", True), (None, "a", "b", False),
])
def mime_conflicts(c):
    return c.select("k", scalars.mime_conflict(F.col("present"), F.col("claimed"), F.col("sniffed")).alias("out"))


@rule("head string", [
    ("255044462D312E34", "application/pdf"), ("2550444620", "text/plain"), ("504B0304", "application/zip"), ("504B0506", "application/zip"), ("1F8B08", "application/gzip"), ("28B52FFD00", "application/zstd"), ("252150532D41", "application/postscript"), ("89504E47", "image/png"), ("FFD8FFE0", "image/jpeg"),
    ("4749463837", "image/gif"), ("49492A00", "image/tiff"), ("4D4D002A", "image/tiff"), ("D0CF11E0", "application/x-ole-storage"), ("7B5C72746631", "application/rtf"), ("", "empty"), (None, None), ("20203C3F786D6C3E3C613E", "application/xml"),
    ("3C3F786D6C3E3C48544D4C3E", "text/html"), ("0A3C21444F43545950452068746D6C3E", "text/html"), ("3C703E3C68746D6C3E", "text/html"), ("7B2261223A317D", "application/json"), ("5B312C325D", "application/json"), ("5B312C32", "text/plain"), ("7B2261223A", "application/json"), ("7B61", "text/plain"), ("E9E8", "text/plain"),
])
def magic_bytes(c):
    return c.select("k", scalars.sniff_mime(F.unhex("head")).alias("out"))


@rule("name string", [
    (None, "MISSING"), ("", "MISSING"), ("Acme Holdings", "ENTITY"), ("First Bank of X", "ENTITY"), ("the Seller", "DEFINED_TERM"), ("WFB", "ABBREVIATION"), ("CS-2", "ABBREVIATION"), ("John Smith", "PERSON_CANDIDATE"), ("John Q. Smith", "PERSON_CANDIDATE"), ("Forrest", "SURNAME_CANDIDATE"),
    ("ab", "UNCLASSIFIED"), ("John Smith Jones Brown Green", "UNCLASSIFIED"),
])
def actor_kinds(c):
    return c.select("k", evidence.actor_kind(F.col("name")).alias("out"))


@rule("name string, role string", [
    ("Acme Holdings LLC", "owner", "entity"), ("Smith", "owner", "person"), ("Smith", "alias_subject", "person"), ("Smith", "owned", "entity"), ("IBM", "owner", "entity"), ("John Smith", "owned", "person"), ("Maria de Silva", "owned", "entity"), ("One Two Three Four Five", "owner", "entity"), ("Banco Central", "owner", "person"),
    ("Acme Trust.", "owner", "entity"),
])
def node_kinds(c):
    return c.select("k", evidence.node_kind(F.col("name"), F.col("role")).alias("out"))


GATES = [
    (None, "missing party"), ("the Bank", "document-generic reference; needs in-document resolution"), ("Approval of the Bank", "document-generic reference; needs in-document resolution"), ("Delaware", "stop-listed name (place/agency/group, not an owner party)"), ("FinCEN", "stop-listed name (place/agency/group, not an owner party)"),
    ("Hong Kong", "stop-listed name (place/agency/group, not an owner party)"), ("AB", "name too short to identify a party"), ("Holdings Limited", "bare corporate-suffix token(s), not a name"), ("Two Smiths", "count phrase / generic plural, not a named party"), ("Foreign companies", "count phrase / generic plural, not a named party"),
    ("New York corporation", "jurisdiction-form phrase, not a party name"), ("Delaware LLC", "jurisdiction-form phrase, not a party name"), ("It Holdco", "clause fragment, not a name"), ("J. P.", "initials-only fragment"), ("Acme LLC", None), ("John Smith", None),
]


@rule("name string", GATES)
def gate_reasons(c):
    return c.select("k", evidence.gate(F.col("name")).alias("out"))


@rule("name string", [(n, None if r is None else r.split(";")[0]) for n, r in GATES])
def gate_histogram(c):
    """The histogram of reasons without what follows a semicolon, from rows that were rejected."""
    return c.select("k", F.split_part(evidence.gate(F.col("name")), F.lit(";"), F.lit(1)).alias("out"))


@rule("assertion_type string, subject_raw string, object_raw string, reported_speech boolean, extraction_confidence double, duplicate_of_prior boolean", [
    ("OWNERSHIP", "Ann Lee", "Beta LLC", False, 0.9, False, "BENEFICIAL_OWNER"), ("CONTROL", "Ann Lee", "Beta and Gamma LLC", False, 0.9, None, "UNKNOWN_CONTROL_ROLE"), ("PARENT_SUBSIDIARY", "Alpha Inc", "Beta LLC", None, 1.0, False, "PARENT"), ("OWNERSHIP", "Ann Lee", "Beta LLC", False, 0.9, True, "skip_duplicate_sentence"),
    ("SHELL_NOMINEE", "Ann Lee", "Beta LLC", False, 0.9, False, "skip_type_SHELL_NOMINEE"), ("OWNERSHIP", None, "Beta LLC", False, 0.9, False, "skip_missing_party"), ("OWNERSHIP", "Ann Lee", "Beta LLC", True, 0.9, False, "skip_reported_speech"), ("OWNERSHIP", "Ann Lee", "Beta LLC", False, 0.55, False, "skip_low_confidence"),
    ("OWNERSHIP", "Both Owners", "Beta LLC", False, 0.9, False, "skip_name_screen"), ("OWNERSHIP", "Al", "Beta LLC", False, 0.9, False, "skip_name_screen"), ("OWNERSHIP", "Ann Lee", "Beta and Gamma LLC", False, 0.9, False, "skip_conjunctive_object"), ("OWNERSHIP", "Ann Lee", "Trust", False, 0.9, False, "skip_name_screen"),
])
def skip_reasons(c):
    return evidence.skip_reason(c).select("k", F.coalesce("skip_reason", "assertion").alias("out"))


@rule("name string", [
    ("Lucas, Nunns and McNaul", "Lucas+Nunns+McNaul"), ("Cravath, Swaine & Moore LLP", "Cravath, Swaine & Moore LLP"), ("John Smith", "John Smith"), ("Smith and their affiliated entities", "Smith and their affiliated entities"), ("Ann Lee and Bo Ray", "Ann Lee+Bo Ray"),
    ("Smith, the man of the hour and more", "Smith, the man of the hour and more"),
])
def owner_lists(c):
    return c.select("k", F.array_join(evidence.owners(F.col("name")), "+").alias("out"))


@rule("name string", [
    ("He said so. Acme LLC", "Acme LLC"), ("pursuant to Acme LLC", "Acme LLC"), ("Texas-based Acme LLC", "Acme LLC"), ("SCHEDULE 13G Exhibit 1 Acme LLC", "Acme LLC"), ("the report.12 Acme LLC,", "Acme LLC"), ("The Acme LLC.", "Acme LLC"), (" ,;", None),
])
def sanitized_names(c):
    return c.select("k", evidence.sanitize(F.col("name")).alias("out"))


@rule("family string, url string, head string, classes array<string>", [
    ("SEC", "https://x/sc-13d.txt", "", [], "SELF_REPORTED"), ("SEC", "https://x/1", "Schedule 13", ["SEC_OWNERSHIP"], "SELF_REPORTED"), ("SEC", "https://x/1", "none", ["SEC_OWNERSHIP"], "GOVERNMENT_ALLEGATION"), ("SEC", "https://x/comp2020", "", [], "GOVERNMENT_ALLEGATION"), ("SEC", "https://x/final-judgment", "", [], "COURT_ALLEGATION"),
    ("SEC", "https://x/cease-and-desist", "", [], "GOVERNMENT_FINDING"), ("TREASURY", "https://x/sdn", "", [], "ADMINISTRATIVE_DESIGNATION"), ("TREASURY_OIG", "https://x/1", "", ["SANCTIONS"], "ADMINISTRATIVE_DESIGNATION"), ("TREASURY", "https://x/1", "", [], "GOVERNMENT_FINDING"), ("FINCEN", "https://x/1", "", [], "GOVERNMENT_FINDING"),
    ("DOJ", "https://x/judgment", "", [], "GOVERNMENT_ALLEGATION"), ("CONGRESS_OVERSIGHT", None, None, None, "CONGRESSIONAL_ASSERTION"), ("NCUA", "https://x/1", "", [], "OTHER_DIRECT_ASSERTION"), (None, None, None, None, "OTHER_DIRECT_ASSERTION"),
])
def postures(c):
    return c.select("k", evidence.posture(F.col("family"), F.col("url"), F.col("head"), F.col("classes")).alias("out"))


@rule("categories array<string>, terms array<string>, provenance string, family string, classes array<string>", [
    (["OWNERSHIP_EXPLICIT"], [], "COURT", "SEC", [], "ownership"), (["STRUCTURED"], ["pct_of_entity"], "COURT", "SEC", [], "ownership"), (["STRUCTURED"], ["person_role_entity"], "COURT", "SEC", [], ""), (["STRUCTURED"], ["entity_subsidiary_of"], "COURT", "SEC", [], "parent-subsidiary"),
    (["CONTROL_EXPLICIT", "SHELL_NOMINEE"], [], "CONGRESS", "SEC", [], "congressional+control+shell-structure"), (["FINANCIAL_FLOW"], [], None, "CONGRESS_GOV", None, "congressional+financial-flow"), (["BOI_CTA", "SAR_BSA"], None, None, None, ["CONGRESSIONAL_EVIDENCE"], "boi-cta+congressional+sar-bsa"),
    (["PARENT_SUBSIDIARY"], [], "COURT", "SEC", [], "parent-subsidiary"),
])
def candidate_buckets(c):
    rows = c.withColumn("row", F.monotonically_increasing_id())
    found = corpus.buckets(rows).groupBy("row").agg(F.array_join(F.array_sort(F.collect_list("bucket")), "+").alias("out"))
    return rows.select("k", "row").join(found, "row", "left").select("k", F.coalesce("out", F.lit("")).alias("out"))


@rule("family string, url string", [("GAO", "https://x/1", True), ("OTHER_GOV", "https://x/Consent-1", True), ("OTHER_GOV", "https://x/news", False), (None, None, False), (None, "https://x/vault", True)])
def high_value_rows(c):
    return c.select("k", recovery.high_value(F.col("family"), F.col("url")).alias("out"))


@rule("text string, is_pdf boolean", [
    ("x" * 300, True, "OK/1/false"), ("x" * 199, True, "NO_TEXT/1/true"), ("x" * 250 + "\f" * 19, True, "NO_TEXT/20/true"), ("short", False, "OK/1/false"), (" \n", False, "EMPTY/1/false"), (None, False, "EMPTY/1/false"), (None, True, "NO_TEXT/1/true"),
])
def text_statuses(c):
    s = recovery.text_status(F.col("text"), F.col("is_pdf"))
    return c.select("k", F.concat_ws("/", s["status"], s["pages"], s["ocr_candidate"]).alias("out"))


PARAGRAPH = "Then John Smith of Acme LLC paid $5,000 in May 3 of 2010"


@rule("provenance string, family string, url string, category string, matched_text string, paragraph string", [
    ("CONGRESS", "DOJ", "https://x/opa/pr/1", "OWNERSHIP_EXPLICIT", "owned by", PARAGRAPH, "18.0"), ("GOV-PUBLIC", "GOVINFO", "https://x/1", "ROLE_TITLE", "trustee", "a trustee", "4.0"), (None, None, None, "X", "m", "", "0.0"),
    ("COURT", "SEC", "https://x/1", "STRUCTURED", "The term \"owner\" is long enough to be no short match", "Table 4: owners", "6.0"), ("FOIA", "GAO", "https://x/plea", "FINANCIAL_FLOW", "wired to Beta Inc.", "wired to Beta Inc.", "12.0"),
])
def span_ranks(c):
    return recovery.rank_spans(c).select("k", F.col("review_priority").alias("out"))


@rule("url string, status int, content_type string, body string, family string", [
    ("https://a/d.pdf", 200, "application/pdf", "%PDF-1.4 " + "x" * 900, "doj", "true REAL_CONTENT"), ("https://a/d.pdf", 200, "application/pdf", "no pdf", "doj", "false UNKNOWN_RESPONSE"), ("https://a/n", 200, "text/html", "<html><title>t</title>" + "word " * 40, "doj", "false UNKNOWN_RESPONSE"),
    ("https://a/n", 200, "text/html", "<html><title>t</title><article>" + "word " * 40, "doj", "true THIN_REAL_CONTENT"), ("https://a/n", 200, "text/html", "<html><title>t</title>" + "word " * 200, "doj", "true REAL_CONTENT"), ("https://a/d.json", 200, "application/json", " {\"a\": 1}", "federal_register", "true REAL_CONTENT"),
    ("https://a/d.json", 200, "application/json", "sorry", "federal_register", "false UNKNOWN_RESPONSE"), ("https://a/n", 404, "text/html", "<html>gone", "doj", "false ERROR_RESPONSE"), ("https://a/n", 200, "text/html", "<html><title>t</title>" + "word " * 200, "gao", "true REAL_CONTENT"),
])
def content_gate(c):
    rows = c.withColumns({"final_url": F.col("url"), "error": F.lit(None).cast("string"), "host_pattern": F.lit(False), "url": F.concat("url", F.lit(""))})
    keyed = rows.withColumn("url", F.col("url"))
    return respond.gate_content(keyed).select(F.concat_ws(" ", "ok", "kind").alias("out"))


@rule("url string, content_type string, content_length long, family string, host_pattern boolean", [
    ("https://a/1", "text/html", 900, "doj", True, "BOT_CHALLENGE MEDIUM"), ("https://a/1", "text/html", 900, "gao", False, "UNKNOWN_RESPONSE LOW"), ("https://a/1.PDF", "text/html", 90000, "doj", False, "UNKNOWN_RESPONSE LOW"), ("https://a/1", "text/html", 90000, "doj", True, "REAL_CONTENT LOW"), ("https://a/1", None, None, None, None, "REAL_CONTENT LOW"),
])
def unread_classes(c):
    return respond.classify_unread(c).select(F.concat_ws(" ", "kind", "confidence").alias("out"))


@rule("route string, kind string, found boolean", [
    ("same_agency_probe", "REAL_CONTENT", None, "RECOVERED_SAME_AGENCY"), ("same_agency_probe", "BOT_CHALLENGE", None, None), ("web_archive", "REAL_CONTENT", True, "RECOVERED_WEB_ARCHIVE"), ("web_archive", "BOT_CHALLENGE", True, "WEB_ARCHIVE_NON_CONTENT"), ("web_archive", None, False, "NO_WEB_ARCHIVE_CAPTURE"), ("web_archive", "REAL_CONTENT", None, None),
])
def fetch_outcomes(c):
    return c.select("k", respond.after_fetch(F.col("route"), F.col("kind"), F.col("found")).alias("out"))


@rule("name string", [
    ("Acme Corporation", "acme corp"), ("The Acme Company, Limited", "acme co ltd"), ("ACME L L C", "acme llc"), ("First Bank, National Association", "first bank na"), ("O’Brien's  Companies", "obriens cos"), ("A.B. Incorporated.", "ab inc"), (None, ""), ("Théâtre & Co", "théâtre & co"),
])
def graph_keys(c):
    return c.select("k", scalars.graph_key(F.col("name")).alias("out"))


@rule("text string", [
    ("In 2019 Acme Holdings LLC owns 25% of the shares of Beta Corp. today.", "A owns_pct_of In 2019 Acme Holdings LLC|Beta Corp|25|0.9"), ("Gamma Corp. is owned by John Smith. More.", "A owned_by John Smith|Gamma Corp|0.9"), ("The Bank is controlled by Delta Holdings.", "B controlled_by Delta Holdings|The Bank|0.55"),
    ("Nothing owned here of note.", ""), ("Alpha Inc. is a wholly-owned subsidiary of Omega Group.", "C subsidiary_of Omega Group|Alpha Inc|0.9"), ("Beta LLC was merely a shell company.", "D shell_named Beta LLC|0.55"),
])
def observations(c):
    rows = c.withColumn("id", F.monotonically_increasing_id())
    found = evidence.observe(corpus.spans(rows.select("id", "text")), rows.select("id", "text"))
    said = found.select("id", F.concat_ws(" ", "tier", "predicate_raw", F.concat_ws("|", "subject_raw", "object_raw", "percentage_raw", "extraction_confidence")).alias("out"))
    return rows.select("k", "id").join(said, "id", "left").select("k", F.coalesce("out", F.lit("")).alias("out"))


QUERIES = {name: run_cases(name) for name in CASES}
ORACLES = {name: cases_sql(name) for name in CASES}
