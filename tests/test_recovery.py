from pyspark.sql import functions as F

from veritrail.operators import recovery


def test_offline_pass_and_carry(spark):
    queue = spark.createDataFrame([("https://fr/a", "2024-1", "PENDING", 0), ("https://fr/b", "2024-2", "RETRY_LATER", 1), ("https://fr/c", None, "PENDING", 0), ("https://fr/d", "2024-1", "RECOVERED_WEB_ARCHIVE", 3)], "url string, document_number string, state string, attempts int")
    archived = spark.createDataFrame([("https://mirror.example/x/2024-1.pdf", "application/pdf", "h2", 2), ("https://mirror.example/2024-1.pdf", "application/pdf", "h1", 1), ("https://mirror.example/2024-2.pdf", "text/html", "h", 3), ("https://other/2024-2.pdf", "application/pdf", "h", 4)], "url string, content_type string, sha256 string, seq int")
    passed = recovery.recover_offline(queue, archived, "mirror.example", "2026-01-01")
    got = {r.url[-1]: (r.state, r.attempts, r.next_retry_after, r.mirror_url) for r in passed.collect()}
    assert got == {"a": ("RECOVERED_OFFICIAL_MIRROR", 1, None, "https://mirror.example/2024-1.pdf"), "b": ("RETRY_LATER", 2, "2026-01-08", None), "c": ("NO_DOCUMENT_IDENTITY", 0, None, None), "d": ("RECOVERED_WEB_ARCHIVE", 3, None, None)}
    again = recovery.recover_offline(passed.select(*queue.columns), archived, "mirror.example", "2026-01-01").collect()
    assert {r.url[-1]: r.attempts for r in again} == {"a": 1, "b": 3, "c": 0, "d": 3}
    fresh = spark.createDataFrame([("https://fr/a", "PENDING", 0), ("new", "PENDING", 0)], "url string, state string, attempts int")
    assert {r.url: (r.state, r.attempts) for r in recovery.carry(fresh, passed, ["state", "attempts"]).collect()} == {"https://fr/a": ("RECOVERED_OFFICIAL_MIRROR", 1), "new": ("PENDING", 0)}


def test_priorities_ranking_and_dates(spark):
    ocr = spark.createDataFrame([("https://h/a/b/exhibit.pdf", "DOJ", 10, True), ("https://h/a/b/x.pdf", "OTHER", 1, False)], "url string, family string, pages int, high_value boolean")
    assert {r.score: (r.band, r.reasons) for r in recovery.ocr_priority(ocr).collect()} == {8: ("HIGH", ["high_value", "url_high", "family", "pages"]), 0: ("LOW", [])}
    spans = spark.createDataFrame([(1, 0, "COURT", "DOJ", "https://x/complaint", "OWNERSHIP_EXPLICIT", "owned by", "Acme LLC is 50% owned by John Smith since 2019"), (1, 1, None, None, "u", "X", "x" * 50, "means")], "id long, seq int, provenance string, family string, url string, category string, matched_text string, paragraph string")
    ranked = recovery.rank_spans(spans).orderBy("seq").collect()
    assert [r.review_priority for r in ranked] == [3 + 2 + 5 + 2 + 3 + 1, 1 - 2] and ranked[1].ranking_features == {"provenance_weight": 0, "family_weight": 0, "category_weight": 1, "definitional": -2}
    docs = spark.createDataFrame([(1, "https://e/data/0012/0000000001-20-000001.txt", ""), (2, "https://e/x", "FILED AS OF DATE:  20200304"), (3, "https://e/x", "On May 6, 2021 we"), (4, "https://e/2019/x", "none"), (5, "https://e/x", "none")], "id long, url string, head string")
    filings = spark.createDataFrame([(12, "0000000001-20-000001", "2020-01-02")], "cik long, accession string, filed string")
    assert {r.id: (r.date, r.basis) for r in recovery.document_dates(docs, filings).collect()} == {1: ("2020-01-02", "filing_metadata"), 2: ("2020-03-04", "filing_header"), 3: ("2021-05-06", "head"), 4: ("2019", "url_year"), 5: (None, None)}


def test_families_routes_and_filter(spark):
    rows = spark.createDataFrame([("www.justice.gov",), ("x.example",)], "host string").select(recovery.family(F.col("host")).alias("f"))
    got = rows.select("f", recovery.tier(F.lit("u"), F.col("f")).alias("t"), recovery.routes(F.col("f")).alias("r")).collect()
    assert [(r.f, r.t, r.r) for r in got] == [("doj", 2, ["same_agency_retry_probe", "web_archive", "later_ordinary_retry"]), ("other", 2, ["web_archive", "later_ordinary_retry"])]
    seen = spark.createDataFrame([("REAL_CONTENT", 200), ("ERROR_RESPONSE", 404), ("ERROR_RESPONSE", 403), ("BOT_CHALLENGE", None)], "kind string, status int")
    assert recovery.to_observe(seen).count() == 2
