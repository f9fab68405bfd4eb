import random

from hypothesis import given, settings
from hypothesis import strategies as st

from veritrail.operators import logstate, respond

LOG = "url string, retrieved_at string, seq long, sha256 string, http_status int, error string, host string, content_type string, content_length long"


def frame(spark, rows):
    full = [(u, t, s, h, c, e, "h.example", "text/html", 2500) for u, t, s, h, c, e in rows]
    return spark.createDataFrame(full, LOG)


def histories():
    """(name, history of hash or None, change, previous, current)"""
    return [
        ("a", ["A"], "ADDED", None, "A"), ("aa", ["A", "A"], "UNCHANGED", "A", "A"), ("ab", ["A", "B"], "MODIFIED", "A", "B"), ("af", ["A", None], "REMOVED", "A", None),
        ("ff", [None, ""], "UNAVAILABLE", None, None), ("afa", ["A", None, "A"], "UNCHANGED", "A", "A"), ("abf", ["A", "B", ""], "REMOVED", "B", None), ("fab", [None, "A", "B"], "MODIFIED", "A", "B"),
    ]


def test_ledger_cases_in_any_order(spark):
    rows, seq = [], 0
    for name, history, *_ in histories():
        for k, sha in enumerate(history):
            rows.append((name, f"2026-01-0{k + 1}", seq, sha, 200 if sha else 500, None))
            seq += 1
    rows += [("tie", "2026-01-01", 900, "A", 200, None), ("tie", "2026-01-01", 901, "B", 200, None)]
    want = {n: (c, p, q) for n, _, c, p, q in histories()} | {"tie": ("MODIFIED", "A", "B")}
    for seed in (0, 1):
        random.Random(seed).shuffle(rows)
        got = {r.url: (r.change_type, r.previous_sha256, r.current_sha256) for r in logstate.ledger(frame(spark, rows)).collect()}
        assert got == want


def test_queue(spark):
    rows = [("ok", "t", 0, "A", 200, None), ("shell", "t", 1, "A", 200, None), ("robots", "t", 2, None, None, "robots_disallowed"), ("review", "t", 3, None, None, "host_not_allowlisted"), ("no", "t", 4, None, 403, None), ("gone", "t", 5, None, 410, None), ("slow", "t", 6, None, 429, None)]
    rows += [("tried", "t", 10 + k, None, 500, None) for k in range(5)]
    known = spark.createDataFrame([("ok", "P", "s", "seed"), ("new", "P", "s", "seed")], "url string, provenance string, source string, origin string")
    challenged = spark.createDataFrame([("shell",), ("shell",)], "url string")
    queue = logstate.work_queue(known, frame(spark, rows), challenged)
    got = {r.url: (r.state, r.attempts, r.retry_eligible, r.origin) for r in queue.collect()}
    assert got == {
        "ok": ("ARCHIVED", 1, False, "seed"), "new": ("DISCOVERED", 0, False, "seed"), "shell": ("NON_CONTENT_TECHNICAL_RESPONSE", 1, False, "crawl"), "robots": ("ROBOTS_DISALLOWED", 1, False, "crawl"), "review": ("MANUAL_REVIEW", 1, False, "crawl"),
        "no": ("ACCESS_RESTRICTED", 1, False, "crawl"), "gone": ("NOT_FOUND", 1, False, "crawl"), "slow": ("RATE_LIMITED", 1, True, "crawl"), "tried": ("TEMPORARY_ERROR", 5, False, "crawl"),
    }
    assert [r.url for r in logstate.pending(queue, 5).collect()] == ["new", "slow"]


def test_merge_keeps_base_and_is_idempotent(spark):
    schema = "id string, v int"
    base, other = spark.createDataFrame([("a", 1), (None, 5)], schema), spark.createDataFrame([("a", 2), ("b", 3), (None, 5), (None, 6)], schema)
    merged = logstate.merge_by_id(base, other)
    assert sorted((str(r.id), r.v) for r in merged.collect()) == [("None", 5), ("None", 6), ("a", 1), ("b", 3)]
    assert logstate.merge_by_id(merged.drop("merge_key"), other).count() == 4


def test_host_anomaly_and_coverage(spark):
    rows = [(f"u{i}", "t", i, f"h{i}", 200, None) for i in range(60)]
    assert [r.host for r in respond.host_anomalies(frame(spark, rows)).collect()] == ["h.example"]
    assert respond.host_anomalies(frame(spark, rows[:49])).count() == 0
    obs = spark.createDataFrame([(u, c, s) for u, c, s in [("m", "BOT_CHALLENGE", 200), ("s", "BOT_CHALLENGE", 200), ("w", "BOT_CHALLENGE", 200), ("n", "BOT_CHALLENGE", 200), ("d", "ERROR_RESPONSE", 403), ("o", "REDIRECT_STUB", 200), ("e", "BOT_CHALLENGE", 200)]], "url string, classification string, http_status int")
    links = spark.createDataFrame([("m", "x", "OFFICIAL_MIRROR", "h", 1), ("s", "s", "SAME_DOCUMENT", "h", 2), ("w", "x", "ARCHIVED_VERSION", "h", 3), ("e", "x", "OFFICIAL_MIRROR", "", 4)], "original_url string, alternative_url string, relation string, sha256 string, seq long")
    got = {r.url: r.state for r in respond.coverage_states(obs, links).collect()}
    assert got == {"m": "RECOVERED_OFFICIAL_MIRROR", "s": "ARCHIVED_CONTENT", "w": "RECOVERED_WEB_ARCHIVE", "n": "UNRESOLVED_CHALLENGE", "d": "ACCESS_RESTRICTED", "o": "NON_CONTENT_TECHNICAL_RESPONSE", "e": "UNRESOLVED_CHALLENGE"}


def page(body, url="https://a.example/x", status=200, kind="text/html", final=None, error=None, pattern=False):
    return (url, final, status, kind, body, error, pattern)


def test_response_classifier(spark):
    long = "<html><title>T</title><body>" + "real words here " * 60 + "</body></html>"
    cases = [
        (page(long), "REAL_CONTENT"), (page("<html><title>T</title><body>" + "words " * 30 + "</body></html>"), "THIN_REAL_CONTENT"), (page("%PDF-1.4 x", "https://a.example/d.pdf", kind="application/pdf"), "REAL_CONTENT"), (page('{"a":1}', kind="application/json"), "REAL_CONTENT"),
        (page("<html>Access Denied Reference #18 akamai</html>"), "BOT_CHALLENGE"), (page("<html><script src=/cdn-cgi/challenge-platform></script>wait</html>"), "BOT_CHALLENGE"), (page('<html><body><div id="root"></div></body></html>'), "APPLICATION_SHELL"), (page("<html>Access denied</html>", status=403), "ACCESS_INTERSTITIAL"),
        (page("<html>no</html>", "https://a.example/d.pdf"), "BOT_CHALLENGE"), (page('<html><meta http-equiv="refresh" content="0;url=/y">x</html>'), "REDIRECT_STUB"), (page("<html>sorry</html>", status=403), "ERROR_RESPONSE"), (page("", status=404), "ERROR_RESPONSE"), (page("<html>x</html>", status=429), "ERROR_RESPONSE"),
        (page("<html><p>tiny</p></html>"), "UNKNOWN_RESPONSE"), (page("<html><p>tiny</p></html>", pattern=True), "BOT_CHALLENGE"), (page(long, pattern=True), "REAL_CONTENT"), (page(None, status=None, error="redirect escaped allowlist: https://unblock.a.example/z"), "ACCESS_INTERSTITIAL"), (page(None, status=None), "ERROR_RESPONSE"),
    ]
    rows = [(f"{r[0]}?{i}" if not r[0].endswith("pdf") else r[0], *r[1:]) for i, (r, _) in enumerate(cases)]
    frame_ = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "url string, final_url string, status int, content_type string, body string, error string, host_pattern boolean, n int")
    got = respond.classify(frame_.coalesce(1)).collect()
    assert [r.kind for r in got] == [k for _, k in cases]
    assert got[8].signals == ["expected_pdf_not_pdf"] and "pdf_magic_bytes" in got[2].signals and got[4].vendor == "akamai"


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=4), st.integers(1, 100), max_size=30), st.integers(1, 250))
def test_packing_is_whole_and_first_fit(sizes, target):
    placed = logstate.pack_hosts(list(sizes.items()), target)
    load = [sum(sizes[h] for h in sizes if placed[h] == k) for k in range(max(placed.values(), default=-1) + 1)]
    assert set(placed) == set(sizes) and all(n <= target or sum(k == at for at in placed.values()) == 1 for k, n in enumerate(load))
    # no chunk would have had room for the first host of a later one
    assert all(load[i] + max(sizes[h] for h in sizes if placed[h] == j) > target for j in range(len(load)) for i in range(j))
