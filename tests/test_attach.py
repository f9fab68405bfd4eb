import io
import json
import zipfile
from collections import deque

import duckdb
import pytest
from pyspark.sql import functions as F

from veritrail.functions.scalars import slug_title
from veritrail.operators import attach, sitemaps
from veritrail.plans import attach_queries
from veritrail.sources import readers

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", list(attach_queries.QUERIES))
def test_queries_equal_their_sql(spark, name):
    got = attach_queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    with duckdb.connect() as db:
        for t in ("orders", "customer", "lineitem", "pages", "supplier"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = db.execute(f"SELECT {', '.join(columns)} FROM ({attach_queries.ORACLES[name]})").fetchall()
    assert len(want) > 0 and plain(got.select(*columns).collect()) == plain(want)


def test_repeated_facts_and_null_keys_add_no_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("z", 3)], "sha256 string, k int")
    facts = spark.createDataFrame([("a", "X"), ("a", "Y"), (None, "N")], "sha256 string, family string")
    assert plain(attach.with_inventory(rows, facts, ["family"]).collect()) == plain([("a", 1, "Y"), ("a", 1, "Y"), (None, 2, None), ("z", 3, None)])
    assert attach.of_families(rows, facts, ["X"]).count() == 2 and attach.of_families(rows, facts.limit(0), ["X"]).count() == 0


def test_slug_titles(spark):
    cases = {"https://h/a/Big_Annual-REPORT.pdf": "Big annual report", "https://h/a/report.pdf": None, "https://h/": None, "https://h/a--b/": "A  b", "https://h/v1.toolongext-x": "V1.toolongext x", None: None}
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: r.t for r in rows.select("url", slug_title(F.col("url")).alias("t")).collect()} == cases


def walk(host, robots, saved, allowed, max_sitemaps, max_urls):
    """The closure of one host by a plain queue."""
    name = lambda u: u.split("/")[2]
    queue, seen, found, n = deque(robots or [f"https://{host}/sitemap.xml"]), set(), {}, 0
    while queue and n < max_sitemaps:
        url = queue.popleft()
        if url in seen:
            continue
        seen.add(url)
        if name(url) not in allowed or url not in saved:
            continue
        n += 1
        kind, entries = saved[url]
        if kind == "sitemapindex":
            queue.extend(entries)
        else:
            found |= {u: None for u in entries if name(u) in allowed and u not in found}
    return list(found)[:max_urls], len(found) > max_urls


@pytest.mark.parametrize("bounds", [(50, 5000), (4, 5000), (50, 5), (2, 3), (1, 1)])
def test_closure_equals_a_plain_queue(spark, bounds):
    a, b = "https://a.test", "https://b.test"
    saved = {
        f"{a}/r1.xml": ("sitemapindex", [f"{a}/s2.xml", f"{a}/s1.xml", f"{a}/r1.xml", "https://no.test/s.xml", f"{a}/missing.xml", f"{b}/s.xml"]),
        f"{a}/r2.xml": ("sitemapindex", [f"{a}/s1.xml", f"{a}/r3.xml"]), f"{a}/r3.xml": ("sitemapindex", [f"{a}/r2.xml", f"{a}/s4.xml"]),
        f"{a}/s1.xml": ("urlset", [f"{a}/1", f"{a}/2", f"{a}/1", "https://no.test/1"]), f"{a}/s2.xml": ("urlset", [f"{a}/2", f"{a}/3", f"{b}/9"]),
        f"{a}/s4.xml": ("urlset", [f"{a}/4", f"{a}/5"]), f"{b}/s.xml": ("urlset", [f"{b}/7", f"{b}/8"]), f"{b}/sitemap.xml": ("urlset", [f"{b}/8", f"{b}/6"]), "https://no.test/s.xml": ("urlset", [f"{a}/bad"]),
    }
    rows = [(u, bytearray(f"<{k} xmlns='x'>{''.join(f'<u><loc>{e}</loc></u>' for e in es)}</{k}>".encode())) for u, (k, es) in saved.items()]
    stored = spark.createDataFrame([*rows, (f"{a}/missing.xml", bytearray(b"<broken")), (f"{a}/null.xml", None)], "url string, content binary")
    hosts = spark.createDataFrame([("a.test", f"Sitemap: {a}/r1.xml\nSITEMAP: /r2.xml"), ("b.test", None), ("c.test", "")], "host string, robots string")
    allowed = spark.createDataFrame([("a.test",), ("b.test",), ("b.test",)], "host string")
    got = {(r.url, r.discovered_via, r.truncated) for r in sitemaps.closure(hosts, stored, allowed, *bounds).collect()}
    want = {}
    for host, robots in (("a.test", [f"{a}/r1.xml", f"{a}/r2.xml"]), ("b.test", [])):
        pages, truncated = walk(host, robots, saved, {"a.test", "b.test"}, *bounds)
        for u in pages:
            want.setdefault(u, (f"sitemap:{host}", truncated))
    assert got == {(u, *v) for u, v in want.items()}


def test_closure_without_sitemaps(spark):
    hosts = spark.createDataFrame([("a.test", None)], "host string, robots string")
    none = spark.createDataFrame([], "url string, content binary")
    assert sitemaps.closure(hosts, none, hosts.select("host")).count() == 0


def test_newest_checkpoint(spark, tmp_path):
    for name, body in (("1", {"as_of": "2024-01-02", "n": 1}), ("2", {"as_of": "2025-01-01", "n": 2}), ("3", {"as_of": None, "n": 3}), ("4", {"as_of": "2025-01-01", "n": 4})):
        (tmp_path / f"checkpoint-{name}.json").write_text(json.dumps(body, indent=1))
    assert [r.n for r in readers.newest_checkpoint(spark, str(tmp_path)).collect()] == [4]
    assert [tuple(r) for r in readers.newest_checkpoint(spark, str(tmp_path), "as_of string, n long").collect()] == [("2025-01-01", 4)]


def test_zipped_names(spark):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("CIK0000000001.json", '{"name":"Acme LLC","formerNames":[{"name":"Old Acme"},{"name":"Older"}],"x":1}')
        z.writestr("CIK0000000002.json", '{"pad":"' + "x" * 5000 + '","name":"Too Late"}')
        z.writestr("CIK0000000001-submissions-001.json", '{"name":"Not primary"}')
        z.writestr("other.json", '{"name":"Other"}')
    archives = spark.createDataFrame([(bytearray(raw.getvalue()),), (None,)], "content binary")
    assert plain(readers.zipped_names(archives).collect()) == plain([("CIK0000000001.json", 0, "Acme LLC"), ("CIK0000000001.json", 1, "Old Acme"), ("CIK0000000001.json", 2, "Older")])


def test_filing_index_with_overflow(spark):
    arrays = "accessionNumber array<string>, filingDate array<string>, reportDate array<string>, form array<string>"
    recent = spark.createDataFrame([(1, (["a", "b"], ["2024-01-01", "2024-02-01"], ["", None], ["8-K", "10-K"]))], f"cik int, recent struct<{arrays.replace(' array', ': array')}>")
    more = spark.createDataFrame([(1, ["b", "c"], ["2020-02-01", "2020-03-01"], [None, None], ["10-Q", "3"])], f"cik int, {arrays}")
    assert plain(readers.filing_index(recent).collect()) == plain([(1, "a", "2024-01-01", "", "8-K"), (1, "b", "2024-02-01", None, "10-K")])
    assert plain(readers.filing_index(recent, more).collect()) == plain([(1, "a", "2024-01-01", "", "8-K"), (1, "b", "2020-02-01", None, "10-Q"), (1, "c", "2020-03-01", None, "3")])
