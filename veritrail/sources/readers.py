"""Readers of logs, seeds, object stores and stored documents. All read through Spark's own data sources."""

from __future__ import annotations

import html as html_lib
import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import quote, urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.functions.scalars import host
from veritrail.session import ship_package

CORRUPT = "_corrupt"


def json_log(spark: SparkSession, path: str, schema: str, mode: str = "skip") -> DataFrame:
    """JSON lines, gzip or not. mode: skip (malformed rows go), keep (they stay in _corrupt), fail."""
    if mode == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    # parsed line by line, so that counting alone sees malformed lines too
    lines = spark.read.text(path).where("trim(value) <> ''")
    rows = lines.select(F.from_json("value", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
    return rows if mode == "keep" else rows.where(f"{CORRUPT} is null").drop(CORRUPT)


def json_log_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As json_log; a path that does not exist has no rows."""
    from pyspark.errors import AnalysisException

    try:
        return json_log(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of lines that are no JSON."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("text")).where("text <> ''")
    return lines.where(F.try_parse_json("text").isNull())


def in_file_order(rows: DataFrame) -> DataFrame:
    """rows with seq, their place in order of files and lines within a run."""
    return rows.withColumn("seq", F.monotonically_increasing_id())


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """URL|PROVENANCE|SOURCE lines; blank lines and # comments go, provenance defaults to UNCLASSIFIED."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' and not startswith(v, '#')")
    part = F.split("v", r"\|", 3)
    field = lambda k: F.nullif(F.trim(F.get(part, F.lit(k))), F.lit(""))
    return lines.select(F.trim(F.get(part, F.lit(0))).alias("url"), F.coalesce(field(1), F.lit("UNCLASSIFIED")).alias("provenance"), field(2).alias("source"))


def objects(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """A content-addressed store .../aa/rest: sha256 from the path, length and, if wanted, content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    sha = F.concat(F.regexp_extract("path", r"([0-9a-f]{2})/([0-9a-f]+)$", 1), F.regexp_extract("path", r"([0-9a-f]{2})/([0-9a-f]+)$", 2))
    return found.select(sha.alias("sha256"), "length", *(["content"] if with_content else [])).where("sha256 <> ''")


def sitemap_entries(content: Column) -> Column:
    """The loc entries of a sitemap or sitemap index, in any namespace."""
    return F.transform(F.regexp_extract_all(content, F.lit(r"(?s)<(?:\w+:)?loc>\s*(.*?)\s*</(?:\w+:)?loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def robots_sitemaps(robots: Column) -> Column:
    lines = F.transform(F.split(robots, r"\r?\n"), lambda x: F.trim(x))
    return F.transform(F.filter(lines, lambda x: F.lower(x).startswith("sitemap:")), lambda x: F.trim(F.substr(x, F.lit(9))))


def api_results(pages: DataFrame) -> DataFrame:
    """pages(body) of JSON with results[]: a row for each page url and each pdf url."""
    result = "array<struct<html_url: string, pdf_url: string, document_number: string, publication_date: string, title: string, type: string>>"
    rows = pages.select(F.explode(F.from_json("body", f"struct<results: {result}>")["results"]).alias("r"))
    urls = F.array_compact(F.array("r.html_url", "r.pdf_url"))
    return rows.select(F.explode(urls).alias("url"), "r.document_number", "r.publication_date", "r.title", F.col("r.type").alias("document_type"))


def sanitize_url(url: str) -> str:
    """Percent-encoding of what may not stand in a url; what is encoded stays."""
    return quote(url.strip(), safe="%/:=&?~#+!$,;'@()*[]")


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v]


def links_of(page: str, base: str) -> list[str]:
    """Absolute http links without fragments, in order, each once."""
    parser = _Links()
    parser.feed(page)
    out = {}
    for href in parser.found:
        try:
            url = urldefrag(urljoin(base, href))[0]
        except ValueError:
            continue
        if url.startswith(("http://", "https://")):
            out[sanitize_url(url)] = None
    return list(out)


def links(pages: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """pages(url, html) to (parent_url, url), to hosts of allowed(host) only if given."""
    ship_package(pages.sparkSession)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def extract(urls: pd.Series, bodies: pd.Series) -> pd.Series:
        return pd.Series([links_of(b or "", u or "") for u, b in zip(urls, bodies, strict=True)], dtype=object)

    found = pages.select(F.col("url").alias("parent_url"), F.explode(extract("url", "html")).alias("url"))
    return found if allowed is None else found.withColumn("host", host(F.col("url"))).join(allowed.select("host").distinct(), "host", "left_semi").drop("host")


def decode(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _strip_html(raw: bytes) -> str:
    text = re.sub(r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ", decode(raw))
    text = re.sub(r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6]|/table|/ul|/ol)[^>]*>", "\n", text)
    text = html_lib.unescape(re.sub(r"(?s)<[^>]*>", "", text))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(re.sub(r"[ \t\r\f\v]+", " ", x).strip() for x in text.split("\n"))).strip()


def zip_index(raw: bytes) -> str:
    """Members, sizes, extensions and traversal paths of an archive, without inflating it."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        infos = z.infolist()
    extensions: dict[str, int] = {}
    for i in infos:
        e = i.filename.rpartition(".")[2].lower() if "." in i.filename else ""
        extensions[e] = extensions.get(e, 0) + 1
    risky = sum(i.filename.startswith("/") or ".." in i.filename.split("/") for i in infos)
    return json.dumps({"members": len(infos), "bytes": sum(i.file_size for i in infos), "by_extension": dict(sorted(extensions.items())[:20]), "traversal_paths": risky, "first": [i.filename for i in infos[:20]]}, sort_keys=True)


def extract_one(mime: str, raw: bytes) -> tuple[str, str]:
    """(status, text) of a stored object by its type; errors become a status."""
    try:
        if mime == "application/zip":
            return "INDEXED_CONTAINER", zip_index(raw)
        if mime == "text/html":
            text = _strip_html(raw)
        elif mime == "application/xml":
            text = " ".join(" ".join(ET.fromstring(raw).itertext()).split())
        elif mime == "application/json":
            text = json.dumps(json.loads(decode(raw)), sort_keys=True, indent=1, ensure_ascii=False)
        elif mime == "text/plain":
            text = decode(raw)
        else:
            return "UNSUPPORTED", ""
    except Exception as e:  # a broken object is a row, not a failed job
        return "ERROR", type(e).__name__
    return ("OK" if text.strip() else "EMPTY"), text


def extract_texts(stored: DataFrame) -> DataFrame:
    """stored(sha256, mime, content) to sha256, status, text. PDF and images are UNSUPPORTED here."""
    ship_package(stored.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(s, *extract_one(m, bytes(c))) for s, m, c in zip(b["sha256"], b["mime"], b["content"], strict=True)]
            yield pd.DataFrame(out, columns=["sha256", "status", "text"])

    return stored.select("sha256", "mime", "content").mapInPandas(run, "sha256 string, status string, text string")


# Where an archived company file tells its names.
COMPANY_NAME = rb'"name":"([^"]{1,120})"'
FORMER_NAMES = rb'(?s)"formerNames":\[(.*?)\]'


def company_names(raw: bytes) -> list[str]:
    """Names at the head of a company's JSON: the present one of the first 4,096 bytes, then the former ones of the first 8,192."""
    former = re.search(FORMER_NAMES, raw[:8192])
    found = re.findall(COMPANY_NAME, raw[:4096])[:1] + (re.findall(COMPANY_NAME, former.group(1)) if former else [])
    return [n.decode("utf-8", "replace") for n in found]


def zipped_names(archives: DataFrame, member: str = r"CIK(?!.*-submissions-).*\.json") -> DataFrame:
    """archives(content) to (member, at, name): the names in each member whose path matches; members that can't be read go.

    An archive is opened by the one task that holds it, its members are inflated one at a time. Cut very large archives before they are stored.
    """
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    for path in z.namelist():
                        if not re.fullmatch(member, path):
                            continue
                        try:
                            with z.open(path) as f:
                                names = company_names(f.read(8192))
                        except (zipfile.BadZipFile, OSError, EOFError, NotImplementedError, RuntimeError):
                            continue
                        if names:
                            yield pd.DataFrame({"member": path, "at": range(len(names)), "name": names})

    return archives.where("content is not null").select("content").mapInPandas(run, "member string, at int, name string")


def newest_checkpoint(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The checkpoint with the greatest as_of (none counts as empty; ties: the last file) of a folder of JSON documents, one row."""
    reader = spark.read.option("multiLine", "true")
    found = (reader.schema(schema) if schema else reader).json(path)
    named = found.withColumn("_file", F.col("_metadata.file_path"))
    return named.orderBy(F.coalesce("as_of", F.lit("")).desc(), F.col("_file").desc()).limit(1).drop("_file")


def filing_index(filings: DataFrame, overflow: DataFrame | None = None) -> DataFrame:
    """filings(cik, recent struct of parallel arrays) to a row for each accession; overflow(cik, the same arrays as columns) has the older filings, which win over the recent ones."""
    columns = ("accessionNumber", "filingDate", "reportDate", "form")
    rows = filings.select("cik", F.lit(0).alias("turn"), *(F.col(f"recent.{c}").alias(c) for c in columns))
    if overflow is not None:
        rows = rows.unionByName(overflow.select("cik", F.lit(1).alias("turn"), *columns))
    each = rows.select("cik", "turn", F.explode(F.arrays_zip(*columns)).alias("f"))
    made = each.select("cik", F.col("f.accessionNumber").alias("accession"), "turn", F.col("f.filingDate").alias("filed"), F.col("f.reportDate").alias("period"), F.col("f.form").alias("form"))
    if overflow is None:
        return made.drop("turn")
    return made.groupBy("cik", "accession").agg(F.max(F.struct("turn", "filed", "period", "form")).alias("m")).select("cik", "accession", "m.filed", "m.period", "m.form")
