"""Scalar functions over columns, all inside the JVM.

Three name normalisers with different results are kept apart on purpose (graph_key, term_key, registry_key):
they key different dictionaries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of a graph key and what they are written as, in the order in which they are replaced.
KEY_WORDS = (
    (r"\bincorporated\b", "inc"), (r"\blimited\b", "ltd"), (r"\bcorporation\b", "corp"), (r"\bcompany\b", "co"), (r"\bcompanies\b", "cos"),
    (r"\bl\s?l\s?c\b", "llc"), (r"\bl\s?p\b", "lp"), (r"\bnational association\b", "na"), (r"\bn\s?a\b", "na"), (r"^the\s+", ""),
)
SUFFIX_WORDS = ("inc", "corp", "co", "ltd", "llc", "lp", "llp", "plc", "sa", "gmbh", "ag", "bv", "nv")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def host(url: Column) -> Column:
    """Lower-case host without port and user, null where there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def display_host(url: Column) -> Column:
    """Host without a leading www. or home.; ? if no path follows it."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"^https?://(?:www\.|home\.)?([^/]+)/", 1), F.lit("")), F.lit("?"))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_extension(url: Column) -> Column:
    """Up to five letters or digits after the last dot of the last path segment; empty if there are none."""
    return F.regexp_extract(F.lower(F.element_at(F.split(path(url), "/"), -1)), r"\.([a-z0-9]{1,5})$", 1)


def parent_folder(url: Column) -> Column:
    """The url up to two segments above its end, if it has more than three slashes; else itself."""
    parts = F.split(url, "/")
    return F.when(F.size(parts) > 4, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), "/")).otherwise(url)


def slug_title(url: Column) -> Column:
    """The words of the last path segment without its extension, the first letter raised and the rest lowered; null for fewer than two words."""
    segment = F.try_element_at(F.filter(F.split(path(url), "/"), lambda x: x != ""), F.lit(-1))
    words = F.split(F.regexp_replace(segment, r"\.[A-Za-z0-9]{1,5}$", ""), "[-_]")
    title = F.lower(F.trim(F.array_join(words, " ")))
    return F.when((F.size(words) > 1) & (title != ""), F.concat(F.upper(F.left(title, F.lit(1))), F.substr(title, F.lit(2))))


def html_title(page: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1), r"[\s]+", " "))


def visible_text(page: Column) -> Column:
    """Script and style blocks and tags taken out, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(page, r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


# Sizes in bytes below which a band ends.
SIZE_BANDS = ((10_240, "<10KB"), (102_400, "10-100KB"), (1_048_576, "100KB-1MB"), (10_485_760, "1-10MB"), (104_857_600, "10-100MB"))


def size_bucket(n: Column) -> Column:
    out = F.when(n.isNull(), F.lit("unknown"))
    for below, name in SIZE_BANDS:
        out = out.when(n < below, F.lit(name))
    return out.otherwise(F.lit(">=100MB"))


# First bytes in hex and the type they tell.
MAGIC = (
    ("255044462D", "application/pdf"), ("504B0304", "application/zip"), ("504B0506", "application/zip"), ("1F8B", "application/gzip"), ("28B52FFD", "application/zstd"), ("25215053", "application/postscript"),
    ("89504E47", "image/png"), ("FFD8FF", "image/jpeg"), ("47494638", "image/gif"), ("49492A00", "image/tiff"), ("4D4D002A", "image/tiff"), ("D0CF11E0", "application/x-ole-storage"), ("7B5C727466", "application/rtf"),
)


def sniff_mime(content: Column) -> Column:
    """MIME type from the first 4,096 bytes (binary column), the first rule that holds; null content has none, empty content is "empty".

    An opening brace or bracket is JSON if the head parses, or if a brace is followed by a quote within 64 bytes (the head of a larger document).
    """
    head = F.substring(content, 1, 4096)
    text = F.decode(head, "ISO-8859-1")
    low, stripped = F.lower(text), F.regexp_replace(text, r"^[\s\x0B]+", "")
    start = F.lower(F.substring(stripped, 1, 256))
    parses = F.try_parse_json(F.try_validate_utf8(head.cast("string"))).isNotNull()
    out = F.when(content.isNull(), F.lit(None)).when(F.octet_length(content) == 0, F.lit("empty"))
    for digits, mime in MAGIC:
        out = out.when(F.hex(F.substring(content, 1, len(digits) // 2)) == digits, F.lit(mime))
    out = out.when(start.startswith("<?xml"), F.when(low.contains("<html"), F.lit("text/html")).otherwise(F.lit("application/xml")))
    out = out.when(start.startswith("<!doctype html") | start.contains("<html"), F.lit("text/html"))
    out = out.when(stripped.startswith("{") & (parses | F.substring(stripped, 1, 64).contains('"')), F.lit("application/json")).when(stripped.startswith("[") & parses, F.lit("application/json"))
    return out.otherwise(F.lit("text/plain"))


# Claimed and sniffed types that do not conflict.
COMPATIBLE = (
    ("text/html", "text/plain"), ("text/plain", "text/html"), ("application/xhtml+xml", "text/html"), ("text/xml", "application/xml"), ("application/xml", "text/html"), ("application/json", "text/plain"), ("text/plain", "application/json"),
    ("text/csv", "text/plain"), ("application/octet-stream", "application/zip"), ("application/x-zip-compressed", "application/zip"), ("binary/octet-stream", "application/zip"),
)


def mime_conflict(present: Column, claimed: Column, sniffed: Column) -> Column:
    """Whether an object that is there was claimed to be something that it isn't; what is unknown does not conflict."""
    pair = F.concat_ws(" ", claimed, sniffed)
    known = (F.coalesce(claimed, F.lit("")) != "") & (F.coalesce(sniffed, F.lit("")) != "")
    return F.coalesce(present & known & (claimed != sniffed) & ~pair.isin(*(f"{a} {b}" for a, b in COMPATIBLE)), F.lit(False))


# Source family of a host, by its exact name.
HOST_FAMILIES = {
    "www.fincen.gov": "FINCEN", "bsaefiling.fincen.gov": "FINCEN", "bsaaml.ffiec.gov": "FFIEC", "www.ffiec.gov": "FFIEC", "home.treasury.gov": "TREASURY", "oig.treasury.gov": "TREASURY_OIG", "www.sec.gov": "SEC",
    "www.justice.gov": "DOJ", "vault.fbi.gov": "FBI_VAULT", "www.occ.gov": "OCC", "www.fdic.gov": "FDIC", "oversight.house.gov": "CONGRESS_OVERSIGHT", "judiciary.house.gov": "CONGRESS_JUDICIARY", "www.congress.gov": "CONGRESS_GOV",
    "www.federalregister.gov": "FEDERAL_REGISTER", "www.govinfo.gov": "GOVINFO", "www.gao.gov": "GAO", "www.federalreserve.gov": "FEDERAL_RESERVE", "www.ncua.gov": "NCUA",
}


def host_family(host_col: Column, families: dict[str, str] | None = None, other: str = "OTHER_GOV") -> Column:
    """Source family by a host's exact name."""
    pairs = F.create_map(*(F.lit(x) for kv in (families or HOST_FAMILIES).items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, F.coalesce(host_col, F.lit(""))), F.lit(other))


def graph_key(name: Column) -> Column:
    """Key of a graph node: white space collapsed, lower case, full stops, commas and apostrophes dropped, legal forms in one spelling, no leading article."""
    k = F.lower(F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " "), F.lit(" ,;:.")))
    k = F.regexp_replace(k, "[.,’']", "")
    for pattern, short in KEY_WORDS:
        k = F.regexp_replace(k, pattern, short)
    return k


def term_key(name: Column) -> Column:
    """Key of a defined term: as graph_key, but double quotes go too, and four of the rarer forms stay as they are."""
    k = F.lower(F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " "), F.lit(" ,;:.")))
    k = F.regexp_replace(k, "[.,’'\"“”‘]", "")
    for pattern, short in KEY_WORDS:
        if short not in ("cos", "lp", "na"):
            k = F.regexp_replace(k, pattern, short)
    return k


def registry_key(name: Column) -> Column:
    """Key of a register of companies: upper case, punctuation dropped, white space collapsed."""
    k = F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), r"[.,'\"()]", "")
    return F.trim(F.regexp_replace(k, r"\s+", " "))


def acronym(name: Column) -> Column:
    """Initials of the words that are not small words or legal suffixes."""
    small = ("of", "the", "and", "for", "de", "&", *SUFFIX_WORDS)
    words = F.filter(F.split(graph_key(name), " "), lambda w: (w != "") & ~w.isin(*small))
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def amount_usd(raw: Column) -> Column:
    """US dollars in text such as $1,234.56 million; null if there is no number."""
    low = F.lower(raw)
    number = F.regexp_replace(F.regexp_extract(low, r"([0-9][0-9,]*(?:\.[0-9]+)?)", 1), ",", "").try_cast("double")
    scale = F.when(low.rlike(r"\bbillion\b"), 1e9).when(low.rlike(r"\bmillion\b"), 1e6).when(low.rlike(r"\bthousand\b"), 1e3).otherwise(1.0)
    return number * scale


def iso_date(raw: Column) -> Column:
    """YYYY-MM-DD from Month D, YYYY, else from YYYY-MM-DD, M/D/YYYY, else the year alone, 1930 to 2026; days are checked by range only."""
    low = F.lower(raw)
    names = "|".join(MONTHS)
    long = rf"\b({names})\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})\b"
    month = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.regexp_extract(low, long, 1)).cast("int")

    def checked(y: Column, m: Column, d: Column) -> Column:
        y, m, d = (x.try_cast("int") for x in (y, m, d))
        return F.when(y.between(1930, 2026) & m.between(1, 12) & d.between(1, 31), F.format_string("%04d-%02d-%02d", y, m, d))

    iso, slash = r"\b([0-9]{4})-([0-9]{2})-([0-9]{2})\b", r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\b"
    year = F.regexp_extract(low, r"\b((?:19|20)[0-9]{2})\b", 1).try_cast("int")
    return F.coalesce(
        checked(F.regexp_extract(low, long, 3), month.cast("string"), F.regexp_extract(low, long, 2)),
        checked(*(F.regexp_extract(low, iso, k) for k in (1, 2, 3))),
        checked(*(F.regexp_extract(low, slash, k) for k in (3, 1, 2))),
        F.when(year.between(1930, 2026), year.cast("string")),
    )


def short_id(prefix: str, *parts: Column) -> Column:
    """prefix and 16 hex digits of the SHA-256 of the parts joined by |."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16))
