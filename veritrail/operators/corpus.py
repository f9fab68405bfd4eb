"""Corpus reconnaissance: inventory, boilerplate, near copies, spans with locators, ranking, samples.

Locators are code-point offsets into the raw text and always reproduce the match. Text search that needs
offsets runs in Arrow batches, row by row, after a JVM-side filter; everything else is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.functions import lexicon
from veritrail.functions.scalars import mime_conflict
from veritrail.operators.components import connected_components
from veritrail.session import cut, once, ship_package

SKETCH, BANDS, ROWS, MIN_JACCARD, MAX_BUCKET = 64, 16, 4, 0.85, 200
#: Of a crowded bucket: sketches that all others are compared with; parts of a sketch, more than two sketches of MIN_JACCARD can differ in.
PIVOTS, PARTS = 8, 11
MAX_SPANS = 40
SALTS = 8


def line_key(line: Column) -> Column:
    """Collapsed lower-case line of 20 to 400 characters, else null."""
    k = F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))
    return F.when(F.length(k).between(20, 400), k)


def boilerplate(texts: DataFrame, least_docs: int = 20) -> DataFrame:
    """texts(id, host, text): line keys of each host of least_docs documents or more that are in max(5, a tenth) of its documents."""
    keys = F.array_distinct(F.array_compact(F.transform(F.split("text", "\n"), line_key)))
    per_key = texts.select("host", F.explode(keys).alias("line_key")).groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("docs"))
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= least_docs)
    return per_key.join(hosts, "host").where(F.col("docs") >= F.greatest(F.lit(5), F.floor(F.col("total") / 10))).select("host", "line_key", "docs")


def suppressed(texts: DataFrame, model: DataFrame) -> DataFrame:
    """texts with searchable: the text without its host's boilerplate lines.

    Lines meet the model by (host, line), each line of the model in SALTS copies, so that a line of a large host does not fill one task; texts meet the positions they
    lose by a key of the row.
    """
    me = [F.xxhash64("id", "host", "text"), F.xxhash64(F.lit(1), "id", "host", "text")]
    keyed = texts.select("*", me[0].alias("_k1"), me[1].alias("_k2"))
    lines = keyed.select("_k1", "_k2", "host", F.posexplode(F.transform(F.split("text", "\n"), line_key)).alias("pos", "line_key")).where("line_key is not null")
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("_k1", "pos"), F.lit(SALTS)))
    known = model.select("host", "line_key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    dropped = lines.join(known, ["host", "line_key", "salt"], "left_semi").groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set("pos")).alias("_dropped"))
    split = F.split("text", "\n")
    gaps = F.zip_with(F.concat(F.array(F.lit(-1)), F.col("_dropped")), F.concat(F.col("_dropped"), F.array(F.size(split))), lambda a, b: F.slice(split, a + 2, b - a - 1))
    rebuilt = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return keyed.join(dropped, ["_k1", "_k2"], "left").withColumn("searchable", rebuilt).select(*texts.columns, "searchable")


def sketches(texts: DataFrame) -> DataFrame:
    """id and the 64 least hashes of five-word shingles, for texts of 500 bytes and 20 words that have so many."""
    words = once(texts.where(F.octet_length("text") >= 500).select("id", F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z0-9]{2,}"), F.lit(0)).alias("w"))).where(F.size("w") >= 20)
    hashed = once(words.select("id", F.array_distinct(F.slice(F.transform("w", lambda x, i: F.xxhash64(x, *(F.get("w", i + k) for k in range(1, 5)))), 1, F.size("w") - 4)).alias("h")))
    return hashed.where(F.size("h") >= SKETCH).select("id", F.slice(F.sort_array("h"), 1, SKETCH).alias("sketch"))


def near_duplicates(texts: DataFrame) -> DataFrame:
    """(id, group): texts linked by sketches of Jaccard 0.85 or more that share a band; group is the least id.

    Equal sketches are linked to their least id first, so a large group of copies enters the bands once. A band's bucket of MAX_BUCKET
    different sketches or fewer gives all its pairs. In a crowded one all are compared with a few pivots, which joins most of a family in
    linear time; what then still is in different groups is compared where a part of both sketches is equal. That loses nothing: 64 hashes
    of Jaccard 0.85 differ in five on either side, so of 11 parts (by hash modulo 11) one is equal.
    """
    made = cut(sketches(texts))
    firsts = made.groupBy("sketch").agg(F.min("id").alias("first"))
    same = made.join(firsts, "sketch").where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    parts = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sketch", i * ROWS + 1, F.lit(ROWS))))
    banded = firsts.select(F.col("first").alias("id"), "sketch", F.posexplode(parts).alias("band", "value"))
    sizes = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alike = F.size(F.array_intersect("sketch", "other")) / F.size(F.array_union("sketch", "other")) >= MIN_JACCARD
    met = banded.join(sizes.where(F.col("n") <= MAX_BUCKET).select("band", "value"), ["band", "value"]).select("id", "band", "value")
    candidates = met.withColumnRenamed("id", "a").join(met.withColumnRenamed("id", "b"), ["band", "value"]).where("a < b").select("a", "b").distinct()
    # only ids meet in the bands; each different pair then fetches its two sketches once
    left_sketch, right_sketch = firsts.select(F.col("first").alias("a"), "sketch"), firsts.select(F.col("first").alias("b"), F.col("sketch").alias("other"))
    pairs = candidates.join(left_sketch, "a").join(right_sketch, "b").where(alike).select("a", "b")
    links = cut(same.unionByName(pairs))
    crowded = cut(banded.join(sizes.where(F.col("n") > MAX_BUCKET).select("band", "value"), ["band", "value"]))
    if not crowded.isEmpty():
        least = crowded.groupBy("band", "value").agg(*(F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("h"), "id", "sketch")).alias(f"p{k}") for k in range(PIVOTS)))
        pivots = least.select("band", "value", F.explode(F.array_distinct(F.array(*(F.struct(f"p{k}.id", f"p{k}.sketch") for k in range(PIVOTS))))).alias("p")).select("band", "value", F.col("p.id").alias("b"), F.col("p.sketch").alias("other"))
        stars = crowded.join(pivots, ["band", "value"]).where("id <> b").where(alike).select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
        links = cut(links.unionByName(stars))
        known = crowded.join(connected_components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        open_ = known.groupBy("band", "value").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("band", "value")
        keys = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.xxhash64(i, F.filter("sketch", lambda h: F.pmod(h, F.lit(PARTS)) == i)))
        left = cut(known.join(open_, ["band", "value"]).select("id", "component", "sketch", "band", "value", F.explode(keys).alias("key")))
        right = left.select(F.col("id").alias("b"), F.col("component").alias("_component"), F.col("sketch").alias("other"), "band", "value", "key")
        rest = left.withColumnRenamed("id", "a").join(right, ["band", "value", "key"]).where("component < _component").where(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = links.unionByName(rest)
    return connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("group"))


def line_offsets(texts: DataFrame) -> DataFrame:
    """id, line_no, char_start (code points), page (1 plus form feeds before), line."""
    lines = texts.select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    before = Window.partitionBy("id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    feeds = F.regexp_count("line", F.lit("\f"))
    return lines.select(
        "id", "line_no", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).alias("char_start"), (F.coalesce(F.sum(feeds).over(before), F.lit(0)) + 1).alias("page"), "line",
    )


def spans(texts: DataFrame, most: int | None = MAX_SPANS, carry: tuple[str, ...] = ()) -> DataFrame:
    """texts(id, text) to a row per match: id, seq, category, term, line, character_start, character_end, matched_text, context_before, context_after, matched_groups (of structures; else empty).

    seq is the place among the document's kept matches; of a category most (40; None: all) stay in each document, overflow tells how many more there were.
    Each match carries the columns named in carry (without nulls), so that nothing has to be joined by ids, which may repeat.
    """
    ship_package(texts.sparkSession)
    schema = "id long, seq int, category string, term string, line int, character_start int, character_end int, matched_text string, context_before string, context_after string, matched_groups array<string>, overflow int"
    schema = ", ".join([schema, *(f"{c} {texts.schema[c].dataType.simpleString()}" for c in carry)])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patterns = lexicon.span_patterns()
        for batch in batches:
            out = []
            for id_, text, *carried in zip(batch["id"], batch["text"], *(batch[c] for c in carry), strict=True):
                found: dict[str, list[tuple]] = {}
                at = 0
                lines = []
                for number, line in enumerate(text.split("\n")):
                    lines.append((number, at, line))
                    at += len(line) + 1
                for category, term, pattern in patterns:
                    for number, start, line in lines:
                        for m in pattern.finditer(line):
                            found.setdefault(category, []).append((category, term, number, start + m.start(), start + m.end(), m[0], text[max(0, start + m.start() - 150) : start + m.start()], text[start + m.end() : start + m.end() + 150], list(m.groups())))
                seq = 0
                for rows in found.values():
                    rows.sort(key=lambda r: r[2])
                    for r in rows[:most]:
                        out.append((id_, seq, *r, max(0, len(rows) - len(rows[:most])), *carried))
                        seq += 1
                if carry and len(out) >= 1000:  # carried texts take room
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return texts.select("id", "text", *(c for c in carry if c != "text")).where(F.col("text").rlike(lexicon.SPAN_HINT)).mapInPandas(search, schema)


def classes(texts: DataFrame) -> DataFrame:
    """id and the document classes whose pattern the text holds, UNCLASSIFIED if there are none."""
    found = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(name)) for name, p in lexicon.class_patterns())))
    return texts.select("id", found.alias("classes")).select("id", F.when(F.size("classes") > 0, F.col("classes")).otherwise(F.array(F.lit("UNCLASSIFIED"))).alias("classes"))


def buckets(candidates: DataFrame) -> DataFrame:
    """candidates(categories array, terms array, provenance, family, classes array) with a row for each bucket they fall in; buckets overlap."""
    has = lambda c: F.coalesce(F.array_contains("categories", c), F.lit(False))
    term = lambda *names: F.coalesce(F.arrays_overlap("terms", F.array(*(F.lit(n) for n in names))), F.lit(False))
    tests = {
        "ownership": has("OWNERSHIP_EXPLICIT") | ((F.col("categories") == F.array(F.lit("STRUCTURED"))) & term("entity_owned_by", "pct_of_entity")), "control": has("CONTROL_EXPLICIT"),
        "parent-subsidiary": has("PARENT_SUBSIDIARY") | term("entity_subsidiary_of"), "shell-structure": has("SHELL_NOMINEE"), "financial-flow": has("FINANCIAL_FLOW"), "boi-cta": has("BOI_CTA"), "sar-bsa": has("SAR_BSA"),
        "congressional": F.coalesce(F.col("provenance") == "CONGRESS", F.lit(False)) | F.coalesce(F.col("family").startswith("CONGRESS"), F.lit(False)) | F.coalesce(F.array_contains("classes", "CONGRESSIONAL_EVIDENCE"), F.lit(False)),
    }
    return candidates.withColumn("bucket", F.explode(F.array_compact(F.array(*(F.when(t, F.lit(b)) for b, t in tests.items())))))


def numbered_groups(groups: DataFrame) -> DataFrame:
    """near_duplicates() as group ids ndg-00001 on, in order of the least member, with the number of members; members stay rows."""
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = sizes.select("group", "n", F.format_string("ndg-%05d", F.row_number().over(Window.orderBy("group"))).alias("group_id"))
    return groups.join(firsts, "group").select("group_id", "id", "n")


def tiers_sample(rows: DataFrame, key: str, priority: str, seed: str, n: int = 25) -> DataFrame:
    """n rows each of the first tenth, the middle third and the last tenth by priority (all rows where a tier would be empty), by the hash of seed and key.

    Ranks are exact; ranges of priority are ranked side by side, and only the sizes of ranges are added up in one task.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(rows.repartitionByRange(parts, F.desc(priority), key).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    total = dealt.count()
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(F.desc(priority), key)) - 1
    ranked = dealt.join(F.broadcast(before), "_part").withColumn("_place", place)
    tenth, third = total // 10, total // 3
    tests = {"high": F.col("_place") < (tenth or total), "medium": F.col("_place").between(third, 2 * total // 3 - 1) if 2 * total // 3 > third else F.lit(True), "low": F.col("_place") >= (total - tenth if tenth else 0)}
    tiered = ranked.select(*rows.columns, F.explode(F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))).alias("tier"))
    turn = F.row_number().over(Window.partitionBy("tier").orderBy(F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256), key))
    return tiered.withColumn("place", turn).where(F.col("place") <= n)


def doc_priority(ranked: DataFrame, n: int = 10) -> DataFrame:
    """Per id the sum of its n best span priorities, rounded half even."""
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("priority"), "seq"))
    return ranked.withColumn("place", place).where(F.col("place") <= n).groupBy("id").agg(F.bround(F.sum("priority"), 2).alias("priority"))


def best_span(ranked: DataFrame) -> DataFrame:
    """Per id the span of the greatest priority, the first on a tie."""
    best = ranked.groupBy("id").agg(F.max(F.struct("priority", (-F.col("seq")).alias("back"))).alias("b"))
    return best.select("id", F.col("b.priority").alias("priority"), (-F.col("b.back")).alias("seq"))


def capped(ranked: DataFrame, group: str, cap: int) -> DataFrame:
    """Per id and group: rows kept under the cap and overflow."""
    return ranked.groupBy("id", group).agg(F.least(F.count(F.lit(1)), F.lit(cap)).alias("kept"), F.greatest(F.count(F.lit(1)) - cap, F.lit(0)).alias("overflow"))


def locators_hold(found: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """found with holds: the text between the offsets is the match. Without texts(id, text), whose ids may not repeat, found carries the column text itself."""
    joined = found.withColumn("_text", F.col("text")) if texts is None else found.join(texts.select("id", F.col("text").alias("_text")), "id")
    return joined.withColumn("holds", F.col("_text").substr(F.col("character_start") + 1, F.col("character_end") - F.col("character_start")) == F.col("matched_text")).drop("_text")


def seeded_sample(rows: DataFrame, strata: str, key: str, seed: str, n: int) -> DataFrame:
    """n rows of each stratum, by the hash of seed and key."""
    place = F.row_number().over(Window.partitionBy(strata).orderBy(F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256), key))
    return rows.withColumn("place", place).where(F.col("place") <= n)


def inventory(objects: DataFrame, retrievals: DataFrame, with_urls: bool = False) -> DataFrame:
    """Per hash: size, presence, number of retrievals, the earliest url, whether there are several and whether one of them had another hash too.

    If objects has sniffed and retrievals has content_type: the claimed type of the earliest retrieval and mime_conflict. with_urls adds the distinct urls, each with its
    earliest time, as an array in order of time: only for logs in which no object has very many urls.
    """
    good = retrievals.where("coalesce(sha256, '') <> ''")
    typed = "content_type" in retrievals.columns and "sniffed" in objects.columns
    claimed = F.lower(F.trim(F.split_part(F.coalesce("content_type", F.lit("")), F.lit(";"), F.lit(1)))) if typed else F.lit("")
    per_url = good.groupBy("sha256", "url").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("retrieved_at").alias("first"), claimed.alias("claimed"))).alias("at")).select("sha256", "url", "n", "at.first", "at.claimed")
    versions = per_url.groupBy("url").agg((F.count(F.lit(1)) > 1).alias("several"))
    per_url = per_url.join(versions, "url")
    aggregates = [F.sum("n").alias("retrieval_count"), F.count(F.lit(1)).alias("n_urls"), F.min(F.struct("first", "url", "claimed")).alias("primary"), F.bool_or("several").alias("url_has_multiple_versions")]
    if with_urls:
        aggregates.append(F.array_sort(F.collect_list(F.struct(F.col("first").alias("retrieved_at"), "url"))).alias("urls"))
    grouped = per_url.groupBy("sha256").agg(*aggregates).join(objects, "sha256", "left")
    present = F.col("size_bytes").isNotNull()
    columns = ["sha256", "size_bytes", present.alias("present"), F.col("primary.url").alias("url"), "retrieval_count", (F.col("n_urls") > 1).alias("multi_url_object"), "url_has_multiple_versions"]
    if typed:
        columns += [F.nullif(F.col("primary.claimed"), F.lit("")).alias("claimed_content_type"), F.col("sniffed").alias("sniffed_mime"), mime_conflict(present, F.col("primary.claimed"), F.col("sniffed")).alias("mime_conflict")]
    return grouped.select(*columns, *(["urls"] if with_urls else []))
