"""SimHash near-dedup by multi-index hashing.

A fingerprint has two segments of 32 bits. If two fingerprints differ in at most two bits,
either their first segments differ in at most one, or their second ones are equal. So each distinct fingerprint
looks up the ball of radius 1 around its first segment and its second segment itself (34 keys) in
a table by segment, and complete distances are verified by popcount.

A segment that more than bucket_limit distinct fingerprints share would give pairs without bound. Nothing is dropped
there: the fingerprints that touch such a bucket enumerate the ball of radius 1 in both segments of the whole
fingerprint (65 keys). Two of them are within two bits exactly if they share such a key, so the least fingerprint of each key
links them all, in rows linear in the fingerprints. Distances within one such star are verified too:
any two in it differ from the key in one bit at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.llm.common import cut, row_key, small_batches, text_of
from veritrail.operators.components import connected_components

SEED = 42
MAX_DISTANCE = 2
#: Buckets of more distinct fingerprints are linked by stars instead of table fetches; which of the two is used changes no result.
BUCKET_LIMIT = 64
SALTS = 16
#: Shingles whose bits are added up at once; bounds the memory a very long text takes.
CHUNK = 1 << 16


def simhash64(text: str | None, ngram: int = 3) -> int:
    """The fingerprint as an unsigned integer: bit i is 1 if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= ngram:
        return digest(b" ".join(words), SEED)
    n = len(words) - ngram + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        upto = min(at + CHUNK, n)
        hashes = np.array([digest(b" ".join(words[i : i + ngram]), SEED) for i in range(at, upto)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprint_udf(ngram: int = 3):
    @F.pandas_udf(T.LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, ngram) for t in texts], dtype=np.uint64).view(np.int64))

    return fingerprint


def near_links(fingerprints: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that span the same components as all pairs at two or fewer bits.

    Spark takes exploded rows to be as many as before they were exploded, and so would broadcast up to 65 times the rows it has counted, by way of the driver. The hints forbid that.
    """
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    flips = [1 << i for i in range(32)]
    rows = fingerprints.select("fp", high.alias("high"), low.alias("low"))
    entries = rows.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), F.col("high").alias("key")), F.struct(F.lit(1).alias("seg"), F.col("low").alias("key")))).alias("e")).select("fp", "e.seg", "e.key")
    ball = [F.struct(F.lit(0).alias("seg"), F.col("high").bitwiseXOR(F.lit(x)).alias("key")) for x in [0, *flips]]
    probes = rows.select("fp", F.explode(F.array(*ball, F.struct(F.lit(1).alias("seg"), F.col("low").alias("key")))).alias("e")).select(F.col("fp").alias("probe"), "e.seg", "e.key")
    sizes = entries.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    # Of the buckets that are small: fetch and verify. Of the others: who touches them.
    small = entries.hint("merge").join(sizes.where(F.col("n") <= bucket_limit).select("seg", "key"), ["seg", "key"])
    pairs = probes.hint("merge").join(small, ["seg", "key"]).where((F.col("probe") != F.col("fp")) & (F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= MAX_DISTANCE))
    links = pairs.select(F.least("probe", "fp").alias("a"), F.greatest("probe", "fp").alias("b"))
    large = sizes.where(F.col("n") > bucket_limit).select("seg", "key")
    # a crowded segment is one key: it is spread over SALTS
    salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    touching = probes.withColumn("salt", F.pmod(F.xxhash64("probe"), F.lit(SALTS)).cast("int")).hint("merge").join(salted, ["seg", "key", "salt"]).select(F.col("probe").alias("fp")).distinct()
    whole_ball = [F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64))]
    keyed = touching.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(x) for x in whole_ball))).alias("key"))
    stars = keyed.hint("merge").join(keyed.groupBy("key").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "least"), "key")
    starred = stars.where((F.col("fp") != F.col("least")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= MAX_DISTANCE)).select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return links.unionByName(starred).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (the least id reachable over links, its own included).

    Null and empty texts have fingerprint zero and link like any other. Rows with a null id keep it; a component's id passes over nulls
    and is null only if all its ids are. Rows may repeat; each gives a row. Other columns are not read; no rows: no rows.
    """
    small_batches(docs.sparkSession)
    prints = cut(docs.select(F.col(id_col).alias("id"), fingerprint_udf(ngram)(text_of(text_col)).alias("fp")))
    per_print = prints.groupBy("fp").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    members = connected_components(near_links(per_print.select("fp"), bucket_limit))
    labelled = per_print.join(members.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", "n", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_print = cut(labelled.join(least, "component").select("fp", "n", "component_id"))
    # Fingerprints of a 64th of all rows or more are at most 64: they are broadcast, the rest is joined by a shuffle.
    total = by_print.agg(F.sum("n")).first()[0] or 0
    hot = by_print.where(F.col("n") * 64 >= total).select("fp", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot"))
    marked = prints.join(F.broadcast(hot), "fp", "left")
    rest = marked.where("is_hot is null").join(by_print.where(F.col("n") * 64 < total).select("fp", "component_id"), "fp").select("id", "fp", "component_id")
    joined = marked.where("is_hot").select("id", "fp", F.col("hot_id").alias("component_id")).unionByName(rest)
    return joined.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group: the one with the least id; all columns stay.

    Ids may repeat, in different groups too: each group has its own row, found by a key of the row's columns (maps, which have no hash, aside). Of a group's rows with the least
    id, the one with the least key stays; equal rows count as one. Rows without an id stand for their group only if no row of it has one. Columns of any name pass through.
    There are nearly as many groups as rows: they are joined by merges, as in near_links.
    """
    small_batches(docs.sparkSession)
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    k1, k2 = row_key(*hashed)
    prints = cut(docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), fingerprint_udf()(text_of(text_col)).alias("fp")))
    per_print = prints.groupBy("fp").agg(F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "k1", "k2")).alias("first"))
    members = connected_components(near_links(per_print.select("fp")))
    labelled = per_print.hint("merge").join(members.withColumnRenamed("node", "fp"), "fp", "left")
    firsts = cut(labelled.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first")).select("first.k1", "first.k2"))
    kept = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2")).join(firsts.hint("merge"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
