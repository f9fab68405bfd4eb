"""Line dedup: lines that many documents share are dropped from all of them.

Explode the normalised lines, hash them, count distinct documents per hash, drop the
lines whose hash reaches the threshold and reassemble the rest by position. Everything
is DataFrame functions. Only 24-byte rows (hash, document key, position) meet at the
counting and at the join with the dropped hashes. Counting pre-aggregates per document and task. At the
join the HOT most frequent dropped hashes are broadcast, so of the occurrences that are shuffled no hash has more
than one in HOT. Texts are shuffled once, by a 128-bit key of (id, text), to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import WORD_SPACE, cut, row_key, text_of

#: Rows of the broadcast with the most frequent dropped hashes, at any size of the corpus.
HOT = 1024


def line_key_hash(line: Column) -> Column:
    """128-bit hash of the key of a line (ends stripped, A-Z lowered) and the key's length.

    The bytes are read as Latin-1 before lower(). That lowers A-Z and moves the lead bytes
    C3..DE to E3..FE, never continuation bytes; as the number of continuation bytes still
    tells the lead bytes apart, two results are equal only if the keys are.
    """
    stripped = F.btrim(line, F.lit(WORD_SPACE))
    folded = F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(F.lower(F.decode(stripped.cast("binary"), "ISO-8859-1")))
    return F.struct(F.xxhash64(folded).alias("h1"), F.xxhash64(F.lit(1), folded).alias("h2"), F.length(stripped).alias("n"))


def without_positions(lines: Column, dropped: Column) -> Column:
    """lines without the 0-based positions in dropped (sorted), in linear time: the gaps between them are sliced out."""
    starts = F.concat(F.array(F.lit(-1)), dropped)
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def shared_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(h1, h2, n_docs) of the line keys of min_chars code points or more that are in min_docs rows or more."""
    lines = F.split(text_of(text_col), "\n")
    return (
        docs.select(F.explode(F.array_distinct(F.transform(lines, line_key_hash))).alias("key"))
        .where(F.col("key.n") >= min_chars)
        .groupBy("key.h1", "key.h2")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """docs with the text rebuilt from the lines that stay, and _n_lines, _n_dropped.

    Lines are split at \\n; their key is the line with white space stripped at both ends and
    A-Z lowered. Each row counts as a document of its own, also where its id is null or repeated. A null
    or empty text is one empty line; lines with a key of under min_chars code points always stay. A text whose
    lines all go becomes empty. Other columns pass through, whatever their names (but columns named like the
    two added ones are replaced); no rows: no rows.
    """
    lines = F.split(text_of(text_col), "\n")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keyed = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2"))
    shared = cut(shared_lines(docs, text_col, min_docs, min_chars))
    hot = shared.orderBy(F.desc("n_docs"), "h1", "h2").limit(HOT).select("h1", "h2", F.lit(True).alias("is_hot"))
    occurrences = docs.select(k1.alias("k1"), k2.alias("k2"), F.posexplode(F.transform(lines, line_key_hash)).alias("pos", "key")).where(F.col("key.n") >= min_chars)
    marked = occurrences.select("k1", "k2", "pos", F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2")).join(F.broadcast(hot), ["h1", "h2"], "left")
    # occurrences of hot hashes are settled: they travel by their document's key, which spreads them and matches nothing
    travel = {"j1": F.when(F.col("is_hot"), F.col("k1")).otherwise(F.col("h1")), "j2": F.when(F.col("is_hot"), F.col("k2")).otherwise(F.col("h2"))}
    rest = shared.join(F.broadcast(hot), ["h1", "h2"], "left_anti").select(F.col("h1").alias("j1"), F.col("h2").alias("j2"), F.lit(True).alias("is_shared"))
    gone = marked.withColumns(travel).join(rest, ["j1", "j2"], "left").where("is_hot or is_shared")
    dropped = gone.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    whole = keyed.join(dropped, ["k1", "k2"], "left").select("row", text.alias("text"), F.split(text, "\n").alias("lines"), "dropped")
    rebuilt = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(without_positions(F.col("lines"), F.col("dropped")), "\n"))
    columns = [rebuilt.alias(text_col) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    return whole.select(*columns, F.size("lines").cast("long").alias("_n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("_n_dropped"))
