"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Each paragraph gives 135 entries of 4 bits (9 XXH64 hashes of its own XXH64 under different seeds); a
fingerprint is the entrywise sum over the paragraphs modulo 2^20, and their number. So it does
not depend on their order, and paragraphs are inserted or deleted by adding or subtracting.
Paragraphs are lines, cut further after sentence ends (after CJK marks also where no space follows), and those of over LONG bytes
after words whose hash is divisible by eight, so that a text of one line has several, and an edit changes few.

As entries are uniform and independent, the squares of the centred sums, and of the differences of two fingerprints, estimate how many paragraphs
they hold (a paragraph that occurs m times counts m^2). likeness() is one less the share that only one of the two
holds; its standard error is some 0.12 times that share. A paragraph that occurs over 69,905 times in one text wraps around.

Three entries travel in one long (fields of 21 bits, of which the highest stays free for carries), 45 longs and the count make a vector.
All of it is DataFrame functions, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import WORD_SPACE, cut, once, repeated, row_key, text_of

SEEDS, SHIFTS = 9, (0, 4, 8, 12, 16)
LONGS = SEEDS * len(SHIFTS)
#: Where the three fields of a long begin.
FIELDS = (0, 21, 42)
MODULUS = 1 << 20
ENTRY_FIELDS = sum(0xF << at for at in FIELDS)
SUM_FIELDS = sum(MODULUS - 1 << at for at in FIELDS)
CARRIES = sum(MODULUS << at for at in FIELDS)
#: The mean of an entry.
MEAN = 7.5
BLANK = r"[\x20\x09-\x0D]"
PARAGRAPH_END = rf"{BLANK}*\n{BLANK}*|(?<=[.!?]){BLANK}+|(?<=[。！？]){BLANK}*"
#: Bytes from which on a paragraph is cut at words.
LONG = 500


def let(value: Column, use) -> Column:
    """use(value), with value computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def paragraphs(text: Column) -> Column:
    def cut_long(p: Column) -> Column:
        words = F.transform(F.split(p, " "), lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(8)) == 0, F.concat(w, F.lit("\n"))).otherwise(w))
        return F.when(F.octet_length(p) > LONG, F.transform(F.split(F.array_join(words, " "), "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)))).otherwise(F.array(p))

    def cut(pieces: Column) -> Column:
        return F.when(F.exists(pieces, lambda p: F.octet_length(p) > LONG), F.flatten(F.transform(pieces, cut_long))).otherwise(pieces)

    return F.filter(let(F.split(F.btrim(text, F.lit(WORD_SPACE)), PARAGRAPH_END), cut), lambda p: p != "")


def hashes(paras: Column) -> Column:
    return F.transform(paras, lambda p: F.xxhash64(p))


def vector(hashed: Column) -> Column:
    """45 packed sums, then the number of paragraphs. hashed (see hashes()) must be a column that is read more than once, not an expression."""

    zero = F.lit(0).cast("long")

    def entries(x: Column, shift: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, shift).bitwiseAND(F.lit(ENTRY_FIELDS))

    def totals(seeded: Column) -> Column:
        shifts = F.array(*(F.lit(k) for k in SHIFTS))
        # so few paragraphs cannot fill a field
        short = F.transform(shifts, lambda k: F.aggregate(seeded, zero, lambda s, x: s + entries(x, k)))
        long = F.transform(shifts, lambda k: F.aggregate(seeded, zero, lambda s, x: (s + entries(x, k)).bitwiseAND(F.lit(SUM_FIELDS))))
        return F.when(F.size(seeded) * 15 < MODULUS, short).otherwise(long)

    sums = F.transform(F.sequence(F.lit(0), F.lit(SEEDS - 1)), lambda seed: let(F.transform(hashed, lambda h: F.xxhash64(seed, h)), totals))
    return F.concat(F.flatten(sums), F.array(F.size(hashed).cast("long")))


def combine(a: Column, b: Column) -> Column:
    """The vector of both multisets together: insertion."""
    return F.concat(F.zip_with(packed(a), packed(b), lambda x, y: (x + y).bitwiseAND(F.lit(SUM_FIELDS))), F.array(F.element_at(a, -1) + F.element_at(b, -1)))


def remove(a: Column, b: Column) -> Column:
    """The vector of a without the paragraphs of b, which a must hold: deletion."""
    return F.concat(F.zip_with(packed(a), packed(b), lambda x, y: (x.bitwiseOR(F.lit(CARRIES)) - y).bitwiseAND(F.lit(SUM_FIELDS))), F.array(F.element_at(a, -1) - F.element_at(b, -1)))


def packed(v: Column) -> Column:
    return F.slice(v, 1, LONGS)


def hex_digits(v: Column) -> Column:
    """The vector as lowercase hex: 16 digits for each long."""
    return F.lower(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def centred(v: Column) -> Column:
    """The 135 sums of a vector as doubles, less their mean; where they may have wrapped around, each nearest to zero modulo 2^20."""
    mean, half = F.element_at(v, -1).cast("double") * MEAN, MODULUS // 2

    def field(at: int) -> Column:
        return F.transform(packed(v), lambda x: (F.shiftright(x, at) if at else x).bitwiseAND(F.lit(MODULUS - 1)) - mean)

    sums = F.concat(*(field(at) for at in FIELDS))
    wrapped = F.transform(sums, lambda x: F.pmod(x + half, F.lit(float(MODULUS))) - half)
    return F.when(F.element_at(v, -1) * 15 < MODULUS, sums).otherwise(wrapped)


def inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(same: Column, aa: Column, bb: Column, ab: Column) -> Column:
    """0 to 1 from the inner products of two centred vectors: 1 where same holds (equal fingerprints), 0 if one has no paragraphs."""
    return F.when(same, F.lit(1.0)).when((aa == 0) | (bb == 0), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(2.0) * ab / (aa + bb))))


def fingerprints(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """keep and vector, for an expression text over docs."""
    return once(docs.select(*keep, hashes(paragraphs(text)).alias("_hashes"))).withColumn("vector", vector(F.col("_hashes"))).drop("_hashes")


def successors(keys: DataFrame) -> DataFrame:
    """keys(id, k1, k2, n_chars), a row per document, to distinct rows with their next one's (next1, next2) and copies.

    Order: id (nulls first), then k1, k2; after the last comes the first. Of equal rows all but one are followed by an equal row. The order is
    found within range partitions; only their first rows (one each) are ordered in one task.
    """
    parts = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    distinct = keys.groupBy("id", "k1", "k2", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    placed = cut(distinct.repartitionByRange(parts, "id", "k1", "k2").withColumn("part", F.spark_partition_id()))
    me = F.struct("id", "k1", "k2")
    firsts = placed.groupBy("part").agg(F.min(me).alias("first"))
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.lead("first").over(Window.orderBy("part"))
    firsts = firsts.select("part", F.coalesce(following, F.first("first").over(by_part)).alias("after"))
    inside = F.lead(me).over(Window.partitionBy("part").orderBy("id", "k1", "k2"))
    chained = placed.withColumn("inside", inside).join(F.broadcast(firsts), "part").withColumn("next", F.coalesce("inside", "after"))
    once = F.struct(F.col("next.k1").alias("next1"), F.col("next.k2").alias("next2"), F.lit(1).cast("long").alias("times"))
    again = F.struct(F.col("k1").alias("next1"), F.col("k2").alias("next2"), (F.col("copies") - 1).alias("times"))
    both = F.when(F.col("copies") > 1, F.array(once, again)).otherwise(F.array(once))
    return chained.select("id", "k1", "k2", "n_chars", F.explode(both).alias("to")).select("id", "k1", "k2", "n_chars", "to.next1", "to.next2", "to.times")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, the edited text and vectors of the document, of its edited text and of the next document.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document. Null and empty texts have no
    paragraphs and so the zero vector; rows may repeat and ids may be null, see successors(). Other columns are not read; no rows: no rows.
    Texts are shuffled by a 128-bit key of (id, text), once for both joins, and with them a quarter for the heads.
    """
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), text_of(text_col).alias("text"))
    pairs = cut(successors(rows.select("id", "k1", "k2", F.length("text").cast("long").alias("n_chars"))))
    if pairs.where("times > 1 or (next1 = k1 and next2 = k2)").limit(1).count():
        rows = rows.dropDuplicates(["k1", "k2"])
    own = rows.select("k1", "k2", "text")
    heads = pairs.join(own.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("text").alias("next_text")), ["next1", "next2"])
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    heads = heads.select("id", "k1", "k2", "n_chars", "times", "next1", "next2", F.col("next_text").substr(F.lit(1), quarter).alias("head"))
    edited = F.concat(F.col("text").substr(F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.col("head"))
    keep = ("id", "n_chars", "k1", "k2", "next1", "next2", "times", "edited")
    joined = once(own.join(heads, ["k1", "k2"]).withColumn("edited", edited).select(*keep, "text"))
    joined = once(joined.select(*keep, hashes(paragraphs(F.col("text"))).alias("_own"), hashes(paragraphs(F.col("edited"))).alias("_edited")))
    return joined.select(*keep, vector(F.col("_own")).alias("vector"), vector(F.col("_edited")).alias("edited_vector"))


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: see fingerprint_edits()."""
    made = cut(fingerprint_edits(docs, id_col, text_col).withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited"))
    following = made.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("vector").alias("next_vector")).dropDuplicates(["next1", "next2"])
    full = made.join(following, ["next1", "next2"]).withColumns({"a": centred(F.col("vector")), "b": centred(F.col("edited_vector")), "c": centred(F.col("next_vector"))})
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    full = full.withColumns({"aa": inner(a, a), "bb": inner(b, b), "cc": inner(c, c), "ab": inner(a, b), "ac": inner(a, c)})
    out = full.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", hex_digits(F.col("vector")).alias("fingerprint"), hex_digits(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector") == F.col("edited_vector"), F.col("aa"), F.col("bb"), F.col("ab")).alias("near_edited"),
        likeness(F.col("vector") == F.col("next_vector"), F.col("aa"), F.col("cc"), F.col("ac")).alias("near_next"), F.col("times").alias("_times"),
    )
    return repeated(out, "_times")
