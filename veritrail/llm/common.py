"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.session import cut, once, ship_package  # noqa: F401

#: White space that separates words: space and U+0009 to U+000D.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows in one Arrow batch, so that a batch of long texts stays small.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text_col: str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def row_key(*cols: Column) -> list[Column]:
    """A 128-bit key of a row as two longs: defined for nulls, equal for equal rows."""
    marked = [x for c in cols for x in (F.isnull(c), c)]
    return [F.xxhash64(*marked), F.xxhash64(F.lit(7919), *marked)]


def ascii_lower(c: Column) -> Column:
    """A-Z lowered, every other character kept."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str, text_col: str, train_only: bool = False) -> DataFrame:
    """(label, text) of labelled texts, each distinct text once with its greatest label: most ids and most rows at most, however often ids or rows repeat.

    Of the ids with a label those with the least hash are taken, of their distinct texts those with the least hash; no more than hashes are ordered.
    train_only leaves out ids whose crc32 is divisible by five.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    if train_only:
        chosen = chosen.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0)
    chosen = chosen.groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label")).orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = cut(rows.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.max("label").alias("label")))
    last = rows.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return rows.where(F.col("h") <= (0 if last is None else last)).select("label", "text")


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as the column times says, without that column. No array of numbers is longer than 2^16."""
    part = 1 << 16
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / part))))
    size = F.least(F.lit(part), F.col(times) - F.col("_block") * part)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("_block", "_copy", times)


def small_batches(spark: SparkSession) -> None:
    """Make ready for Python workers: the package is shipped, and the rows of an Arrow batch are bounded (kept if the session already asks for less)."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
