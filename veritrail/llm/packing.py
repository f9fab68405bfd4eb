"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are the powers of two of its length (as many of
the largest as fit, then one for each set bit of the rest, longest first). Every piece is a sequence of its own, in the
bucket of its length: no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.llm.bpe import FastBpe, load
from veritrail.llm.common import cut, small_batches, text_of

MAX_TOKENS = 2048
END_ID = 1
RESULT = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


def binary_lengths(n: int, largest: int) -> list[int]:
    """Powers of two up to largest that sum up to n, longest first."""
    rest = n % largest
    return [largest] * (n // largest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens and, if asked for, ids (a binary of little-endian unsigned 32-bit integers)."""
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError("max_tokens must be a power of two")
    small_batches(docs.sparkSession)
    longs = ("start", "length", "ids_crc32", "doc_tokens")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in longs), *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    end = end_id.to_bytes(4, "little")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, FastBpe)
        for batch in batches:
            rows, out = [], tuple([] for _ in longs)
            parts = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(bpe.encode(text) + end)
                n, start = len(ids) // 4, 0
                for length in binary_lengths(n, max_tokens):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    for column, value in zip(out, (start, length, zlib.crc32(piece), n), strict=True):
                        column.append(value)
                    if with_ids:
                        parts.append(bytes(piece))
                    start += length
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in out)]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(parts, pa.binary())] if with_ids else []), names=schema.names)

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(cut_up, schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """pieces() with sequence_id (dense, in order of the bucket) and offset (always 0).

    Null and empty texts hold the end id alone. Ids may be null or repeated: each row is a document. Rows are numbered
    within hashed parts of a bucket, whose sizes are added up first (12 rows a part), so no task holds a bucket.
    No rows give no pieces; other columns are not read. An id column named like a column of the result is refused.
    """
    if id_col in RESULT:
        raise ValueError(f"the id column must not be named {id_col}")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    made = cut(pieces(docs, path, id_col, text_col, max_tokens, end_id, with_ids)).withColumn("part", F.pmod(F.xxhash64("id", "start", "doc_tokens", "ids_crc32"), F.lit(parts)))
    sizes = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("length", "part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "start", "doc_tokens", "ids_crc32"))
    numbered = made.withColumn("place", place).join(F.broadcast(firsts), ["length", "part"])
    columns = [F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("place") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")]
    return numbered.select(*columns, *(["ids"] if with_ids else []))
