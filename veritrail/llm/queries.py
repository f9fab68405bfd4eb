"""Queries of the training-data operators over the whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SHARDS, SLOTS = [f"shard-{i:03d}" for i in range(64)], 8191


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.sharding import shard

    placed = shard(table(spark, sf_dir, "documents").select("doc_id"), SHARDS, size=SLOTS)
    return placed.select("doc_id", F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.line_dedup import line_dedup

    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.quality import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.bpe import bpe_round_trip

    made = bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veritrail.llm.fingerprint import edit_likeness

    return edit_likeness(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_html, op3_simhash, op4_line_dedup, op5_packing, op6_quality, op7_license, op8_bpe, op9_toxicity, op10_fingerprint)}

LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, i AS pos, l[i] AS line, translate(trim(l[i], chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d, unnest(range(1, len(l) + 1)) AS u(i)
), shared AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT lines.*, shared.key IS NOT NULL AS gone FROM lines LEFT JOIN shared ON lines.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SHARDING_SQL = r"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 3, '0') AS name,
    ('0x' || substr(sha256('start:shard-' || lpad(i::VARCHAR, 3, '0')), 1, 15))::BIGINT % 8191 AS first,
    ('0x' || substr(sha256('step:shard-' || lpad(i::VARCHAR, 3, '0')), 1, 15))::BIGINT % 8190 + 1 AS step
  FROM range(64) t(i)
), turns AS (
  SELECT -1 AS turn, list_transform(range(8191), lambda x: -1) AS owner
  UNION ALL
  SELECT turn, list_transform(owner, lambda x, k: if(k = pos + 1, turn % 64, x)) FROM (
    SELECT turn + 1 AS turn, owner,
      (first + step * list_filter(range(8191), lambda j: owner[(first + step * j) % 8191 + 1] = -1)[1]) % 8191 AS pos
    FROM turns JOIN shards ON shards.i = (turn + 1) % 64 WHERE turn < 8190
  ) claims
), filled AS (
  SELECT k - 1 AS slot, owner[k] AS shard_id FROM (SELECT owner FROM turns WHERE turn = 8190) t, unnest(range(1, 8192)) u(k)
)
SELECT doc_id, d.slot::INTEGER AS slot, name AS shard
FROM (SELECT doc_id, ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % 8191 AS slot FROM documents) d
JOIN filled ON filled.slot = d.slot JOIN shards ON shards.i = filled.shard_id
"""

ORACLES = {"op1_sharding": SHARDING_SQL, "op4_line_dedup": LINE_DEDUP_SQL}
