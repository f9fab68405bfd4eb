"""A pipeline over documents: toxicity, quality rules, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. Texts without a line left stay as empty documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.llm.common import table
from veritrail.llm.line_dedup import line_dedup
from veritrail.llm.packing import pack
from veritrail.llm.quality import keep_quality
from veritrail.llm.queries import tokenizer_path
from veritrail.llm.simhash import near_dedup
from veritrail.llm.toxicity import keep_clean
from veritrail.session import remove_folder, shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go from all of them; n_chars follows the text."""
    kept = line_dedup(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids."""
    return pack(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("quality rules", quality_rules), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_near), ("packing", packing)]

#: A trained classifier and a trained decision list decide: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder of spark.checkpoint.dir and read again; a stage's folder goes once the next one is written."""
    place = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
        if k:
            remove_folder(spark, f"{place}/{k - 1}")
    return docs
