"""Sinks: append, replace, sorted export, seeds, chunks and metric documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_log(rows: DataFrame, path: str) -> None:
    """JSON lines appended, columns in name order."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Parquet replaced by the commit protocol; path must not be read by rows."""
    rows.write.mode("overwrite").parquet(path)


def export_sorted(rows: DataFrame, path: str, *order: str, gzip: bool = False) -> None:
    """JSON lines in one order over all files."""
    out = rows.select(*sorted(rows.columns)).orderBy(*order).write.mode("overwrite")
    (out.option("compression", "gzip") if gzip else out).json(path)


def write_seeds(rows: DataFrame, path: str, limit: int | None = None) -> None:
    """URL|PROVENANCE|SOURCE lines by priority, then url; limit is the feature."""
    ordered = rows.orderBy(F.desc("priority"), "url")
    ordered = ordered if limit is None else ordered.limit(limit)
    ordered.select(F.concat_ws("|", "url", "provenance", "source").alias("value")).write.mode("overwrite").text(path)


def write_chunks(rows: DataFrame, path: str) -> None:
    """rows(chunk, value) as text, a folder for each chunk."""
    rows.select("chunk", "value").write.mode("overwrite").partitionBy("chunk").text(path)


def new_objects(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Objects to store: each hash once, what is stored already left out."""
    return found.dropDuplicates(["sha256"]).join(stored.select("sha256"), "sha256", "left_anti")


def metric_document(metrics: DataFrame) -> DataFrame:
    """metrics(metric, key, value) to one JSON document for each metric."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))
    return metrics.groupBy("metric").agg(F.to_json(entries).alias("document"))


def markdown(rows: DataFrame, title: str, limit: int = 50) -> str:
    """A report table of the first rows; limit is the feature."""
    head = "| " + " | ".join(rows.columns) + " |\n|" + "---|" * len(rows.columns)
    body = "\n".join("| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows.limit(limit).collect())
    return f"## {title}\n\n{head}\n{body}\n"


def graph_payload(nodes: DataFrame, edges: DataFrame, limit: int = 5000) -> str:
    """Nodes and edges of the greatest degree as JSON that may stand in a script element; limit is the feature."""
    import json

    top = edges.select(F.explode(F.array("subject_id", "object_id")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree")).orderBy(F.desc("degree"), "id").limit(limit)
    shown = nodes.join(top, "id")
    kept = edges.join(top.select(F.col("id").alias("subject_id")), "subject_id", "left_semi").join(top.select(F.col("id").alias("object_id")), "object_id", "left_semi").limit(limit)
    data = {"nodes": [r.asDict() for r in shown.collect()], "edges": [r.asDict() for r in kept.collect()]}
    return json.dumps(data, sort_keys=True, default=str).replace("</", "<\\/")
