"""Left joins that attach stored facts to rows: dates, quotes, titles, metadata, classes.

Every row of the left side stays, once for each time it is there: the facts are made unique by key before they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.functions.scalars import iso_date, short_id, slug_title


def one_per_key(facts: DataFrame, key: str, rank: list[Column] | None = None) -> DataFrame:
    """One row for each key that is not null: the last by rank; without a rank, or where ranks tie, the greatest row."""
    others = [c for c in facts.columns if c != key]
    named = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*(c.alias(f"_r{n}") for n, c in enumerate(rank or [])), *others)).alias("_best"))
    return named.select(key, *(F.col(f"_best.{c}").alias(c) for c in others))


def with_inventory(rows: DataFrame, inventory: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """rows(sha256, ...) with columns of inventory(sha256, ...); how: left (unknown objects have nulls) or inner."""
    return rows.join(one_per_key(inventory.select("sha256", *columns), "sha256"), "sha256", how)


def of_families(candidates: DataFrame, inventory: DataFrame, families: list[str]) -> DataFrame:
    """Candidates whose object belongs to one of families, with that family. The inventory is cut to those families before it meets the candidates."""
    return with_inventory(candidates, inventory.where(F.col("family").isin(*families)), ["family"], "inner")


def with_classes(candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """candidates(sha256, ...) with the classes of their document; without any, an empty list."""
    joined = candidates.join(one_per_key(classes.select("sha256", "classes"), "sha256"), "sha256", "left")
    return joined.withColumn("classes", F.coalesce("classes", F.array().cast("array<string>")))


def dated(observations: DataFrame, dates: DataFrame) -> DataFrame:
    """observations(source_sha256, date_raw, ...) with the date of the document and the date from which the relation holds.

    dates(sha256, publication_date, publication_basis, event_date, event_basis). source_date is the document's publication.
    valid_from is the full date that the sentence states, else the document's own event date; a year alone is no date. The two are never mixed.
    """
    known = one_per_key(dates.select("sha256", "publication_date", "publication_basis", "event_date", "event_basis"), "sha256")
    stated = iso_date(F.col("date_raw"))
    stated = F.when(F.length(stated) == 10, stated)
    joined = observations.join(known.withColumnRenamed("sha256", "source_sha256"), "source_sha256", "left")
    basis = F.when(stated.isNotNull(), "sentence-stated").when(F.col("event_date").isNotNull(), F.col("event_basis"))
    return joined.select(
        *observations.columns, F.col("publication_date").alias("source_date"), F.col("publication_basis").alias("source_date_basis"), F.coalesce(stated, "event_date").alias("valid_from"), basis.alias("valid_from_basis"),
    )


def quoted(edges: DataFrame, observations: DataFrame, limit: int = 260) -> DataFrame:
    """edges(source_id, ...) with quote: the first limit characters of the text of their observation, white space collapsed; empty where there is none."""
    text = F.trim(F.regexp_replace(F.coalesce("raw_text", F.lit("")), r"(?U)\s+", " "))
    cut = observations.select(F.col("observation_id").alias("source_id"), F.left(text, F.lit(limit)).alias("quote"))
    return edges.join(one_per_key(cut, "source_id"), "source_id", "left").withColumn("quote", F.coalesce("quote", F.lit("")))


def identities(observed: DataFrame, inventory: DataFrame) -> DataFrame:
    """observed(url, family, ...) with the identity of the document: its number and title in inventory(url, document_number, title, publication_date, seq), the last row of a url that has either.

    The key is the number, else the url; without a title the words of the url stand for it.
    """
    told = inventory.where((F.coalesce("document_number", F.lit("")) != "") | (F.coalesce("title", F.lit("")) != ""))
    known = one_per_key(told.select("url", "document_number", "title", "publication_date", "seq"), "url", [F.col("seq")]).drop("seq")
    joined = observed.join(known, "url", "left")
    key = F.coalesce(F.nullif("document_number", F.lit("")), "url")
    title = F.coalesce(F.nullif("title", F.lit("")), slug_title(F.col("url")))
    return joined.withColumns({"title": title, "identity_key": key, "identity_id": short_id("doc-", F.col("family"), key)})


def titled(candidates: DataFrame, statuses: DataFrame) -> DataFrame:
    """candidates(source_sha256, source_url, ...) with title: that of the extracted object, else the first 100 characters of the url."""
    known = statuses.where(F.coalesce("title", F.lit("")) != "").select(F.col("sha256").alias("source_sha256"), "title")
    joined = candidates.join(one_per_key(known, "source_sha256"), "source_sha256", "left")
    return joined.withColumn("title", F.coalesce("title", F.left(F.coalesce("source_url", F.lit("")), F.lit(100))))


def with_bodies(records: DataFrame, stored: DataFrame) -> DataFrame:
    """records(sha256, ...) with content of stored(sha256, content); null where the object is not stored."""
    return records.join(stored.select("sha256", "content").dropDuplicates(["sha256"]), "sha256", "left")
