import os
import random

import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402


def corpus():
    rng = random.Random(21)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "ti", "vu", "xe", "zan", "dor")]
    bad = ["grumpf", "idiot", "zorkel"]
    docs, labels = [], []
    for i in range(420):
        text = [rng.choice(words) for _ in range(120)]
        toxic, poor = i % 10 == 1, i % 10 == 2
        for _ in range(5 if toxic else 0):
            text[rng.randrange(120)] = rng.choice(bad)
        if poor:
            text = [w + "###" for w in text]
        body = " ".join(text)
        if i % 10 == 3:
            body += "\nSubscribe to our letter"
        docs.append((i, body, "xx", "src0", len(body)))
        if i % 2 or i % 10 == 2:
            labels.append((i, int(not poor), int(toxic)))
    docs += [(1000 + i, docs[50][1], "xx", "src1", len(docs[50][1])) for i in range(5)]
    return docs, labels


def test_stages_against_what_was_planted(spark, tmp_path):
    docs, labels = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame, columns = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"stage{k}")
        stage(spark, frame, str(tmp_path)).write.parquet(out)
        columns, before = frame.columns, frame
        frame = spark.read.parquet(out)
        if k < 4:
            assert frame.columns == columns == before.columns
            left.append({r.doc_id for r in frame.collect()})
    every = {d[0] for d in docs}
    assert left[0] == {i for i in every if i >= 1000 or i % 10 != 1}
    assert left[1] == left[2] == {i for i in left[0] if i >= 1000 or i % 10 != 2}
    assert left[3] == {i for i in left[1] if i < 1000}
    lines = spark.read.parquet(str(tmp_path / "stage2")).collect()
    assert not any("Subscribe" in r.text for r in lines) and all(r.n_chars == len(r.text) for r in lines)
    assert {r.doc_id for r in frame.select("doc_id").collect()} == left[3]
    assert os.path.exists(tmp_path / "stage4")


def test_run_gives_the_last_stage(spark, tmp_path):
    docs, labels = corpus()
    spark.createDataFrame(docs[:60], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels[:30], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() > 0 and "sequence_id" in got.columns


def test_near_dedup_sends_no_groups_through_the_driver(spark):
    """Rows that stay are nearly as many as documents; they were broadcast wherever they had less than 10 MB."""
    docs = spark.createDataFrame(corpus()[0], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.dedup_near(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == set(range(420))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
