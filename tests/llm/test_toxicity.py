import random
import zlib

import numpy as np

from veritrail.llm import toxicity as tx
from veritrail.llm.common import bounded_sample


def data(n=900):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("lo", "ma", "ti") for b in ("na", "ro", "ke") for c in ("s", "t", "lin", "dor")]
    bad = ["zarkun", "zarkeft", "zarkolm", "blivok", "blivast", "idiot"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(60)]
        toxic = i % 8 == 0
        for _ in range(3 if toxic else 0):
            text[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_no_look_at_held_out_labels(spark):
    docs, labels = data()
    frame = spark.createDataFrame([(i, t, "x", 0.5) for i, t in docs] + [(None, None, "x", 0.1), (-1, "", "x", 0.1), (3, docs[3][1], "x", 0.1)], "doc_id long, text string, lang string, score double")
    got = tx.toxicity(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].held_out == held(i) for i, _ in docs) and by_id[None].predicted == 0 == by_id[-1].predicted
    out = [i for i, _ in docs if held(i)]
    assert np.mean([by_id[i].predicted == (i % 8 == 0) for i in out]) > 0.97
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels] + [(None, 1, 1), (4, 1, None)]
    again = tx.toxicity(frame, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert sorted((str(r.doc_id), r.score) for r in again) == sorted((str(r.doc_id), r.score) for r in got)
    clean = tx.keep_clean(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert clean.columns == frame.columns and {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in got if not r.predicted}


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "you stupid idiot"), (2, "a fine day")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.doc_id: r.predicted for r in tx.toxicity(docs, none).collect()} == {1: 1, 2: 0}
    assert tx.toxicity(docs.limit(0), none).count() == 0


def test_labels_all_null_or_of_one_class(spark):
    docs = spark.createDataFrame([(i, t) for i, t in ((1, "you stupid idiot"), (2, None), (3, ""), (3, "a day"))], "doc_id long, text string")
    for labels in ([(1, None), (2, None)], [(1, 1), (2, 1), (3, 1)], [(None, 1), (None, 0)]):
        got = tx.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert sorted((r.doc_id, r.predicted) for r in got) == [(1, 1), (2, 0), (3, 0), (3, 0)]


def test_the_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "same")] * 200, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    assert bounded_sample(docs, labels, "toxic", 10, "doc_id", "text").count() == 10
    assert bounded_sample(docs, labels, "toxic", 1000, "doc_id", "text").count() == 301
    assert bounded_sample(docs, labels.limit(0), "toxic", 10, "doc_id", "text").count() == 0


def test_unlabelled_documents_are_voted_on(spark):
    docs, labels = data()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    few = spark.createDataFrame([x for x in labels if x[0] < 400], "doc_id long, quality int, toxic int")
    prior = []
    made = tx.label_model
    try:
        tx.label_model = lambda *a: prior.append(a[1].sum()) or made(*a)
        model = tx.fit(frame, few)
    finally:
        tx.label_model = made
    assert prior == [sum(not held(i) for i, _ in docs)]
    assert np.mean([(model.score(t) >= 0.5) == (i % 8 == 0) for i, t in docs if i >= 400]) > 0.97


def test_label_model_finds_the_accurate_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.1
    good = np.where(y[:, None], rng.random((4000, 4)) < 0.7, rng.random((4000, 4)) < 0.002)
    twins = np.repeat((rng.random(4000) < np.where(y, 0.5, 0.3))[:, None], 3, axis=1)
    votes = np.hstack([good, twins]).astype(float)
    for labelled in (600, 4000):
        model = tx.label_model(votes, np.ones(4000), votes[:labelled], y[:labelled], np.ones(labelled))
        assert ((model.posterior(votes) > 0.5) == y).mean() > 0.97  # the twins alone don't make a text toxic
        assert model.share[4:].max() < 0.4 < model.share[:4].min()  # three voters that always agree count as one


def test_cover_reaches_each_document_several_times():
    hits = [["a", "b", "rare1", "rare2"], ["a", "b", "rare1", "rare2"], ["a", "b"], ["c"], ["c"], ["d"]]
    assert tx.cover(hits, np.ones(6), np.array([True] * 5 + [False]), times=2) == ["b", "a", "c"]


def test_lexicons_hold_what_occurs_together():
    hits = [["a", "b"], ["a", "b"], ["a"], ["x", "y"], ["y"], ["b", "q"]]
    groups = tx.lexicons(["a", "b", "x", "y"], hits, np.ones(6), np.array([True] * 5 + [False]))
    assert groups["a"] == groups["b"] != groups["x"] == groups["y"]


def test_patterns_look_at_every_whole_word():
    def vote(text, name):
        return bool(tx.features(text, {"scum-": 1})[1] >> (2 * tx.GROUPS + len(tx.INSULTS) + tx.PATTERNS.index(name)) & 1)

    assert vote("an idiot came by. " + "more words " * 20 + "and you are an idiot", "address") and vote("idiotic " * 20 + "you idiot", "address")
    assert not vote("you idiotic man, " + "more words " * 20 + "an idiot", "address") and not vote("an idiot came by, you see", "address")
    assert vote("an idiot, idiot!", "emphasis") and vote("a SCUMMY man", "emphasis") and not vote("an idiotic! IDIOTIC idiot", "emphasis")
    assert vote("idiot and moron", "several") and not vote("idiot idiot", "several")
    assert tx.features("scummy", {"scum-": 1}) == (["scum-"], 1 << (tx.GROUPS + 1) | 1 << (2 * tx.GROUPS + len(tx.INSULTS) + 1))
    assert tx.features("", {}) == ([], 0) and tx.VOTERS <= 16
