import random
import re
from collections import Counter
from unicodedata import category

import numpy as np

from veritrail.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), sum(category(c) == "Lu" for c in text), sum(c == "!" for c in text), len(set(w)), text.count("\n") + 1


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a a a", "a a a a", "x y z x y z", "É# É# É#|<>&%$*", "l\nl\n\nl \n \n", "😀 😀 😀 😀 😀", " a\x1cb\xa0c ", "one two three " * 400]
    out += ["".join(rng.choice(["a", "b", "É", "#"]) + rng.choice([" ", "\n", " ", "\t", "  ", "\x0b"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    return out


def test_statistics(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts())] + [(None, "q q", 1, "x"), (3, "a", 1, "x"), (3, "a", 1, "x")]
    got = quality.statistics(spark.createDataFrame(rows, "doc_id long, text string, w int, h string")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaims", "n_distinct_words", "n_lines")
    assert sorted((str(r.id), *(r[k] for k in names)) for r in got) == sorted((str(i), *brute(t)) for i, t, _, _ in rows)


def labelled(spark):
    rng = random.Random(7)
    words = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(words) for _ in range(80)]
        bad = i % 5 == 0
        if bad:
            w = [x + "###" for x in w] if i % 2 else [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), "s"))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 0, 0), (5, None, 0), (7, 1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, quality string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_list_rejects_unlabelled_bad_and_keeps_good(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in quality.quality_verdicts(docs, labels).collect()}
    assert all(got[i].kept == (i % 5 != 0) and not got[i].base_failed for i in range(600))
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(600) if i % 5}
    plain = quality.quality_verdicts(docs, labels.limit(0))
    assert all(r.kept != r.base_failed for r in plain.collect())
    assert quality.quality_verdicts(docs.limit(0), labels).count() == 0


def test_labels_all_null_and_a_bounded_sample(spark, monkeypatch):
    docs, labels = labelled(spark)
    nothing = docs.selectExpr("doc_id", "cast(null as string) as text")
    assert quality.fit_rules(nothing, labels) == [] == quality.fit_rules(docs, labels.selectExpr("doc_id", "cast(null as int) as quality"))
    sizes = []
    monkeypatch.setattr(quality, "SAMPLE", 10)
    monkeypatch.setattr(quality, "learn_rules", lambda x, bad: sizes.append(len(x)) or [])
    one = docs.selectExpr("1 as doc_id", "text")
    quality.fit_rules(one, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert sizes == [10]


def test_no_rule_from_noise():
    rng = np.random.default_rng(0)
    assert quality.learn_rules(rng.normal(size=(900, len(quality.RATIOS))), rng.random(900) < 0.1) == []
