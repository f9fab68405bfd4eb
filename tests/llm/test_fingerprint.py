import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from veritrail.llm import fingerprint as fp

SPACE = " \t\n\x0b\x0c\r"


def paragraphs(text):
    """As the operator cuts them; none of these texts has a paragraph of over 500 bytes."""
    return [p for p in (x.strip(SPACE) for x in re.split(r"\n+|(?<=[.!?])[ \t]+|(?<=[。！？])[ \t]*", text)) if p]


def likeness(a, b):
    """From the multisets themselves: a paragraph that occurs m times counts m^2."""
    a, b = Counter(a), Counter(b)
    squares = lambda c: sum(v * v for v in c.values())
    apart = squares({k: a[k] - b[k] for k in a.keys() | b.keys()})
    return 1 - apart / (squares(a) + squares(b)) if a and b else float(a == b)


def brute_chain(rows):
    """(id, text) in order -> the next one's text, by id then by the operator's own key order among equal ids."""
    return rows[1:] + rows[:1]


def test_chain_digests_and_equality(spark):
    rng = random.Random(9)
    rows = [(i * 3, "\n".join(f"Line {rng.randrange(40)} é😀. Next {rng.randrange(9)}!" for _ in range(rng.randrange(9)))) for i in range(150)]
    rows += [(1, None), (2, ""), (4, "x"), (700, "B\nA"), (701, "A\nB"), (702, "A. B"), (800, "p. " * 40_000)]
    rows.sort()
    frame = spark.createDataFrame([(t, i, "z", 0) for i, t in rows], "text string, doc_id long, k1 string, n_chars int")
    got = {r.doc_id: r for r in fp.edit_likeness(frame.repartition(5)).collect()}
    assert len(got) == len(rows)
    for (i, text), (j, following) in zip(rows, brute_chain(rows), strict=True):
        text, following = text or "", following or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == got[j].fingerprint) == (sorted(paragraphs(text)) == sorted(paragraphs(following)))
        assert (r.fingerprint == r.edited_fingerprint) == (sorted(paragraphs(text)) == sorted(paragraphs(edited)))
        a, b = paragraphs(text), paragraphs(edited)
        assert abs(r.near_edited - max(0, likeness(a, b))) < 0.12 + 0.2 * (len(a) + len(b) < 6)
        assert abs(r.near_next - max(0, likeness(a, paragraphs(following)))) < 0.3
    assert got[800].near_edited > 0.9  # 30,000 of 40,000 equal paragraphs stay
    assert got[700].fingerprint == got[701].fingerprint and got[700].near_next == 1.0
    assert got[1].fingerprint == got[2].fingerprint


def test_likeness_is_near_the_truth(spark):
    rng = random.Random(4)
    pairs = []
    for n in (10, 40, 200, 3000):
        for share in (0, 10, 25, 50, 75, 100):
            a = [f"paragraph {rng.random()}" for _ in range(n)]
            b = [f"paragraph {rng.random()}" if rng.random() * 100 < share else p for p in a]
            pairs.append(("\n".join(a), "\n".join(b), likeness(a, b)))
    rows = spark.createDataFrame(pairs, "a string, b string, true_likeness double")
    rows = fp.fingerprints(rows, F.col("a"), F.col("b"), F.col("true_likeness")).withColumnRenamed("vector", "v")
    rows = fp.fingerprints(rows, F.col("b"), F.col("v"), F.col("true_likeness"))
    a, b = fp.centred(F.col("v")), fp.centred(F.col("vector"))
    near = fp.likeness(F.col("v") == F.col("vector"), fp.inner(a, a), fp.inner(b, b), fp.inner(a, b))
    errors = [(abs(max(0, r.true_likeness) - r.got), r.true_likeness) for r in rows.select("true_likeness", near.alias("got")).collect()]
    assert all(e < 0.1 for e, t in errors if t >= 0.75) and all(e < 0.3 for e, _ in errors), errors
    assert sum(e for e, _ in errors) / len(errors) < 0.06


def test_one_line_texts_are_cut(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(800)]
    chinese = "".join("".join(chr(0x4E00 + rng.randrange(900)) for _ in range(12)) + "。" for _ in range(60))
    for text in (" ".join(words), chinese):
        frame = spark.createDataFrame([(text,)], "t string").select(fp.paragraphs(F.col("t")).alias("p"), fp.paragraphs(F.expr("t || ' more'")).alias("q"))
        p, q = frame.first()
        assert len(p) > 40 and "".join(p).replace(" ", "") == text.replace(" ", "") and len(set(p) ^ set(q)) <= 2


def test_repeats_and_nulls(spark):
    rows = [(5, "same"), (5, "same"), (5, "same"), (6, "next one"), (None, "null id"), (None, "null id")]
    got = fp.edit_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    five = sorted((r.edited_sha256, r.near_next) for r in got if r.doc_id == 5)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(x for x, _ in five) == sorted([sha("sams"), sha("sams"), sha("samn")])
    assert sorted(r.edited_sha256 for r in got if r.doc_id is None) == sorted([sha("null in"), sha("null is")])
    assert fp.edit_likeness(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = fp.edit_likeness(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == sha("abca") and one[0].near_next == 1.0


def test_insert_and_delete(spark):
    texts = {"whole": "a\nb\nc\nb", "part": "b\nc", "rest": "a\nb"}
    frame = spark.createDataFrame([tuple(texts.values())], ", ".join(f"{c} string" for c in texts))
    for c in texts:
        frame = frame.withColumn(f"h_{c}", fp.hashes(fp.paragraphs(F.col(c))))
    frame = frame.select(*(fp.vector(F.col(f"h_{c}")).alias(c) for c in texts))
    row = frame.select("whole", "rest", fp.combine(F.col("part"), F.col("rest")).alias("sum"), fp.remove(F.col("whole"), F.col("part")).alias("left")).first()
    assert row["sum"] == row["whole"] and row["left"] == row["rest"] and len(row["whole"]) == 46
