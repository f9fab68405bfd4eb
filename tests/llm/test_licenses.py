import random
import re

import pytest

from veritrail.llm import licenses as li


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(text, templates):
    """Licenses of which one window of the method's windows holds 0.8 of the shingles."""
    own, out = shingles(text), {}
    for name, t in templates.items():
        want = set(shingles(t))
        scale = li.scale_of(len(want))
        best = max((len(want & set(own[i : i + li.window_length(scale)])) / len(want) for i in range(0, max(1, len(own)), max(1, scale // 2))), default=0)
        if best >= 0.8:
            out[name] = best
    return out


def corpus():
    rng = random.Random(12)
    noise = [f"w{i}" for i in range(200)] + ["license", "the", "under"]
    rows = []
    for i in range(160):
        parts = [" ".join(rng.choice(noise) for _ in range(rng.randrange(120)))]
        for name in rng.sample(sorted(li.TEMPLATES), rng.randrange(3)):
            words = re.sub(r"\s+", " ", li.TEMPLATES[name]).split(" ")
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(noise)
            parts += [" ".join(words), " ".join(rng.choice(noise) for _ in range(rng.randrange(90)))]
        rows.append((i, "\n".join(parts)))
    return rows


def test_against_brute_force(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, "the mit license"), (None, "x RELEASED under the MIT-License!!"), (None, "Released under the MIT License"), (903, "Licensed under CC BY-NC 4.0. " * 2000)]
    frame = spark.createDataFrame([(i, t, "l", 1) for i, t in rows], "doc_id long, text string, license string, n int")
    got = li.license_scan(frame).collect()
    want = {(i, t): brute(t, li.TEMPLATES) for i, t in rows}
    assert sorted((str(r.doc_id), r.license, round(r.containment, 9)) for r in got) == sorted((str(i), k, round(v, 9)) for (i, _), found in want.items() for k, v in found.items())
    assert len(got) > 60 and all(r.first_word >= 0 for r in got)


def test_recall_against_every_position(spark):
    """A run of words anywhere that holds 0.8 of a template lies in some window, and bands find it."""
    rng = random.Random(3)
    rows = []
    for i, name in enumerate(sorted(li.TEMPLATES) * 3):
        words = re.sub(r"\s+", " ", li.TEMPLATES[name]).split(" ")
        if rng.random() < 0.5 and len(words) > 60:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join([f"w{rng.randrange(300)}" for _ in range(rng.randrange(200))] + words + [f"w{rng.randrange(300)}" for _ in range(rng.randrange(200))])))
    got = {(r.doc_id, r.license) for r in li.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = set()
    for i, text in rows:
        own = shingles(text)
        for name, t in li.TEMPLATES.items():
            there = set(shingles(t))
            scale = li.scale_of(len(there))
            if any(len(there & set(own[k : k + scale])) >= 0.8 * len(there) for k in range(max(1, len(own) - scale // 2))):
                want.add((i, name))
    assert len(want) >= len(rows) and len(want - got) <= 0.01 * len(want)


def test_repeats_empty_and_refusals(spark):
    row = (1, "Released under the MIT License.")
    frame = spark.createDataFrame([row, row, (1, "no"), row], "doc_id long, text string")
    assert [(r.doc_id, r.license, r.containment, r.first_word) for r in li.license_scan(frame).collect()] == [(1, "MIT short", 1.0, 0)] * 3
    with pytest.raises(ValueError):
        li.license_scan(frame.withColumnRenamed("doc_id", "license"), id_col="license")
    assert li.license_scan(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        li.license_scan(frame, {"x": "too short"})


def test_bands_rarely_miss(spark):
    """The stated bound: a quarter in common is all but always found."""
    assert len({s >> 59 for s in li.band_seeds()}) == li.BANDS and (1 - 0.25) ** li.BANDS < 1.1e-4
