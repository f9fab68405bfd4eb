import random

import pytest
import xxhash

from veritrail.llm.simhash import near_dedup, near_links, simhash64, simhash_components
from veritrail.operators.components import connected_components


def slow_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def slow_groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(60):
        text = " ".join(rng.choice(["A", "the", "É x", "b c", "ÀB", "\x1c", "\n", "\t"]) for _ in range(rng.randrange(12)))
        assert simhash64(text) == slow_print(text)
    assert simhash64(None) == simhash64(" \n") == 0


@pytest.mark.parametrize("limit", [0, 3, 64])
def test_links_span_the_components_of_all_pairs(spark, limit):
    rng = random.Random(limit)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(rng.randrange(14)):
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(3)])
            prints.add(x)
    prints = sorted(map(signed, prints))
    pairs = [(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    links = near_links(spark.createDataFrame([(p,) for p in prints], "fp long"), limit)
    got = {(r.a, r.b) for r in links.collect()}
    assert got <= set(pairs) and (limit < 64 or got == set(pairs))
    assert slow_groups(prints, got) == slow_groups(prints, pairs)
    found = {r.node: r.component for r in connected_components(links).collect()}
    want = slow_groups(prints, pairs)
    assert found == {n: c for n, c in want.items() if any(n in p for p in pairs)}


def test_components_shapes(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(200)]
    rng.shuffle(chain)
    links = [*chain, *((1000, 1001 + i) for i in range(150)), (5000, 5000), (6000, None), (7001, 7000), (7000, 7001)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(151)} | {5000: 5000, 7000: 7000, 7001: 7000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_nodes_and_crowded_segments(spark):
    links = [(0, i) for i in range(1, 400)] + [(i, 1000 + i) for i in range(1, 40)] + [(5000, 5001)]
    for hot in (1, 20, 1 << 17):
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), hot_links=hot).collect()}
        assert got == {n: 0 if n < 5000 else 5000 for link in links for n in link}


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [" ".join(rng.choice(words) for _ in range(400)) for _ in range(12)]
    for i in range(120):
        text = base[i % 12].split()
        if i % 3:
            text[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(text)))
    return [*rows, (200, None), (201, ""), (202, " \n"), (203, "one"), (204, "One"), (5, rows[5][1]), (None, "one"), (None, "no other"), (None, "no other")]


def test_operator_against_all_pairs(spark):
    rows = corpus()
    got = simhash_components(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component int")).collect()
    prints = sorted({slow_print(t) for _, t in rows})
    groups = slow_groups(prints, [(a, b) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= 2])
    least = {}
    for i, t in rows:
        g = groups[slow_print(t)]
        least[g] = min([x for x in (least.get(g), i) if x is not None], default=None)
    want = sorted((str(i), f"{slow_print(t):016x}", str(least[groups[slow_print(t)]])) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    groups = simhash_components(frame.select("doc_id", "text")).collect()
    kept = near_dedup(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({r.component_id for r in groups if r.component_id is not None})
    assert ids.count(None) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup(empty).count() == 0 and simhash_components(empty).count() == 0


def test_near_dedup_keeps_each_group_of_a_repeated_id(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(60)) for _ in range(12)]
    rows = [(1, t) for t in texts] + [(0, texts[0]), (1, texts[5]), (1, texts[5]), (None, texts[7]), (None, "no id"), (None, "no id")]
    for order in (rows, rows[::-1]):
        kept = near_dedup(spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("0", texts[0]), *(("1", t) for t in texts[1:]), ("None", "no id")])


def test_near_dedup_is_determined_and_takes_any_columns(spark):
    rows = [(1, "one text", s, {"m": 1}, 5) for s in "cab"] + [(2, "one text", "0", None, 5)]
    for order in (rows, rows[::-1]):
        kept = near_dedup(spark.createDataFrame(order, "doc_id long, text string, k1 string, row map<string, int>, component int"))
        assert kept.columns == ["doc_id", "text", "k1", "row", "component"]
        got = kept.collect()
        assert len(got) == 1 and got[0].doc_id == 1
        assert got[0].k1 == (first := got[0].k1 if order is rows else first)


@pytest.mark.parametrize("limit", [1, 64])
def test_exploded_rows_are_never_broadcast(spark, limit):
    """The rows of these tables count as few before they are exploded, which is why they were sent through the driver."""
    rng = random.Random(8)
    crowd = [signed(5 << 32 | rng.getrandbits(32)) for _ in range(40)]
    links = near_links(spark.createDataFrame([(x,) for x in {*crowd, *(c ^ 2 for c in crowd)}], "fp long").distinct(), limit)
    assert links.count() >= 40
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
