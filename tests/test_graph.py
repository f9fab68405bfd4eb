import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veritrail.operators import graph
from veritrail.operators.components import connected_components
from veritrail.plans import graph_queries


def pairs(spark, rows):
    return spark.createDataFrame([(a, b, w) for a, b, w in rows], "subject_id string, object_id string, weight double")


def test_paths_and_reachability(spark):
    p = pairs(spark, [("a", "b", 0.5), ("b", "c", 0.5), ("c", "d", 1.0), ("b", "e", 1.0), ("x", "y", 1.0), ("y", "x", 1.0), ("z", "w", 1.0), ("d", "b", 1.0)])
    got = {">".join(r.path): (r.hops, r.weight) for r in graph.paths(p).collect()}
    assert got == {"a>b>c>d": (3, 0.25), "a>b>e": (2, 0.5)}  # the cycle x, y has no root; z>w is one hop
    reach = {r.node: r.reached for r in graph.reachability(p).collect()}
    assert reach == {"a": 4, "b": 4, "c": 4, "d": 4, "x": 2, "y": 2, "z": 1}
    assert graph.paths(p.limit(0)).count() == 0


def test_long_chains_are_walked_to_their_end(spark):
    chain = [f"n{i:02}" for i in range(13)]
    p = pairs(spark, [(a, b, 1.0) for a, b in zip(chain, chain[1:], strict=False)])
    assert [(list(r.path), r.hops) for r in graph.paths(p).collect()] == [(chain, 12)]
    assert graph.paths(p, 12).count() == 1
    assert {r.node: r.reached for r in graph.reachability(p).collect()} == {n: 12 - i for i, n in enumerate(chain[:-1])}
    with pytest.raises(RuntimeError):
        graph.paths(p, 11)
    with pytest.raises(RuntimeError):
        graph.reachability(p, 5)


def test_components_do_not_depend_on_order(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(40) if i % 7] + [("hub", f"s{i}") for i in range(30)]
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(links)
        got = {r.node: r.component for r in connected_components(spark.createDataFrame([(b, a) if seed else (a, b) for a, b in links], "a string, b string")).collect()}
        assert want is None or got == want
        want = got


def test_components_and_paths_over_all_edges(spark):
    sf = "/root/testdata/sf0.001"
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_suppkey", "l_partkey").collect():
        a, b = find(f"s{r.l_suppkey}"), find(f"p{r.l_partkey % 500}")
        root[max(a, b)] = min(a, b)
    assert {r.component: r.n for r in graph_queries.component_sizes_all(spark, sf).collect()} == Counter(map(find, list(root)))
    keys = [r.s_suppkey for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()]
    step = {(r.subject_id, r.object_id) for r in graph_queries.hierarchy(spark, sf, 1).collect()}
    assert {(f"s{k}", f"s{k // 2}") for k in keys} <= step


def edge(i, s="a", a="BENEFICIAL_OWNER", o="b", posture="SELF_REPORTED", cls="DIRECT", pct=10.0, conf=0.9, date="2020-01-01", doc="d1"):
    return (i, s, a, o, posture, cls, pct, conf, date, doc, "h")


EDGE = "row_id int, subject_id string, assertion string, object_id string, evidentiary_posture string, evidence_class string, ownership_percent double, confidence double, source_date string, source_sha256 string, host string"


def test_each_rule_has_its_row(spark):
    rows = [edge(0), edge(1, s=None), edge(2, o=""), edge(3, a="X"), edge(4, posture="X"), edge(5, cls="X", a="PARENT"), edge(6, cls="REPORTED"), edge(7, pct=101.0), edge(8, conf=1.5), edge(9, date="2020"), edge(10, o="a"), edge(11, o="lost")]
    known = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    got = {(r.row_id, r.rule) for r in graph.violations(spark.createDataFrame(rows, EDGE), known).collect()}
    assert got == {
        (1, "missing_subject"), (2, "missing_object"), (2, "dangling_object_id"), (3, "unknown_assertion"), (4, "unknown_posture"), (5, "unknown_evidence_class"), (6, "owner_not_direct"), (7, "percent_range"), (8, "confidence_range"), (9, "bad_date"), (10, "self_loop"), (11, "dangling_object_id"),
    }
    assert graph.violations(spark.createDataFrame(rows[:1], EDGE)).count() == 0


def test_competing_claims_need_two_documents(spark):
    same = [edge(0, s="x", o="o1"), edge(1, s="y", o="o1")]
    two = [edge(2, s="x", o="o2", date="2021-01-01"), edge(3, s="y", o="o2", doc="d2"), edge(4, s="y", o="o2", doc="d2")]
    got = graph.competing_claims(spark.createDataFrame(same + two, EDGE)).collect()
    assert [tuple(r) for r in got] == [("o2", 2, 2, 2, "2020-01-01", "y")]


def test_weights_names_and_merges(spark):
    w = spark.createDataFrame([("SELF_REPORTED", 0.5), ("UNKNOWN", None), ("GOVERNMENT_FINDING", 0.0)], "p string, c double").select(graph.edge_weight(F.col("p"), F.col("c")).alias("w"))
    assert [round(r.w, 6) for r in w.collect()] == [0.45, 0.2, 0.5]
    keys = spark.createDataFrame([("acme holdings inc",), ("acme holdings",), ("acme holdings group",), ("smith",), ("john smith",)], "key string")
    assert {(r.shorter, r.longer) for r in graph.prefix_pairs(keys).collect()} == {("acme holdings", "acme holdings inc"), ("acme holdings", "acme holdings group")}
    assert [(r.a, r.b) for r in graph.suffix_pairs(keys).collect()] == [("acme holdings", "acme holdings inc")]
    assert [(r.surname, r.full) for r in graph.surname_pairs(keys).collect()] == [("smith", "john smith")]
    names = spark.createDataFrame([("ABC",), ("American Bank of Commerce, Inc.",)], "name string")
    assert [(r.acronym, r.full) for r in graph.acronym_pairs(names).collect()] == [("abc", "american bank of commerce inc")]
    votes = spark.createDataFrame([("k", "Ab"), ("k", "Ab"), ("k", "AB"), ("k", "Abc")], "key string, spelling string")
    assert [(r.canonical, r.variants) for r in graph.spelling_vote(votes).collect()] == [("Ab", ["AB", "Abc"])]
    merged = graph.merged_ids(spark.createDataFrame([("n1",), ("n2",), ("n3",)], "id string"), connected_components(spark.createDataFrame([("n2", "n1")], "a string, b string")))
    moved = graph.redirect(pairs(spark, [("n1", "n2", 1.0), ("n2", "n3", 1.0)]), merged).collect()
    assert [(r.subject_id, r.object_id) for r in moved] == [("n1", "n3")]


def test_diff(spark):
    schema = "relation string, families array<string>, docs long"
    old = spark.createDataFrame([("same", ["a"], 1), ("gone", ["a"], 1), ("fam", ["a"], 1), ("more", ["a"], 1)], schema)
    new = spark.createDataFrame([("same", ["a"], 1), ("new", ["a"], 1), ("fam", ["a", "b"], 2), ("more", ["a"], 2)], schema)
    assert {r.relation: r.change for r in graph.checkpoint_diff(old, new).collect()} == {"same": "SAME", "gone": "DROPPED", "new": "ADDED", "fam": "GAINED_FAMILY", "more": "MORE_DOCS"}
    c = "node string, component string"
    joined = graph.joined_components(spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "b")], c), spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a")], c)).collect()
    assert [(r.component, r.joins) for r in joined] == [("a", 1)]
