"""Graph queries: lineitem's supplier to part rows stand for evidence edges, names of customers, parts and suppliers for nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.functions.scalars import acronym, graph_key
from veritrail.operators import graph
from veritrail.operators.components import connected_components
from veritrail.plans.log_queries import table

POSTURES = ("GOVERNMENT_FINDING", "SELF_REPORTED", "COURT_ALLEGATION", "OTHER_DIRECT_ASSERTION")


def edges(spark, sf_dir) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    posture = F.element_at(F.array(*(F.lit(p) for p in POSTURES)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    confidence = F.when(F.col("l_discount") > 0.05, 0.9).when(F.col("l_discount") > 0.02, 0.0).otherwise(0.75)
    rows = l.select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("subject_id"), F.concat(F.lit("p"), F.col("l_partkey") % 500).alias("object_id"), F.when(F.col("l_returnflag") == "A", "BENEFICIAL_OWNER").when(F.col("l_returnflag") == "N", "UNKNOWN_CONTROL_ROLE").otherwise("PARENT").alias("assertion"),
        posture.alias("evidentiary_posture"), confidence.alias("confidence"), F.concat(F.lit("d"), F.col("l_orderkey") % 1000).alias("source_sha256"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("source_date"), F.concat(F.lit("h"), F.col("l_linenumber")).alias("host"),
        F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("line"), (F.col("l_quantity") * 2.5).alias("ownership_percent"), F.when(F.col("l_linestatus") == "O", "DIRECT").otherwise("REPORTED").alias("evidence_class"),
    )
    return rows.withColumn("weight", graph.edge_weight(F.col("evidentiary_posture"), F.col("confidence")))


EDGES_SQL = """e AS (SELECT 's' || l_suppkey AS subject_id, 'p' || (l_partkey % 500) AS object_id, CASE l_returnflag WHEN 'A' THEN 'BENEFICIAL_OWNER' WHEN 'N' THEN 'UNKNOWN_CONTROL_ROLE' ELSE 'PARENT' END AS assertion,
    ['GOVERNMENT_FINDING', 'SELF_REPORTED', 'COURT_ALLEGATION', 'OTHER_DIRECT_ASSERTION'][l_linenumber % 4 + 1] AS posture, [1.0, 0.9, 0.6, 0.4][l_linenumber % 4 + 1]::DOUBLE * (CASE WHEN l_discount > 0.05 THEN 0.9 WHEN l_discount > 0.02 THEN 0.5 ELSE 0.75 END)::DOUBLE AS weight,
    'd' || (l_orderkey % 1000) AS doc, strftime(l_shipdate, '%Y-%m-%d') AS source_date, 'h' || l_linenumber AS host, l_orderkey AS row_id, l_quantity * 2.5 AS pct, CASE WHEN l_linestatus = 'O' THEN 'DIRECT' ELSE 'REPORTED' END AS cls FROM lineitem)"""


def pair_collapse_best(spark, sf_dir):
    c = graph.collapse_pairs(edges(spark, sf_dir))
    return c.withColumn("weight", F.round("weight", 6))


def controller_centrality(spark, sf_dir):
    return graph.centrality(edges(spark, sf_dir)).withColumn("weight", F.round("weight", 4))


def relationship_persistence(spark, sf_dir):
    return graph.persistence(edges(spark, sf_dir))


def competing_claims(spark, sf_dir):
    return graph.competing_claims(edges(spark, sf_dir))


def degree_count(spark, sf_dir):
    return graph.degrees(edges(spark, sf_dir))


def constraint_violations(spark, sf_dir):
    return graph.violations(edges(spark, sf_dir)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def referential_integrity(spark, sf_dir):
    known = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("entity_id")).where("entity_id not like '%7'")
    lost = edges(spark, sf_dir).select("object_id").join(known.withColumnRenamed("entity_id", "object_id"), "object_id", "left_anti")
    return lost.groupBy("object_id").agg(F.count(F.lit(1)).alias("n"))


def hierarchy(spark, sf_dir, every: int = 5) -> DataFrame:
    """Region to nation to supplier, and suppliers (those whose key every divides) to others, as weighted pairs."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    a = n.select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("subject_id"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("object_id"), F.lit(0.5).alias("weight"))
    b = s.select(F.concat(F.lit("n"), F.col("s_nationkey")).alias("subject_id"), F.concat(F.lit("s"), F.col("s_suppkey")).alias("object_id"), F.lit(0.25).alias("weight"))
    c = s.where(F.col("s_suppkey") % every == 0).select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("subject_id"), F.concat(F.lit("s"), F.floor(F.col("s_suppkey") / 2)).alias("object_id"), F.lit(0.5).alias("weight"))
    return a.unionByName(b).unionByName(c)


PAIRS_SQL = """pairs AS (SELECT 'r' || n_regionkey AS s, 'n' || n_nationkey AS t, 0.5::DOUBLE AS w FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, 0.25 FROM supplier UNION ALL SELECT 's' || s_suppkey, 's' || (s_suppkey // 2), 0.5 FROM supplier WHERE s_suppkey % 5 = 0)"""


def multi_hop_paths(spark, sf_dir):
    p = graph.paths(hierarchy(spark, sf_dir))
    return p.select(F.array_join("path", ">").alias("path"), F.col("hops").cast("int").alias("hops"), "weight")


def reachability(spark, sf_dir):
    return graph.reachability(hierarchy(spark, sf_dir))


def multi_hop_paths_all(spark, sf_dir):
    """multi_hop_paths with the links of every supplier."""
    p = graph.paths(hierarchy(spark, sf_dir, 1))
    return p.select(F.array_join("path", ">").alias("path"), F.col("hops").cast("int").alias("hops"), "weight")


def reachability_all(spark, sf_dir):
    """reachability with the links of every supplier."""
    return graph.reachability(hierarchy(spark, sf_dir, 1))


def component_sizes_all(spark, sf_dir):
    """Components of suppliers and parts over all edges, by the least node. No SQL: the recursive twin is too slow for all links."""
    links = edges(spark, sf_dir).select(F.col("subject_id").alias("a"), F.col("object_id").alias("b"))
    return connected_components(links).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


def component_sizes(spark, sf_dir):
    """Components over the first two lines of quantity 50 of each order, by the least node: the part of component_sizes_all that SQL can check."""
    links = edges(spark, sf_dir).where("ownership_percent = 125 and line <= 2").select(F.col("subject_id").alias("a"), F.col("object_id").alias("b"))
    return connected_components(links).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


def names(spark, sf_dir) -> DataFrame:
    """Party names in spelling variants, made from the names of parts."""
    p = table(spark, sf_dir, "part")
    base = F.concat(F.lit("Part "), F.regexp_replace("p_type", r"[^A-Za-z ]", ""), F.lit(" "), F.col("p_brand"))
    return p.select(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("The "), base, F.lit(", Inc."))).when(F.col("p_partkey") % 3 == 1, F.upper(base)).otherwise(F.concat(base, F.lit(" "), F.lit("Corp"))).alias("name"), "p_partkey")


NAMES_SQL = """n AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'The ' || b || ', Inc.' WHEN 1 THEN upper(b) ELSE b || ' Corp' END AS name, p_partkey FROM (SELECT p_partkey, 'Part ' || regexp_replace(p_type, '[^A-Za-z ]', '', 'g') || ' ' || p_brand AS b FROM part) q),
k AS (SELECT name, p_partkey, regexp_replace(regexp_replace(lower(name), '[.,]', '', 'g'), '^the ', '') AS key FROM n)"""


def name_normalise(spark, sf_dir):
    return names(spark, sf_dir).select("p_partkey", graph_key(F.col("name")).alias("key"))


def spelling_vote(spark, sf_dir):
    rows = names(spark, sf_dir).select(graph.stem(graph_key(F.col("name"))).alias("key"), F.col("name").alias("spelling"))
    return graph.spelling_vote(rows).select("key", "canonical", F.array_join("variants", "|").alias("variants"))


def prefix_containment(spark, sf_dir):
    return graph.prefix_pairs(names(spark, sf_dir).select(graph_key(F.col("name")).alias("key")))


def suffix_stem_pairs(spark, sf_dir):
    return graph.suffix_pairs(names(spark, sf_dir).select(graph_key(F.col("name")).alias("key")))


def acronym_initials(spark, sf_dir):
    return names(spark, sf_dir).select("p_partkey", acronym(F.col("name")).alias("acronym"))


def dictionary_match_cardinality(spark, sf_dir):
    """Names against a register: none, one or many entries."""
    register = table(spark, sf_dir, "customer").select(F.upper(F.concat(F.lit("part "), F.col("c_mktsegment"))).alias("k"), F.col("c_nationkey").alias("cik"))
    entries = register.groupBy("k").agg(F.array_sort(F.collect_set("cik")).alias("ciks"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.lit("PART BUILDING")).otherwise(F.upper("p_name")).alias("k"))
    n = F.coalesce(F.size("ciks"), F.lit(0))
    return rows.join(entries, "k", "left").select("p_partkey", F.when(n < 1, "UNRESOLVED").when(n == 1, "PROBABLE_MATCH").otherwise("AMBIGUOUS").alias("resolution"), F.greatest(n, F.lit(0)).cast("long").alias("matches"))


def checkpoint_diff(spark, sf_dir):
    def snapshot(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.concat_ws("|", "subject_id", "assertion", "object_id").alias("relation")).agg(F.array_sort(F.collect_set("host")).alias("families"), F.count_distinct("source_sha256").alias("docs"))

    e = edges(spark, sf_dir)
    diff = graph.checkpoint_diff(snapshot(e.where("row_id % 10 < 8")), snapshot(e.where("row_id % 10 > 0")))
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def dup_of_prior_flag(spark, sf_dir):
    """The rows that come first, by order and line."""
    e = edges(spark, sf_dir).select("subject_id", "assertion", "object_id", "row_id", "line")
    return graph.first_seen_duplicates(e, ["subject_id", "assertion", "object_id"], ["row_id", "line"]).where("not is_duplicate").drop("is_duplicate")


def control_chains(spark, sf_dir):
    """Every control path with the hosts of its hops, over the hierarchy with a host for each link."""
    rows = hierarchy(spark, sf_dir, 1).withColumn("host", F.concat(F.lit("h"), F.length("object_id")))
    return graph.chain_families(graph.paths(rows), rows).select(F.array_join("path", ">").alias("path"), F.array_join("families", ",").alias("families"), "cross_family")


def merged_nodes(spark, sf_dir):
    """Suppliers and customers of a nation as nodes of two kinds, linked along keys that differ by 10; links across kinds don't count."""
    s, c = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    nodes = s.select(F.format_string("s%06d", "s_suppkey").alias("id"), F.lit("entity").alias("kind")).unionByName(c.select(F.format_string("c%06d", "c_custkey").alias("id"), F.lit("person").alias("kind")))
    a = s.select(F.format_string("s%06d", "s_suppkey").alias("a"), F.format_string("s%06d", F.col("s_suppkey") + 10).alias("b"), F.lit("same key").alias("basis"))
    b = c.where("c_custkey % 3 = 0").select(F.format_string("c%06d", "c_custkey").alias("a"), F.format_string("c%06d", F.col("c_custkey") + 1).alias("b"), F.lit("alias").alias("basis"))
    x = s.select(F.format_string("s%06d", "s_suppkey").alias("a"), F.format_string("c%06d", "s_suppkey").alias("b"), F.lit("no link").alias("basis"))
    made = graph.merge_typed(nodes, a.unionByName(b).unionByName(x))
    return made.select("id", "kind", "survivor", F.coalesce(F.size("merged_from"), F.lit(0)).cast("long").alias("merged"), F.array_join("merge_basis", ",").alias("basis"))


def merge_ranking(spark, sf_dir):
    """Pairs of subjects that follow each other, the most central first; 50 are shown."""
    e = edges(spark, sf_dir)
    pairs = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("a"), F.concat(F.lit("s"), F.col("s_suppkey") + 1).alias("b"))
    return graph.rank_merge_candidates(pairs, graph.centrality(e)).limit(50).withColumn("weight", F.round("weight", 4))


def named_degrees(spark, sf_dir):
    """Edges of one document with the names of their ends, as they are shown."""
    nodes = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return graph.named_edges(edges(spark, sf_dir).where("source_sha256 = 'd1'").select("subject_id", "object_id"), nodes).groupBy("subject_name", "object_name").agg(F.count(F.lit(1)).alias("n"))


def dangling_ends(spark, sf_dir):
    """violations() with entities: edges whose object is no known entity."""
    known = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("entity_id")).where("entity_id not like '%7'").unionByName(table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("entity_id")))
    return graph.violations(edges(spark, sf_dir), known).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def acronym_pairs(spark, sf_dir):
    """Acronyms made from the names, against the names."""
    n = names(spark, sf_dir).select("name")
    short = n.select(F.left(acronym(F.col("name")), F.lit(3)).alias("name")).distinct()
    return graph.acronym_pairs(n.unionByName(short))


QUERIES = {
    f.__name__: f
    for f in (
        pair_collapse_best, controller_centrality, relationship_persistence, competing_claims, control_chains, merged_nodes, merge_ranking, named_degrees, dangling_ends, acronym_pairs, degree_count, constraint_violations, referential_integrity, multi_hop_paths, multi_hop_paths_all, reachability, reachability_all, component_sizes, component_sizes_all, name_normalise,
        spelling_vote, prefix_containment, suffix_stem_pairs, acronym_initials, dictionary_match_cardinality, checkpoint_diff, dup_of_prior_flag,
    )
}
STEM_SQL = "CASE WHEN regexp_matches(key, '( (inc|corp|co|ltd|llc|lp|llp|plc|sa|gmbh|ag|bv|nv))+$') AND len(string_split(regexp_replace(key, '( (inc|corp|co|ltd|llc|lp|llp|plc|sa|gmbh|ag|bv|nv))+$', ''), ' ')) >= 2 THEN regexp_replace(key, '( (inc|corp|co|ltd|llc|lp|llp|plc|sa|gmbh|ag|bv|nv))+$', '') WHEN len(string_split(key, ' ')) >= 2 THEN key END"
ORACLES = {
    "pair_collapse_best": f"WITH {EDGES_SQL} SELECT subject_id, object_id, round(-b['w'], 6) AS weight, b['d'] AS source_sha256, b['t'] AS source_date, b['h'] AS host, b['p'] AS evidentiary_posture, docs, evidence FROM (SELECT subject_id, object_id, min({{'w': -weight, 'd': doc, 't': source_date, 'h': host, 'p': posture}}) AS b, count(DISTINCT doc) AS docs, count(*) AS evidence FROM e GROUP BY 1, 2) g",
    "controller_centrality": f"WITH {EDGES_SQL}, b AS (SELECT subject_id, object_id, max(weight) AS w FROM e GROUP BY 1, 2), h AS (SELECT subject_id, count(*) AS held, round(sum(w), 4) AS weight FROM b GROUP BY 1) SELECT h.subject_id, held, weight, evidence, postures, hosts FROM h JOIN (SELECT subject_id, count(*) AS evidence, count(DISTINCT posture) AS postures, count(DISTINCT host) AS hosts FROM e GROUP BY 1) x ON x.subject_id = h.subject_id",
    "relationship_persistence": f"WITH {EDGES_SQL} SELECT subject_id, assertion, object_id, count(DISTINCT doc) AS docs, min(source_date) AS first_date, max(source_date) AS last_date, count(source_date) AS n_dated, string_agg(DISTINCT posture, ',' ORDER BY posture) AS postures, string_agg(DISTINCT host, ',' ORDER BY host) AS families FROM e GROUP BY 1, 2, 3 HAVING count(DISTINCT doc) >= 2",
    "degree_count": f"WITH {EDGES_SQL} SELECT node, count(*) AS degree FROM (SELECT subject_id AS node FROM e UNION ALL SELECT object_id FROM e) u GROUP BY node",
    "constraint_violations": f"WITH {EDGES_SQL} SELECT rule, count(*) AS n FROM (SELECT 'owner_not_direct' AS rule FROM e WHERE assertion = 'BENEFICIAL_OWNER' AND cls <> 'DIRECT' UNION ALL SELECT 'percent_range' FROM e WHERE pct NOT BETWEEN 0 AND 100) v GROUP BY rule",
    "referential_integrity": f"WITH {EDGES_SQL} SELECT object_id, count(*) AS n FROM e WHERE object_id NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_partkey % 10 <> 7) GROUP BY 1",
    "multi_hop_paths": f"WITH RECURSIVE {PAIRS_SQL}, walk AS (SELECT [s, t] AS path, w FROM pairs WHERE s NOT IN (SELECT t FROM pairs) AND s <> t UNION ALL SELECT list_append(path, t), walk.w * pairs.w FROM walk JOIN pairs ON path[-1] = s WHERE NOT list_contains(path, t)) SELECT array_to_string(path, '>') AS path, (len(path) - 1)::INTEGER AS hops, w AS weight FROM walk WHERE len(path) > 2 AND NOT EXISTS (SELECT 1 FROM pairs WHERE s = walk.path[-1] AND NOT list_contains(walk.path, t))",
    "reachability": f"WITH RECURSIVE {PAIRS_SQL}, c AS (SELECT s AS a, t AS b FROM pairs UNION SELECT a, t FROM c JOIN pairs ON b = s) SELECT a AS node, count(*) AS reached FROM c GROUP BY a",
    "component_sizes": f"WITH RECURSIVE {EDGES_SQL.replace('l_orderkey AS row_id', 'l_orderkey AS row_id, l_linenumber AS line')}, l AS (SELECT DISTINCT subject_id AS a, object_id AS b FROM e WHERE pct = 125 AND line <= 2), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l), c AS (SELECT a, a AS b FROM u UNION SELECT c.a, u.b FROM c JOIN u ON c.b = u.a) SELECT component, count(*) AS n FROM (SELECT a, min(b) AS component FROM c GROUP BY a) m GROUP BY component",
    "name_normalise": f"WITH {NAMES_SQL} SELECT p_partkey, key FROM k",
    "spelling_vote": f"WITH {NAMES_SQL}, c AS (SELECT {STEM_SQL} AS key, name, count(*) AS n FROM k GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, length(name) DESC, name) AS r FROM c) SELECT key, max(name) FILTER (WHERE r = 1) AS canonical, coalesce(string_agg(name, '|' ORDER BY name) FILTER (WHERE r > 1), '') AS variants FROM r GROUP BY key",
    "prefix_containment": f"WITH {NAMES_SQL}, d AS (SELECT DISTINCT key, string_split(key, ' ') AS t FROM k), p AS (SELECT key AS longer, array_to_string(t[1:i], ' ') AS shorter FROM d, unnest(range(2, len(t))) u(i)) SELECT shorter, longer FROM p WHERE shorter IN (SELECT key FROM d)",
    "suffix_stem_pairs": f"WITH {NAMES_SQL}, d AS (SELECT DISTINCT key, {STEM_SQL} AS stem FROM k) SELECT x.stem, x.key AS a, y.key AS b FROM d x JOIN d y ON x.stem = y.stem AND x.key < y.key",
    "acronym_initials": f"WITH {NAMES_SQL} SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(key, ' '), lambda w: w NOT IN ('', 'of', 'the', 'and', 'for', 'de', '&', 'inc', 'corp', 'co', 'ltd', 'llc', 'lp', 'llp', 'plc', 'sa', 'gmbh', 'ag', 'bv', 'nv')), lambda w: w[1:1]), '') AS acronym FROM k",
    "dictionary_match_cardinality": "WITH r AS (SELECT upper('part ' || c_mktsegment) AS k, count(DISTINCT c_nationkey) AS n FROM customer GROUP BY 1), p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'PART BUILDING' ELSE upper(p_name) END AS k FROM part) SELECT p_partkey, CASE WHEN coalesce(n, 0) < 1 THEN 'UNRESOLVED' WHEN n = 1 THEN 'PROBABLE_MATCH' ELSE 'AMBIGUOUS' END AS resolution, coalesce(n, 0) AS matches FROM p LEFT JOIN r ON p.k = r.k",
    "competing_claims": f"WITH {EDGES_SQL}, c AS (SELECT object_id, subject_id, doc, min(source_date) AS d FROM e WHERE assertion IN ('BENEFICIAL_OWNER', 'UNKNOWN_CONTROL_ROLE') GROUP BY 1, 2, 3) SELECT object_id, count(DISTINCT subject_id) AS subjects, count(DISTINCT doc) AS docs, count(*) AS n_claims, min(d) AS first_date, min({{'d': d, 's': subject_id}})['s'] AS first_subject FROM c GROUP BY object_id HAVING count(DISTINCT subject_id) >= 2 AND count(DISTINCT doc) >= 2",
    "checkpoint_diff": f"WITH {EDGES_SQL}, o AS (SELECT subject_id || '|' || assertion || '|' || object_id AS r, list(DISTINCT host) AS f, count(DISTINCT doc) AS d FROM e WHERE row_id % 10 < 8 GROUP BY 1), w AS (SELECT subject_id || '|' || assertion || '|' || object_id AS r, list(DISTINCT host) AS f, count(DISTINCT doc) AS d FROM e WHERE row_id % 10 > 0 GROUP BY 1) SELECT CASE WHEN o.r IS NULL THEN 'ADDED' WHEN w.r IS NULL THEN 'DROPPED' WHEN len(list_filter(w.f, lambda x: NOT list_contains(o.f, x))) > 0 THEN 'GAINED_FAMILY' WHEN w.d > o.d THEN 'MORE_DOCS' ELSE 'SAME' END AS change, count(*) AS n FROM o FULL OUTER JOIN w ON o.r = w.r GROUP BY 1",
    "dup_of_prior_flag": f"WITH {EDGES_SQL.replace('l_orderkey AS row_id', 'l_orderkey AS row_id, l_linenumber AS line')} SELECT subject_id, assertion, object_id, row_id, line FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, assertion, object_id ORDER BY row_id, line) AS r FROM e) x WHERE r = 1",
    "merged_nodes": """WITH n AS (SELECT printf('s%06d', s_suppkey) AS id, 'entity' AS kind, printf('s%06d', CASE WHEN s_suppkey % 10 = 0 THEN (SELECT min(s_suppkey) FROM supplier x WHERE x.s_suppkey % 10 = 0) ELSE (SELECT min(s_suppkey) FROM supplier x WHERE x.s_suppkey % 10 = supplier.s_suppkey % 10) END) AS survivor, 'same key' AS why FROM supplier
      UNION ALL SELECT printf('c%06d', c_custkey), 'person', CASE WHEN c_custkey % 3 = 1 THEN printf('c%06d', c_custkey - 1) ELSE printf('c%06d', c_custkey) END, 'alias' FROM customer),
      g AS (SELECT survivor, count(*) - 1 AS merged, any_value(why) AS why FROM n GROUP BY 1) SELECT n.id, n.kind, n.survivor, CASE WHEN n.id = n.survivor THEN merged ELSE 0 END AS merged, CASE WHEN n.id = n.survivor AND merged > 0 THEN g.why END AS basis FROM n JOIN g ON g.survivor = n.survivor""",
    "merge_ranking": f"WITH {EDGES_SQL}, b AS (SELECT subject_id, object_id, max(weight) AS w FROM e GROUP BY 1, 2), h AS (SELECT subject_id, sum(w) AS w FROM b GROUP BY 1), p AS (SELECT 's' || s_suppkey AS a, 's' || (s_suppkey + 1) AS b FROM supplier) SELECT p.a, p.b, round(greatest(coalesce(x.w, 0), coalesce(y.w, 0)), 4) AS weight FROM p LEFT JOIN h x ON x.subject_id = p.a LEFT JOIN h y ON y.subject_id = p.b WHERE greatest(coalesce(x.w, 0), coalesce(y.w, 0)) > 0 ORDER BY greatest(coalesce(x.w, 0), coalesce(y.w, 0)) DESC, 1, 2 LIMIT 50",
    "named_degrees": f"WITH {EDGES_SQL} SELECT coalesce(s_name, subject_id) AS subject_name, object_id AS object_name, count(*) AS n FROM e LEFT JOIN supplier ON 's' || s_suppkey = subject_id WHERE doc = 'd1' GROUP BY 1, 2",
    "dangling_ends": f"WITH {EDGES_SQL} SELECT rule, count(*) AS n FROM (SELECT 'owner_not_direct' AS rule FROM e WHERE assertion = 'BENEFICIAL_OWNER' AND cls <> 'DIRECT' UNION ALL SELECT 'percent_range' FROM e WHERE pct NOT BETWEEN 0 AND 100 UNION ALL SELECT 'dangling_object_id' FROM e WHERE object_id NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_partkey % 10 <> 7)) v GROUP BY rule",
}
ORACLES |= {f"{name}_all": ORACLES[name].replace(" WHERE s_suppkey % 5 = 0", "") for name in ("multi_hop_paths", "reachability")}
ORACLES["control_chains"] = ORACLES["multi_hop_paths_all"].replace("SELECT array_to_string(path, '>') AS path, (len(path) - 1)::INTEGER AS hops, w AS weight FROM walk", "SELECT array_to_string(path, '>') AS path, array_to_string(list_transform(path[2:], lambda x: 'h' || length(x)), ',') AS families, len(list_distinct(list_transform(path[2:], lambda x: length(x)))) > 1 AS cross_family FROM walk")
