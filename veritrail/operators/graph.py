"""Evidence graphs: edges(subject_id, assertion, object_id, confidence, evidentiary_posture, source_sha256, source_date, host).

Edges are a multigraph: rows are never merged except by analysis. Iterations are joins on node ids, cut by
checkpoints, and go on until nothing is left to do; pairs are bounded by equi-joins on derived keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.functions.scalars import SUFFIX_WORDS, acronym, graph_key
from veritrail.operators.components import connected_components
from veritrail.session import cut

# Weight of each posture of evidence.
POSTURE_WEIGHTS = {
    "ADJUDICATED_FACT": 1.0, "GOVERNMENT_FINDING": 1.0, "ADMINISTRATIVE_DESIGNATION": 1.0, "SELF_REPORTED": 0.9, "GOVERNMENT_ALLEGATION": 0.6,
    "COURT_ALLEGATION": 0.6, "CONGRESSIONAL_ASSERTION": 0.5, "THIRD_PARTY_ASSERTION": 0.4, "OTHER_DIRECT_ASSERTION": 0.4,
}
CONTROL = ("BENEFICIAL_OWNER", "PARENT", "UNKNOWN_CONTROL_ROLE")
CLAIMS = ("BENEFICIAL_OWNER", "UNKNOWN_CONTROL_ROLE")
ASSERTIONS = (*CONTROL, "OFFICER_OR_DIRECTOR", "AFFILIATE", "SHARED_ADDRESS", "ALIAS")
EVIDENCE_CLASSES = ("DIRECT", "INFERRED", "REPORTED")
#: Rounds after which an iteration that is sure to end raises an error.
SAFETY = 10_000


def edge_weight(posture: Column, confidence: Column) -> Column:
    """Weight of the posture (0.4 if unknown) times the confidence (0.5 if null or zero)."""
    weight = F.lit(0.4)
    for name, value in POSTURE_WEIGHTS.items():
        weight = F.when(posture == name, F.lit(value)).otherwise(weight)
    return weight * F.when(F.coalesce(confidence, F.lit(0.0)) == 0, F.lit(0.5)).otherwise(confidence)


def collapse_pairs(edges: DataFrame) -> DataFrame:
    """Parallel edges to one hop: the weight, posture, document, date and host of the best edge (ties: the first by document, date, host and posture), distinct documents, edges."""
    best = F.min(F.struct((-F.col("weight")).alias("w"), "source_sha256", "source_date", "host", "evidentiary_posture"))
    made = edges.groupBy("subject_id", "object_id").agg(best.alias("best"), F.count_distinct("source_sha256").alias("docs"), F.count(F.lit(1)).alias("evidence"))
    return made.select("subject_id", "object_id", (-F.col("best.w")).alias("weight"), "best.evidentiary_posture", "best.source_sha256", "best.source_date", "best.host", "docs", "evidence")


def paths(pairs: DataFrame, max_hops: int = SAFETY) -> DataFrame:
    """All maximal node-simple paths of two hops or more from roots (subjects that are no objects): path, hops, weight.

    The walk ends when no path can grow. max_hops cuts nothing: a path that would grow beyond it is an error.
    """
    step = cut(pairs.select(F.col("subject_id").alias("s"), F.col("object_id").alias("t"), F.col("weight").alias("w")))
    roots = step.select("s").distinct().join(step.select(F.col("t").alias("s")).distinct(), "s", "left_anti")
    frontier = roots.join(step, "s").where("s <> t").select(F.array("s", "t").alias("path"), F.col("w").alias("weight"), F.col("t").alias("end"))
    done = frontier.select("path", (F.size("path") - 1).alias("hops"), "weight").limit(0)
    hops = 1
    while not frontier.isEmpty():
        met = cut(frontier.join(step, (F.col("end") == F.col("s")) & ~F.array_contains("path", F.col("t")), "left"))
        if hops > 1:
            done = done.unionByName(met.where("t is null").select("path", (F.size("path") - 1).alias("hops"), "weight"))
        frontier = met.where("t is not null").select(F.concat("path", F.array("t")).alias("path"), (F.col("weight") * F.col("w")).alias("weight"), F.col("t").alias("end"))
        hops += 1
        if hops > max_hops and not frontier.isEmpty():
            raise RuntimeError(f"paths have more than {max_hops} hops")
    return done


def reachability(pairs: DataFrame, max_rounds: int = SAFETY) -> DataFrame:
    """(node, reached): nodes that can be reached from each subject; one on a cycle reaches itself.

    Semi-naive closure: each round joins only what the last one found, until nothing is new. If max_rounds do not suffice, that is an error.
    """
    step = cut(pairs.select(F.col("subject_id").alias("s"), F.col("object_id").alias("t")).distinct())
    known = cut(step.select(F.col("s").alias("a"), F.col("t").alias("b")))
    fresh = known
    for _ in range(max_rounds):
        more = fresh.join(step, fresh["b"] == step["s"]).select("a", F.col("t").alias("b")).distinct()
        fresh = cut(more.join(known, ["a", "b"], "left_anti"))
        if fresh.isEmpty():
            break
        known = cut(known.unionByName(fresh))
    else:
        raise RuntimeError(f"the closure did not settle in {max_rounds} rounds")
    return known.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("reached"))


def centrality(edges: DataFrame, reach: DataFrame | None = None) -> DataFrame:
    """Per subject: objects held, evidence, postures, hosts, the sum of the best weight of each pair, and with reach(node, reached) how many nodes it reaches."""
    best = edges.groupBy("subject_id", "object_id").agg(F.max("weight").alias("weight")).groupBy("subject_id").agg(F.count(F.lit(1)).alias("held"), F.sum("weight").alias("weight"))
    spread = edges.groupBy("subject_id").agg(F.count(F.lit(1)).alias("evidence"), F.count_distinct("evidentiary_posture").alias("postures"), F.count_distinct("host").alias("hosts"))
    made = best.join(spread, "subject_id")
    return made if reach is None else made.join(reach.select(F.col("node").alias("subject_id"), "reached"), "subject_id", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))


def persistence(edges: DataFrame) -> DataFrame:
    """Relationships in two documents or more: first and last date, dated rows, postures in order."""
    grouped = edges.groupBy("subject_id", "assertion", "object_id").agg(
        F.count_distinct("source_sha256").alias("docs"), F.min("source_date").alias("first_date"), F.max("source_date").alias("last_date"), F.count("source_date").alias("n_dated"), F.array_join(F.array_sort(F.collect_set("evidentiary_posture")), ",").alias("postures"),
        F.array_join(F.array_sort(F.collect_set("host")), ",").alias("families"),
    )
    return grouped.where("docs >= 2")


def claims(edges: DataFrame) -> DataFrame:
    """(object_id, subject_id, source_sha256, source_date): a subject claims an object once for each document, at its earliest date."""
    return edges.where(F.col("assertion").isin(*CLAIMS)).groupBy("object_id", "subject_id", "source_sha256").agg(F.min("source_date").alias("source_date"))


def competing_claims(edges: DataFrame) -> DataFrame:
    """Objects that two subjects or more claim in two documents or more: how many of each, the number of claims, the date and subject of the first. claims() has the claims themselves."""
    made = claims(edges)
    grouped = made.groupBy("object_id").agg(F.count_distinct("subject_id").alias("subjects"), F.count_distinct("source_sha256").alias("docs"), F.count(F.lit(1)).alias("n_claims"), F.min(F.struct("source_date", "subject_id")).alias("first"))
    return grouped.where("subjects >= 2 and docs >= 2").select("object_id", "subjects", "docs", "n_claims", F.col("first.source_date").alias("first_date"), F.col("first.subject_id").alias("first_subject"))


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("subject_id", "object_id")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def spelling_vote(names: DataFrame) -> DataFrame:
    """names(key, spelling) to the most frequent, then longest, then first spelling, and the others in order."""
    counts = names.groupBy("key", "spelling").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((-F.col("n")).alias("a"), (-F.length("spelling")).alias("b"), F.col("spelling").alias("spelling"))
    voted = counts.groupBy("key").agg(F.min(rank).alias("best"), F.collect_list("spelling").alias("all"))
    return voted.select("key", F.col("best.spelling").alias("canonical"), F.array_sort(F.array_except("all", F.array("best.spelling"))).alias("variants"))


def prefix_pairs(names: DataFrame) -> DataFrame:
    """Keys of which one is a proper token prefix (two tokens or more) of the other: all prefixes are made and equi-joined."""
    rows = names.select("key").distinct().withColumn("tokens", F.split("key", " "))
    prefixes = rows.where(F.size("tokens") > 2).select(F.col("key").alias("longer"), F.explode(F.transform(F.sequence(F.lit(2), F.size("tokens") - 1), lambda n: F.array_join(F.slice("tokens", F.lit(1), n), " "))).alias("shorter"))
    return prefixes.join(rows.select(F.col("key").alias("shorter")), "shorter").select("shorter", "longer")


def stem(key: Column) -> Column:
    """The key without legal suffixes at its end, if two tokens stay; else null."""
    bare = F.regexp_replace(key, rf"( (?:{'|'.join(SUFFIX_WORDS)}))+$", "")
    return F.when((bare != key) & (F.size(F.split(bare, " ")) >= 2), bare).when(F.size(F.split(key, " ")) >= 2, key)


def suffix_pairs(names: DataFrame) -> DataFrame:
    """Different keys with the same stem, the lesser first."""
    rows = names.select("key").distinct().withColumn("stem", stem(F.col("key"))).where("stem is not null")
    other = rows.select(F.col("key").alias("b"), "stem")
    return rows.withColumnRenamed("key", "a").join(other, "stem").where("a < b").select("stem", "a", "b")


def acronym_pairs(names: DataFrame) -> DataFrame:
    """A key of 2 to 5 letters and the names whose initials it spells."""
    rows = names.select("name", graph_key(F.col("name")).alias("key")).distinct()
    short = rows.where(F.col("key").rlike("^[a-z]{2,5}$")).select(F.col("key").alias("acronym")).distinct()
    full = rows.select(F.col("key").alias("full"), acronym(F.col("name")).alias("acronym")).where(F.size(F.split("full", " ")) > 1).distinct()
    return short.join(full, "acronym")


def surname_pairs(names: DataFrame) -> DataFrame:
    """Bare surnames and the names of two tokens or more that end in them."""
    rows = names.select("key").distinct().withColumn("tokens", F.split("key", " "))
    bare = rows.where(F.size("tokens") == 1).select(F.col("key").alias("surname"))
    full = rows.where(F.size("tokens") > 1).select(F.element_at("tokens", -1).alias("surname"), F.col("key").alias("full"))
    return bare.join(full, "surname")


def merged_ids(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """nodes(id) with the least id of their component as survivor; nodes without links survive themselves."""
    return nodes.join(components.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("survivor"))


def redirect(edges: DataFrame, survivors: DataFrame) -> DataFrame:
    """Edges with their ends replaced by survivors; self-loops go."""
    a = survivors.select(F.col("id").alias("subject_id"), F.col("survivor").alias("_s"))
    b = survivors.select(F.col("id").alias("object_id"), F.col("survivor").alias("_o"))
    moved = edges.join(a, "subject_id", "left").join(b, "object_id", "left").withColumns({"subject_id": F.coalesce("_s", "subject_id"), "object_id": F.coalesce("_o", "object_id")})
    return moved.drop("_s", "_o").where("subject_id <> object_id").select(*edges.columns)


def violations(edges: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """A row (row_id, rule) for each rule an edge breaks; edges needs row_id, evidence_class and ownership_percent too."""
    rules = {
        "missing_subject": F.coalesce("subject_id", F.lit("")) == "", "missing_object": F.coalesce("object_id", F.lit("")) == "",
        "unknown_assertion": ~F.coalesce("assertion", F.lit("")).isin(*ASSERTIONS), "unknown_posture": ~F.coalesce("evidentiary_posture", F.lit("")).isin(*POSTURE_WEIGHTS),
        "unknown_evidence_class": ~F.coalesce("evidence_class", F.lit("")).isin(*EVIDENCE_CLASSES), "owner_not_direct": (F.col("assertion") == "BENEFICIAL_OWNER") & (F.coalesce("evidence_class", F.lit("")) != "DIRECT"),
        "percent_range": ~F.col("ownership_percent").between(0, 100), "confidence_range": ~F.col("confidence").between(0, 1), "bad_date": ~F.col("source_date").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
        "self_loop": F.col("subject_id") == F.col("object_id"),
    }
    broken = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))
    out = edges.select("row_id", F.explode(broken).alias("rule"))
    if entities is not None and not entities.isEmpty():
        for end in ("subject_id", "object_id"):
            lost = edges.where(F.col(end).isNotNull()).join(entities.select(F.col("entity_id").alias(end)), end, "left_anti")
            out = out.unionByName(lost.select("row_id", F.lit(f"dangling_{end}").alias("rule")))
    return out


def checkpoint_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """old, new(relation, families, docs): ADDED, DROPPED, GAINED_FAMILY, MORE_DOCS or SAME for each relation; a gained family counts before more documents."""
    both = old.select("relation", F.col("families").alias("f0"), F.col("docs").alias("d0")).join(new.select("relation", F.col("families").alias("f1"), F.col("docs").alias("d1")), "relation", "full_outer")
    gained = F.size(F.array_except("f1", "f0")) > 0
    change = F.when(F.col("d0").isNull(), "ADDED").when(F.col("d1").isNull(), "DROPPED").when(gained, "GAINED_FAMILY").when(F.col("d1") > F.col("d0"), "MORE_DOCS").otherwise("SAME")
    return both.select("relation", change.alias("change"))


def joined_components(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per new component: how many old ones it joins beyond the first; both are (node, component)."""
    met = new.join(old.withColumnRenamed("component", "old_component"), "node")
    return met.groupBy("component").agg((F.count_distinct("old_component") - 1).alias("joins"))


def first_seen_duplicates(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """rows with is_duplicate: an equal key came before in order, which must tell the rows of a key apart. Nulls are keys like others. The first rows are grouped minima."""
    at = F.struct(*order)
    keyed = rows.withColumn("_key", F.struct(*key))
    firsts = keyed.groupBy("_key").agg(F.min(at).alias("_first"))
    met = keyed.alias("r").join(firsts.withColumnRenamed("_key", "_other"), F.col("_key").eqNullSafe(F.col("_other")))
    return met.withColumn("is_duplicate", ~at.eqNullSafe(F.col("_first"))).select(*rows.columns, "is_duplicate")


def chain_families(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """paths() with the hosts of its hops in order and whether they are of more than one family; pairs is collapse_pairs()."""
    hops = found.withColumn("_id", F.xxhash64("path")).select("_id", "path", F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("hop", "subject_id"))
    hops = hops.withColumn("object_id", F.element_at("path", F.col("hop") + 2)).join(pairs.select("subject_id", "object_id", "host"), ["subject_id", "object_id"])
    grouped = hops.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("hop", "host"))), lambda x: x["host"]).alias("families"))
    return found.join(grouped, "path").withColumn("cross_family", F.size(F.array_distinct("families")) > 1)


def alias_links(records: DataFrame, nodes: DataFrame) -> DataFrame:
    """Alias records(id, alias) to links (a, b, basis) with other nodes(id, kind, name) of the same kind whose key is that of the alias."""
    keyed = nodes.select("id", "kind", graph_key(F.col("name")).alias("key"))
    named = records.join(nodes.select("id", "kind"), "id").select(F.col("id").alias("a"), "kind", graph_key(F.col("alias")).alias("key"))
    return named.join(keyed.withColumnRenamed("id", "b"), ["kind", "key"]).where("a <> b and key <> ''").select("a", "b", F.concat(F.lit("alias:"), F.col("key")).alias("basis"))


def merge_typed(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes(id, kind) with survivor (the least id of the group), and on survivors merged_from and merge_basis in order. Links (a, b, basis) between kinds are no links."""
    kinds = nodes.select("id", "kind")
    same = links.join(kinds.withColumnRenamed("id", "a"), "a").join(kinds.select(F.col("id").alias("b"), F.col("kind").alias("_kind")), "b").where("kind = _kind")
    placed = merged_ids(nodes, connected_components(same.select("a", "b")))
    basis = same.join(placed.select(F.col("id").alias("a"), "survivor"), "a").groupBy("survivor").agg(F.array_sort(F.collect_set("basis")).alias("merge_basis"))
    gone = placed.where("id <> survivor").groupBy("survivor").agg(F.array_sort(F.collect_set("id")).alias("merged_from"))
    on = gone.join(basis, "survivor", "left").withColumnRenamed("survivor", "id")
    return nodes.join(placed, "id").join(on, "id", "left")


def rank_merge_candidates(pairs: DataFrame, central: DataFrame) -> DataFrame:
    """pairs(a, b) of which one at least is central, by the greater weight of the two, then a and b: place 1 on."""
    weight = lambda side: central.select(F.col("subject_id").alias(side), F.col("weight").alias(f"_{side}"))
    worth = pairs.join(weight("a"), "a", "left").join(weight("b"), "b", "left").select("a", "b", F.greatest(F.coalesce("_a", F.lit(0.0)), F.coalesce("_b", F.lit(0.0))).alias("weight"))
    return worth.where("weight > 0").orderBy(F.desc("weight"), "a", "b")


def named_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges with the names of both ends from nodes(id, name), the id where there is none."""
    a, b = nodes.select(F.col("id").alias("subject_id"), F.col("name").alias("_s")), nodes.select(F.col("id").alias("object_id"), F.col("name").alias("_o"))
    made = edges.join(a, "subject_id", "left").join(b, "object_id", "left")
    return made.withColumns({"subject_name": F.coalesce("_s", "subject_id"), "object_name": F.coalesce("_o", "object_id")}).drop("_s", "_o")


def new_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Names of nodes(kind, name) that are new, counted by kind."""
    return new.select("kind", "name").distinct().join(old.select("kind", "name").distinct(), ["kind", "name"], "left_anti").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
