import random
import re

import pytest

from veritrail.functions import lexicon
from veritrail.operators import corpus, evidence
from veritrail.plans import corpus_queries
from veritrail.sources import readers, sinks
from veritrail.streaming import incremental

TEXT = "😀 Intro line.\n\nAcme Widgets LLC is owned by John Smith. Blue Harbor Ltd was a shell company. The wire\ttransfer went on.\n\n\fJane Doe transferred $1,200,000 to Gray Stone Inc. Nominee owners hold 25% of shares.\n"


def texts(spark, rows):
    return spark.createDataFrame(rows, "id long, host string, text string")


def test_locators_reproduce_matches(spark):
    t = texts(spark, [(1, "h", TEXT), (2, "h", ""), (3, "h", "shell company " * 60)]).select("id", "text")
    found = corpus.spans(t)
    checked = corpus.locators_hold(found, t).collect()
    assert checked and all(r.holds for r in checked)
    assert {"OWNERSHIP_EXPLICIT", "SHELL_NOMINEE", "FINANCIAL_FLOW"} <= {r.category for r in checked if r.id == 1}
    groups = {r.term: list(r.matched_groups) for r in checked if r.category == "STRUCTURED" and r.id == 1}
    assert groups["entity_owned_by"][0] == "Acme Widgets LLC" and groups["entity_owned_by"][1].startswith("John Smith")
    third = [r for r in checked if r.id == 3]
    assert len(third) == 40 and {r.overflow for r in third} == {20} and sorted(r.seq for r in third) == list(range(40))


#: A text for each pattern that it finds, and what it finds there.
EXAMPLES = {
    "beneficial_owner": "a Beneficially owned firm", "owned_by": "OWNED and operated by", "owns_stake": "owns, with others, ten shares", "pct_ownership": "25% of the issued voting stock", "ownership_interest": "membership interests", "sole_majority_owner": "co-owner", "shareholder_of": "managing members of",
    "owner_of": "owners of the small Acme Inc", "controlled_by": "controlled\tby", "under_control": "under the control of", "exercises_control": "exercising significant control", "substantial_control": "substantial control", "controlling_person": "controlling stockholders", "controls_entity": "control over the three entities",
    "wholly_owned_sub": "wholly-owned subsidiaries", "subsidiary_of": "subsidiary of", "subsidiary": "subsidiaries", "parent_co": "parent bank", "holding_co": "holding companies", "affiliate": "affiliated, it says, with", "dba_fka": "f/k/a", "shell": "shell corporations", "front_co": "front businesses", "nominee": "nominee director", "straw": "straw buyers",
    "spv": "an SPV", "shelf_co": "shelf company", "alter_ego": "Alter Ego", "intermediary_layer": "layered through", "registered_agent": "registered agents", "managing_member": "sole member", "organizer": "incorporators", "officer_of": "CEO and owner of the old Acme Bank", "member_manager_llc": "manager of the LLC", "trustee_settlor": "settlors",
    "signatory": "authorized signer", "on_behalf": "on behalf of", "wire_transfer": "wired", "transferred_amt": "transferred about $ 5,000", "dollar_flow": "$12,000 went through", "bank_account": "account ending", "proceeds": "illicit proceeds were laundered", "funnel": "funnel accounts", "payment_to": "payments to Acme Inc", "beneficiary_recipient": "payee of the account",
    "sar": "SARs", "bsa": "the BSA", "aml": "anti-money laundering", "ctr": "CTR", "money_laundering": "laundered", "structuring": "structured cash deposits", "gto": "geographic targeting order", "314": "314(b)", "boi": "BOI", "cta": "Corporate Transparency Act", "boss": "BOSS", "boi_rule": "BOI reporting", "reporting_company": "reporting companies",
    "company_applicant": "company applicant", "fincen_id": "FinCEN identifier", "cta_cite": "31 U.S.C. 5336", "access_rule": "access rule", "formation_docs": "certificate of formation", "incorporated_in": "organized under", "dissolution": "wound up", "merger": "merged quietly into", "acquired": "acquired, in part, by",
    "person_role_entity": "Ann Lee, the president of Acme Corp", "entity_owned_by": "Acme LLC is owned by Ann Lee", "entity_subsidiary_of": "Acme Two is a wholly-owned subsidiary of Beta Group", "pct_of_entity": "30 percent of the equity of Beta",
}
#: Texts in which a pattern that minds its case finds nothing, or that lack a part.
COUNTER = {"sar": "sars", "bsa": "the bsa", "ctr": "ctr", "boi": "boi", "boss": "boss", "spv": "an spv", "aml": "aml", "owned_by": "owned hereby", "controls_entity": "Office of Foreign Assets Control", "314": "314", "cta_cite": "31 U.S.C. 5335"}


@pytest.mark.parametrize("name", [n for _, n, _ in lexicon.span_patterns()])
def test_each_pattern_finds_its_example(name):
    pattern = next(p for _, n, p in lexicon.span_patterns() if n == name)
    assert pattern.search(f"x {EXAMPLES[name]} y") and re.search(lexicon.SPAN_HINT, f"x {EXAMPLES[name]} y")
    assert name not in COUNTER or not pattern.search(f"x {COUNTER[name]} y")


#: A text of each grammar with its subject, object and confidence.
SENTENCES = {
    "owned_by": ("Gamma Corp. is owned by John Smith", "John Smith", "Gamma Corp", 0.9), "owns_pct_of": ("John Smith owns 25% of the shares of Beta Corp.", "John Smith", "Beta Corp", 0.9), "pct_interest_in": ("John Smith held a 30 percent ownership interest in Beta LLC", "John Smith", "Beta LLC", 0.9), "owner_of": ("John Smith is the sole owner of Beta LLC", "John Smith", "Beta LLC", 0.9),
    "owner_of_appositive": ("Forrest, the majority owner of Beta LLC", "Forrest", "Beta LLC", 0.9), "founder_sole_owner": ("John Smith was the founder and sole shareholder of Beta LLC", "John Smith", "Beta LLC", 0.9), "beneficial_owner_of": ("Alpha Inc. became the beneficial owner of Beta LLC", "Alpha Inc", "Beta LLC", 0.9), "holds_shares_of": ("Alpha Inc. holds 10% of the shares", "Alpha Inc", None, 0.55),
    "controlled_by": ("The Bank is controlled by Delta Holdings", "Delta Holdings", "The Bank", 0.55), "designation_controller": ("designated today for being owned or controlled by Delta Holdings", "Delta Holdings", None, 0.55), "controls": ("John Smith controls Beta LLC", "John Smith", "Beta LLC", 0.9), "controlling_person_of": ("John Smith is a controlling shareholder of Beta LLC", "John Smith", "Beta LLC", 0.9),
    "exercises_control": ("John Smith exercised complete control over Beta LLC", "John Smith", "Beta LLC", 0.9), "subsidiary_of": ("Alpha Inc. is a wholly-owned subsidiary of Omega Group", "Omega Group", "Alpha Inc", 0.9), "subsidiary_of_appositive": ("Alpha Inc., an indirect subsidiary of Omega Group", "Omega Group", "Alpha Inc", 0.9), "parent_of": ("Omega Group is the parent company of Alpha Inc.", "Omega Group", "Alpha Inc", 0.9),
    "holding_company_of": ("Omega Group became the bank holding company for Alpha Bank", "Omega Group", "Alpha Bank", 0.9), "affiliate_of": ("Omega Group is an affiliate of Alpha Bank", "Omega Group", "Alpha Bank", 0.9), "alias_of": ("John Smith d/b/a Smith Cars", "John Smith", "Smith Cars", 0.9), "its_subsidiary": ("Omega Group and its subsidiary Alpha Bank", "Omega Group", "Alpha Bank", 0.9),
    "operates_through_sub": ("Omega Group operates through Alpha Bank, its wholly owned subsidiary", "Omega Group", "Alpha Bank", 0.9), "shell_named": ("Beta LLC was merely a shell company", None, "Beta LLC", 0.55), "used_shells": ("John Smith formed Beta LLC as a conduit", "John Smith", "Beta LLC", 0.9), "nominee_for": ("John Smith acted as a nominee for Beta LLC", "John Smith", "Beta LLC", 0.9),
    "transferred_to": ("John Smith wired $5,000 that day to Beta LLC", "John Smith", "Beta LLC", 0.9), "received_from": ("Beta LLC received about $7,000 from John Smith", "John Smith", "Beta LLC", 0.9), "wire_from_to": ("a wire transfer of $9,000 from John Smith to Beta LLC", "John Smith", "Beta LLC", 0.9),
}


def test_each_grammar(spark):
    rows = list(enumerate(SENTENCES.items()))
    t = spark.createDataFrame([(k, f"{s}. More.") for k, (_, (s, *_)) in rows], "id long, text string")
    spans = spark.createDataFrame([(k, 0, len(s)) for k, (_, (s, *_)) in rows], "id long, character_start int, character_end int")
    got = {r.id: (r.predicate_raw, r.subject_raw, r.object_raw, r.extraction_confidence) for r in evidence.observe(spans, t).collect()}
    assert got == {k: (name, *want) for k, (name, (_, *want)) in rows}


def test_designations_are_resolved_in_their_own_clause(spark):
    text = "Today, Beta Trading LLC, based in Malta, is being designated pursuant to an order for being owned or controlled by John Smith. Also, John Smith, and Gamma LLC are designated for being owned or controlled by John Smith."
    at = text.index("designated pursuant")
    o = spark.createDataFrame([(1, "designation_controller", "John Smith", None, at, at + 85, 0.55), (1, "designation_controller", "Other Man", None, at, at + 85, 0.55), (1, "controls", "A", "B", 0, 1, 0.9)], "id long, predicate_raw string, subject_raw string, object_raw string, character_start int, character_end int, extraction_confidence double")
    got = sorted((r.subject_raw, str(r.object_raw), r.extraction_confidence, str(r.resolution)) for r in evidence.resolve_designations(o, texts(spark, [(1, "h", text)])).collect())
    assert got == [("A", "B", 0.9, "None"), ("John Smith", "Beta Trading LLC", 0.7, "designation-window"), ("Other Man", "None", 0.55, "None")]


def test_routing_of_observations(spark):
    schema = "observation_id string, id long, predicate_raw string, subject_raw string, object_raw string, percentage_raw string, raw_text string, extraction_confidence double"
    rows = [
        ("o1", 1, "owned_by", "Lucas, Nunns and McNaul", "Beta LLC", "125", "x", 0.9), ("o2", 1, "controlled_by", "John Smith", "Beta LLC", None, "owned or controlled by", 0.9), ("o3", 1, "controls", "John Smith", "Beta LLC", "5", "controls", 0.9), ("o4", 1, "parent_of", "A Group", "the Bank", None, "", 0.9),
        ("o5", 1, "owned_by", "John Smith", "Beta LLC", None, "", 0.55), ("o6", 1, "holds_shares_of", "John Smith", None, "5", "", 0.9), ("o7", 1, "received_from", "a", "b", None, "", 0.9), ("o8", 1, "affiliate_of", "Beta Company", "Beta Co", None, "", 0.9), ("o9", 1, "alias_of", "John Smith", "Smith Cars", None, "John Smith f/k/a Smith Cars", 0.9),
    ]
    o = spark.createDataFrame(rows, schema)
    edges, unresolved = evidence.build_edges(o)
    assert sorted((r.observation_id, r.assertion, r.ownership_percent) for r in edges.collect()) == [("o1", "BENEFICIAL_OWNER", 100.0)] * 3 + [("o2", "BENEFICIAL_OWNER", None), ("o3", "UNKNOWN_CONTROL_ROLE", 5.0)]
    reasons = {r.observation_id: r.reason.split(";")[0].split(" (")[0] for r in unresolved.collect()}
    assert reasons == {"o4": "document-generic reference", "o5": "sub-threshold extraction confidence", "o6": "counterparty not in sentence window", "o7": "out of scope", "o8": "subject and object are one party"}
    assert [tuple(r) for r in evidence.alias_records(o).collect()] == [("John Smith", "Smith Cars", "FORMER", "person")]


def test_defined_terms_raise_confidence(spark):
    o = spark.createDataFrame([(1, "o", "the Bank", "Acme LLC", 0.55), (2, "p", "the Bank", "Acme LLC", 0.55)], "id long, observation_id string, subject_raw string, object_raw string, extraction_confidence double")
    terms = spark.createDataFrame([(1, "bank", "First Bank of X")], "id long, term_key string, full string")
    got = {r.id: (r.subject_raw, r.subject_as_stated, r.resolution, r.extraction_confidence) for r in evidence.resolve_terms(o, terms).collect()}
    assert got == {1: ("First Bank of X", "the Bank", "defined-term", 0.75), 2: ("the Bank", None, None, 0.55)}


def test_groups_are_numbered(spark):
    g = spark.createDataFrame([(1, 1), (2, 1), (9, 5), (5, 5)], "id long, group long")
    assert sorted((r.group_id, r.id, r.n) for r in corpus.numbered_groups(g).collect()) == [("ndg-00001", 1, 2), ("ndg-00001", 2, 2), ("ndg-00002", 5, 2), ("ndg-00002", 9, 2)]


def test_observations_terms_and_edges(spark):
    t = texts(spark, [(1, "h", TEXT), (2, "h", 'Big Holding Corporation (the "Company") is the owner of Little Shop LLC. It is controlled by them.')]).select("id", "text")
    found = evidence.observe(corpus.spans(t), t)
    rows = {(r.id, r.predicate_raw): r for r in found.collect()}
    own = next(r for r in found.collect() if r.predicate_raw == "owned_by" and r.subject_raw == "John Smith")
    assert (own.subject_raw, own.object_raw, own.extraction_confidence) == ("John Smith", "Acme Widgets LLC", 0.9) and TEXT[own.character_start : own.character_end] == own.raw_text
    assert rows[1, "shell_named"].object_raw.startswith("Blue Harbor Ltd") and rows[1, "transferred_to"].amount_raw == "1,200,000"
    terms = {(r.id, r.term_key): r.full for r in evidence.defined_terms(t).collect()}
    assert terms == {(2, "co"): "Big Holding Corporation"}
    edges, unresolved = evidence.build_edges(found)
    assert "BENEFICIAL_OWNER" in {r.assertion for r in edges.collect()} and "out of scope" in {r.reason for r in unresolved.collect()}


def test_boilerplate_and_near_copies(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(500)]
    rows = [(i, "a", "Copyright notice of this site\n" + " ".join(rng.choice(words) for _ in range(30))) for i in range(30)]
    model = corpus.boilerplate(texts(spark, rows))
    assert [(r.line_key, r.docs) for r in model.collect()] == [("copyright notice of this site", 30)]
    left = corpus.suppressed(texts(spark, rows), model).collect()
    assert all("Copyright" not in r.searchable and r.searchable for r in left)
    base = [rng.choice(words) for _ in range(600)]
    near = base[:300] + ["changed"] + base[301:]
    rows = [(1, "a", " ".join(base)), (2, "a", " ".join(base)), (3, "a", " ".join(near)), (4, "a", " ".join(rng.choice(words) for _ in range(600))), (5, "a", "short")]
    for order in (rows, rows[::-1]):
        assert {r.id: r.group for r in corpus.near_duplicates(texts(spark, order)).collect()} == {1: 1, 2: 1, 3: 1}


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(corpus, "MAX_BUCKET", 2)
    rng = random.Random(6)
    words = [f"word{i}" for i in range(3000)]
    base, rows = [rng.choice(words) for _ in range(600)], []
    for i in range(260):
        if i % 40 == 0:  # the family drifts, so that no one text is like all others
            for _ in range(6):
                base[rng.randrange(600)] = rng.choice(words)
        text = list(base)
        text[rng.randrange(600)] = f"own{i}"
        rows.append((i, "a", " ".join(text)))
    t = texts(spark, rows)
    made = {r.id: frozenset(r.sketch) for r in corpus.sketches(t).collect()}
    bands = {r.id: {(k, tuple(r.sketch[4 * k : 4 * k + 4])) for k in range(16)} for r in corpus.sketches(t).collect()}
    root = {i: i for i in made}
    for a in made:
        for b in made:
            if a < b and bands[a] & bands[b] and len(made[a] & made[b]) >= 0.85 * len(made[a] | made[b]):
                x, y = a, b
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
    want = {}
    for i in made:
        x = i
        while root[x] != x:
            x = root[x]
        want[i] = x
    sizes = [list(want.values()).count(g) for g in want.values()]
    linked = {i: g for (i, g), n in zip(want.items(), sizes, strict=True) if n > 1}
    assert len(linked) > 200
    assert {r.id: r.group for r in corpus.near_duplicates(t).collect()} == linked


def test_repeated_lines_of_a_host_give_no_class(spark, tmp_path):
    rows = [(i, "wire transfer instructions of this site\n" + ("a wire transfer" if i == 3 else f"other text {i}"), "a") for i in range(25)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["class"]: r.n for r in corpus_queries.document_classes(spark, str(tmp_path)).collect()} == {"WIRE_TRANSFER": 1, "FINANCIAL_TRANSACTION": 1, "UNCLASSIFIED": 24}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"url": "a", "n": 1}\n{broken\n{"url": "b", "n": null}\n')
    path = str(tmp_path / "log.jsonl")
    assert readers.json_log(spark, path, "url string, n int").count() == 2
    assert readers.json_log(spark, path, "url string, n int", "keep").where("_corrupt is not null").count() == 1
    assert readers.json_log_or_empty(spark, str(tmp_path / "none.jsonl"), "url string").count() == 0
    assert [r.text for r in readers.malformed(spark, path).collect()] == ["{broken"]
    (tmp_path / "seeds.txt").write_text("# c\n\nhttps://a|P|S|x\nhttps://b\n")
    assert [tuple(r) for r in readers.seeds(spark, str(tmp_path / "seeds.txt")).orderBy("url").collect()] == [("https://a", "P", "S|x"), ("https://b", "UNCLASSIFIED", None)]
    assert readers.links_of('<a href="/x#f">1</a><a href="https://o.example/y z">2</a><a href="mailto:q">3</a><a href="/x">4</a>', "https://a.example/p") == ["https://a.example/x", "https://o.example/y%20z"]
    stored = spark.createDataFrame([("1", "text/html", bytearray(b"<p>a</p><script>n</script>b")), ("2", "application/json", bytearray(b'{"b":1,"a":2}')), ("3", "application/json", bytearray(b"{")), ("4", "image/png", bytearray(b"x")), ("5", "application/xml", bytearray(b"<a> x <b>y</b></a>"))], "sha256 string, mime string, content binary")
    assert {r.sha256: (r.status, r.text) for r in readers.extract_texts(stored).collect()} == {"1": ("OK", "a\nb"), "2": ("OK", '{\n "a": 2,\n "b": 1\n}'), "3": ("ERROR", "JSONDecodeError"), "4": ("UNSUPPORTED", ""), "5": ("OK", "x y")}
    rows = spark.createDataFrame([("u2", "P", "s", 1), ("u1", "P", "s", 1), ("u3", "P", "s", 9)], "url string, provenance string, source string, priority int")
    sinks.write_seeds(rows, str(tmp_path / "out"), 2)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["u3|P|s", "u1|P|s"]
    sinks.append_log(rows, str(tmp_path / "log"))
    sinks.append_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 6


def test_stream_ledger_takes_late_rows(spark, tmp_path):
    schema = "url string, retrieved_at string, seq long, sha256 string, http_status int"
    batches = [[("u", "2026-01-02", 2, "B", 200)], [("u", "2026-01-01", 1, "A", 200), ("v", "2026-01-01", 3, None, 500)], [("u", "2026-01-03", 4, None, 404)]]
    out = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = incremental.stream_ledger(spark.readStream.schema(schema).json(str(tmp_path / "in")))
        stream.writeStream.outputMode("update").foreachBatch(lambda b, n: out.append({r.url: (r.change_type, r.previous_sha256, r.current_sha256) for r in b.collect()})).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert out == [{"u": ("ADDED", None, "B")}, {"u": ("MODIFIED", "A", "B"), "v": ("UNAVAILABLE", None, None)}, {"u": ("REMOVED", "B", None)}]


def test_entry_registers_names_once():
    import __spark_entry__ as entry

    names, oracles = entry.queries(), entry.oracle_sql()
    assert len(names) >= 40 and set(oracles) <= set(names)


def test_candidate_spans_are_those_of_the_sql(spark, tmp_path):
    """Repeated ids, null texts, texts with terms of their own (more than a category keeps), ids below zero and none."""
    duckdb = pytest.importorskip("duckdb")
    own = "Ann Lee, owner of Acme LLC. A shell company of a subsidiary, controlled by a SAR on a wire transfer."
    rows = [(i, t) for i in (0, 1, 2, 3, 4, 5) for t in ("one\ntwo", "one\ntwo", "é \U0001f600", "", None, own, "\n".join([own] * 45))]
    rows += [(-1, "a"), (-2, "b"), (-5, "c"), (None, "d"), (7 + 5 * 10**17, "e")]
    spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(r) for r in corpus_queries.candidate_spans(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(map(repr, found)) == sorted(map(repr, con.execute(corpus_queries.ORACLES["candidate_spans"]).fetchall())) and len(found) > 60
