"""Structured observations: sentence windows, grammars, defined terms, gates, edges, citations, harvested names.

Text is read in Arrow batches, a document at a time with all that is looked for in it; decisions are columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.functions import lexicon
from veritrail.functions.scalars import graph_key, registry_key, short_id, term_key
from veritrail.session import cut, ship_package

OBSERVATION = (
    "id long, tier string, predicate_raw string, subject_raw string, object_raw string, percentage_raw string, qualifier_raw string, amount_raw string, date_raw string, role_raw string, character_start int, character_end int, "
    "raw_text string, extraction_confidence double"
)
QUOTED = re.compile(r"([A-Z][\w&.,'’ -]{3,80}?),?\s*\((?:the|hereinafter)?\s*[\"“]([A-Z][\w&. -]{1,40})[\"”]\)")
SHORT = re.compile(r"((?:[A-Z][\w&'’-]*\s+(?:of\s+|and\s+|the\s+)?){2,8})\(([A-Z]{2,6})\)")
# Dates and roles in a sentence, names that only the document itself explains, words before a party in a caption.
DATE = re.compile(r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+(?:19|20)\d{2}\b|\bin\s+(?:(?:19|20)\d{2})\b")
ROLE = re.compile(r"\b(president|chief executive officer|CEO|chief financial officer|CFO|chairman|secretary|treasurer|director|officer|founder|managing member|sole member|manager|general partner|principal)\b", re.I)
GENERIC = re.compile(r"^(?:the\s+)?(?:proposed\s+)?(?:bank|company|corporation|trust|venture|fund|association|partnership|firm|institution)$", re.I)
CAPTION = re.compile(r"^(?:defendants?|plaintiffs?|relief\s+defendants?|respondents?)\s+", re.I)
#: A sentence is no wider, and is looked for no further.
WIDEST, BEYOND = 900, 400
SENTENCE_ENDS = (". ", "\n\n", "? ", "! ")


def sentence(text: str, start: int, end: int) -> tuple[int, int]:
    """Bounds of the sentence around a match."""
    before = [text.rfind(e, 0, start) for e in SENTENCE_ENDS]
    left = max(before) + 2 if max(before) >= 0 else 0
    after = [at for e in SENTENCE_ENDS if (at := text.find(e, end)) >= 0]
    right = min(after) + 1 if after else min(len(text), end + BEYOND)
    return (max(left, start - WIDEST // 2), min(right, end + WIDEST // 2)) if right - left > WIDEST else (left, right)


def clean_name(name: str | None) -> str | None:
    """White space collapsed, punctuation at the ends and a caption's role before the name dropped; None if nothing stays."""
    return CAPTION.sub("", re.sub(r"\s+", " ", name).strip(" ,;:.")) or None if name else None


def observe(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """spans(id, character_start, character_end) and texts(id, text): of each span's sentence the first grammar that matches; equal ones give one row.

    Confidence is 0.9 with both parties, 0.55 with one or with one that only the document explains. Spans of a document travel together, so its text is read once.
    """
    ship_package(spans.sparkSession)
    per_text = spans.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("character_start", "character_end"))).alias("spans")).join(texts.select("id", "text"), "id")
    names = [c.split()[0] for c in OBSERVATION.split(", ")]

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammars = lexicon.grammar_patterns()
        for batch in batches:
            out = []
            for id_, found, text in zip(batch["id"], batch["spans"], batch["text"], strict=True):
                seen = set()
                for s in found:
                    left, right = sentence(text, s["character_start"], s["character_end"])
                    if (left, right) in seen:
                        continue
                    seen.add((left, right))
                    words = text[left:right]
                    for tier, predicate, pattern in grammars:
                        m = pattern.search(words)
                        if m:
                            g = m.groupdict()
                            amount = " ".join(x for x in (g.get("amount"), g.get("scale")) if x) or None
                            parties = clean_name(g.get("subject")), clean_name(g.get("object"))
                            sure = all(parties) and not any(GENERIC.match(p) for p in parties)
                            when, role = DATE.search(words), ROLE.search(words)
                            out.append((id_, tier, predicate, *parties, g.get("percentage"), clean_name(g.get("qualifier")), amount, when and when[0], role and role[0], left + m.start(), left + m.end(), m[0], 0.9 if sure else 0.55))
                            break
            yield pd.DataFrame(out, columns=names)

    found = per_text.mapInPandas(match, OBSERVATION).dropDuplicates(["id", "tier", "predicate_raw", "character_start", "character_end"])
    return numbered(found)


def numbered(observations: DataFrame) -> DataFrame:
    """With observation_id: obs:, the document and its number there, by tier and place."""
    turn = F.row_number().over(Window.partitionBy("id").orderBy("tier", "character_start", "character_end", "predicate_raw"))
    return observations.select(F.format_string("obs:%d:%04d", F.col("id"), turn).alias("observation_id"), "*")


def sequence_ids(rows: DataFrame, prefix: str, order: str) -> DataFrame:
    """With sequence_id, prefix and a number of five digits in order, 1 on. order must tell rows apart. Ranges are numbered side by side; one task adds up their sizes only."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(rows.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return dealt.join(F.broadcast(before), "_part").select(*rows.columns, F.format_string(f"{prefix}:%05d", number).alias("sequence_id"))


def defined_terms(texts: DataFrame) -> DataFrame:
    """(id, term_key, full): names that a text defines in quotes or as an acronym; terms with two meanings in a text are dropped."""
    ship_package(texts.sparkSession)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                out += [(id_, m[2], m[1].strip(" ,")) for m in QUOTED.finditer(text)]
                for m in SHORT.finditer(text):
                    words = m[1].split()
                    for k in range(len(words) - 1, -1, -1):  # the shortest tail whose initials spell it
                        if "".join(w[0] for w in words[k:] if w[0].isupper()) == m[2]:
                            out.append((id_, m[2], " ".join(words[k:])))
                            break
            yield pd.DataFrame(out, columns=["id", "term", "full"])

    found = texts.select("id", "text").where(F.col("text").contains("(")).mapInPandas(find, "id long, term string, full string").where(name_like(F.col("full"))).withColumn("term_key", term_key(F.col("term")))
    grouped = found.groupBy("id", "term_key").agg(F.count_distinct(term_key(F.col("full"))).alias("meanings"), F.min("full").alias("full"))
    return grouped.where("meanings = 1 and term_key <> ''").select("id", "term_key", "full")


def name_like(name: Column) -> Column:
    """Eight words at most, and six in ten of them (small words aside) begin with a capital or a digit."""
    words = F.filter(F.split(F.trim(F.coalesce(name, F.lit(""))), r"\s+"), lambda w: (w != "") & ~w.isin("of", "the", "and", "for", "de", "&"))
    capital = F.filter(words, lambda w: w.rlike(r"^[\p{Lu}0-9]"))
    return (F.size(words) > 0) & (F.size(F.split(F.trim(name), r"\s+")) <= 8) & (F.size(capital) >= 0.6 * F.size(words))


def resolve_terms(observations: DataFrame, terms: DataFrame) -> DataFrame:
    """Subject and object replaced by what the same document defines them as; the wording stays in _as_stated. resolution is defined-term if one was, confidence then 0.75 at least."""
    out, stated = observations, F.lit(False)
    for slot in ("subject", "object"):
        raw = f"{slot}_raw"
        t = terms.select(F.col("id").alias("_id"), F.col("term_key").alias("_key"), F.col("full").alias("_full"))
        out = out.join(t, (F.col("id") == F.col("_id")) & (graph_key(F.coalesce(sanitize(F.col(raw)), F.col(raw))) == F.col("_key")), "left")
        found = F.col("_full").isNotNull() & (graph_key(F.col("_full")) != graph_key(F.col(raw)))
        out = out.withColumn(f"{slot}_as_stated", F.when(found, F.col(raw))).withColumn(raw, F.when(found, F.col("_full")).otherwise(F.col(raw))).drop("_id", "_key", "_full")
        stated = stated | F.col(f"{slot}_as_stated").isNotNull()
    return out.withColumn("resolution", F.when(stated, "defined-term")).withColumn("extraction_confidence", F.when(stated, F.greatest("extraction_confidence", F.lit(0.75))).otherwise(F.col("extraction_confidence")))


# What a captured name may carry of the sentence before it, in the order in which it is cut off.
GLUE = (
    (r"^.*(?<=[a-z]{2})\.\s+(?=[A-Z])", ""), (r"^.*(?<=[a-z])\.\d+\s+", ""), (r"(?i)^(?:pursuant\s+to|according\s+to|in\s+re|the)\s+", ""), (r"^[A-Z][a-z]+(?:\s[A-Z][a-z]+)?-based\s+", ""),
    (r"^(?:(?:SCHEDULE|FORM|EXHIBIT|ITEM|Exhibit|Item|Amendment)\s+[\w./-]{1,10}\s+)+", ""),
)


def sanitize(name: Column) -> Column:
    """The name without what came with it; null if nothing stays."""
    out = name
    for pattern, by in GLUE:
        out = F.regexp_replace(out, pattern, by)
    return F.nullif(F.btrim(out, F.lit(" ,;:.")), F.lit(""))


# Names that are no parties.
STATES = (
    "alabama alaska arizona arkansas california colorado connecticut delaware florida georgia hawaii idaho illinois indiana iowa kansas kentucky louisiana maine maryland massachusetts michigan minnesota mississippi missouri montana nebraska nevada ohio "
    "oklahoma oregon pennsylvania tennessee texas utah vermont virginia washington wisconsin wyoming"
).split()
STATES_OF_TWO_WORDS = ("new york", "new jersey", "new mexico", "new hampshire", "north carolina", "north dakota", "south carolina", "south dakota", "rhode island", "west virginia")
STOP_NAMES = (
    *STATES, "united states", "united states of america", "america", "congress", "treasury", "government", "state", "states", "piano", "artwork", "occ", "fdic", "sec", "fincen", "ncua", "cfpb", "irs", "fbi", "doj", "federal reserve",
    "comptroller of the currency", "asian americans", "african americans", "native americans", "hispanic americans", "women", "minorities", "veterans", "british virgin islands", "virgin islands", "cayman islands", "hong kong", "jersey", "spa", "hotel", "resort",
    "casino",
)
BARE_WORDS = (
    "limited", "ltd", "inc", "llc", "corp", "corporation", "company", "co", "holdings", "holding", "group", "bank", "fund", "association", "partners", "partnership", "trust", "savings", "national", "federal", "commercial", "banking", "state",
)
GENERIC_NAME = (
    r"(?i)^(?:(?:the|this|that|such)\s+)?(?:proposed\s+)?(?:bank|company|corporation|trust|venture|fund|association|partnership|firm|institution|account|defendants?|issuer|borrower|lender|guarantor|purchaser|seller|acquirer|depositor|servicer|sponsor"
    r"|registrant|reporting\s+person)$"
)
GENERIC_TAIL = r"(?i)\b(?:the|this|that)\s+(?:proposed\s+)?(?:bank|company|corporation|trust|venture|fund|association)$"
COUNT_OR_PLURAL = r"(?i)^(?:(?:one|two|three|four|five|six|seven|eight|nine|ten|all|both|several|these|those|following)\b.*|.*\b(?:entities|companies|firms|individuals)$)"
PRONOUN = r"(?i)^(?:he|she|it|they|we|who|whose)\b"


def gate(name: Column) -> Column:
    """Why a name is no party, by the first rule that holds; null if it is one."""
    key = graph_key(name)
    tokens, words = F.split(key, " "), F.split(F.trim(name), r"\s+")
    place = F.array_join(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), " ")
    rules = (
        (F.coalesce(name, F.lit("")) == "", "missing party"), (name.rlike(GENERIC_NAME) | name.rlike(GENERIC_TAIL), "document-generic reference; needs in-document resolution"),
        (key.isin(*STOP_NAMES), "stop-listed name (place/agency/group, not an owner party)"), (F.length(key) < 3, "name too short to identify a party"), (F.forall(tokens, lambda t: t.isin(*BARE_WORDS)), "bare corporate-suffix token(s), not a name"),
        (name.rlike(COUNT_OR_PLURAL), "count phrase / generic plural, not a named party"),
        ((F.size(tokens) >= 2) & F.element_at(tokens, -1).isin("corporation", "corp", "company", "co", "llc", "bank", "trust") & place.isin(*STATES, *STATES_OF_TWO_WORDS), "jurisdiction-form phrase, not a party name"),
        (name.rlike(PRONOUN), "clause fragment, not a name"), (F.forall(words, lambda t: F.length(t) <= 2), "initials-only fragment"),
    )
    return F.coalesce(*(F.when(test, F.lit(reason)) for test, reason in rules))


# Legal forms at a name's end (nodes) and anywhere (actors), shapes of persons and acronyms.
NODE_SUFFIX = (
    r"(?i)\b(?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Company|Compan(?:y|ies)|Co\.|Ltd\.?|Limited|Incorporated|LP|L\.P\.|LLP|PLLC|PLC|GmbH|N\.V\.|Holdings?|Group|Trust|Bank|Bancorp|Bancshares|N\.A\.|S\.?A\.?R\.?L\.?|Partners(?:hip)?|Fund|Association|OOO|OAO|ZAO"
    r"|PAO|AD|EOOD|SARL|SA|AG)\.?\s*$"
)
ACTOR_SUFFIX = r"(?i)\b(LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Company|Co\.|Ltd\.?|LP|LLP|PLLC|Holdings?|Group|Trust|Bank|N\.A\.|S\.?A\.?R\.?L\.?|Partners(?:hip)?|Fund|Ventures?|Capital|Financial|Investments?)\b"
NODE_PERSON = r"^[A-Z][A-Za-z'’\-]+(?:\s+[A-Z]\.?)?(?:\s+[A-Z][A-Za-z'’\-]+){1,3}$"
ACTOR_PERSON = r"^[A-Z][a-z]+(?:\s+[A-Z]\.?)?(?:\s+[A-Z][a-z]+){1,2}$"


def actor_kind(name: Column) -> Column:
    """What a name looks like, by itself."""
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "MISSING").when(name.rlike(ACTOR_SUFFIX), "ENTITY").when(name.rlike(r"(?i)^the\s"), "DEFINED_TERM").when(name.rlike(r"^[A-Z]{2,6}(?:-\d+)?$"), "ABBREVIATION")
        .when(name.rlike(ACTOR_PERSON), "PERSON_CANDIDATE").when(name.rlike(r"^[A-Z][a-z]{2,}$"), "SURNAME_CANDIDATE").otherwise("UNCLASSIFIED")
    )


def node_kind(name: Column, role: Column) -> Column:
    """entity or person; a single word that is no acronym is a person as an owner or the subject of an alias, else an entity."""
    n = F.size(F.split(F.trim(name), r"\s+"))
    alone = F.when(~name.rlike(r"^[A-Z0-9&\-]{2,8}$") & role.isin("owner", "alias_subject"), "person").otherwise("entity")
    return F.when(name.rlike(NODE_SUFFIX), "entity").when(n == 1, alone).when((n <= 4) & name.rlike(NODE_PERSON), "person").otherwise("entity")


# Names that a validator rejects; two names in one.
BAD_NAME = (
    r"^(?:Both|All|Each|Various|Several|Certain)\b|^(?:Limited\s+Liability\s+Company|Company|Corporation|LLC|Inc\.?|US|UN|Bank|Trust|Group)$|\b(?:Proposed|Additionally|Shareholders)\b|\.\s|\band\b.*\b(?:LLC|Inc\.?|Corp\.?|Company|Bank)\b.*\band\b"
)
CONJUNCTION = r"\b(?:and|or)\b\s+[A-Z]"


def name_ok(name: Column) -> Column:
    """3 to 90 characters and none of BAD_NAME."""
    return F.coalesce(F.length(name).between(3, 90) & ~name.rlike(BAD_NAME), F.lit(False))


def owners(name: Column) -> Column:
    """A list of owners split into its names; a name with a legal form, or with parts that are no names, stays whole."""
    parts = F.filter(F.split(name, r",\s+|,?\s+and\s+"), lambda p: p != "")
    kept = F.filter(parts, lambda p: ~F.lower(p).contains("affiliated entities"))
    listed = (F.size(parts) >= 2) & F.forall(parts, lambda p: (F.size(F.split(F.trim(p), r"\s+")) <= 4) & p.rlike(r"^\p{Lu}")) & ~name.rlike(NODE_SUFFIX) & (F.size(kept) > 0)
    return F.when(F.coalesce(listed, F.lit(False)), kept).otherwise(F.array(name))


OWNERSHIP = ("owned_by", "owns_pct_of", "pct_interest_in", "owner_of", "owner_of_appositive", "founder_sole_owner", "beneficial_owner_of", "holds_shares_of", "designated_owned_controlled")
CONTROL = ("controlled_by", "controls", "controlling_person_of", "exercises_control")
PARENT = ("subsidiary_of", "subsidiary_of_appositive", "its_subsidiary", "operates_through_sub", "parent_of", "holding_company_of")
OUT_OF_SCOPE = ("transferred_to", "received_from", "wire_from_to", "shell_named", "used_shells", "nominee_for")


def assertion_of(predicate: Column, raw_text: Column | None = None) -> Column:
    """The edge an observation stands for; control becomes ownership only where the text says owned and, or, and/or controlled by. Null: out of scope."""
    both = F.lit(False) if raw_text is None else F.coalesce(raw_text, F.lit("")).rlike(r"(?i)owned\s+(?:and/or\s+|or\s+|and\s+)?controlled\s+by")
    return (
        F.when(predicate.isin(*OWNERSHIP) | (predicate == "designation_controller"), "BENEFICIAL_OWNER").when(predicate.isin(*CONTROL), F.when(both, "BENEFICIAL_OWNER").otherwise("UNKNOWN_CONTROL_ROLE"))
        .when(predicate.isin(*PARENT), "PARENT").when(predicate == "affiliate_of", "RELATED_ORGANIZATION").when(predicate == "alias_of", "ALIAS")
    )


# Who is designated in the sentences before an observation, and what is cut off that name.
DESIGNATED = re.compile(r"([A-Z][^.\n]{2,90}?)\s*(?:\([^)]{0,80}\)\s*)?,?\s*(?:along\s+with[^,]{0,80},\s*)?(?:is|are|was|were)\s+(?:also\s+)?(?:being\s+)?(?:concurrently\s+)?designated\b[^.]{0,220}?for\s+being\s+owned\s+or\s+controlled\s+by")
TRAIL = re.compile(r",?\s*(?:along\s+with\b.*|based\s+in\b.*|located\s+in\b.*|which\b.*|while\b.*|registered\s+in\b.*|(?:is\s+)?an\s+entity\b.*|whose\b.*)$", re.I | re.S)
LEAD = re.compile(r"^(?:Concurrent(?:ly)?\s+(?:to|with)[^,]{0,60},\s*|(?:Today|In\s+addition|Additionally|Finally|Also|Separately)\s*,\s*|[A-Z][a-z]+-based\s+|the\s+)+")


def designated(text: str, start: int, end: int, controller: str | None) -> str | None:
    """The name that the last designation clause before an observation speaks of, if that clause is the observation's own and the name holds no list with the controller."""
    window = text[max(0, start - 500) : end]
    last = None
    for last in DESIGNATED.finditer(window):
        pass
    if last is None:
        return None
    words = (controller or "").split()
    if words and words[-1][:14] not in window[last.end() : last.end() + 200]:
        return None
    name = re.sub(r"\s*\([^)]{0,60}\)", "", TRAIL.sub("", last[1]).strip(" ,;:"))
    name = LEAD.sub("", name).strip(" ,;:").split()
    while name and not name[0][0].isupper():
        del name[0]
    joined = " ".join(name)
    return None if not joined or (controller and re.search(re.escape(controller) + r"\s*,", joined)) else joined


def resolve_designations(observations: DataFrame, texts: DataFrame) -> DataFrame:
    """Observations of a controller alone (designation_controller) with the designated name as object, resolution designation-window and confidence 0.7 where it is found; others as they are."""
    ship_package(observations.sparkSession)

    @F.pandas_udf("string")
    def find(text: pd.Series, start: pd.Series, end: pd.Series, controller: pd.Series) -> pd.Series:
        return pd.Series([designated(t, int(a), int(b), c) if isinstance(t, str) else None for t, a, b, c in zip(text, start, end, controller, strict=True)], dtype=object)

    out = observations if "resolution" in observations.columns else observations.withColumn("resolution", F.lit(None).cast("string"))
    open_ = (F.col("predicate_raw") == "designation_controller") & F.col("object_raw").isNull()
    found = out.where(open_).join(texts.select("id", "text"), "id", "left").withColumn("_name", find("text", "character_start", "character_end", "subject_raw")).drop("text")
    known = F.col("_name").isNotNull()
    found = found.withColumns({"object_raw": F.col("_name"), "resolution": F.when(known, "designation-window").otherwise(F.col("resolution")), "extraction_confidence": F.when(known, 0.7).otherwise(F.col("extraction_confidence"))})
    return out.where(~F.coalesce(open_, F.lit(False))).unionByName(found.select(*out.columns))


def route(observations: DataFrame) -> DataFrame:
    """observations with assertion and reason: why one gives no edge, by the first rule that holds; null if it gives one. Parties are sanitized."""
    resolved = F.col("resolution").isNotNull() if "resolution" in observations.columns else F.lit(False)
    o = observations.withColumns({"subject_raw": sanitize(F.col("subject_raw")), "object_raw": sanitize(F.col("object_raw")), "assertion": assertion_of(F.col("predicate_raw"), F.col("raw_text"))})
    alias = F.col("assertion") == "ALIAS"
    reason = F.coalesce(
        F.when(F.col("predicate_raw").isin(*OUT_OF_SCOPE), F.lit("out of scope")), F.when(F.col("assertion").isNull(), F.concat(F.lit("no mapping for predicate "), F.col("predicate_raw"))),
        F.when(~alias & F.col("object_raw").isNull(), F.lit("counterparty not in sentence window (controller known, controlled party upstream)")),
        F.when((F.col("extraction_confidence") < 0.9) & ~resolved, F.lit("sub-threshold extraction confidence; party naming needs in-document resolution")),
        gate(F.col("subject_raw")), gate(F.col("object_raw")), F.when(~alias & (graph_key(F.col("subject_raw")) == graph_key(F.col("object_raw"))), F.lit("subject and object are one party")),
    )
    return o.withColumn("reason", reason)


def build_edges(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, unresolved): an edge for each owner of an observation without a reason against it, and the others with that reason. Aliases are no edges: see alias_records()."""
    o = route(observations)
    percent = F.regexp_extract(F.coalesce("percentage_raw", F.lit("")), r"([0-9.]+)", 1).try_cast("double")
    split = F.when(F.col("assertion").isin("BENEFICIAL_OWNER", "UNKNOWN_CONTROL_ROLE"), owners(F.col("subject_raw"))).otherwise(F.array("subject_raw"))
    objects = F.when(F.col("predicate_raw") == "designation_controller", owners(F.col("object_raw"))).otherwise(F.array("object_raw"))
    good = o.where("reason is null and assertion <> 'ALIAS'").withColumn("owner", F.explode(split)).withColumn("owned", F.explode(objects))
    ends = (short_id("obs-ent:", graph_key(F.col("owner"))).alias("subject_id"), "assertion", short_id("obs-ent:", graph_key(F.col("owned"))).alias("object_id"))
    edges = good.select(*ends, F.when(percent.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), percent))).alias("ownership_percent"), F.col("extraction_confidence").alias("confidence"), "observation_id", "id")
    return edges, o.where("reason is not null").select("observation_id", "reason")


def alias_records(observations: DataFrame) -> DataFrame:
    """(name, alias, name_type, kind) of alias observations that pass: FORMER for f/k/a, LEGAL for n/k/a in the 30 characters before the alias, else DBA."""
    o = route(observations).where("assertion = 'ALIAS' and reason is null")
    at = F.locate("x", F.lit("x")) * 0 + F.expr("instr(raw_text, left(object_raw, 40))")
    before = F.lower(F.when(at > 1, F.col("raw_text").substr(F.greatest(at - 30, F.lit(1)), F.least(at - 1, F.lit(30)))).otherwise(F.col("raw_text")))
    kind = F.when(before.contains("f/k/a"), "FORMER").when(before.contains("n/k/a"), "LEGAL").otherwise("DBA")
    return o.select(F.col("subject_raw").alias("name"), F.col("object_raw").alias("alias"), kind.alias("name_type"), node_kind(F.col("subject_raw"), F.lit("alias_subject")).alias("kind"))


# The edge of each type of assertion that is validated.
VALIDATED = {"OWNERSHIP": "BENEFICIAL_OWNER", "CONTROL": "UNKNOWN_CONTROL_ROLE", "PARENT_SUBSIDIARY": "PARENT"}


def skip_reason(assertions: DataFrame) -> DataFrame:
    """assertions(assertion_type, subject_raw, object_raw, reported_speech, extraction_confidence, duplicate_of_prior) with skip_reason, the first that holds, and the edge's assertion if none does."""
    kind, missing = F.col("assertion_type"), lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    reason = F.coalesce(
        F.when(F.coalesce("duplicate_of_prior", F.lit(False)), F.lit("skip_duplicate_sentence")), F.when(~F.coalesce(kind, F.lit("")).isin(*VALIDATED), F.concat(F.lit("skip_type_"), F.coalesce(kind, F.lit("")))),
        F.when(missing("subject_raw") | missing("object_raw"), F.lit("skip_missing_party")), F.when(F.coalesce("reported_speech", F.lit(False)), F.lit("skip_reported_speech")),
        F.when(F.coalesce("extraction_confidence", F.lit(0.0)) < 0.9, F.lit("skip_low_confidence")), F.when(~(name_ok(F.col("subject_raw")) & name_ok(F.col("object_raw"))), F.lit("skip_name_screen")),
        F.when(F.col("object_raw").rlike(CONJUNCTION) & (kind != "CONTROL"), F.lit("skip_conjunctive_object")),
    )
    edge = F.try_element_at(F.create_map(*(F.lit(x) for kv in VALIDATED.items() for x in kv)), kind)
    return assertions.withColumn("skip_reason", reason).withColumn("assertion", F.when(F.col("skip_reason").isNull(), edge))


def citations(texts: DataFrame, known: DataFrame | None = None, sources: int = 5) -> DataFrame:
    """Per cited target (a url on a host of records, or a report number): kind, citations, topical citations, citing documents, priority, the first documents that cite it.

    A url has no punctuation or slash at its end; urls of over 300 characters and those of known(url) are no targets, as the rule has it. A citation is topical if a word of
    the topic stands within 200 characters. Of the citing documents, the least sources ids are given.
    """
    ship_package(texts.sparkSession)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        url, number, topic = re.compile(lexicon.CITED_URL), re.compile(lexicon.REPORT_NUMBER), re.compile(lexicon.TOPIC)
        for batch in batches:
            out = []
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                hits = [("url", f"https://www.{m[1].lower()}{m[2]}".rstrip(".,;:)\"'").rstrip("/"), m) for m in url.finditer(text)] + [("report", f"GAO-{m[1]}-{m[2]}", m) for m in number.finditer(text)]
                out += [(id_, kind, target, m.start(), topic.search(text, max(0, m.start() - 200), m.end() + 200) is not None) for kind, target, m in hits]
            yield pd.DataFrame(out, columns=["id", "kind", "target", "character_start", "topical"])

    maybe = texts.select("id", "text").where(F.col("text").rlike(r"(?i)https?://|GAO"))
    found = maybe.mapInPandas(find, "id long, kind string, target string, character_start int, topical boolean").where("kind <> 'url' or length(target) <= 300")
    if known is not None:
        urls = known.select(F.rtrim(F.col("url"), F.lit("/")).alias("target"), F.lit("url").alias("kind")).distinct()
        found = found.join(urls, ["target", "kind"], "left_anti")
    per_text = found.groupBy("kind", "target", "id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("topical"), 1)).alias("topical"))
    first = per_text.withColumn("place", F.row_number().over(Window.partitionBy("kind", "target").orderBy("id"))).where(F.col("place") <= sources)
    first = first.groupBy("kind", "target").agg(F.array_sort(F.collect_list("id")).alias("sources"))
    grouped = per_text.groupBy("kind", "target").agg(F.sum("n").alias("citations"), F.sum("topical").alias("topical"), F.count(F.lit(1)).alias("documents"))
    priority = F.col("topical") * 3 + F.least("citations", F.lit(10)) + F.when(F.col("kind") == "report", 2).otherwise(0)
    return grouped.join(first, ["kind", "target"]).select(F.col("target").alias("url"), "kind", "citations", "topical", "documents", priority.alias("priority"), "sources")


# Weights of candidate buckets, names of entities in text, names too general to look up, priorities of filing forms.
BUCKET_WEIGHTS = {"ownership": 5, "control": 4, "parent-subsidiary": 3, "shell-structure": 4, "financial-flow": 2, "congressional": 3}
ENTITY = r"\b([A-Z][A-Za-z0-9&.,'’\- ]{2,60}?[ .,](?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Company|Co\.|Ltd\.?|LP|L\.P\.|LLP|PLLC|Holdings?|Group|Trust|Bank|N\.A\.|Partners(?:hip)?))(?=[\s.,;:)\"']|$)"
GENERAL_NAMES = ("THE COMPANY", "THE BANK", "THE TRUST", "NATIONAL BANK", "HOLDING COMPANY", "THE CORPORATION", "STATE BANK")
FORM_PRIORITIES = {"SC 13D": 10, "SC 13D/A": 9, "SC 13G": 8, "SC 13G/A": 7, "10-K": 8, "10-K/A": 7, "10-K405": 7, "20-F": 6, "3": 5, "4": 5, "5": 4, "D": 5, "D/A": 4, "8-K": 3}


def harvest(candidates: DataFrame) -> DataFrame:
    """candidates(bucket, candidate_id, id, review_priority, texts array) to entity names in register spelling: score, buckets, an example document (the least).

    A candidate gives each name once, weight times (1 + priority / 20); its texts are the match, its groups and 150 characters on either side.
    """
    weights = F.create_map(*(F.lit(x) for kv in BUCKET_WEIGHTS.items() for x in kv))
    weighted = candidates.withColumn("weight", F.try_element_at(weights, F.col("bucket"))).where("weight is not null")
    names = F.array_distinct(F.transform(F.flatten(F.transform("texts", lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(ENTITY), F.lit(1)))), registry_key))
    each = weighted.select("bucket", "id", "weight", "review_priority", F.explode(names).alias("name")).where((F.length("name") >= 6) & ~F.col("name").isin(*GENERAL_NAMES))
    score = F.sum(F.col("weight") * (1 + F.coalesce("review_priority", F.lit(0.0)) / 20))
    return each.groupBy("name").agg(F.bround(score, 6).alias("score"), F.array_sort(F.collect_set("bucket")).alias("buckets"), F.min("id").alias("example_id"))


def register_matches(names: DataFrame, register: DataFrame) -> DataFrame:
    """register(cik, name, former array) with the first of its names, the current one before former ones in order, that names(name) holds; entries without one go."""
    every = F.filter(F.concat(F.array("name"), F.coalesce("former", F.array().cast("array<string>"))), lambda n: n.isNotNull())
    spelled = register.select("cik", F.posexplode(every).alias("pos", "spelling")).withColumn("matched_name", registry_key(F.col("spelling")))
    return spelled.join(names.select(F.col("name").alias("matched_name")).distinct(), "matched_name", "left_semi").groupBy("cik").agg(F.min_by("matched_name", "pos").alias("matched_name"))


def filing_queue(filings: DataFrame, harvested: DataFrame, archived: DataFrame, most_8k: int = 3) -> DataFrame:
    """filings(cik, matched_name, pos, form, accession, filed, url) of forms with a priority, at most most_8k of form 8-K for each cik in order of pos, with priority and already_archived.

    Order: priority falling, date rising with missing dates first, url.
    """
    forms = F.create_map(*(F.lit(x) for kv in FORM_PRIORITIES.items() for x in kv))
    rows = filings.withColumn("_form", F.try_element_at(forms, F.col("form"))).where("_form is not null")
    turn = F.row_number().over(Window.partitionBy("cik").orderBy("pos"))
    events = rows.where("form = '8-K'").withColumn("_turn", turn).where(F.col("_turn") <= most_8k).drop("_turn")
    kept = rows.where("form <> '8-K'").unionByName(events)
    scored = kept.join(harvested.select(F.col("name").alias("matched_name"), "score"), "matched_name")
    priority = F.bround(F.col("_form") * (1 + F.least("score", F.lit(50.0)) / 25), 2)
    flagged = scored.join(archived.select("url").distinct().withColumn("_has", F.lit(True)), "url", "left")
    out = flagged.select("cik", "matched_name", "form", "accession", "filed", "url", priority.alias("priority"), F.coalesce("_has", F.lit(False)).alias("already_archived"))
    return out.orderBy(F.desc("priority"), F.asc_nulls_first("filed"), "url")


# Marks of urls by which a posture is told.
SELF_REPORT_URL = r"(?i)sc-?13[dg]|schedule.?13[dg]|form-?[345]\b"
COMPLAINT_URL = r"(?i)complaint|amended-?complaint|comp\d|amendedcomplaint"
JUDGMENT_URL = r"(?i)judg|final-?judgment|consent"
ORDER_URL = r"(?i)consent.?order|cease.?and.?desist|civil.?money.?penalt|enforcement|assessment|comptroller-orders"
DESIGNATION_URL = r"(?i)designat|sanction|blocked|SDN|specially.designated|magnitsky|E\.?O\.?\s?13"


def posture(family: Column, url: Column, head: Column, classes: Column | None = None) -> Column:
    """Evidentiary posture by source family; never ADJUDICATED_FACT. classes: of the document (T3)."""
    u, h = F.coalesce(url, F.lit("")), F.left(F.coalesce(head, F.lit("")), F.lit(2000))
    has = lambda c: F.lit(False) if classes is None else F.coalesce(F.array_contains(classes, c), F.lit(False))
    sec = (
        F.when(u.rlike(SELF_REPORT_URL) | (has("SEC_OWNERSHIP") & h.contains("13")), "SELF_REPORTED").when(u.rlike(COMPLAINT_URL), "GOVERNMENT_ALLEGATION").when(u.rlike(JUDGMENT_URL), "COURT_ALLEGATION").when(u.rlike(ORDER_URL), "GOVERNMENT_FINDING")
        .otherwise("GOVERNMENT_ALLEGATION")
    )
    return (
        F.when(family == "SEC", sec).when(family.isin("TREASURY", "TREASURY_OIG"), F.when(u.rlike(DESIGNATION_URL) | has("SANCTIONS"), "ADMINISTRATIVE_DESIGNATION").otherwise("GOVERNMENT_FINDING"))
        .when(family.isin("FINCEN", "OCC", "FDIC", "GAO", "GOVINFO", "FEDERAL_REGISTER"), "GOVERNMENT_FINDING").when(family.isin("DOJ", "FBI_VAULT"), "GOVERNMENT_ALLEGATION").when(family.startswith("CONGRESS"), "CONGRESSIONAL_ASSERTION")
        .otherwise("OTHER_DIRECT_ASSERTION")
    )
