"""Toxicity by weak supervision.

1. Lexicons: words and word beginnings that occur in toxic training documents and hardly in others are
   counted over a bounded sample of labelled texts. A greedy cover keeps those that together reach each toxic
   document several times, so that words of one much-copied document don't fill them. Entries that occur
   together form a lexicon of their own (in practice one for each language).
2. Voters: the words and the beginnings of each lexicon, four general lexicons of insults, and patterns
   (several words, density, insult after an address, emphasis). A voter votes toxic or abstains. All
   training documents, labelled or not, are voted on; only the number of documents of each set of votes reaches the driver.
3. A generative label model estimates the prior, how often each voter fires on toxic and on other documents (expectation
   maximisation) and the voters' correlations within a class, which discount their evidence. An
   abstention says nothing, but the silence of all voters does. On the labelled sample the given label is one more, fallible witness.
4. A linear classifier is fitted to the posterior labels (made by the voters alone, without the given label): on the sets of votes of all training
   documents and on the entries in the sampled texts. It scores every text.

Only texts enter a score. Sampling, voting, counting and scoring run on executors; the driver gets CANDIDATES lexicon
counts, hits of SAMPLE texts and 2^VOTERS numbers at most.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.llm.common import bounded_sample, cut, small_batches, text_of

#: Labelled training documents used at most, those with the least hash of the id.
SAMPLE = 20_000
CANDIDATES, LEXICON, COVER = 3_000, 400, 4
MIN_PRECISION = 0.85
PREFIXES = (3, 4, 5, 6, 7)
#: The weight of the labelled sample in the label model, as a multiple of that of all other training documents.
WITNESSED = 4.0
#: Lexicons made from entries that occur together.
GROUPS = 4
WORDS = re.compile(r"[^\W\d_]+")
# General lexicons of insults in four languages.
INSULTS = {
    "en": frozenset(
        """idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown clowns fool fools imbecile
        jerk creep freak vermin filth filthy ugly useless coward crap bastard bitch asshole shit dumbass""".split()
    ),
    "fr": frozenset("idiote imbécile crétin connard salope ordure minable dégueulasse".split()),
    "de": frozenset("dummkopf arschloch abschaum trottel widerlich erbärmlich wertlos".split()),
    "es": frozenset("idiota imbécil estúpido estúpida basura asqueroso patético gilipollas".split()),
}
ALL_INSULTS = frozenset().union(*INSULTS.values())
ADDRESS = re.compile(r"\b(?:you|you're|your|ur|du|ihr|sie|tu|vous|eres|usted)\W+(?:\w+\W+){0,3}$")
PATTERNS = ("several", "dense", "address", "emphasis")
VOTERS = 2 * GROUPS + len(INSULTS) + len(PATTERNS)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def grams_of(words: set[str]) -> set[str]:
    """The words, and their beginnings marked by a final hyphen."""
    return words | {f"{w[:k]}-" for w in words for k in PREFIXES if len(w) > k}


def entries_in(words: set[str], lexicon) -> dict[str, set[str]]:
    """The lexicon's entries among words, each with the words it stands for."""
    found = {w: {w} for w in words if w in lexicon}
    for w in words:
        for k in PREFIXES:
            if len(w) > k and (p := f"{w[:k]}-") in lexicon:
                found.setdefault(p, set()).add(w)
    return found


def features(text: str, group_of: dict[str, int]) -> tuple[list[str], int]:
    """The lexicons' entries in a text, sorted, and the votes as bits: words of each group, beginnings of each group, general lexicons, patterns."""
    words = words_of(text)
    distinct = set(words)
    found = entries_in(distinct, group_of)
    known = (distinct & ALL_INSULTS).union(*found.values())
    if not known:
        return [], 0
    votes = 0
    for e in found:
        votes |= 1 << ((GROUPS if e[-1] == "-" else 0) + group_of[e])
    for i, insults in enumerate(INSULTS.values()):
        if not insults.isdisjoint(distinct):
            votes |= 1 << (2 * GROUPS + i)
    address = emphasis = False
    count = 0
    for m in WORDS.finditer(text):
        if m[0].lower() in known:
            count += 1
            emphasis = emphasis or text[m.end() : m.end() + 1] == "!" or (len(m[0]) > 1 and m[0].isupper())
            address = address or ADDRESS.search(text[max(0, m.start() - 60) : m.start()].lower()) is not None
    for i, vote in enumerate((len(known) > 1, count * 200 >= len(words), address, emphasis)):
        votes |= vote << (2 * GROUPS + len(INSULTS) + i)
    return sorted(found), votes


def bits(votes) -> np.ndarray:
    """Rows of 0 and 1 for votes as numbers."""
    return (np.asarray(votes, dtype=np.int64)[:, None] >> np.arange(VOTERS) & 1).astype(float)


@dataclass(frozen=True)
class Model:
    """groups: the lexicon of each entry; weights of entries; weights of the voters; bias."""

    groups: dict[str, int]
    weights: dict[str, float]
    voters: tuple[float, ...]
    bias: float

    def score(self, text: str) -> float:
        hits, votes = features(text, self.groups)
        z = self.bias + sum(self.weights[h] for h in hits) + sum(w for i, w in enumerate(self.voters) if votes >> i & 1)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


#: Where nothing can be learned: an insult of a general lexicon makes a text toxic.
PLAIN = Model({}, {}, (0.0,) * 2 * GROUPS + (6.0,) * len(INSULTS) + (0.5,) * len(PATTERNS), -4.0)


def _candidates(sample: DataFrame) -> list[str]:
    """Words and beginnings with enough toxic texts and hardly any other, the most frequent first."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(grams_of(set(words_of(t)))) for t in texts], dtype=object)

    toxic = (F.col("label") == 1).cast("int")
    total = sample.agg(F.sum(toxic).alias("t"), F.sum(1 - toxic).alias("c")).first()
    if not total["t"] or not total["c"]:
        return []
    # only grams of toxic documents can qualify; each document gives a gram once
    counts = sample.select(toxic.alias("toxic"), F.explode(grams("text")).alias("gram")).groupBy("gram").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    precision = (F.col("t") + 0.5) / (F.col("t") + F.col("c") + 1)
    least = max(2, min(10, total["t"] // 60))
    return [r["gram"] for r in counts.where((F.col("t") >= least) & (precision >= MIN_PRECISION)).orderBy(F.desc("t"), "gram").limit(CANDIDATES).collect()]


def _hits(sample: DataFrame, entries: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Of each set of entries in sampled texts: the set, the number of texts with it, whether they are labelled toxic."""
    known = frozenset(entries)

    @F.pandas_udf(T.StringType())
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(sorted(entries_in(set(words_of(t)), known))) for t in texts], dtype=object)

    rows = sample.select((F.col("label") == 1).alias("toxic"), found("text").alias("f")).groupBy("toxic", "f").agg(F.count(F.lit(1)).alias("n")).orderBy("f", "toxic").collect()
    return [json.loads(r["f"]) for r in rows], np.array([r["n"] for r in rows], dtype=float), np.array([r["toxic"] for r in rows], dtype=bool)


def holders_of(hits: list[list[str]], toxic: np.ndarray) -> dict[str, list[int]]:
    """The toxic rows of each entry."""
    out: dict[str, list[int]] = {}
    for i, own in enumerate(hits):
        if toxic[i]:
            for h in own:
                out.setdefault(h, []).append(i)
    return out


def cover(hits: list[list[str]], counts: np.ndarray, toxic: np.ndarray, limit: int = LEXICON, times: int = COVER) -> list[str]:
    """Entries picked greedily, each time the one in most toxic documents that were reached under times times."""
    demand = [times if t else 0 for t in toxic]
    holders = holders_of(hits, toxic)
    gain = {h: float(counts[d].sum()) for h, d in holders.items()}
    picked: list[str] = []
    while gain and len(picked) < limit:
        best = max(gain, key=lambda h: (gain[h], h))
        if gain[best] < 2:
            break
        picked.append(best)
        del gain[best]
        for i in holders[best]:
            if demand[i]:
                demand[i] -= 1
                if not demand[i]:
                    for h in hits[i]:
                        if h in gain:
                            gain[h] -= counts[i]
    return picked


def lexicons(entries: list[str], hits: list[list[str]], counts: np.ndarray, toxic: np.ndarray) -> dict[str, int]:
    """The lexicon (0 to GROUPS - 1) of each entry. The entry in most rows that no lexicon reaches founds the next one; an entry goes to the founder it meets most often."""
    holders = {h: set(d) for h, d in holders_of(hits, toxic).items()}
    weight = lambda rows: sum(counts[i] for i in rows)
    founders: list[str] = []
    left = set().union(*(holders[e] for e in entries)) if entries else set()
    while len(founders) < GROUPS and left:
        best = max(entries, key=lambda e: (weight(holders[e] & left), e))
        if best in founders or not holders[best] & left:
            break
        founders.append(best)
        near = [e for e in entries if weight(holders[e] & holders[best]) >= 0.25 * weight(holders[e])]
        left -= set().union(*(holders[e] for e in near))
    return {e: max(range(len(founders)), key=lambda g: (weight(holders[e] & holders[founders[g]]), -g)) for e in entries}


def _votes(texts: DataFrame, groups: dict[str, int], *keep: Column) -> DataFrame:
    """texts(text) as keep and votes, a number."""

    @F.pandas_udf(T.IntegerType())
    def votes(column: pd.Series) -> pd.Series:
        return pd.Series([features(t, groups)[1] for t in column], dtype="int32")

    return texts.select(*keep, votes("text").alias("votes"))


@dataclass(frozen=True)
class LabelModel:
    """prior of toxic; how often each voter fires (other, toxic); how often any does; what share of its evidence counts."""

    prior: float
    fire: np.ndarray
    any: np.ndarray
    share: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        silent = votes.sum(axis=1) == 0
        evidence = votes @ (self.share * np.log(self.fire[1] / self.fire[0]))
        return np.log(self.prior / (1 - self.prior)) + np.where(silent, np.log((1 - self.any[1]) / (1 - self.any[0])), evidence)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -50, 50)))


def label_model(votes: np.ndarray, counts: np.ndarray, labelled: np.ndarray, labels: np.ndarray, label_counts: np.ndarray, rounds: int = 60) -> LabelModel:
    """Fitted to rows of votes with their counts, and to labelled rows of votes, whose label is one more witness of unknown reliability."""
    m = votes.shape[1]
    both = np.vstack([votes, labelled])
    fired = both.sum(axis=1) > 0
    # the labelled sample weighs WITNESSED times as much as all other rows, whatever their number
    scale = label_counts.sum() / max(counts.sum(), 1.0) / WITNESSED if label_counts.sum() else 1.0
    weight = np.concatenate([counts * scale, label_counts])
    model = LabelModel(0.1, np.vstack([np.full(m, 0.01), np.full(m, 0.4)]), np.array([0.05, 0.95]), np.ones(m))
    right = np.array([0.95, 0.95])  # how often the label of other and of toxic texts is right
    before = np.zeros(len(both))
    for turn in range(rounds):
        z = model.log_odds(both)
        witness = np.where(labels, np.log(right[1] / (1 - right[0])), np.log((1 - right[1]) / right[0]))
        z[len(votes) :] += witness
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        if turn and np.abs(p - before).max() < 1e-6:
            break
        before = p
        mass = np.vstack([weight * (1 - p), weight * p])
        total = mass.sum(axis=1)
        fire = np.clip((mass @ both + [[0.1], [0.5]]) / (total[:, None] + [[10.0], [1.0]]), 1e-5, 1 - 1e-5)
        any_fires = np.clip((mass @ fired + [0.1, 1.0]) / (total + [10.0, 1.1]), 1e-4, 1 - 1e-4)
        if len(labelled):
            own = mass[:, len(votes) :]
            right = np.clip([(own[0] @ ~labels + 95) / (own[0].sum() + 100), (own[1] @ labels + 95) / (own[1].sum() + 100)], 0.9, 0.999)
        phi = np.zeros((m, m))
        for y in (0, 1):
            centred = both - fire[y]
            spread = np.sqrt(np.maximum(mass[y] @ centred**2, 1e-9))
            phi = np.maximum(phi, (centred * mass[y][:, None]).T @ centred / np.outer(spread, spread))
        np.fill_diagonal(phi, 1)
        model = LabelModel(float(np.clip(total[1] / total.sum(), 0.001, 0.5)), fire, any_fires, 1 / phi.sum(axis=1))
    return model


def logistic(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], size: int, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    """size weights, then the bias, by Newton steps. A block: rows of some columns, their soft labels, their counts, the columns."""
    penalty = np.append(np.full(size, ridge), 1e-3)
    w = np.zeros(size + 1)
    for _ in range(rounds):
        gradient, hessian = penalty * w, np.diag(penalty)
        for x, y, n, columns in blocks:
            a, at = np.hstack([x, np.ones((len(x), 1))]), np.append(columns, size)
            p = 1 / (1 + np.exp(-np.clip(a @ w[at], -30, 30)))
            gradient[at] += a.T @ (n * (p - y))
            hessian[np.ix_(at, at)] += (a * (n * (p * (1 - p) + 1e-6))[:, None]).T @ a
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labels of the training rows only. Without both classes among them, or without words that tell them apart: PLAIN."""
    small_batches(docs.sparkSession)
    sample = cut(bounded_sample(docs, labels, "toxic", SAMPLE, id_col, text_col, train_only=True))
    candidates = _candidates(sample)
    if not candidates:
        return PLAIN
    hits, counts, toxic = _hits(sample, candidates)
    entries = sorted(set(cover(hits, counts, toxic)))
    if not entries:
        return PLAIN
    known = set(entries)
    hits = [[h for h in own if h in known] for own in hits]
    groups = lexicons(entries, hits, counts, toxic)
    training = docs.where(~held_out(id_col)).select(text_of(text_col).alias("text"))
    seen = _votes(training, groups).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    rows = _sampled(sample, groups)
    votes, n = bits([r["votes"] for r in seen]), np.array([r["n"] for r in seen], dtype=float)
    sampled, sampled_n = bits([r["votes"] for r in rows]), np.array([r["n"] for r in rows], dtype=float)
    model = label_model(votes, n, sampled, np.array([r["toxic"] for r in rows], dtype=bool), sampled_n)
    column = {h: j for j, h in enumerate(entries)}
    x = np.zeros((len(rows), len(entries) + VOTERS))
    for i, r in enumerate(rows):
        x[i, [column[h] for h in json.loads(r["f"])]] = 1
    x[:, len(entries) :] = sampled
    voters = np.arange(len(entries), len(entries) + VOTERS)
    blocks = [(x, model.posterior(sampled), sampled_n, np.arange(x.shape[1])), (votes, model.posterior(votes), n * (SAMPLE / n.sum()), voters)]
    w = logistic(blocks, x.shape[1])
    return Model(groups, {h: float(w[j]) for h, j in column.items()}, tuple(map(float, w[voters])), float(w[-1]))


def _sampled(sample: DataFrame, groups: dict[str, int]) -> list:
    """Of the sampled texts: entries (JSON) and votes, label, number of texts; SAMPLE rows at most."""

    @F.pandas_udf("f string, votes int")
    def both(texts: pd.Series) -> pd.DataFrame:
        made = [features(t, groups) for t in texts]
        return pd.DataFrame({"f": [json.dumps(h) for h, _ in made], "votes": [v for _, v in made]})

    rows = sample.select((F.col("label") == 1).alias("toxic"), both("text").alias("b")).groupBy("b.f", "b.votes", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy("f", "votes", "toxic").collect()


def score_udf(model: Model):
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for each row of docs.

    Null and empty texts get the score of a text without hits. A row without an id counts as not held out; ids may repeat. No rows: no rows.
    Labels of held-out ids are never read; a label that is null counts as none.
    """
    model = fit(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score_udf(model)(text_of(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score under 0.5, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score_udf(model)(text_of(text_col)) < 0.5)
