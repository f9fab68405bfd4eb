"""Quality rules: a learned decision list over statistics of each text.

Statistics are DataFrame functions over one row at a time. The list is learned by sequential covering
from labelled documents: a rule grows by the threshold that gains most information on two thirds of the
documents not yet covered, is pruned by its last conditions on the other third and stays if it is
precise there. The rules become one ordered conditional expression, so the scan stays inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import WORD_SPACE, WORD_SPACE_CLASS, bounded_sample, once, text_of

#: The list is fitted on so many labelled documents at most, those with the least hash of the id.
SAMPLE = 20_000
MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 12, 3, 96
#: A rule must be so precise on documents that did not grow it.
MIN_PRECISION = 0.9

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaims", "n_distinct_words", "n_lines")
#: What thresholds are learned on, from the counts.
RATIOS = {
    "symbols_per_word": "n_symbols / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "mean_word_chars": "word_chars / n_words",
    "upper_share": "n_upper / word_chars",
    "exclaims_per_word": "n_exclaims / n_words",
    "distinct_share": "n_distinct_words / n_words",
}


def repeat_words(words: Column, hashes: Column, order: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more. hashes: of the windows; order: (hash, position), sorted."""
    twice = F.filter(
        order,
        lambda e, i: ((i > 0) & (F.get(order, i - 1)["h"] == e["h"])) | (F.get(order, i + 1)["h"] == e["h"]),
    )
    return F.sort_array(F.transform(twice, lambda e: e["p"]))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and COUNTS (long). A null text counts as an empty one: no words, one line.

    Windows are compared by a 64-bit hash of their three words within one text. A text whose windows all differ skips the sort.
    """
    text = text_of(text_col)
    base = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    base = base.select(
        "id",
        F.filter(F.split("t", WORD_SPACE_CLASS + "+"), lambda w: w != "").alias("w"),
        F.split("t", "\n").alias("lines"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^!]+", "")).alias("n_exclaims"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).alias("n_upper"),
    )
    worded = F.filter("lines", lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    base = base.select(
        "id", "w", "n_symbols", "n_exclaims", "n_upper", worded.alias("worded"), F.size("lines").alias("n_lines"), F.size("w").alias("n"),
        F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2))), 1, F.greatest(F.size("w") - 2, F.lit(0))).alias("h"),
    )
    unlike = F.size(F.array_distinct("h")) == F.size("h")
    none = F.expr("cast(array() as array<struct<h: bigint, p: int>>)")
    base = base.withColumn("order", F.when(unlike, none).otherwise(F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    base = base.withColumn("at", repeat_words(F.col("w"), F.col("h"), F.col("order")))
    steps = F.zip_with(F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0))), F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(3)))
    repeated = F.when(F.size("at") == 0, F.lit(0)).otherwise(F.lit(3) + F.aggregate(steps, F.lit(0), lambda s, x: s + x))
    made = {
        "n_words": F.col("n"), "word_chars": F.length(F.array_join("w", "")), "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("worded") - F.size(F.array_distinct("worded")), "n_repeat_words": repeated,
        "n_upper": F.col("n_upper"), "n_exclaims": F.col("n_exclaims"), "n_distinct_words": F.size(F.array_distinct("w")), "n_lines": F.col("n_lines"),
    }
    return once(base.select("id", *(c.cast("long").alias(k) for k, c in made.items())))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def ratios() -> dict[str, Column]:
    parts = {k: v.split(" / ") for k, v in RATIOS.items()}
    return {k: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)) for k, (a, b) in parts.items()}


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = ratios()[self.name]
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, list(RATIOS).index(self.name)]
        return value > self.threshold if self.above else value <= self.threshold


def _covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS:
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for j, name in enumerate(RATIOS):
            values = np.unique(x[inside, j])
            if len(values) < 2:
                continue
            middles = (values[1:] + values[:-1]) / 2
            if len(middles) > THRESHOLDS:
                middles = np.unique(np.quantile(middles, np.linspace(0, 1, THRESHOLDS)))
            good_values, bad_values = np.sort(x[inside & ~bad, j]), np.sort(x[inside & bad, j])
            for above in (True, False):
                pb, nb = np.searchsorted(bad_values, middles, "right"), np.searchsorted(good_values, middles, "right")
                pc, nc = (p - pb, n - nb) if above else (pb, nb)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(pc > 0, pc * (np.log2(np.maximum(pc, 1e-9) / np.maximum(pc + nc, 1e-9)) - np.log2(p / (p + n))), 0)
                k = int(np.argmax(gains))
                if gains[k] > gain:
                    best, gain = Condition(name, above, float(middles[k])), float(gains[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def learn_rules(x: np.ndarray, bad: np.ndarray) -> list[list[Condition]]:
    """Ordered conjunctions for bad rows; x has the RATIOS as columns. Nothing precise to learn: no rules."""
    rules: list[list[Condition]] = []
    left = np.ones(len(x), dtype=bool)
    prune_rows = np.arange(len(x)) % 3 == 2
    while len(rules) < MAX_RULES:
        grow, prune = left & ~prune_rows, left & prune_rows
        if (bad & grow).sum() < 3:
            break
        rule = _grow(x[grow], bad[grow])

        def worth(r: list[Condition]) -> tuple[float, int, int]:
            c = _covered(r, x[prune])
            p, n = int((bad[prune] & c).sum()), int((~bad[prune] & c).sum())
            return (p - n) / max(p + n, 1), p, n

        if not rule:
            break
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r)[0])
        _, p, n = worth(rule)
        if p < 1 or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~_covered(rule, x)
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[list[Condition]]:
    """Learn from the labelled texts that pass the base rules, each distinct text once; SAMPLE rows of numbers at most come to the driver, however often ids repeat."""
    some = bounded_sample(docs, labels.withColumn("_bad", (F.col("quality") == 0).cast("int")), "_bad", SAMPLE, id_col, text_col)
    stats = statistics(some.select(F.struct(F.xxhash64("text").alias("h"), "label").alias("key"), "text"), "key", "text")
    rows = stats.where(~base_failed()).select("id.h", "id.label", *(c.alias(k) for k, c in ratios().items())).orderBy("h", "label").collect()
    if not rows:
        return []
    return learn_rules(np.array([[r[k] for k in RATIOS] for r in rows], dtype=float), np.array([r["label"] == 1 for r in rows]))


def verdict(rules: list[list[Condition]]) -> Column:
    """The ordered conditional expression: False for base failures and each rule in turn, else True."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        all_of = rule[0].column()
        for c in rule[1:]:
            all_of = all_of & c.column()
        out = out.when(all_of, F.lit(False))
    return out.otherwise(F.lit(True))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, COUNTS, base_failed, kept for each row of docs.

    Null texts have no words and fail the base rules. Ids may be null or repeated: each row gives a row. Without labels only the base rules hold.
    """
    rules = fit_rules(docs, labels, id_col, text_col)
    return statistics(docs, id_col, text_col).select(F.col("id").alias(id_col), *COUNTS, base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    rules = fit_rules(docs, labels, id_col, text_col)
    stats = statistics(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), "row", "text")
    return stats.where(verdict(rules)).select(*(F.col("id").getField(c).alias(c) for c in docs.columns))
