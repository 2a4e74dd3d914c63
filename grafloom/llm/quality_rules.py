"""Quality rules: a decision list learned by sequential covering, run as one conditional expression.

Conjunctions of thresholds on text statistics are grown for the bad class by information gain on two
thirds of the labelled rows and pruned on the rest; each accepted rule takes its rows away and the
next is learned from what is left. The list becomes an ordered chain of `when` expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import bare, materialise
from grafloom.llm.text_stats import with_stats

#: Labelled rows that a list is learned from, at most: those of the smallest id hashes.
MOST_LABELLED = 6000
#: Thresholds tried for each statistic, and conditions in a rule.
MOST_THRESHOLDS, MOST_CONDITIONS = 48, 4
#: A rule must be right on so many of the pruning rows it covers, and cover so many rows.
LEAST_PRECISION, LEAST_COVER = 0.95, 12

#: The statistics that rules speak of, each a ratio that doesn't grow with the text.
FEATURES = {
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound

    @property
    def expression(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), dtype=bool)
    for c in rule:
        out &= c.covers(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule, inside = (), np.ones(len(bad), dtype=bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any():
        p0, n0, best = (inside & bad).sum(), (inside & ~bad).sum(), (0.0, None, None)
        base = log2(p0 / (p0 + n0))
        for feature, values in x.items():
            seen = np.unique(values[inside])
            at = np.unique(np.linspace(0, len(seen) - 1, MOST_THRESHOLDS).astype(int))[:-1]
            at = np.union1d(at, np.searchsorted(seen, np.quantile(values[inside], np.linspace(0, 1, MOST_THRESHOLDS), method="lower")))
            for bound in (seen[at[at < len(seen) - 1]] + seen[at[at < len(seen) - 1] + 1]) / 2:  # halfway to the next value, clear of either class
                for above in (True, False):
                    c = Condition(feature, above, float(bound))
                    now = inside & c.covers(x)
                    p, n = (now & bad).sum(), (now & ~bad).sum()
                    if p and (gain := p * (log2(p / (p + n)) - base)) > best[0]:
                        best = (gain, c, now)
        if best[1] is None:
            break
        rule, inside = (*rule, best[1]), best[2]
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (right - wrong) / covered."""

    def worth(r: Rule) -> float:
        c = covers(r, x)
        return float((c & bad).sum() - (c & ~bad).sum()) / max(1, c.sum())

    return max((rule[:i] for i in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def _tightest(rule: Rule) -> Rule:
    """The rule without conditions that another one implies."""
    best = {}
    for c in rule:
        key = (c.feature, c.above)
        if key not in best or (c.bound > best[key].bound) == c.above:
            best[key] = c
    return tuple(best.values())


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 3, most_rules: int = 12) -> list[Rule]:
    """An ordered list of rules for the bad rows; none if there are too few of either class."""
    rules, left = [], np.ones(len(bad), dtype=bool)
    part = np.random.default_rng(seed).permutation(len(bad)) % 3 == 0
    while len(rules) < most_rules:
        grow, check = left & ~part, left & part
        if (grow & bad).sum() < LEAST_COVER or not (grow & ~bad).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow])
        if not rule:
            break
        rule = _prune(rule, {k: v[check] for k, v in x.items()}, bad[check])
        inside = covers(rule, x) & left
        seen = inside & part
        if inside.sum() < LEAST_COVER or (inside & bad).sum() < LEAST_PRECISION * inside.sum() or (seen & bad).sum() < LEAST_PRECISION * seen.sum():
            break
        rules.append(_tightest(rule))
        left &= ~inside
    return rules


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labelled: int = MOST_LABELLED) -> list[Rule]:
    """Learns from at most `most_labelled` labelled ids that are in `docs` (label 0 is bad); null ids, labels and texts are not learned from. An id of several rows is one example: that of the smallest statistics."""
    y = bare(labels, id_col, label_col).toDF("id", "y").where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    rows = bare(docs, id_col, text_col).toDF("id", "text").where("text is not null")
    y = materialise(y.join(rows.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most_labelled), "labels")
    stats = with_stats(rows.join(F.broadcast(y), "id"), "text").select("id", "y", F.struct(*[F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()]).alias("x"))
    found = stats.groupBy("id", "y").agg(F.min("x").alias("x")).collect()
    found.sort(key=lambda r: r["id"])
    return learn({k: np.array([r["x"][k] for r in found], dtype=float) for k in FEATURES}, np.array([r["y"] == 0 for r in found], dtype=bool)) if found else []


def first_rule(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that covers a row of statistics; null if none does."""
    out = F.lit(None).cast("int")
    for n, rule in reversed([*enumerate(rules, 1)]):
        whole = rule[0].expression
        for c in rule[1:]:
            whole &= c.expression
        out = F.when(whole, F.lit(n)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the base statistics, `base_failed`, `rule` (first learned rule that covers it) and `kept`.

    Null or wordless texts have no words and fail the base rules; texts of any length are read whole. Repeated rows are judged alike, null ids are
    returned, an empty table gives no rows, further columns are not looked at.
    """
    rows = with_stats(bare(docs, id_col, text_col).toDF("__id", "__text"), "__text").drop("__text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, "rule": first_rule(rules)})
    return rows.select(F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))
