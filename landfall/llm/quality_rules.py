"""Quality rules: a learned decision list over document statistics.

The statistics are native expressions over each whole text. Rules are learned from a
bounded sample of labelled statistics by sequential covering: a rule grows by the threshold
condition that raises its gain most, is pruned to the length that does best on the folds it was
not grown on, and the rows it covers leave before the next one. The list becomes one ordered
``CASE WHEN``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import SPACE_CHARS, SPACES

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_upper", "n_exclaim", "n_lines", "n_bars")

#: What conditions may test: shares of the counts above.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "bar_share": ("n_bars", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "exclaim_share": ("n_exclaim", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
}


@dataclass(frozen=True)
class Learning:
    max_sample: int = 20000  # labelled documents that are learned from at most
    max_rules: int = 8
    max_conditions: int = 3
    thresholds: int = 48  # candidate thresholds of a feature
    folds: int = 5  # parts of the sample, each judged by rules grown on the others
    min_precision: float = 0.9  # of a rule's length, on folds its rules were not grown on
    min_covered: int = 5  # rows that these cover at least
    min_share: float = 0.001  # and the same as a share of the sample
    seed: int = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = _share(*FEATURES[self.feature])
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x >= self.threshold if self.above else x < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1)).cast("double")


def _less_length(text: Column, removed: str) -> Column:
    """How many code points the pattern takes out of the text."""
    return (F.length(text) - F.length(F.regexp_replace(text, removed, ""))).cast("long")


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of COUNTS; a null text counts as empty. Native and without a shuffle.

    Words found again in 3-word windows are counted from the 64-bit hashes of a
    document's windows, sorted within the row.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(value, F.lit(SPACE_CHARS))
    one = docs.withColumns({
        "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)),
        "_lines": F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""),
        "word_chars": F.length(F.regexp_replace(value, SPACES, "")).cast("long"),
        "n_symbols": _less_length(value, r"[#*$%&|<>]"),
        "n_upper": _less_length(value, r"[A-Z]"),
        "n_exclaim": _less_length(value, "!"),
        "n_bars": _less_length(value, r"\|"),
    })
    w = F.col("_words")
    two = one.withColumns({
        "n_words": F.size(w).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.when(
            F.size(w) >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    }).drop("_words", "_lines")
    # Only texts with a repeated window have their windows sorted.
    h, s, j, p = (F.col(c) for c in ("_h", "_s", "_j", "_p"))
    three = two.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ),
    ).drop("_h")
    four = three.withColumn(
        "_j",
        F.when(
            s.isNotNull(),
            F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda i: s[i]["h"] == s[i - 1]["h"]),
        ),
    )
    five = four.withColumn(
        "_p",
        F.when(
            j.isNotNull(),
            F.sort_array(F.array_distinct(F.concat(
                F.transform(j, lambda i: s[i]["p"]), F.transform(j, lambda i: s[i - 1]["p"])
            ))),
        ),
    ).drop("_s", "_j")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x)),
        F.lit(0), lambda a, b: a + b,
    )
    return five.withColumn(
        "n_repeat_words", F.when(p.isNotNull(), covered).otherwise(0).cast("long")
    ).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, learning: Learning) -> list:
    """Counts and label of at most ``max_sample`` labelled documents, chosen by a hash of the id."""
    chosen = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id", F.lit(learning.seed)), "doc_id")
        .limit(learning.max_sample)
    )
    # At most max_sample rows of two numbers, which bounds the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Of rows that repeat an id one counts, so the labels bound the rows as well.
    rows = add_statistics(rows).groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS)).alias("c"))
    return sorted(rows.select("doc_id", "quality", "c.*").collect())


def _gain(bad: np.ndarray, good: np.ndarray, bad0: int, good0: int) -> np.ndarray:
    """Information gain of narrowing (bad0, good0) rows to (bad, good), per bad row kept."""
    with np.errstate(divide="ignore", invalid="ignore"):
        new = np.log2(bad / (bad + good))
        old = np.log2(bad0 / (bad0 + good0))
        return np.where(bad > 0, bad * (new - old), -np.inf)


def _candidates(values: dict[str, np.ndarray], thresholds: int) -> list[Condition]:
    found = []
    for name, x in values.items():
        cuts = np.unique(np.quantile(x, np.linspace(0, 1, thresholds + 1)[1:]))
        unique = np.unique(x)
        for cut in cuts:
            at = np.searchsorted(unique, cut)
            if 0 < at < len(unique):
                middle = float((unique[at - 1] + unique[at]) / 2)
                found += [Condition(name, True, middle), Condition(name, False, middle)]
    return found


def learn(rows: list, learning: Learning) -> list[Rule]:
    """Rules that find documents of quality 0, the first one to be tried first."""
    if not rows:
        return []
    raw = {c: np.array([r[c] for r in rows], float) for c in COUNTS}
    values = {f: raw[a] / np.maximum(raw[b], 1) for f, (a, b) in FEATURES.items()}
    bad = np.array([r["quality"] == 0 for r in rows])
    # The fixed rules decide first, so the list learns from what they leave.
    failed = (raw["n_words"] < 50) | (100 * raw["n_repeat_words"] > 50 * raw["n_words"])
    fold = _folds(bad, ~failed, learning)
    fewest = max(learning.min_covered, learning.min_share * len(rows))
    left, rules = ~failed, []
    while len(rules) < learning.max_rules and (bad & left).any():
        rule = _grow(values, bad, left, learning)
        length = _pruned_length(values, bad, left, fold, fewest, learning)
        if not rule or not length:
            break
        rules.append(rule[:length])
        left &= ~_covered(rule[:length], values, left)
    return rules


def _folds(bad: np.ndarray, rows: np.ndarray, learning: Learning) -> np.ndarray:
    """A fold per row; each fold gets its part of either label."""
    fold, rng = np.zeros(len(bad), int), np.random.default_rng(learning.seed)
    for label in (True, False):
        at = rng.permutation(np.flatnonzero(rows & (bad == label)))
        fold[at] = np.arange(len(at)) % learning.folds
    return fold


def _covered(rule: Rule, values: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    covers = rows.copy()
    for condition in rule:
        covers &= condition.holds(values)
    return covers


def _pruned_length(
    values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, fold: np.ndarray, fewest: float, learning: Learning
) -> int:
    """How many conditions the next rule keeps, 0 for no rule.

    For each fold a rule is grown on the others. The length whose rules together have the best
    value (b - g) / (b + g) on the folds they did not see is taken, the shortest of equals, if it
    is precise enough there and covers enough rows.
    """
    b, g = np.zeros(learning.max_conditions + 1, int), np.zeros(learning.max_conditions + 1, int)
    for f in range(learning.folds):
        rule = _grow(values, bad, rows & (fold != f), learning)
        for length in range(1, learning.max_conditions + 1):
            # A rule that stops growing earlier stays as it is.
            covers = _covered(rule[:length], values, rows & (fold == f)) if rule else np.zeros(len(bad), bool)
            b[length] += (covers & bad).sum()
            g[length] += (covers & ~bad).sum()
    covered = b + g
    fit = (covered >= fewest) & (b >= learning.min_precision * covered) & (covered > 0)
    value = np.where(fit, (b - g) / np.maximum(covered, 1), -np.inf)
    return int(value.argmax()) if fit.any() else 0


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, learning: Learning) -> Rule:
    rule: list[Condition] = []
    while len(rule) < learning.max_conditions and (rows & ~bad).any():
        options = _candidates({f: x[rows] for f, x in values.items()}, learning.thresholds)
        if not options:
            break
        b = np.array([(c.holds(values) & rows & bad).sum() for c in options])
        g = np.array([(c.holds(values) & rows & ~bad).sum() for c in options])
        gains = _gain(b, g, int((rows & bad).sum()), int((rows & ~bad).sum()))
        best = int(gains.argmax())
        if not gains[best] > 1e-9:
            break
        rule.append(options[best])
        rows = rows & options[best].holds(values)
    return tuple(rule)


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the number of the first rule that fires, else null."""
    fired = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        condition = rule[0].column()
        for further in rule[1:]:
            condition &= further.column()
        fired = F.when(condition, F.lit(number)).otherwise(fired)
    return fired


def apply_rules(docs: DataFrame, rules: list[Rule], columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, base_failed, the rule that fired and kept for every row of ``docs``.

    Null and empty texts have no words, so they fail the fixed rules and are not kept. Rows
    with the same id or text are judged one by one; other columns take no part.
    """
    rows = add_statistics(docs.select(*columns, "text")).withColumn("base_failed", base_failed())
    rows = rows.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return rows.select(
        *columns, *BASE, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule"
    )


def judge(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> DataFrame:
    """Learn a list from ``labels`` and apply it. Without usable labels only the fixed rules count."""
    return apply_rules(docs, learn(labelled_sample(docs, labels, learning), learning))
