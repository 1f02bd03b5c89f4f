"""Quality rules as a learned decision list, by DataFrame functions only.

Statistics of every whole text are computed once. Rules are learned from the labelled rows
by sequential covering: a rule grows by the threshold condition of the highest gain until it
covers no good row, is pruned on rows held back for that, and its rows leave before the next
one grows. The list comes out as ordered conditional expressions (`verdict`).

Rows: a null text has no words and fails the base rules, as every text of fewer than 50
words does. Repeated rows are judged each. Rows without a label, or labelled other than 0
and 1, teach nothing; without labels of both kinds the list is empty and keeps what passes
the base rules. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import written

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = UPPER.lower()
DIGITS = "0123456789"
MARKS = "!?;:()[]{}\"'/\\_=+~^`@-"
MIN_WORDS = 50
# Thresholds tried for each statistic, rules of a list and conditions of a rule.
CUTS, RULES, CONDITIONS = 24, 8, 4
# A rule must be right on so many of the rows that it is pruned on, and cover so many.
PRECISION, COVERED = 0.8, 5


class Condition(NamedTuple):
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.name) > self.cut if self.above else F.col(self.name) <= self.cut


Rule = list[Condition]


def number_of(chars: str) -> Column:
    return F.length("text") - F.length(F.translate("text", chars, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    windows = F.transform(
        F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))
    )
    ordered = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    again = F.filter(
        "ordered",
        lambda x, i: (x["h"] == F.get("ordered", i - 1)["h"]) | (x["h"] == F.get("ordered", i + 1)["h"]),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("again", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    counts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        words.alias("w"),
        lines.alias("lines"),
        (F.length("text") - number_of(SPACES)).alias("word_chars"),
        number_of(SYMBOLS).alias("n_symbols"),
        number_of(UPPER).alias("n_upper"),
        number_of(SMALL).alias("n_small"),
        number_of(DIGITS).alias("n_digits"),
        number_of(MARKS).alias("n_marks"),
    )
    counts = (
        counts.withColumn("n_words", F.size("w"))
        .withColumn("n_lines", F.size("lines"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines")))
        .withColumn("windows", windows)
        .withColumn("repeats", F.size("windows") != F.size(F.array_distinct("windows")))
        # Only texts in which a window comes twice need the places of the windows.
        .withColumn("ordered", F.when(F.col("repeats"), ordered))
        .withColumn("again", F.when(F.col("repeats"), again))
        .withColumn("n_repeat_words", F.when(F.col("repeats"), covered).otherwise(0))
        .withColumn("n_distinct", F.size(F.array_distinct("w")))
        .drop("w", "lines", "windows", "repeats", "ordered", "again")
    )
    return counts.select("doc_id", *[F.col(c).cast("long").alias(c) for c in counts.columns[1:]])


def with_ratios(counts: DataFrame) -> DataFrame:
    """Adds the statistics that rules may test, none of which depends on the length alone."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return counts.withColumns(
        {
            "word_length": F.col("word_chars") / words,
            "symbols_a_word": F.col("n_symbols") / words,
            "dup_lines": F.col("n_dup_lines") / lines,
            "repeated": F.col("n_repeat_words") / words,
            "upper": F.col("n_upper") / chars,
            "small": F.col("n_small") / chars,
            "digits": F.col("n_digits") / chars,
            "marks_a_word": F.col("n_marks") / words,
            "words_a_line": F.col("n_words") / lines,
            "distinct": F.col("n_distinct") / words,
        }
    )


RATIOS = ["word_length", "symbols_a_word", "dup_lines", "repeated", "upper", "small", "digits", "marks_a_word", "words_a_line", "distinct"]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def bin_of(name: str, cuts: list[float]) -> Column:
    """How many of the cuts a statistic is above."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < F.col(name)))


def learn(labelled: DataFrame, seed: int = 5) -> list[Rule]:
    """Rules for `bad` rows, in order, from rows with the ratios, doc_id and bad (boolean).

    Every step counts over all labelled rows; the driver sees counts by statistic and cut only.
    """
    cuts = labelled.agg(*[F.percentile_approx(c, [(i + 0.5) / CUTS for i in range(CUTS)], 10_000).alias(c) for c in RATIOS]).first()
    if cuts[RATIOS[0]] is None:
        return []
    cuts = {c: sorted({float(x) for x in cuts[c]}) for c in RATIOS}
    bins = F.array(*[bin_of(c, cuts[c]) for c in RATIOS])
    rows = written(
        labelled.select("bad", (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(3)) > 0).alias("grow"), *RATIOS, bins.alias("bins")), "rule-rows"
    )
    rules: list[Rule] = []
    while len(rules) < RULES:
        open_rows = rows.where(~verdict(rules).isNotNull()) if rules else rows
        rule = grown(open_rows.where("grow"), cuts)
        if rule:
            rule = pruned(open_rows.where("not grow"), rule)
        if not rule:
            break
        rules.append(rule)
    return rules


def grown(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Add the condition of the highest gain until no good row is covered or none gains."""
    from math import log2

    rule: Rule = []
    while len(rule) < CONDITIONS:
        counts: dict[str, list[list[int]]] = {c: [[0] * (len(cuts[c]) + 1) for _ in range(2)] for c in RATIOS}
        found = rows.where(holds(rule)).select("bad", F.posexplode("bins").alias("at", "bin")).groupBy("at", "bin", "bad").count().collect()
        for at, bin_, bad, n in found:
            counts[RATIOS[at]][int(bad)][bin_] += n
        good, bad = (sum(counts[RATIOS[0]][k]) for k in (0, 1))
        if not bad or not good:
            break
        best, choice = 0.0, None
        for name in RATIOS:
            for i, cut in enumerate(cuts[name]):
                for above in (True, False):
                    # A value in bin b is above the first b cuts.
                    n, p = (sum(counts[name][k][i + 1 :] if above else counts[name][k][: i + 1]) for k in (0, 1))
                    gain = p * (log2(p / (p + n)) - log2(bad / (bad + good))) if p else 0.0
                    if gain > best + 1e-9:
                        best, choice = gain, Condition(name, above, cut)
        if choice is None:
            break
        rule.append(choice)
    return rule


def pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule with the best balance on rows that did not grow it; none if it is not precise."""
    counts = rows.agg(
        *[F.count_if(holds(rule[:i]) & (F.col("bad") == bad)).alias(f"{kind}{i}") for i in range(1, len(rule) + 1) for kind, bad in (("p", True), ("n", False))]
    ).first()
    scored = [((counts[f"p{i}"] - counts[f"n{i}"]) / max(1, counts[f"p{i}"] + counts[f"n{i}"]), -i) for i in range(1, len(rule) + 1)]
    best = -max(scored)[1]
    p, n = counts[f"p{best}"], counts[f"n{best}"]
    return rule[:best] if p + n >= COVERED and p >= PRECISION * (p + n) else []


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(holds(rule), F.lit(number)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The base counts of every document and whether it is kept: its rule, if one rejects it, follows."""
    counts = written(statistics(docs), "rule-counts")
    stats = with_ratios(counts)
    marked = labels.where("quality in (0, 1)").select("doc_id", (F.col("quality") == 0).alias("bad"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # The list decides on what passes the base rules, so it learns from that.
    rules = learn(stats.where(~base).join(marked, "doc_id"))
    return stats.withColumn("rule", verdict(rules)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.col("rule").isNull()).alias("kept"),
        "rule",
    )
