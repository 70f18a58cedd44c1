"""Quality rules: fixed base limits and a learned decision list over text statistics.

Statistics, rules and verdicts are Spark column expressions.  The list is learned by
sequential covering (grow a conjunction of thresholds on two thirds of the labelled rows,
prune it on the rest, drop what it covers, repeat) on the driver from a bounded sample of
labelled statistics, then applied as one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from climgrid.llm.store import smallest_hashed
from climgrid.llm.text import SPACE_CHARS, SPACES

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    """Code points of ``text`` that are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def windows(w: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        return F.sort_array(keys)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (x.h == F.get(s, k - 1).h) | (x.h == F.get(s, k + 1).h))
        return F.sort_array(F.transform(twice, lambda x: x.i))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return _bind(words, lambda w: F.when(F.size(w) >= 3, _bind(_bind(windows(w), repeated), covered)).otherwise(0))


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and counts of each text, plus ``n_lines`` (with a word), ``n_capitals``
    (A-Z), ``n_bangs`` and ``n_distinct`` (words)."""
    text = F.coalesce("text", F.lit(""))
    chars = F.lit(SPACE_CHARS)
    base = docs.select("doc_id", text.alias("text"), F.trim(text, chars).alias("_t"))
    split = base.select(
        "doc_id",
        "text",
        F.when(F.length("_t") == 0, F.array().cast("array<string>")).otherwise(F.split("_t", SPACES)).alias("_w"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x, chars)) > 0).alias("_l"),
    )
    return split.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        (F.length("text") - _without(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        _without(F.col("text"), CAPITALS).cast("long").alias("n_capitals"),
        _without(F.col("text"), "!").cast("long").alias("n_bangs"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
    )


#: What the rules may look at: one count over another, so that the length of a text does not matter.
FEATURES = {
    "symbol_share": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "capital_share": ("n_capitals", "word_chars"),
    "bang_share": ("n_bangs", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}


def feature(name: str) -> Column:
    above, below = FEATURES[name]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)


def base_failed() -> Column:
    """Too short, or mostly repeats."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(feature, sign, threshold)``; sign ">" or "<="; ``kept``: its verdict."""

    tests: tuple[tuple[str, str, float], ...]
    kept: bool

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, at in self.tests:
            out &= x[name] > at if sign == ">" else x[name] <= at
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, sign, at in self.tests:
            out = out & (feature(name) > at if sign == ">" else feature(name) <= at)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {t:.6g}" for n, s, t in self.tests)


def _grow(x: dict, bad: np.ndarray, most: int, steps: int) -> list[tuple[str, str, float]]:
    """Add the threshold of largest information gain until no good row is covered."""
    tests, inside = [], np.ones(len(bad), bool)
    while len(tests) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best = (1e-9, None, None)
        for name, all_values in x.items():
            values, flag = all_values[inside], bad[inside]
            order = np.argsort(values, kind="stable")
            v, hits = values[order], np.concatenate([[0], np.cumsum(flag[order])])
            cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
            if len(cuts) > steps:
                cuts = cuts[np.linspace(0, len(cuts) - 1, steps).astype(int)]
            for sign, pos, size in ((">", p - hits[cuts], len(v) - cuts), ("<=", hits[cuts], cuts)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / size) - np.log2(p / (p + n))), 0)
                if len(gain) and (k := int(gain.argmax())) is not None and gain[k] > best[0]:
                    at = float(v[cuts[k] - 1] + v[cuts[k]]) / 2
                    best = (gain[k], (name, sign, at), values > at if sign == ">" else values <= at)
        if best[1] is None:
            break
        tests.append(best[1])
        inside[np.flatnonzero(inside)[~best[2]]] = False
    return tests


def learn_rules(
    x: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 12, most_tests: int = 4,
    precision: float = 0.9, steps: int = 512, seed: int = 7, few: int = 30,
) -> list[Rule]:
    """Ordered rules that reject; what no rule covers is kept.

    A rule enters when it is right on ``precision`` of the rows it covers in the growing
    and in the pruning part; the first that is not ends the list.  Rows left over by
    earlier rules only are looked at, ties between tests go to the earlier feature, and
    the split into parts depends on ``seed`` alone; with fewer than ``few`` bad rows all rows
    serve for both.  No labelled rows or none that are
    bad: no rules.
    """
    part = np.random.Generator(np.random.PCG64(seed)).random(len(bad)) < 2 / 3
    grown, pruned = (part, ~part) if bad.sum() >= few else (np.ones(len(bad), bool),) * 2
    left, rules = np.ones(len(bad), bool), []
    score = lambda rule, rows: (bad[rows & (h := rule.holds(x))].sum(), (rows & h).sum())
    while len(rules) < most_rules and bad[left & grown].any() and bad[left & pruned].any():
        tests = _grow({k: v[left & grown] for k, v in x.items()}, bad[left & grown], most_tests, steps)
        if not tests:
            break

        def worth(n: int) -> float:
            hit, size = score(Rule(tuple(tests[:n]), False), left & pruned)
            return (2 * hit - size) / max(size, 1)

        rule = Rule(tuple(tests[: max(range(1, len(tests) + 1), key=lambda n: (worth(n), -n))]), False)
        if any(hit < precision * size or not size for hit, size in (score(rule, left & grown), score(rule, left & pruned))):
            break
        rules.append(rule)
        left &= ~rule.holds(x)
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, **options) -> list[Rule]:
    """Learn from at most ``fit_rows`` labelled documents, those of smallest hashed doc_id.

    The bounded sample of labels is drawn first and sent to the documents, so only their
    texts are counted and no text is shuffled.  Documents that fail the base limits are
    not shown to the learner.  Null labels are left out; a document labelled twice counts
    twice.
    """
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    sample = smallest_hashed(known, "doc_id", fit_rows, "quality")
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    counted = text_statistics(chosen).join(F.broadcast(sample), "doc_id")
    rows = counted.select("doc_id", "quality", base_failed().alias("_f"), *[feature(n).alias(n) for n in FEATURES]).collect()
    # a filter on the counts would be moved in front of the sample's join, and count every text
    rows = sorted((r for r in rows if not r["_f"]), key=tuple)
    x = {n: np.array([r[n] for r in rows], float) for n in FEATURES}
    return learn_rules(x, np.array([r["quality"] == 0 for r in rows], bool), **options)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, number of the rule that decided: 0 the base limits, null none)."""
    kept, by = F.when(base_failed(), F.lit(False)), F.when(base_failed(), F.lit(0))
    for i, rule in enumerate(rules, 1):
        kept, by = kept.when(rule.column(), F.lit(rule.kept)), by.when(rule.column(), F.lit(i))
    return kept.otherwise(True), by


def quality_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``rule`` of each document, in one scan.

    A null or empty text has no words and fails the base limits; a null doc_id is judged
    like any other; other columns of ``docs`` are ignored.
    """
    kept, by = verdict(fit_rules(docs, labels, fit_rows))
    return text_statistics(docs).select("doc_id", *COUNTS, base_failed().alias("base_failed"), kept.alias("kept"), by.alias("rule"))


def reject_bad(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``, in one scan."""
    kept, _ = verdict(fit_rules(docs, labels, fit_rows))
    names = [f"`{c}`" for c in docs.columns]
    # the whole row travels in place of the id, so that its names cannot clash
    rows = text_statistics(docs.select(F.struct(*names).alias("doc_id"), F.col("text")))
    return rows.where(kept).select("doc_id.*")
