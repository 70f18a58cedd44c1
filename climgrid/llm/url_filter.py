"""URL filters: host rules, and where none fits a ratio of two character language models.

Rules (allow or block a host with its subdomains, from a path on) are a few values, applied
as one expression; the longest that fits wins.  The URLs that rules decide teach two models
of characters, one of accepted and one of rejected URLs.  Each is a Markov model of variable
order: the probability of a character after a context of ``order`` characters is smoothed
with that after the context's end, and so on down to a uniform one, by the number of
different characters that followed (Witten and Bell); a context never seen counts for
nothing, so the order that decides varies from place to place.

Counts are exact and cover all URLs that rules decide, but for one in ``hold`` (by hash of
the URL), on which the score is calibrated: a logistic curve over the difference of the two
log-likelihoods, divided by the length.  All counting, smoothing and looking up is grouping
and joining of n-gram tables that grow with the data.  N-grams that make up more than 1 in
``COMMON`` of all places are met by broadcast (there can be no more than ``COMMON`` of them),
so that no n-gram of the others is a hot key.

A url that is null or without ``://`` has an empty host and path; it is judged by the models
as any other text, a null one as an empty text.  Equal URLs have equal scores.  A class
without any URL is a uniform model; where one class has no URL held out, the curve is the
plain logistic function.  Differences are summed as whole numbers (of 1e-9), so results do
not depend on the order of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from climgrid.llm.store import written

Rule = tuple[str, str, str]  # allow or block, host, path

START, END = "\x02", "\x03"
COMMON = 1 << 15
STRETCH = 256
UNIT = 1e9
BINS = 100  # of the score, per unit, for calibration
MOST = 30  # scores are cut to +-MOST for calibration


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    whole = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)([^?#]*)", 2)
    return F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (host and path in one string) and its verdict, or NULL."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    rule = verdict = None
    for what, h, p in longest:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _places(df: DataFrame, order: int, *keep) -> DataFrame:
    """One row per character of ``chars`` and its end: the n-gram that ends there.  A text is
    first cut into overlapping stretches, since finding a place in it takes time in proportion."""
    text = F.concat(F.lit(START * order), F.col("chars"), F.lit(END))
    each = df.select(*keep, text.alias("_t"), F.length("chars").alias("_n"))
    each = each.select(*keep, "_t", "_n", F.explode(F.sequence(F.lit(0), F.col("_n"), F.lit(STRETCH))).alias("_j"))
    part = F.substr("_t", F.col("_j") + 1, F.lit(STRETCH + order))
    each = each.select(*keep, part.alias("_t"), F.least(F.lit(STRETCH), F.col("_n") + 1 - F.col("_j")).alias("_n"))
    spots = F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")
    return each.select(*keep, "_t", spots).select(*keep, F.substr("_t", F.col("_i"), F.lit(order + 1)).alias("gram"))


def gram_counts(urls: DataFrame, order: int) -> DataFrame:
    """(gram, a, r, n): how often each n-gram stands in learning URLs that are accepted
    (a) and rejected (r), and in all URLs (n)."""
    places = _places(urls, order, "teaches")
    of = lambda what: F.count(F.when(F.col("teaches") == what, 1))
    return places.groupBy("gram").agg(of("allow").alias("a"), of("block").alias("r"), F.count(F.lit(1)).alias("n"))


def smoothed(grams: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log of the accepted over the rejected probability of the last
    character of each n-gram after the others, in units of 1e-9."""
    levels = [grams.select("gram", "a", "r")]
    for k in range(order, 0, -1):  # an n-gram's count is the sum of those that end in it
        shorter = F.substr("gram", F.lit(2))
        levels.append(levels[-1].groupBy(shorter.alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    # all characters that occur, and one for those that do not
    letters = levels[-1].agg((F.count(F.lit(1)) + 1).cast("double").alias("_letters"))
    known = None
    for k, level in enumerate(reversed(levels)):
        context = F.substr("gram", F.lit(1), F.lit(k)) if k else F.lit("")
        seen = lambda c: F.count(F.when(F.col(c) > 0, 1))
        totals = level.groupBy(context.alias("_c")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"), seen("a").alias("ta"), seen("r").alias("tr")
        )
        rows = level.withColumn("_c", context).join(totals, "_c").drop("_c")
        if known is None:
            rows = rows.withColumn("pa", 1 / letters.scalar()).withColumn("pr", F.col("pa"))
        else:
            rows = rows.withColumn("_s", F.substr("gram", F.lit(2))).join(known, "_s").drop("_s")
        blend = lambda n, p, total, kinds: F.when(
            F.col(total) > 0, (F.col(n) + F.col(kinds) * F.col(p)) / (F.col(total) + F.col(kinds))
        ).otherwise(F.col(p))
        here = rows.select("gram", blend("a", "pa", "na", "ta").alias("pa"), blend("r", "pr", "nr", "tr").alias("pr"))
        known = here.withColumnRenamed("gram", "_s")
    ratio = F.rint((F.log("pa") - F.log("pr")) * UNIT).cast("long")
    return here.select("gram", ratio.alias("ratio"))


def curve(held: DataFrame) -> tuple[float, float]:
    """Slope and middle of the logistic curve of acceptance over the score, fitted to the
    held-out URLs with both classes weighing alike.

    The driver sees counts per hundredth of the score, 2 * MOST * BINS + 1 numbers a class
    at most."""
    place = F.least(F.greatest(F.rint(F.col("llr") * BINS), F.lit(-MOST * BINS)), F.lit(MOST * BINS)).cast("int")
    counts = held.groupBy(place.alias("bin")).agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("a"), F.count(F.when(F.col("ruled") == "block", 1)).alias("r")
    )
    rows = counts.orderBy("bin").collect()
    x = np.array([row["bin"] for row in rows], float) / BINS
    a, r = (np.array([row[c] for row in rows], float) for c in "ar")
    if not a.sum() or not r.sum():
        return 1.0, 0.0
    a, r = a / a.sum() / 2, r / r.sum() / 2
    w = np.array([0.0, 1.0])  # intercept, slope
    design = np.stack([np.ones_like(x), x])
    for _ in range(50):  # Newton's method with a little ridge: separable classes stay finite
        p = 1 / (1 + np.exp(-np.clip(w @ design, -500, 500)))
        slope = design @ (p * (a + r) - a) + 1e-4 * (w - [0.0, 1.0])
        bend = (design * (p * (1 - p) * (a + r))) @ design.T + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    if w[1] <= 0:  # held-out URLs that gainsay the models: leave the score as it is
        return 1.0, 0.0
    return float(w[1]), float(-w[0] / w[1])


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", *, order: int = 4, hold: int = 4, allow_from: float = 0.5
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``llr`` (the
    length-normalised log-likelihood difference) and ``score`` (its calibrated probability
    of acceptance).  Columns of these names are replaced."""
    names = ("host", "path", "rule", "verdict", "llr", "score")
    mine = {"_page", "ruled", "teaches", "chars", "sum", "gram", "ratio", *names}
    if url in mine:
        raise ValueError(f"the url column may not be called {url!r}")
    host, path = host_and_path(F.col(url))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in mine]
    base = pages.select(*kept, host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("_page"))
    base = base.withColumns({"rule": rule, "ruled": verdict})
    # the text that the models read: the host in lower case, the rest as it is, without the scheme
    rest = F.substr(F.col(url), F.instr(F.col(url), "://") + 3 + F.length("host"))
    chars = F.when(F.instr(F.col(url), "://") > 0, F.concat("host", rest)).otherwise(F.coalesce(F.col(url), F.lit("")))
    teaches = F.when(F.pmod(F.xxhash64("chars"), F.lit(hold)) != 0, F.col("ruled"))
    base = written(base.withColumn("chars", F.regexp_replace(chars, f"[{START}{END}]", " ")).withColumn("teaches", teaches), "urls")
    counts = written(gram_counts(base, order), "grams")
    ratios = written(smoothed(counts, order).join(counts.select("gram", "n"), "gram"), "ratios")
    total = ratios.agg(F.sum("n")).scalar()
    common = F.col("n") * COMMON > total
    places = _places(base, order, "_page")
    hot = F.broadcast(ratios.where(common).select("gram", "ratio"))
    met = places.join(hot, "gram").groupBy("_page").agg(F.sum("ratio").alias("sum"))
    rare = places.join(F.broadcast(ratios.where(common).select("gram")), "gram", "left_anti")
    rare = rare.join(ratios.where(~common).select("gram", "ratio"), "gram").groupBy("_page").agg(F.sum("ratio").alias("sum"))
    sums = met.unionByName(rare).groupBy("_page").agg(F.sum("sum").alias("sum"))
    llr = F.col("sum") / UNIT / (F.length("chars") + 1)
    scored = written(base.join(sums, "_page").withColumn("llr", llr), "scored")
    slope, middle = curve(scored.where(F.col("ruled").isNotNull() & F.col("teaches").isNull()))
    score = 1 / (1 + F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), (F.col("llr") - middle) * -slope))))
    out = scored.withColumn("score", score)
    own = F.when(F.col("score") >= allow_from, "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce("ruled", own)).select(*kept, *names)
