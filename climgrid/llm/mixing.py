"""Mixing sources to target weights by balanced sampling (the cube method).

A source's target over its size is the number of times each of its documents should be
taken: the whole part is certain, the fraction is an inclusion probability.  The flight
phase moves the probabilities of three documents at a time along the direction that keeps
both balances, tokens and documents, until one of them is 0 or 1.  It goes either way, by
a seeded draw that keeps what is expected of each document.  It runs in blocks of a
source, and what is undecided moves on to blocks of the next level, until one block a
source is left with a dozen documents: the landing, drawn among the choices near to the
tokens.  Documents over 2 % of a source's expected tokens fly first, among themselves; the
few of them that stay open are drawn, and the probability of the source's others shifts by
what that draw put in or left out, so that the landing is one of small documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from climgrid.llm.store import written
from climgrid.llm.text import SPACE_CHARS, SPACES

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 4096
LANDING = 12
EDGE = 1e-9
#: Documents over this part of their source's expected tokens fly before the others.
PART = 0.02


def source_targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict:
    """Target of each source: ``share`` of all sizes by weight, at most ``most`` times its size.

    Sources are ordered by code point, null last, and weighed by ``weights`` in turn.  What a
    source cannot take is shared again among those below their limit.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        unit = rest / sum(weight[s] for s in names if s in free)
        full = [s for s in names if s in free and weight[s] * unit >= most * sizes[s]]
        if not full:
            target.update({s: weight[s] * unit for s in free})
            break
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
            free.discard(s)
    return {s: float(target[s]) for s in names}


def fly(p: np.ndarray, size: np.ndarray, leave: int, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities of ordered units, keeping sum(p) and sum(p * size), until at most
    ``leave`` (two at least) are strictly between 0 and 1.  Of both ways to the next 0 or 1
    the nearer is the likelier, so that the expected result of each unit is its ``p``."""
    p = p.copy()
    left = int(((p > EDGE) & (p < 1 - EDGE)).sum())
    held: list[int] = []
    for i in range(len(p)):
        if left <= max(leave, 2):
            break
        if not EDGE < p[i] < 1 - EDGE:
            continue
        held.append(i)
        while len(held) == 3 and left > max(leave, 2):
            a, b, c = (size[j] for j in held)
            way = (b - c, c - a, a - b) if (a != b or b != c) else (1.0, -1.0, 0.0)
            on = min((1 - p[j]) / w if w > 0 else p[j] / -w for j, w in zip(held, way) if w)
            back = min(p[j] / w if w > 0 else (1 - p[j]) / -w for j, w in zip(held, way) if w)
            step = on if rng.random() * (on + back) < back else -back
            for j, w in zip(held, way):
                p[j] += step * w
            still = [j for j in held if EDGE < p[j] < 1 - EDGE]
            left -= len(held) - len(still)
            held = still
    p[p <= EDGE], p[p >= 1 - EDGE] = 0.0, 1.0
    return p


def _choices(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 0/1 choices of at most ``LANDING`` units, and the probability of each."""
    choice = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    return choice.astype(float), np.where(choice, p, 1 - p).prod(axis=1)


def _drawn(choice: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    total = np.cumsum(weight)
    return choice[min(int(np.searchsorted(total, rng.random() * total[-1], side="right")), len(choice) - 1)]


def _fitted(choice: np.ndarray, weight: np.ndarray, p: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of the choices, unit by unit made to give each unit its probability."""
    for _ in range(rounds):
        if np.abs(weight @ choice / weight.sum() - p).max() < 1e-3:
            break
        for x, want in zip(choice.T, p):
            got = weight @ x / weight.sum()
            if EDGE < got < 1 - EDGE:
                weight = weight * np.where(x, want / got, (1 - want) / (1 - got))
    return weight


def land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A 0/1 choice for at most ``LANDING`` units, drawn so that each unit keeps its
    probability.  No choice misses the tokens by more than the largest unit holds (or as
    little as can be); the nearer to the tokens and the count, the likelier."""
    choice, weight = _choices(p)
    tokens, count = np.abs(choice @ size - p @ size), np.abs(choice.sum(axis=1) - p.sum())
    near = tokens <= max(tokens.min(), size.max())
    choice, tokens, count = choice[near], tokens[near], count[near]
    weight = weight[near] * np.exp(-(tokens - tokens.min()) / size.mean() - count)
    return _drawn(choice, _fitted(choice, weight, p), rng)


def settle(p: np.ndarray, size: np.ndarray, others: float, rest: float, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """The 0/1 choice for the open large units of a source, and the probability of its other
    units that makes up for it: they hold ``rest`` tokens and have the probability ``others``.

    Where the others can make up for any choice, each unit is taken with its probability.
    Else the choice is drawn among those that bring the source nearest to its tokens."""
    choice, weight = _choices(p)
    off = choice @ size - p @ size
    miss = np.maximum(np.maximum(off - others * rest, -off - (1 - others) * rest), 0.0)
    if miss.any():
        taken = _drawn(choice, np.where(miss <= miss.min() + EDGE, weight, 0.0), rng)
    else:
        taken = (rng.random(len(p)) < fly(p, size, 2, rng)).astype(float)
    shift = (taken @ size - p @ size) / rest if rest else 0.0
    return taken, float(min(max(others - shift, 0.0), 1.0))


def _generator(*names) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32(repr(names).encode()))


def _move(leave: int, final: bool, *names):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rng = _generator(*names, pdf["source"].iloc[0], int(pdf["block"].iloc[0]))
        pdf = pdf.sort_values(["size", "doc_id", "copy"], ascending=[False, True, True], kind="stable")
        size, p = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float)
        p = fly(p, size, leave, rng)
        if final:
            open_ = np.flatnonzero((p > 0) & (p < 1))
            if len(open_):
                p[open_] = land(p[open_], size[open_], rng)
        return pdf.assign(p=p)

    return run


def _flown(now: DataFrame, count: int, block: int, name: str, seed: int, final: bool) -> tuple[list[DataFrame], DataFrame]:
    """Decided units and, unless ``final``, a dozen open ones a source at most; ``count`` is
    the number of units of the largest source."""
    decided, level = [], 0
    shape = "doc_id long, copy int, source string, size long, p double, block long"
    while True:
        blocks = max(1, -(-count // block))
        spread = F.pmod(F.xxhash64(_null_id("doc_id"), "copy", F.lit(level)), F.lit(blocks))
        last = blocks == 1
        move = _move(LANDING if last else 2, last and final, seed, name, level)
        moved = written(now.withColumn("block", spread).groupBy("source", "block").applyInPandas(move, shape).drop("block"), f"{name}{level}")
        decided.append(moved.where("p = 0 or p = 1"))
        now = moved.where("p > 0 and p < 1")
        if last:
            return decided, now
        # two undecided units a block and source at most
        count, level = 2 * blocks, level + 1


def _null_id(c: str):
    return F.coalesce(F.col(c), F.lit(-(1 << 63)))


def _key() -> list:
    """What a row of documents is known by, besides its number among equal ones."""
    text = F.trim(F.coalesce("text", F.lit("")), F.lit(SPACE_CHARS))
    words = F.when(F.length(text) == 0, 0).otherwise(F.size(F.split(text, SPACES)))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size")]


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``copies`` of every document.

    ``size`` is the number of words (null text: 0), ``taken`` the words the mix takes of
    the document, repeats counted.  The table of sources, one row each, is the
    specification of the mix and goes through the driver.  Repeated rows are documents of
    their own.  Documents without words are taken 0 times; an empty table gives none.  Equal
    ``seed``, equal mix; over the seeds each document is taken as often as its source asks.
    """
    sized = written(docs.select(*_key()), "sizes")
    return _mix_sized(sized, weights, share, most, block, seed)


def _mix_sized(sized: DataFrame, weights, share: float, most: float, block: int, seed: int) -> DataFrame:
    spark = sized.sparkSession
    per = {r["source"]: r["size"] for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    target = source_targets(per, weights, share, most)
    plan = spark.createDataFrame(
        [(s, int(per[s]), t, t / per[s] if per[s] else 0.0) for s, t in target.items()],
        "source string, source_size long, target double, rate double",
    )
    placed = sized.join(F.broadcast(plan.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    base = placed.withColumn("sure", F.floor(F.col("rate") + EDGE)).withColumn("p", F.col("rate") - F.col("sure"))
    # equal rows are told apart by their number, so that the result does not depend on order
    groups = base.groupBy("doc_id", "source", "size", "source_size", "target", "sure", "p").agg(F.count("*").alias("rows"))
    units = groups.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    open_ = (F.col("size") > 0) & (F.col("p") > EDGE)
    large = F.col("size") > PART * (F.col("p") * F.col("source_size"))
    counts = units.where(open_).groupBy("source").agg(
        F.max("p").alias("p"), F.count_if(large).alias("large"), F.count_if(~large).alias("small"), F.sum(F.when(~large, F.col("size"))).alias("rest")
    ).collect()
    key, ones, shifts, decided = ["doc_id", "copy", "source", "size"], [], [], []
    if any(r["large"] for r in counts):
        decided, left = _flown(units.where(open_ & large).select(*key, "p"), max(r["large"] for r in counts), block, "large", seed, False)
        heads: dict = {}
        for r in left.orderBy(F.desc("size"), "doc_id", "copy").collect():  # a dozen a source at most
            heads.setdefault(r["source"], []).append(r)
        source = {r["source"]: r for r in counts}
        for s, rows in heads.items():
            p, size = (np.array([r[c] for r in rows], float) for c in ("p", "size"))
            taken, others = settle(p, size, source[s]["p"], float(source[s]["rest"] or 0), _generator(seed, "settle", s))
            ones += [(*(r[c] for c in key), float(t)) for r, t in zip(rows, taken)]
            shifts.append((s, others))
    decided.append(spark.createDataFrame(ones, "doc_id long, copy int, source string, size long, p double"))
    others = spark.createDataFrame(shifts, "_s string, _p double")
    shifted = units.where(open_ & ~large).join(F.broadcast(others), F.col("source").eqNullSafe(F.col("_s")), "left")
    flying = shifted.select(*key, F.coalesce("_p", "p").alias("p"))
    decided += _flown(flying, max((r["small"] for r in counts), default=0), block, "flight", seed, True)[0]
    chosen = decided[0]
    for part in decided[1:]:
        chosen = chosen.union(part)
    took = chosen.where("p = 1").select(
        _null_id("doc_id").alias("_i"), F.col("copy").alias("_c"), F.coalesce("source", F.lit("")).alias("_s"),
        F.col("source").isNull().alias("_n"), F.col("size").alias("_z"), F.lit(1).alias("_p"),
    )
    same = (
        (_null_id("doc_id") == F.col("_i")) & (F.col("copy") == F.col("_c")) & (F.coalesce("source", F.lit("")) == F.col("_s"))
        & (F.col("source").isNull() == F.col("_n")) & (F.col("size") == F.col("_z"))
    )
    copies = (F.when(F.col("size") > 0, F.col("sure") + F.coalesce("_p", F.lit(0))).otherwise(0)).cast("int")
    return units.join(took, same, "left").select(
        "doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), copies.alias("copies")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: each as often as it is taken.

    Also rows without doc_id or source, and those of a repeated doc_id.  Rows of one doc_id,
    source and size share what ``mix`` takes of them evenly; what is left over goes to the
    first by hash.
    """
    shares = mix(docs, **options).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_sum"), F.count("*").alias("_rows"))
    shares = shares.where("_sum > 0").withColumnsRenamed({"doc_id": "_d", "source": "_s", "size": "_z"})
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), *_key())
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    met = rows.join(shares, same)
    flat = [f"_row.`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64(*flat)))
    times = F.floor(F.col("_sum") / F.col("_rows")) + (F.col("_r") <= F.col("_sum") % F.col("_rows")).cast("long")
    taken = met.withColumn("_r", place).withColumn("_times", times.cast("int")).where("_times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), "_times"))).select("_row.*")
