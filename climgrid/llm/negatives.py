"""Hard-negative mining: exact integer inner products by Kronecker packing.

Each component ``x`` becomes the integer ``floor(scale * x)``.  The components of several
candidates, biased so that none is negative, lie in separate fields of one 64-bit integer;
one multiplication by an anchor's component then serves all of them, and the sum over the
components holds one score in each field.  The width of a field comes from the values at
hand, so that no field can run over; where they are too large for 64 bits, the wide
integers are Python's, which have any width.

Anchors meet all rows in a grid of blocks: every row has a chunk (by a hash of its key),
every anchor a group, and a block is one group with one chunk.  Blocks are bounded by
parameters, however many rows there are; nothing is broadcast or collected.

Rows whose label or vector is null, or whose vector has a null or non-finite component,
take no part.  Vectors of unequal length meet as if the shorter one went on in zeros.
Equal ids are rows of their own; a null id is no anchor and comes last among ties.  Scores
beyond 64 bits are compared exactly and returned as the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from climgrid.llm.store import written

FIELDS_OF_WIDE = 8  # fields of one wide Python integer, where 64 bits hold none
NO_ID = (1 << 63) - 1
TILE = 1 << 21  # scores at once in a task

_PAIRS = "anchor_row long, part int, other_id long, score_text string, score long, order_key binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: vec_id, label, embedding."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return kept.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def whole_numbers(vectors, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)``: 64-bit where all fit, else Python integers."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(out * scale)
    if not np.isfinite(scaled).all():  # only double components can pass the range of doubles
        scaled = np.array([[int(x * int(scale)) if x == int(x) else int(np.floor(x * scale)) for x in map(float, r)] for r in out], object)
        return scaled.reshape(len(vectors), width)
    if np.abs(scaled, out=out).max(initial=0) < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


class Packed:
    """Candidates in fields of wide integers, ready for anchors whose components add up to
    at most ``reach`` without sign."""

    def __init__(self, candidates: np.ndarray, reach: int):
        n, dims = candidates.shape
        self.n = n
        self.bias = max((int(-candidates.min()) if candidates.size else 0), 0)
        top = (int(candidates.max()) if candidates.size else 0) + self.bias
        self.offset = reach * top  # a field's sum lies between -offset and offset
        self.bits = max(1, (2 * self.offset).bit_length())
        self.narrow = self.bits <= 64 and candidates.dtype != object
        self.fields = max(1, 64 // self.bits) if self.narrow else FIELDS_OF_WIDE
        self.step = -(-n // self.fields)  # field t holds candidates t * step, t * step + 1, ...
        kind = np.uint64 if self.narrow else object
        biased = np.zeros((self.fields * self.step, dims), kind)
        biased[:n] = (candidates + self.bias).astype(kind)
        self.words = np.zeros((dims, self.step), kind)
        for t in range(self.fields):
            self.words += biased[t * self.step : (t + 1) * self.step].T << self._shift(t)

    def _shift(self, t: int):
        return np.uint64(t * self.bits) if self.narrow else t * self.bits

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner product of each anchor (row) with each candidate (column)."""
        if not self.step:
            return np.zeros((len(anchors), 0), np.int64)
        kind = np.uint64 if self.narrow else object
        lift = sum(self.offset << (t * self.bits) for t in range(self.fields))
        wide = anchors.astype(kind) @ self.words if self.words.size else np.zeros((len(anchors), self.step), kind)
        wide = wide + (np.uint64(lift) if self.narrow else lift)
        mask = (1 << self.bits) - 1
        out = np.empty((len(anchors), self.fields * self.step), np.int64 if self.narrow else object)
        for t in range(self.fields):
            field = (wide >> self._shift(t)) & (np.uint64(mask) if self.narrow else mask)
            out[:, t * self.step : (t + 1) * self.step] = field.astype(np.int64) if self.narrow else field
        back = anchors.sum(axis=1, dtype=anchors.dtype) * self.bias + self.offset
        return out[:, : self.n] - back[:, None]


def _whole(values, default: int) -> np.ndarray:
    return np.array([default if pd.isna(v) else int(v) for v in values], np.int64)


class Chunk:
    """The candidates of a block, ordered by id, and their places in that order as tie-breaks."""

    def __init__(self, rows: pd.DataFrame, scale: float):
        ids = _whole(rows["vec_id"], NO_ID)
        missing = np.array([bool(pd.isna(v)) for v in rows["vec_id"]], bool)
        order = np.lexsort((rows["row"].to_numpy(), missing, ids))
        self.ids, self.missing, self.rows = ids[order], missing[order], rows["row"].to_numpy()[order]
        self.labels = rows["label"].to_numpy()[order]
        self.vectors = whole_numbers(list(rows["embedding"].iloc[order]), scale)

    def against(self, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Scores of the anchors with all candidates, some anchors at a time."""
        width = max(anchors.shape[1], self.vectors.shape[1])
        fill = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
        anchors, vectors = fill(anchors), fill(self.vectors)
        if anchors.dtype == object or vectors.dtype == object:
            anchors, vectors = anchors.astype(object), vectors.astype(object)
            reach = max((sum(map(abs, r)) for r in anchors.tolist()), default=0)
        else:
            sums = np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)
            reach = int(sums * (1 + 1e-9)) + 1 if sums >= 2.0**53 else int(sums)
        packed = Packed(vectors, reach)
        if not packed.narrow:
            anchors = anchors.astype(object)
        some = max(1, TILE // max(1, len(self.ids)))
        for at in range(0, len(anchors), some):
            yield at, packed.scores(anchors[at : at + some])

    def ranked(self, scores: np.ndarray) -> np.ndarray:
        """Numbers that order a row of candidates by score, then by smaller id; the score is
        the number divided by how many candidates there are, rounded down."""
        n = len(self.ids)
        if scores.dtype != object and np.abs(scores).max(initial=0) >= (1 << 62) // max(1, n):
            scores = scores.astype(object)
        return scores * n + np.arange(n - 1, -1, -1)


def _found(anchor_row, part, chunk: Chunk, keys, n: int):
    """Rows of the result for picked candidates, given by their numbers of ``ranked``."""
    out = []
    for key in keys:
        score, place = divmod(int(key), n)
        at = n - 1 - place
        fits = min(max(score, -(1 << 63)), (1 << 63) - 1)
        out.append((anchor_row, part, None if chunk.missing[at] else int(chunk.ids[at]), str(score), fits, _order(score)))
    return out


def _order(score: int) -> bytes:
    """Bytes that sort as the number does, whatever its size."""
    size = (score.bit_length() + 8) // 8
    body = (score + (1 << (8 * size))).to_bytes(size + 1, "big") if score < 0 else score.to_bytes(size + 1, "big")
    return (32768 + size if score >= 0 else 32767 - size).to_bytes(2, "big") + body


def _frame(rows) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["anchor_row", "part", "other_id", "score_text", "score", "order_key"]).astype({"other_id": "Int64"})


def _positives(scale: float, most: int):
    def block(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if not len(anchors) or not len(rows):
            return _frame(out)
        chunk, n = Chunk(rows, scale), len(rows)
        own, label = anchors["anchor_row"].to_numpy(), anchors["anchor_label"].to_numpy()
        for at, scores in chunk.against(whole_numbers(list(anchors["anchor_vector"]), scale)):
            keys = chunk.ranked(scores)
            for i in range(len(keys)):
                fit = keys[i][(chunk.labels == label[at + i]) & (chunk.rows != own[at + i])]
                if len(fit) > most:
                    fit = np.partition(fit, len(fit) - most)[len(fit) - most :] if fit.dtype != object else np.sort(fit)[-most:]
                out += _found(int(own[at + i]), 0, chunk, fit, n)
        return _frame(out)

    return block


def _negatives(scale: float, most: int, low: int, high: int):
    """``low`` and ``high``: percent of the positive's score that a negative's may have."""

    def block(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if not len(anchors) or not len(rows):
            return _frame(out)
        chunk, n = Chunk(rows, scale), len(rows)
        own, label, wanted = anchors["anchor_row"].to_numpy(), anchors["anchor_label"].to_numpy(), list(anchors["positives"])
        for at, scores in chunk.against(whole_numbers(list(anchors["anchor_vector"]), scale)):
            keys = chunk.ranked(scores)
            for i in range(len(keys)):
                fit = np.sort(keys[i][chunk.labels != label[at + i]])
                for part, text in enumerate(wanted[at + i]):
                    least, top = -(-low * int(text) // 100), high * int(text) // 100
                    if least <= top and len(fit):
                        # keys of a score s lie from s * n on, below (s + 1) * n
                        a, b = int(fit[0]), int(fit[-1]) + 1
                        lo = np.searchsorted(fit, min(max(least * n, a), b))
                        hi = np.searchsorted(fit, min(max((top + 1) * n, a), b))
                        out += _found(int(own[at + i]), part, chunk, fit[max(lo, hi - most) : hi], n)
        return _frame(out)

    return block


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows of each group by score, then id; every block has sent that many at most."""
    best = Window.partitionBy(*by).orderBy(F.desc("order_key"), F.asc_nulls_last("other_id"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)


def mine_negatives(
    embeddings: DataFrame,
    anchor: Column,
    label: Column | None = None,
    *,
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    chunk_rows: int = 8192,
    group_anchors: int = 8192,
) -> DataFrame:
    """For each anchor and each of its ``positives`` nearest rows of the same label, the first
    ``negatives`` rows of another label whose score lies within ``low`` to ``high`` percent of
    the positive's.  ``label`` replaces the label column.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and
    positive_rank (1 for the nearest).  A task holds one block: at most about ``chunk_rows``
    rows and ``group_anchors`` anchors.
    """
    if label is not None:
        embeddings = embeddings.withColumn("label", label)
    base = written(usable(embeddings).select("*", F.monotonically_increasing_id().alias("row"), anchor.alias("is_anchor")), "vectors")
    sizes = base.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_anchor"), 1)).alias("a")).first()
    chunks, groups = max(1, -(-sizes.n // chunk_rows)), max(1, -(-sizes.a // group_anchors))
    spread = lambda c, seed, n: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = base.select("row", "vec_id", "label", "embedding", spread("row", 1, chunks).alias("chunk"), every(groups).alias("group"))
    asks = base.where("is_anchor").select(
        F.col("row").alias("anchor_row"), F.col("label").alias("anchor_label"), F.col("embedding").alias("anchor_vector")
    )

    def blocks(asking: DataFrame, fn) -> DataFrame:
        a = asking.select("*", spread("anchor_row", 2, groups).alias("group"), every(chunks).alias("chunk"))
        return a.groupBy("group", "chunk").cogroup(rows.groupBy("group", "chunk")).applyInPandas(fn, _PAIRS)

    near = _first(blocks(asks, _positives(scale, positives)), ["anchor_row"], positives)
    near = written(near.select("anchor_row", F.col("other_id").alias("positive_id"), "score", "score_text", "place"), "positives")
    lists = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("place", "score_text"))).alias("p"))
    asks = asks.join(lists, "anchor_row").select(*asks.columns, F.transform("p", lambda x: x["score_text"]).alias("positives"))
    far = _first(blocks(asks, _negatives(scale, negatives, low, high)), ["anchor_row", "part"], negatives)
    far = far.select(
        "anchor_row", (F.col("part") + 1).alias("place"), F.col("place").alias("rank"),
        F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    names = base.where("is_anchor").select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return near.join(far, ["anchor_row", "place"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score",
        F.col("place").alias("positive_rank"),
    )
