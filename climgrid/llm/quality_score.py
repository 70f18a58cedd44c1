"""Quality score: regularised quadratic discriminant analysis of document statistics.

Each class is a normal density over transformed statistics, with a covariance shrunk
towards the pooled one and its diagonal.  A score is the logistic of the difference of
log-densities (Mahalanobis distances by cached Cholesky factors), scaled on the learned
rows so that it can be read as a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.store import smallest_hashed
from climgrid.llm.text import gram_hashes, slices, text_buffer, word_hashes, word_spans

_KINDS = np.full(256, 5, np.uint8)  # 0 upper, 1 lower, 2 digit, 3 mark, 4 space, 5 other
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 0, 1, 2
_KINDS[33:48] = _KINDS[58:65] = _KINDS[91:97] = _KINDS[123:127] = 3
_KINDS[[0x20, *range(0x09, 0x0E)]] = 4
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
N_FEATURES = 11


def features(column: pa.Array) -> np.ndarray:
    """Transformed statistics of each text; an empty text has zeros."""
    raw, bounds = text_buffer(column)
    starts, ends, first = word_spans(raw, bounds)
    words, size = word_hashes(raw, starts, ends), ends - starts
    threes = gram_hashes(words, 3)
    feed = np.flatnonzero(raw == 0x0A)
    begin = np.unique(np.concatenate([bounds[:-1], feed + 1]))
    begin = begin[begin < len(raw)]
    stop = np.append(begin[1:], len(raw))
    lines = word_hashes(raw, begin, stop - (raw[stop - 1] == 0x0A)) if len(begin) else np.empty(0, np.uint64)
    line_at = np.searchsorted(begin, bounds)
    kinds, symbol = _KINDS[raw], _SYMBOL[raw]
    out = np.zeros((len(bounds) - 1, N_FEATURES))
    share = lambda a, b: a / b if b else 0.0
    for r in range(len(out)):
        i, j, a, b = int(first[r]), int(first[r + 1]), int(bounds[r]), int(bounds[r + 1])
        n = j - i
        if not n:
            continue
        kind = np.bincount(kinds[a:b], minlength=6)
        solid = b - a - kind[4]
        own = lines[line_at[r] : line_at[r + 1]]
        grams = threes[i : j - 2] if n > 2 else threes[:0]
        root = np.sqrt
        out[r] = (
            np.log1p(n), np.log(solid / n), root(share(symbol[a:b].sum(), solid)), root(share(kind[0], solid)),
            root(share(kind[2], solid)), root(share(kind[3], solid)), root(1 - len(np.unique(own)) / max(len(own), 1)),
            root(1 - len(np.unique(words[i:j])) / n), root(1 - share(len(np.unique(grams)), len(grams))) if len(grams) else 0.0,
            np.log1p(size[i:j].std()), np.log1p(n / max(len(own), 1)),
        )
    return out


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # of class 0 and 1
    factors: np.ndarray  # Cholesky factors of their covariances
    logdet: np.ndarray
    slope: float
    offset: float

    def contrast(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0."""
        z = (x - self.center) / self.scale
        out = []
        for c in (0, 1):
            y = np.linalg.solve(self.factors[c], (z - self.means[c]).T)
            out.append(-0.5 * ((y * y).sum(axis=0) + self.logdet[c]))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(self.contrast(x)) + self.offset, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, shrink: float = 0.1, ridge: float = 0.05) -> Model:
    """Both classes are needed; features without spread weigh nothing.  ``shrink`` and
    ``ridge`` are the least shares of the pooled covariance and of its diagonal."""
    center, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - center) / scale
    means = np.stack([z[y == c].mean(axis=0) for c in (0, 1)])
    covariances = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(c * (y == i).mean() for i, c in enumerate(covariances))
    factors, logdet = [], []
    d = x.shape[1]
    for k, c in enumerate(covariances):
        # few rows of a class say little about its shape: then more of the pooled one, and of its diagonal
        near, flat = (max(least, d / (d + n)) for least, n in ((shrink, (y == k).sum()), (ridge, len(y))))
        s = (1 - near) * c + near * pooled
        s = (1 - flat) * s + flat * np.diag(np.diag(pooled) + 1e-3)
        factors.append(np.linalg.cholesky(s))
        logdet.append(2 * np.log(np.diag(factors[-1])).sum())
    model = Model(center, scale, means, np.stack(factors), np.array(logdet), 1.0, 0.0)
    # logistic fit of the outcome on the squashed contrast, by Newton's method
    t = np.stack([np.arcsinh(model.contrast(x)), np.ones(len(x))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(t @ w, -40, 40)))
        h = (t * (p * (1 - p) + 1e-6)[:, None]).T @ t + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, t.T @ (y - p) - 1e-3 * w)
    return Model(center, scale, means, model.factors, model.logdet, float(w[0]), float(w[1]))


def _feature_rows(batches):
    for part in slices(batches):
        x = features(part.column("text"))
        lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, N_FEATURES).astype(np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "x"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000) -> Model | float:
    """Learn from at most ``fit_rows`` labelled rows, those of smallest hashed doc_id; with
    fewer than two rows of a class, the share of class 1 (0.5 without rows) stands in."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    sample = smallest_hashed(known, "doc_id", fit_rows, "quality")
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    got = chosen.mapInArrow(_feature_rows, "doc_id long, x array<double>")
    rows = sorted(map(tuple, got.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "x").collect()))
    x, y = np.array([r[2] for r in rows]).reshape(-1, N_FEATURES), np.array([int(r[1] == 1) for r in rows])
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return float(y.mean()) if len(y) else 0.5
    return train(x, y)


def _scored(model: Model | float):
    def run(batches):
        for part in slices(batches):
            x = features(part.column("text"))
            score = model.score(x) if isinstance(model, Model) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(score)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model | float, at: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every document, from its whole text alone; a null or
    empty text is scored by its statistics, which are zeros."""
    scored = docs.select("doc_id", "text").mapInArrow(_scored(model), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= at).cast("int"))
