"""Language identification: nearest of several centroids a language, by cosine.

A text is a vector of hashed letter n-grams, square roots of counts weighted by inverse
document frequency and normalised; document frequencies count all learned documents.  A
bounded sample of the texts of each language is clustered (spherical k-means) into a few centroids; a text gets the language of the nearest one and
is rejected when that is farther than nearly all learned texts of the language were.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from climgrid.llm.store import under_share
from climgrid.llm.text import slices, text_buffer

DIMENSIONS = 1 << 13
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[[*range(65, 91)]] = range(97, 123)
_FOLD[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts of each text (rows), and whether it has a letter."""
    raw, bounds = text_buffer(column)
    n = len(bounds) - 1
    plain = np.insert(_FOLD[raw], bounds, 0x20)  # a space before and after each text
    # upper-case Latin letters of two bytes
    plain[1:][(plain[:-1] == 0xC3) & (plain[1:] >= 0x80) & (plain[1:] <= 0x9E)] += 0x20
    x = plain.astype(np.uint32)
    two = x[:-1] * np.uint32(2654435761) + x[1:] * np.uint32(40503) * np.uint32(65537)
    three = two[:-1] * np.uint32(2246822519) + x[2:] * np.uint32(3266489917)
    two = (two ^ two >> np.uint32(15)) * np.uint32(2654435769) >> np.uint32(19)
    three = (three ^ three >> np.uint32(15)) * np.uint32(2654435769) >> np.uint32(19)
    out = np.zeros((n, DIMENSIONS), np.float32)
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    has = letters[bounds[1:]] > letters[bounds[:-1]]
    for i in range(n):
        a, b = int(bounds[i]) + i, int(bounds[i + 1]) + i + 2
        out[i] = np.bincount(two[a : b - 1], minlength=DIMENSIONS)
        out[i] += np.bincount(three[a : b - 2], minlength=DIMENSIONS) if b - a > 2 else 0
        if not has[i] and bounds[i + 1] > bounds[i]:
            has[i] = any(c.isalpha() for c in column[i].as_py())
    return out, has


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows of unit length
    owner: np.ndarray  # language of each centroid
    limit: np.ndarray  # distance beyond which a text is rejected, by language
    sharpness: float = 24.0

    def weigh(self, x: np.ndarray) -> np.ndarray:
        x = np.sqrt(x) * self.idf
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, score and rejection of each row of counts; ties: the first language."""
        near = self.weigh(x) @ self.centroids.T
        best = np.stack([near[:, self.owner == i].max(axis=1) for i in range(len(self.languages))], axis=1)
        index = best.argmax(axis=1)
        top = best.max(axis=1)
        power = np.exp(self.sharpness * (best - top[:, None]))
        return index, 1 / power.sum(axis=1), 1 - top > self.limit[index]


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit rows by cosine; begins with rows far from each other."""
    start = [0]
    far = x @ x[0]
    for _ in range(min(k, len(x)) - 1):
        start.append(int(far.argmin()))
        far = np.maximum(far, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def inverse_frequency(holding: np.ndarray, texts: int) -> np.ndarray:
    """Weight of each n-gram that ``holding`` of ``texts`` documents hold."""
    return (np.log((1 + texts) / (1 + holding)) + 1).astype(np.float32)


def train(x: np.ndarray, labels: list[str], k: int, idf: np.ndarray | None = None, quantile: float = 0.999) -> Model:
    """Centroids of the rows ``x``; ``idf`` from these alone where it is not given."""
    languages = sorted(set(labels))
    mark = np.array([languages.index(v) for v in labels])
    idf = inverse_frequency((x > 0).sum(axis=0), len(x)) if idf is None else idf
    unit = Model(languages, idf, x[:0], mark[:0], mark[:0]).weigh(x)
    parts = [cluster(unit[mark == i], k) for i in range(len(languages))]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    limit = [np.quantile(1 - (unit[mark == i] @ p.T).max(axis=1), quantile) * 1.25 for i, p in enumerate(parts)]
    return Model(languages, idf, np.concatenate(parts).astype(np.float32), owner, np.array(limit))


def _count_rows(batches):
    for part in slices(batches, most=1 << 18):
        x, has = counts(part.column("text"))
        lists = [pa.array(r.astype(np.float32)) for r in x]
        flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, DIMENSIONS).astype(np.int32), pa.concat_arrays(lists))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), flat, pa.array(has)], names=["doc_id", "lang", "x", "has"])


def _holding(batches):
    """How many texts of the task hold each n-gram; at the last place, how many there are."""
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for part in slices(batches, most=1 << 19):
        for at in range(0, part.num_rows, 256):
            x, has = counts(part.column("text").slice(at, 256))
            total[:-1] += np.count_nonzero(x if has.all() else x[has], axis=0)
            total[-1] += has.sum()
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["gram", "texts"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Of all texts with a letter: how many hold each hashed n-gram, and how many there are.
    Tasks count; their sums, one row an n-gram at most, come to the driver."""
    rows = docs.select("text").mapInArrow(_holding, "gram long, texts long").groupBy("gram").agg(F.sum("texts").alias("texts")).toArrow()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    out[rows.column("gram").to_numpy()] = rows.column("texts").to_numpy()
    return out


def fit(docs: DataFrame, fit_rows: int = 1200, k: int = 4) -> Model | None:
    """Learn document frequencies from all texts and centroids from at most ``fit_rows`` of
    them, as many of every language (of more languages, one each of the ``fit_rows`` most
    frequent), those of smallest hashed doc_id.  Null languages, texts and ids are left out;
    nothing left: no model."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = docs.where("lang is not null and doc_id is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(fit_rows).collect()
    if not sizes:
        return None
    each = max(1, fit_rows // len(sizes))
    # a bounded map of languages: rows are left out before anything is dealt by language
    rows_of = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], r["rows"])])[F.col("lang")]
    few = known.select("doc_id", "lang").where(rows_of.isNotNull() & under_share(F.col("doc_id"), rows_of, F.lit(each)))
    chosen = few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each)
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(chosen.drop("_n")), ["doc_id", "lang"])
    rows = sample.mapInArrow(_count_rows, "doc_id long, lang string, x array<float>, has boolean").where("has").toArrow()
    if not rows.num_rows:
        return None
    held = document_frequencies(known)
    rows = rows.sort_by([("lang", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
    return train(x, rows.column("lang").to_pylist(), k, inverse_frequency(held[:-1], int(held[-1])))


def _predict(model: Model | None, reject: bool):
    def run(batches):
        for part in slices(batches, most=1 << 19):
            n = part.num_rows
            index, score, far, has = np.zeros(n, int), np.zeros(n), np.ones(n, bool), np.zeros(n, bool)
            for at in range(0, n, 256) if model else ():
                x, has[at : at + 256] = counts(part.column("text").slice(at, 256))
                index[at : at + 256], score[at : at + 256], far[at : at + 256] = model.predict(x)
            names = [model.languages[i] if h and not (reject and f) else UNKNOWN for i, h, f in zip(index, has, far)] if model else [UNKNOWN] * n
            score = np.where(has, np.where(far, score / 2, score), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(score), pa.array(far | ~has)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, model: Model | None, reject: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every document, from its whole text alone.

    ``und`` with score 0 for a null text, one without a letter, or without a model; with
    ``reject`` also for texts far from all centroids (else their score is halved).
    """
    shape = "doc_id long, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(_predict(model, reject), shape)


def held_out(modulus: int, rest: int):
    """Documents kept from learning, by the CRC-32 of the id's digits; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))
