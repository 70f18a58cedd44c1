"""Near duplicates: one-permutation MinHash, banded buckets, star edges, exact confirmation.

Documents of one shingle set are one class, and only its smallest doc_id goes on.  A set's
hashes fall into bins; the least of each bin is its signature, and an empty bin borrows
from the first filled one in a random order of its own (optimal densification), so that
bins of two sets agree with probability J even for tiny sets.  Bands of bins name buckets.
In each bucket one member, the hub, is compared with the others on the full sets: pairs
grow with the members, not with their square.  What the stars leave in different
components of a bucket is compared too, unless its counts of shared shingles rule a link
out: in pairs of bounded blocks, of which only the components that a link connects come
out.  So every two documents of a bucket are compared, already connected or too different
by count, and no cap is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.graph import stars
from climgrid.llm.store import meet, written
from climgrid.llm.text import gram_hashes, mix, sequence_hash, slices, text_buffer, word_hashes, word_spans

SHINGLE = 5
BANDS, ROWS = 50, 5  # a pair of similarity 0.75 shares no bucket with probability 1.3e-6


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, bounds = text_buffer(column)
    starts, ends, first = word_spans(raw, bounds)
    words = word_hashes(raw, starts, ends, lower=True)
    grams = gram_hashes(words, k)
    for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
        if j - i >= k:
            yield np.unique(grams[i : j - k + 1])
        elif j > i:
            yield np.array([sequence_hash(words[i:j])], np.uint64)
        else:
            yield grams[:0]


class Signer:
    """Band hashes of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        rng = np.random.Generator(np.random.PCG64(5))
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        turn = np.argsort(rng.random((self.bins, self.bins)), axis=1).astype(np.int16)
        self.turn = np.empty_like(turn)  # turn[i, j]: when bin i asks bin j
        np.put_along_axis(self.turn, turn, np.arange(self.bins, dtype=np.int16)[None, :].repeat(self.bins, 0), 1)
        self.factor = rng.integers(1, 1 << 63, self.bins, dtype=np.uint64) | np.uint64(1)
        self.band = rng.integers(1, 1 << 63, bands, dtype=np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """Sorted, not empty hashes; bins are ranges of the hash, so the first of a bin is its least."""
        bins = ((hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        lead = np.flatnonzero(np.diff(bins, prepend=-1))
        out, filled = np.zeros(self.bins, np.uint64), bins[lead]
        out[filled] = hashes[lead]
        if len(filled) < self.bins:
            empty = np.ones(self.bins, bool)
            empty[filled] = False
            asks = self.turn[np.ix_(empty, filled)]
            out[empty] = out[filled[asks.argmin(axis=1)]]
        return out

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        parts = (mix(self.signature(hashes)) * self.factor).reshape(self.bands, self.rows).sum(axis=1, dtype=np.uint64)
        return mix(parts + self.band)


def _signatures(k: int, bands: int, rows: int):
    def run(batches):
        signer = Signer(bands, rows)
        for part in slices(batches):
            n, one, two, names = [], [], [], []
            for s in shingle_sets(part.column("text"), k):
                n.append(len(s))
                m = mix(s)
                one.append(m.sum(dtype=np.uint64))
                two.append((m * (m >> np.uint64(7) | np.uint64(1))).sum(dtype=np.uint64))
                names.append(signer(s) if len(s) else s)
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(x) for x in names])]).astype(np.int32),
                np.concatenate(names).view(np.int64),
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                 np.array(one, np.uint64).view(np.int64), np.array(two, np.uint64).view(np.int64), lists],
                names=["doc_id", "n_shingles", "s1", "s2", "buckets"],
            )

    return run


def _sets(k: int):
    def run(batches):
        for part in slices(batches):
            sets = list(shingle_sets(part.column("text"), k))
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32), np.concatenate(sets).view(np.int64)
            )
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists], names=["node", "shingles"])

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough; twice if a node has two sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    joined = pairs.join(right, "b").join(left, "a")
    return joined.where(100 * both >= percent * (F.size("_x") + F.size("_y") - both)).select("a", "b")


def _in_open_buckets(members: DataFrame) -> DataFrame:
    """Members of the buckets that still hold more than one component, with the bucket's
    least node, ``first``."""
    ends = members.groupBy("bucket").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi"), F.min("node").alias("first"))
    return meet(members, ends.where("_lo < _hi").select("bucket", "first"), "bucket")


def _shared_counts(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``(node, n, common)``: size of each node's set, and how many of its shingles another
    of the nodes has too."""
    own = sets.join(nodes, "node", "left_semi")
    spread = own.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = spread.groupBy("shingle").agg(F.count("*").alias("_k")).where("_k > 1")
    return spread.join(often, "shingle", "left_semi").groupBy("node", "n").agg(F.count("*").alias("common"))


def _block_links(percent: int, columns: int = 4096):
    """Components that are linked, of the documents of two blocks: intersections of all
    sets at once, as products of 0/1 matrices over the shingles that occur twice."""

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        own, low, high = (t.column(c).to_numpy() for c in ("own", "low", "high"))
        part = t.column("part").to_numpy()
        lists = t.column("shingles").combine_chunks()
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        _, code, count = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        code = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[code]
        one, two = np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0])
        both = np.zeros((len(one), len(two)), np.float32)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        for at in range(0, int((count > 1).sum()), columns):
            i, j = np.searchsorted(code, [at, at + columns])
            x = np.zeros((len(size), columns), np.float32)
            x[row[i:j], code[i:j] - at] = 1
            both += x[one] @ x[two].T
        union = size[one][:, None] + size[two][None, :] - both
        near = (100 * both >= percent * union) & (part[one][:, None] != part[two][None, :])
        i, j = np.nonzero(near)
        ends = np.unique(np.sort(np.stack([part[one][i], part[two][j]], axis=1), axis=1), axis=0)
        return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})

    return run


def _linked_parts(open_: DataFrame, sets: DataFrame, percent: int, most: int = 256, mass: int = 500_000) -> DataFrame:
    """Pairs of components among the documents left, ``open_(bucket, node, part, n, first)``,
    that a link between documents of shared buckets connects.

    Documents that buckets tie together are one lot, dealt by hash over blocks of about
    ``most`` documents or ``mass`` shingles; each pair of blocks is a group of bounded size.
    """
    lots = stars(open_.select(F.col("first").alias("a"), F.col("node").alias("b")))
    nodes = open_.select("node", "part", "n").distinct().join(lots, "node", "left")
    nodes = written(nodes.select("node", "part", "n", F.coalesce("component", "node").alias("lot")), "lots")
    blocks = F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("n") / mass)).cast("int")
    dealt = nodes.join(nodes.groupBy("lot").agg(blocks.alias("blocks")), "lot")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = dealt.join(sets, "node").select("lot", "part", "own", "shingles", other)
    pairs = met.select("lot", "part", "own", "shingles", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return pairs.groupBy("lot", "low", "high").applyInArrow(_block_links(percent), "a long, b long")


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, component)`` of the nodes linked with a smaller one, from ``members(bucket,
    node, hub)`` of shared buckets.

    After the stars only documents in buckets of several components are left.  Two
    sets of sizes x and y are similar enough only with percent (x + y) / (100 + percent)
    shingles in common, so each must share percent of its own with others of those left:
    most drop out by that count.  The rest are compared block by block.
    """
    spokes = members.where("hub < node")
    pairs = spokes.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    part = stars(confirm(pairs, sets, percent))
    placed = spokes.select("bucket", "node").join(part, "node", "left")
    placed = placed.select("bucket", "node", F.coalesce("component", "node").alias("part"))
    open_ = written(_in_open_buckets(placed).drop("first"), "open")
    counts = _shared_counts(open_.select("node").distinct(), sets).where(f"100 * common >= {percent} * n")
    open_ = written(_in_open_buckets(open_.join(counts.drop("common"), "node")), "open")
    # components of components: what was known keeps its name or takes that of a smaller one
    over = stars(_linked_parts(open_, sets, percent)).select(F.col("node").alias("component"), F.col("component").alias("over"))
    known = part.join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component"))
    return known.union(over.select(F.col("component").alias("node"), F.col("over").alias("component")))


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, percent: int = 75, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    A text without words has no set and is linked with nothing.  A row without doc_id
    cannot stand for a group: its component is null and it is kept.  Rows of one doc_id
    are taken as one document.  Ties cannot occur: the least doc_id names a component.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(
        source.mapInArrow(
            _signatures(k, bands, rows), "doc_id long, n_shingles long, s1 long, s2 long, buckets array<long>"
        ),
        "signatures",
    )
    same = ["n_shingles", "s1", "s2"]
    real = signed.where("n_shingles > 0 and doc_id is not null")
    classes = written(real.groupBy(*same).agg(F.min("doc_id").alias("node")), "classes")
    named = real.join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    spread = named.select(F.explode("buckets").alias("bucket"), F.col("doc_id").alias("node"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = written(meet(spread, shared.select("bucket", F.col("lo").alias("hub")), "bucket"), "members")
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    sets = written(source.join(nodes, "doc_id", "left_semi").mapInArrow(_sets(k), "node long, shingles array<long>"), "sets")
    part = _links(members, sets, percent)
    found = classes.join(part, "node", "left").select(*same, F.coalesce("component", "node").alias("component_id"))
    rows_ = signed.select("doc_id", *same)
    return (
        rows_.join(found, same, "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that repeat one of smaller doc_id, columns as they are."""
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
