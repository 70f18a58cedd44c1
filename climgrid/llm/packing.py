"""Packing documents into fixed-length sequences along a space-filling curve.

Each document's tokens are hashed to a point in a few dimensions; the Hilbert curve
through that space gives a key, so neighbours in the order are alike.  Documents lie end
to end in key order and are cut every ``length`` tokens: no sequence but the last is
padded.  Ids are written once; only (key, length) is range-sorted, and the positions are
joined back to the ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.store import written
from climgrid.llm.text import slices, unit_encoder

LENGTH, END_ID = 2048, 1
DIMENSIONS, BITS = 4, 12
SLICE = 4 << 20


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of rows of coordinates in 0 .. 2**bits - 1."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    side = 1 << (bits - 1)
    while side > 1:  # undo the turns of the larger cells
        low = side - 1
        for i in range(n):
            up = (x[i] & side) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
        side >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    side = 1 << (bits - 1)
    while side > 1:
        turn ^= np.where((x[n - 1] & side) != 0, side - 1, 0)
        side >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def project(ids: np.ndarray, bounds: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The direction of each document's hashed token vector, in units of the key's grid.

    A token's row of ``directions`` is found by hashing its id."""
    rows = directions[(ids * np.uint32(2654435761)) >> np.uint32(16)]
    sums = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
    v = sums[bounds[1:]] - sums[bounds[:-1]]
    v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)
    return np.clip((v + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1)


def _tokenized(path: str, end_id: int, added: bool):
    def run(batches):
        encode, row = unit_encoder(path, False, added), TaskContext.get().partitionId() << 33
        wide = encode.tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        directions = np.random.Generator(np.random.PCG64(11)).standard_normal((1 << 16, DIMENSIONS)).astype(np.float32)
        for part in slices(batches, most=SLICE):
            ids, bounds = encode(part.column("text"))
            key = hilbert_key(project(ids, bounds, directions), BITS)
            size = np.diff(bounds)
            whole = np.insert(ids, bounds[1:], end_id).astype("<u4" if wide else "<u2")
            ends = (np.cumsum(size + 1) * whole.itemsize).astype(np.int32)
            data = pa.BinaryArray.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(np.insert(ends, 0, 0).tobytes()), pa.py_buffer(whole.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(size))), part.column("doc_id").cast(pa.int64()), pa.array(key), pa.array(size + 1), data],
                names=["row", "doc_id", "key", "doc_tokens", "ids"],
            )
            row += len(size)

    return run


def _running(batches):
    """Tokens before each document in its partition of the curve."""
    stretch, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("doc_tokens").to_numpy()
        ends = total + np.cumsum(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.full(len(n), stretch)), pa.array(ends - n), batch.column("doc_tokens")],
            names=["row", "stretch", "before", "doc_tokens"],
        )
        total = int(ends[-1]) if len(n) else total


def curve_order(tokens: DataFrame) -> DataFrame:
    """``(row, place)``: tokens before each document along the curve."""
    spark = tokens.sparkSession
    light = tokens.select("key", "doc_id", "row", "doc_tokens")
    ordered = light.repartitionByRange("key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
    laid = written(ordered.mapInArrow(_running, "row long, stretch long, before long, doc_tokens long"), "curve")
    # one row a partition of the curve
    totals = sorted(map(tuple, laid.groupBy("stretch").agg(F.sum("doc_tokens")).collect()))
    bases, at = [], 0
    for stretch, total in totals:
        bases.append((stretch, at))
        at += total
    base = spark.createDataFrame(bases, "stretch long, base long")
    return laid.join(F.broadcast(base), "stretch").select("row", (F.col("before") + F.col("base")).alias("place"))


def _pieces(length: int, with_ids: bool):
    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "ids", "doc_tokens", "place")]
            for doc, raw, n, place in zip(*columns):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                at = 0
                while at < n:
                    sequence, offset = divmod(place + at, length)
                    piece = ids[at : at + length - offset].tobytes()
                    out.append((doc, at, len(piece) // 4, zlib.crc32(piece), n, sequence, offset, piece))
                    at += len(piece) // 4
            if out:
                cols = list(zip(*out))
                arrays = [pa.array(c, pa.int64()) for c in cols[:7]] + ([pa.array(cols[7], pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, names=[*PIECE, *(["ids"] if with_ids else [])])

    return run


PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True, added: bool = False) -> DataFrame:
    """Pieces of all documents: where each lies in which sequence; ``ids`` (little-endian
    unsigned 32-bit) on demand.

    Every row of ``docs`` is packed, also repeated ones and those without doc_id; an empty
    or null text is its end id alone.  Texts at one point of the curve go by doc_id.
    ``added``: strings of the vocabulary's added tokens are those tokens, not ordinary text.
    """
    tokens = written(
        docs.select("doc_id", "text").mapInArrow(
            _tokenized(tokenizer, end_id, added), "row long, doc_id long, key long, doc_tokens long, ids binary"
        ),
        "tokens",
    )
    placed = tokens.select("row", "doc_id", "doc_tokens", "ids").join(curve_order(tokens), "row")
    shape = ", ".join(f"{c} long" for c in PIECE) + (", ids binary" if with_ids else "")
    return placed.mapInArrow(_pieces(length, with_ids), shape)


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids, length)`` from pieces with ids: a sequence is at most ``length`` tokens."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p"), F.sum("length").alias("length"))
    return parts.select("sequence_id", F.aggregate("_p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x.ids)).alias("ids"), "length")
