"""Bytes as grey PNG images in a binary column, with perceptual hashes.

The PNG container is written and read here: chunks with their CRC-32 tests, zlib data, and
the five line filters undone with numpy.  Each line is stored under the filter that leaves
the least sum of absolute differences.  The hash keeps the signs of the low frequencies
of a cosine transform of the image, scaled to 32 x 32.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.store import written
from climgrid.llm.text import slices, text_buffer

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
SIDE, LOW = 32, 8
CHUNK = 1 << 20
#: Filters that a stored line is tried under; the first of equals.
FILTERS = (0, 1, 2)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def _predicted(kind: int, rows: np.ndarray) -> np.ndarray:
    """Each byte less its prediction by the filter ``kind`` (one byte a pixel)."""
    left, up, corner = np.zeros_like(rows), np.zeros_like(rows), np.zeros_like(rows)
    left[:, 1:], up[1:], corner[1:, 1:] = rows[:, :-1], rows[:-1], rows[:-1, :-1]
    if kind == 3:
        return rows - ((left.astype(np.uint16) + up) >> 1).astype(np.uint8)
    return rows - (np.zeros_like(rows), left, up, None, _paeth(left, up, corner) if kind == 4 else None)[kind]


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x, y, z = a.astype(np.int16), b.astype(np.int16), c.astype(np.int16)
    p = x + y - z
    pa_, pb, pc = abs(p - x), abs(p - y), abs(p - z)
    return np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c))


def filtered(rows: np.ndarray, filters: tuple[int, ...] = FILTERS) -> np.ndarray:
    """Lines with their filter in front: that of the least sum of absolute differences."""
    tried = [_predicted(kind, rows) for kind in filters]
    # differences are bytes around 0: 255 is one below it
    sums = np.stack([np.minimum(x, -x).sum(axis=1, dtype=np.int64) for x in tried])
    best = sums.argmin(axis=0)
    lines = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    lines[:, 0] = np.array(filters, np.uint8)[best]
    for i, x in enumerate(tried):
        lines[best == i, 1:] = x[best == i]
    return lines


def encode_png(data: bytes | np.ndarray, width: int = WIDTH, filters: tuple[int, ...] = FILTERS, level: int = 6) -> bytes:
    """A grey 8-bit PNG whose pixels are ``data``, a multiple of ``width`` bytes."""
    lines = filtered(np.frombuffer(data, np.uint8).reshape(-1, width), filters)
    body = zlib.compress(lines.tobytes(), level)
    parts = [_chunk(b"IDAT", body[i : i + CHUNK]) for i in range(0, len(body), CHUNK)]
    return b"".join([SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(lines), 8, 0, 0, 0, 0)), *parts, _chunk(b"IEND", b"")])


def _undo_diagonals(kinds: np.ndarray, rows: np.ndarray, above: np.ndarray) -> None:
    """Undo lines of the filters 3 and 4 in place.  A pixel needs those to its left, above
    and between, so that all pixels of one anti-diagonal are undone together."""
    height, width = rows.shape
    full = np.zeros((height + 1, width + 1), np.uint8)  # a line above, a column to the left
    full[0, 1:] = above
    for d in range(height + width - 1):
        r = np.arange(max(0, d - width + 1), min(height, d + 1))
        c = d - r
        left, up, corner = full[r + 1, c], full[r, c + 1], full[r, c]
        mean = ((left.astype(np.uint16) + up) >> 1).astype(np.uint8)
        full[r + 1, c + 1] = rows[r, c] + np.where(kinds[r] == 3, mean, _paeth(left, up, corner))
    rows[:] = full[1:, 1:]


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Pixels of filtered lines whose first byte names the filter.  Lines that only look left
    are undone all at once, then runs of those that look up together."""
    kinds, rows = lines[:, 0], lines[:, 1:].copy()
    if len(kinds) and kinds.max() > 4:
        raise ValueError(f"unknown filter {kinds.max()}")
    sub = kinds == 1
    rows[sub] = np.add.accumulate(rows[sub], axis=1, dtype=np.uint8)
    group = np.minimum(kinds, 3)  # averages and Paeth lines go together
    edges = np.flatnonzero(np.diff(group.astype(np.int16), prepend=-1, append=-1))
    none = np.zeros(rows.shape[1], np.uint8)
    for a, b, kind in zip(edges[:-1].tolist(), edges[1:].tolist(), group[edges[:-1]].tolist()):
        if kind == 2:
            if a:
                rows[a] += rows[a - 1]
            np.add.accumulate(rows[a:b], axis=0, dtype=np.uint8, out=rows[a:b])
        elif kind == 3:
            _undo_diagonals(kinds[a:b], rows[a:b], rows[a - 1] if a else none)
    return rows


def decode_png(png: bytes) -> np.ndarray:
    """Pixels of a grey 8-bit PNG; raises when a chunk fails its test."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, parts, shape = 8, [], None
    while True:
        (size,), kind = struct.unpack_from(">I", png, at), png[at + 4 : at + 8]
        data = png[at + 8 : at + 8 + size]
        if len(data) != size or struct.unpack_from(">I", png, at + 8 + size)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise ValueError(f"chunk {kind!r} fails its checksum")
        at += 12 + size
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", data)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("only plain grey 8-bit images are read")
            shape = (height, width + 1)
        elif kind == b"IDAT":
            parts.append(data)
        elif kind == b"IEND":
            return unfilter(np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(shape))


_K = np.arange(SIDE)
_COSINE = (np.cos(np.pi * (2 * _K[None, :] + 1) * _K[:LOW, None] / (2 * SIDE))).astype(np.float64)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Means of ``SIDE`` even stretches of lines; fewer lines are repeated."""
    n = len(x)
    if n < SIDE:
        return x[np.arange(SIDE) * n // SIDE].astype(np.float64)
    edges = np.arange(SIDE + 1) * n // SIDE
    return np.add.reduceat(x, edges[:-1], axis=0, dtype=np.float64) / np.diff(edges)[:, None]


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which low frequencies are above the median of all but the mean."""
    small = _scaled(_scaled(pixels).T)
    low = (_COSINE @ small @ _COSINE.T).round(6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def padded(text: bytes, unit: int = WIDTH) -> bytes:
    """The text with bytes 0 up to a positive multiple of ``unit``."""
    return text + bytes(max(unit, -(-len(text) // unit) * unit) - len(text))


def _store(level: int):
    def run(batches):
        for part in slices(batches):
            raw, bounds = text_buffer(part.column("text"))
            texts = [raw[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            images = [encode_png(padded(t), level=level) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(bounds)), pa.array(images, pa.binary())], names=["doc_id", "n_bytes", "media"]
            )

    return run


def store_media(docs: DataFrame, level: int = 6) -> DataFrame:
    """``doc_id, n_bytes, media``: each text's bytes as an image in a stored binary column; a
    null text counts as empty, rows without doc_id and repeated rows are stored like others."""
    return written(docs.select("doc_id", "text").mapInArrow(_store(level), "doc_id long, n_bytes long, media binary"), "media")


def _features(batches):
    for part in slices(batches, "media"):
        out = []
        for doc, n, png in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media"))):
            pixels = decode_png(png)
            data = pixels.tobytes()
            digest = hashlib.sha256(data).hexdigest()
            out.append((doc, n, len(data), digest, zlib.crc32(data[-64:]), len(png), hashlib.sha256(png).hexdigest(), cosine_hash(pixels)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=list(_COLUMNS))


_COLUMNS = {
    "doc_id": "long", "n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long",
    "media_bytes": "long", "media_sha256": "string", "hash": "binary",
}


def media_features(media: DataFrame) -> DataFrame:
    """Digests of what the stored images hold, and their cosine ``hash``."""
    return media.mapInArrow(_features, ", ".join(f"{c} {t}" for c, t in _COLUMNS.items()))
