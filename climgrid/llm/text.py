"""Whole-batch text work inside Spark tasks: words, 64-bit hashes, tokenizer ids.

A batch of texts is one byte buffer with offsets (Arrow's own layout); words and hashes
are found for all texts of a slice at once with numpy.  Slices bound the memory of a
task; a longer text is a slice of its own.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64

#: Spark SQL pattern of what separates words.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | U64(1)
_BASE = int(_rng.integers(1 << 62, 1 << 63)) | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base & _MASK))
    out[0] = 1
    return np.multiply.accumulate(out)


_CHUNK = 1 << 18
_POWERS = _powers(_BASE, _CHUNK)
_INVERSES = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows whose texts hold at most ``most`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text begins (one more than texts)."""
    column = pc.fill_null(column, "")
    if column.offset or not pa.types.is_string(column.type):
        column = pa.concat_arrays([column.cast(pa.string())])
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of each word, and the index of each text's first word."""
    space = _IS_SPACE[raw]
    before = np.ones(len(raw), bool)
    before[1:] = space[:-1]
    before[bounds[:-1][bounds[:-1] < len(raw)]] = True
    after = np.ones(len(raw), bool)
    after[:-1] = space[1:]
    last = bounds[1:] - 1
    after[last[last >= 0]] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes; ``lower``: with A-Z as a-z."""
    value = _LOWER_VALUE if lower else _BYTE_VALUE
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = int(np.searchsorted(ends, base + _CHUNK, side="right"))
        if to <= at:  # a word longer than a chunk
            total, factor = U64(0), 1
            for i in range(base, int(ends[at]), _CHUNK):
                part = value[raw[i : min(i + _CHUNK, int(ends[at]))]]
                total += (part * _POWERS[: len(part)]).sum(dtype=np.uint64) * U64(factor)
                factor = factor * pow(_BASE, _CHUNK, 1 << 64) & _MASK
            out[at] = total
            at += 1
            continue
        s, e = starts[at:to] - base, ends[at:to] - base
        part = value[raw[base : base + int(e[-1])]] * _POWERS[: int(e[-1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        out[at:to] = (sums[e] - sums[s]) * _INVERSES[s]
        at = to
    return mix(out ^ (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int, seed: int = 0, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of ``k`` word hashes, in order of its first word; ``at``: of those that
    begin at these words."""
    n = len(words) - k + 1 if at is None else len(at)
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, U64((seed * 2 + 1) * 0x9E3779B97F4A7C15 & _MASK))
    for i in range(k):
        out += (words[i : i + n] if at is None else words[at + i]) * _PLACE[i]
    return mix(out)


def sequence_hash(words: np.ndarray) -> int:
    """Hash of a short sequence of fewer words than a shingle has."""
    return int(mix(np.array([(len(words) << 32) + 7], np.uint64) + (words * _PLACE[8 : 8 + len(words)]).sum(dtype=np.uint64))[0])


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[i for i in range(33, 127) if not chr(i).isalnum() and i != 39]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32


class UnitEncoder:
    """Token ids of whole texts by the tokenizers library, each distinct unit encoded once.

    A unit is a stretch that no pre-token of the vocabulary reaches out of.  For one that
    drops white space and case (``spaces=False``) texts are cut around white space, and A-Z
    taken as a-z; for a byte-level one (``spaces=True``), before a space with a non-space
    byte below 128 on one side, and around a line break between two such bytes.  Both cut
    between an ASCII letter and a mark other than the apostrophe.
    Units are counted per slice; ids of those met are kept up to ``keep`` bytes of units.

    The strings of the vocabulary's added tokens count as ordinary text; with ``added`` they
    are those tokens, as the library has it by default: units cut such strings, so the few
    texts that hold one go to the library whole.
    """

    def __init__(self, path: str, spaces: bool, added: bool = False, keep: int = 3_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.whole, self.added = (Tokenizer.from_file(path), self._added()) if added else (None, [])
        self.spaces, self.keep, self.held, self.known = spaces, keep, 0, {}
        # what a run of units is joined by, and its one id, which no joined unit may hold
        self.glue = "\n\n" if spaces else " \x01 "
        self.glue_ids = self._plain([self.glue])[0]

    def _added(self) -> list[str]:
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _holds_added(self, column: pa.Array) -> np.ndarray:
        """Texts that may hold an added token: a normalizer may change case before it is met."""
        held = np.zeros(len(column), bool)
        for content in self.added:
            held |= pc.match_substring(column, content, ignore_case=True).to_numpy(zero_copy_only=False)
        return held

    def _plain(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _fits(self, unit: str) -> bool:
        if self.spaces:
            return unit[:1] == " " and len(unit.split()) == 1 and not unit[1:2].isspace() and not unit[-1].isspace()
        return unit != "" and "\x01" not in unit and not unit.isspace()

    def _encode(self, units: list[str]) -> dict[str, bytes]:
        """Runs of units go to the library as one text, which is then cut at the glue."""
        out: dict[str, bytes] = {}
        joined = [u for u in units if len(u) < 200 and self._fits(u)] if len(self.glue_ids) == 1 else []
        runs = [joined[i : i + 50] for i in range(0, len(joined), 50)]
        for run, ids in zip(runs, self._plain([self.glue.join(run) for run in runs])):
            ids = np.array(ids, np.uint32)
            cuts = np.flatnonzero(ids == self.glue_ids[0])
            if len(cuts) == len(run) - 1:
                raw, cuts = ids.tobytes(), (4 * cuts).tolist()
                out.update(zip(run, [raw[i:j] for i, j in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]))
        alone = [u for u in units if u not in out]
        out.update(zip(alone, [np.array(ids, np.uint32).tobytes() for ids in self._plain(alone)]))
        return out

    def _units(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, unit bounds in them, and the index of each text's first unit."""
        if not self.spaces:
            starts, ends, _ = word_spans(raw, bounds)
            solid = ~_IS_SPACE[raw]
            kept = np.concatenate([[0], np.cumsum(solid)])
            raw, bounds = _ASCII_LOWER[raw[solid]], kept[bounds]
            cut = np.zeros(len(raw), bool)
            cut[kept[starts]] = True
        else:
            space = _IS_SPACE[raw]
            plain = ~space & (raw < 128)
            before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
            before[1:], after[:-1] = plain[:-1], plain[1:]
            cut = (raw == 0x20) & (before | after)
            line = np.flatnonzero((raw == 0x0A) & before & after)
            cut[line] = cut[line + 1] = True
        edge = _LETTER[raw[:-1]] & _MARK[raw[1:]] | _MARK[raw[:-1]] & _LETTER[raw[1:]]
        cut[1:] |= edge
        cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
        starts = np.flatnonzero(cut)
        return raw, np.append(starts, len(raw)), np.searchsorted(starts, bounds)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin."""
        column = pc.fill_null(column, "")
        held = self._holds_added(column)
        if not held.any():
            return self._by_units(column)
        ids, begin = self._by_units(pc.if_else(pa.array(held), "", column))
        at, size, parts = np.flatnonzero(held), np.zeros(len(column), np.int64), []
        for i in at:
            parts.append(np.array(self.whole.encode(column[int(i)].as_py(), add_special_tokens=False).ids, np.uint32))
            size[i] = len(parts[-1])
        return np.insert(ids, np.repeat(begin[at], size[at]), np.concatenate(parts)), begin + np.insert(np.cumsum(size), 0, 0)

    def _by_units(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, cuts, first = self._units(*text_buffer(column))
        if len(cuts) == 1:
            return np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        units = pa.StringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())
        ).dictionary_encode()
        distinct = units.dictionary.to_pylist()
        known = self.known
        ids = [known.get(u) for u in distinct]
        new = [u for u, x in zip(distinct, ids) if x is None]
        fresh = self._encode(new)
        if new:
            ids = [fresh[u] if x is None else x for u, x in zip(distinct, ids)]
        for u in new if self.held < self.keep else ():
            if len(u) < 40 and self.held < self.keep:
                known[u] = fresh[u]
                self.held += len(u)
        # the ids of each unit in its place: Arrow copies them, so that no index of ids is made
        flat = pa.array(ids, pa.large_binary()).take(units.indices)
        _, ends, data = flat.buffers()
        begin = np.frombuffer(ends, np.int64)[flat.offset : flat.offset + len(flat) + 1] // 4
        return np.frombuffer(data, np.uint32)[begin[0] : begin[-1]], begin[first] - begin[0]


@lru_cache(maxsize=2)
def unit_encoder(path: str, spaces: bool, added: bool = False) -> UnitEncoder:
    """One encoder per Python worker: its memory of units serves all tasks of the worker."""
    return UnitEncoder(path, spaces, added)
