"""Phrase collocations: counting in a HAT-trie of word ids, and ranking by association.

Each task counts its texts in a trie over word ids that is shallow: its nodes are languages
and first words, below them hang hash containers of the two words that follow (fewer where a
piece ends), and a container that grows too large bursts into a node with a container for
each second word.  Every place of a text is one leaf; counts of words and pairs are sums over
the leaves below them.  When a trie holds too many leaves its largest subtrees are spilled
whole, as sorted runs.

Runs are merged per prefix partition: a partition is a range of the sorted leaves, and a run
is cut at its borders into packed blocks, so a shuffle moves few, compressed rows.  The
borders come from a bounded sample of places, so a very common first word or pair spreads
over as many partitions as its share asks for, and of one leaf only a count from each run
meets.  Sums of a prefix that reaches over a border are added up afterwards.

Words of a phrase are joined by one space (words have none).  A null language is ``und``, a
null text is empty.  Equal rows count each for itself.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from climgrid.llm.store import under_share, written
from climgrid.llm.text import slices, text_buffer

NO_LANGUAGE = "und"
BITS = 20  # of a word id; a task with more different words spills and starts anew
BURST = 4096  # leaves of a container that bursts
MOST_LEAVES = 500_000  # leaves of a trie, beyond which subtrees are spilled
MOST_LETTERS = 24 << 20  # letters of words of a trie
AT_ONCE = 1_000_000  # words that a trie takes in at once
SLICE = 2 << 20  # bytes of texts that are taken together
RANGE_PLACES = 3_000_000  # places of the texts that a prefix partition is meant to hold
SAMPLE_DOCS, SAMPLE_PLACES = 2_000, 64  # at most about twice as many documents, and places of each

_BLOCK = pa.schema([("part", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("leaves", pa.binary())])
_SHIFT = BITS + 1  # a second or third word is its id plus one, or 0 for none
_REST = (1 << _SHIFT) - 1
_WORD_MASK = (1 << BITS) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of the texts in order, the text of each, and the number of the piece it is in."""
    raw, bounds = text_buffer(texts)
    raw = _LOWER[raw]
    gap = _GAP[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    starts = np.flatnonzero((before | edge[:-1]) & ~gap)
    ends = np.flatnonzero((after | edge[1:]) & ~gap) + 1
    text = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(_BREAK[raw])[starts] + text if len(starts) else starts  # a text ends a piece as well
    kept = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(~gap, out=kept[1:])
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(kept[starts], kept[-1]).astype(np.int32).tobytes()), pa.py_buffer(raw[~gap].tobytes())
    )
    return words.dictionary_encode(), text, piece


class Trie:
    """Counts of leaves: a word with up to two that follow it in its piece.

    Below a language and a first word lies either a container, ``{rest: count}``, or after a
    burst a node ``{second word: container}``.  The rest is a number made of the second and the
    third word's id, each plus one, or 0 where the piece ends."""

    def __init__(self, most: int = MOST_LEAVES, burst: int = BURST):
        self.most, self.burst = most, burst
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}  # in the order of the ids
        self.letters = self.size = 0
        self.roots: dict[str, dict[int, dict]] = {}
        self.nodes: set[tuple[str, int]] = set()

    def full(self, new_words: int) -> bool:
        return len(self.ids) + new_words > _WORD_MASK or self.letters > MOST_LETTERS

    def learn(self, names: list[str]) -> np.ndarray:
        """Ids of words."""
        ids, before = self.ids, len(self.ids)
        own = np.array([ids.setdefault(w, len(ids)) for w in names], np.int64)
        self.letters += sum(len(names[i]) for i in np.flatnonzero(own >= before).tolist())
        return own

    def add(self, lang: str, w: np.ndarray, piece: np.ndarray, begin: int) -> None:
        """Count the leaves that begin in the first ``begin`` words (ids in their order)."""
        if not begin:
            return
        keys, n = np.unique(leaf_keys(w, piece)[:begin], return_counts=True)
        first = keys >> 2 * _SHIFT
        rest, n = (keys & (1 << 2 * _SHIFT) - 1).tolist(), n.tolist()
        edges = [0, *(np.flatnonzero(np.diff(first)) + 1).tolist(), len(rest)]
        root = self.roots.setdefault(lang, {})
        for f, a, b in zip(first[edges[:-1]].tolist(), edges, edges[1:]):
            if f in root:
                self._count(lang, root, f, rest[a:b], n[a:b])
            else:
                root[f] = dict(zip(rest[a:b], n[a:b]))
                self.size += b - a

    def _count(self, lang: str, root: dict, first: int, rest: list[int], n: list[int]) -> None:
        below = root[first]
        if (lang, first) not in self.nodes:
            before = len(below)
            for k, c in zip(rest, n):
                below[k] = below.get(k, 0) + c
            self.size += len(below) - before
            if len(below) > self.burst:
                root[first] = node = {}
                for k, c in below.items():
                    node.setdefault(k >> _SHIFT, {})[k] = c
                self.nodes.add((lang, first))
        else:
            for k, c in zip(rest, n):
                box = below.get(k >> _SHIFT)
                if box is None:
                    below[k >> _SHIFT] = {k: c}
                    self.size += 1
                else:
                    before = len(box)
                    box[k] = box.get(k, 0) + c
                    self.size += len(box) - before

    def _boxes(self, lang: str, first: int) -> list[dict[int, int]]:
        below = self.roots[lang][first]
        return list(below.values()) if (lang, first) in self.nodes else [below]

    def spill(self, keep: int) -> Iterator["Run"]:
        """Take out whole subtrees, the largest first, until at most ``keep`` leaves are left,
        as one sorted run a language; with ``keep`` 0 everything, and the words are forgotten."""
        trees = [
            (sum(map(len, below.values())) if (lang, f) in self.nodes else len(below), lang, f)
            for lang, root in self.roots.items()
            for f, below in root.items()
        ]
        trees.sort(key=lambda t: -t[0])
        taken: dict[str, list[tuple[int, int, list[dict]]]] = {}
        for size, lang, first in trees:
            if keep and self.size <= keep:
                break
            taken.setdefault(lang, []).append((first, size, self._boxes(lang, first)))
            self.size -= size
            del self.roots[lang][first]
            self.nodes.discard((lang, first))
        words, rank = None, np.zeros(1, np.int64)
        if taken:  # the order of the words is found once for all languages
            words = pa.array(list(self.ids), pa.string())
            order = pc.sort_indices(words).to_numpy()
            words = words.take(pa.array(order))
            rank = np.zeros(len(words) + 1, np.int64)  # by id plus one
            rank[order + 1] = np.arange(1, len(words) + 1)
        for lang, out in sorted(taken.items()):
            boxes = [box for _, _, some in out for box in some]
            first = np.repeat([f for f, _, _ in out], [size for _, size, _ in out])
            rest = np.fromiter(chain.from_iterable(boxes), np.int64, len(first))
            n = np.fromiter(chain.from_iterable(map(dict.values, boxes)), np.int64, len(first))
            keys = rank[first + 1] - 1 << 2 * _SHIFT | rank[rest >> _SHIFT] << _SHIFT | rank[rest & _REST]
            order = np.argsort(keys)
            yield Run(lang, words, keys[order], n[order])
        if not keep:
            self.clear()


def leaf_keys(w: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """The leaf that begins at each word, as a number of the three word ids."""
    second, third = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
    pair = piece[1:] == piece[:-1]
    second[:-1][pair] = w[1:][pair] + 1
    three = pair[1:] & pair[:-1]
    third[:-2][three] = w[2:][three] + 1
    return w << 2 * _SHIFT | second << _SHIFT | third


class Run:
    """Leaves of one language in order of their words."""

    def __init__(self, lang: str, words: pa.Array, keys: np.ndarray, n: np.ndarray):
        """``words`` in order; ``keys`` made of places in them as a trie's leaves are of ids."""
        self.lang, self.words, self.keys, self.n = lang, words, keys, n

    def border(self, leaf: tuple[str, ...]) -> int:
        """The least number that leaves at or after ``leaf`` (one to three words) may have."""
        at = key = 0
        names = self.words
        for i, shift in enumerate((2 * _SHIFT, _SHIFT, 0)):
            if i == len(leaf):
                break
            at = _place(names, leaf[i])
            there = at < len(names) and names[at].as_py() == leaf[i]
            key |= (at + (i > 0)) << shift
            if not there:
                break
        return key

    def blocks(self, borders: list[tuple]) -> Iterator[tuple]:
        """(part, lang, words, leaves) for each range that the run reaches."""
        start = bisect_left(borders, (self.lang,))
        own = borders[start : bisect_right(borders, (self.lang, chr(0x10FFFF)))]
        cuts = np.searchsorted(self.keys, np.array([self.border(b[1:]) for b in own], np.int64))
        edges = [0, *cuts.tolist(), len(self.keys)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                yield start + i, self.lang, *self._packed(a, b)

    def _packed(self, a: int, b: int) -> tuple[bytes, bytes]:
        keys = self.keys[a:b]
        parts = [(keys >> 2 * _SHIFT) + 1, keys >> _SHIFT & _REST, keys & _REST]
        used = np.zeros(len(self.words) + 1, bool)
        for p in parts:
            used[p] = True
        used[0] = False
        number = np.cumsum(used, dtype=np.int32) * used
        codes = [number[p] for p in parts]
        names = pa.record_batch([self.words.take(pa.array(np.flatnonzero(used) - 1))], names=["word"])
        return _stored(names), _stored(pa.record_batch([*map(pa.array, codes), pa.array(self.n[a:b])], names=["w1", "w2", "w3", "n"]))


def _stored(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _loaded(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _place(words: pa.Array, w: str) -> int:
    """Where ``w`` stands, or would stand, among sorted words."""
    lo, hi = 0, len(words)
    while lo < hi:
        mid = (lo + hi) // 2
        if words[mid].as_py() < w:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _languages(part: pa.RecordBatch, text: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """Each language of a batch with the places of its words; ``text``: the text of each word."""
    codes = pc.fill_null(part.column("lang"), NO_LANGUAGE).dictionary_encode()
    of = codes.indices.to_numpy(zero_copy_only=False)[text]
    for k, lang in enumerate(codes.dictionary.to_pylist()):
        mine = np.flatnonzero(of == k)
        if len(mine):
            yield lang, mine


def sorted_runs(batches: Iterable[pa.RecordBatch], trie: Trie | None = None) -> Iterator[Run]:
    """Batches of lang and text as runs of leaves."""
    trie = trie or Trie()
    for part in slices(batches, most=SLICE):
        words, text, piece = words_of(part.column("text"))
        code = words.indices.to_numpy(zero_copy_only=False)
        for at in range(0, len(words), AT_ONCE):  # a text may be very long
            here = slice(at, at + AT_ONCE + 2)
            used = np.zeros(len(words.dictionary), bool)
            used[code[here]] = True
            if trie.full(int(used.sum())):
                yield from trie.spill(0)
            ids = np.zeros(len(used), np.int64)
            ids[used] = trie.learn(words.dictionary.filter(pa.array(used)).to_pylist())
            w = ids[code[here]]
            for lang, mine in _languages(part, text[here]):
                trie.add(lang, w[mine], piece[here][mine], int(np.searchsorted(mine, AT_ONCE)))
            if trie.size > trie.most:
                yield from trie.spill(trie.most // 2)
    yield from trie.spill(0)


def packed_runs(batches: Iterable[pa.RecordBatch], borders: list[tuple]) -> Iterator[pa.RecordBatch]:
    for run in sorted_runs(batches):
        rows = list(run.blocks(borders))
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 64]), _BLOCK)], schema=_BLOCK)


def merged(blocks: pa.Table, least: int) -> pa.Table:
    """Counts of one prefix partition: words, pairs and threes.  Threes are whole, and so are
    pairs but for the first and last of a language; of whole ones those under ``least`` are
    left out.  Words come with what the partition holds of them."""
    langs, phrases, counts = [], [], []
    for lang in pc.unique(blocks.column("lang")).to_pylist():
        own = blocks.filter(pc.equal(blocks.column("lang"), lang))
        names = [_loaded(raw).column(0).combine_chunks() for raw in own.column("words").to_pylist()]
        # one dictionary of all blocks, and the place of each block's words in its order
        every = pa.concat_arrays(names).dictionary_encode()
        order = pc.sort_indices(every.dictionary).to_numpy()
        words = every.dictionary.take(pa.array(order))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(1, len(words) + 1)
        place, begin = rank[every.indices.to_numpy()], 0
        small = len(words) < _REST
        # a leaf is held as one number where it fits: three words apart take several times the room
        keys, times = [], []
        for some, raw in zip(names, own.column("leaves").to_pylist()):
            table = _loaded(raw)
            at = np.append(0, place[begin : begin + len(some)])
            begin += len(some)
            w1, w2, w3 = (at[table.column(c).to_numpy()] for c in ("w1", "w2", "w3"))
            keys.append(w1 << 2 * _SHIFT | w2 << _SHIFT | w3 if small else np.stack((w3, w2, w1)))
            times.append(table.column("n").to_numpy())
        del table, w1, w2, w3
        leaf, n = np.concatenate(keys, axis=-1), np.concatenate(times)
        del keys, times
        # runs are sorted already, which a stable sort makes use of
        order = np.argsort(leaf, kind="stable") if small else np.lexsort(leaf)
        leaf, n = leaf[..., order], n[order]
        del order
        if small:
            w1, w2, w3 = ((leaf >> shift & _REST).astype(np.int32) for shift in (2 * _SHIFT, _SHIFT, 0))
        else:
            w3, w2, w1 = leaf
        del leaf
        name = np.append(None, words.to_numpy(zero_copy_only=False))

        def fold(*by):
            new = np.zeros(len(n), bool)
            new[:1] = True
            for c in by:
                new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            return at, np.add.reduceat(n, at)

        for depth, by in enumerate(((w1,), (w1, w2), (w1, w2, w3)), 1):
            at, f = fold(*by)
            keep = np.ones(len(at), bool)
            if depth > 1:
                keep = f >= least
                if depth == 2:
                    keep[[0, -1]] = True
                keep &= by[-1][at] > 0
            at, f = at[keep], f[keep]
            langs += [lang] * len(at)
            phrases += [" ".join(t) for t in zip(*[name[c[at]].tolist() for c in by])]
            counts.append(f)
    return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "f": np.concatenate(counts or [np.empty(0, np.int64)])})


def merge_range(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    yield from merged(pa.Table.from_batches(batches, _BLOCK), least).to_batches(max_chunksize=50_000)


def sample_leaves(batches: Iterable[pa.RecordBatch], places: int = SAMPLE_PLACES) -> Iterator[pa.RecordBatch]:
    """Some evenly spaced leaves of each text with how many there are."""
    for part in slices(batches):
        for i in range(part.num_rows):
            one = part.slice(i, 1)
            words, text, piece = words_of(one.column("text"))
            names, code, size = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False), len(words)
            some = np.unique(np.linspace(0, size - 1, min(size, places)).astype(int)).tolist()
            for lang, _ in _languages(one, text):
                leaves = [[names[code[k]] for k in range(j, min(j + 3, size)) if piece[k] == piece[j]] for j in some]
                langs, weight = [lang] * len(some), np.full(len(some), size / len(some))
                yield pa.record_batch([pa.array(langs, pa.string()), pa.array(leaves, pa.list_(pa.string())), weight], names=["lang", "leaf", "weight"])


def range_borders(docs: DataFrame, places: int = RANGE_PLACES) -> list[tuple]:
    """Borders (lang, word, ...) of prefix partitions of about ``places`` places each, by a
    sample of some documents; they decide how even the partitions are, not what is counted."""
    total = docs.count()
    few = docs.where(under_share(F.col("text"), F.lit(total), F.lit(SAMPLE_DOCS)))
    rows = few.mapInArrow(sample_leaves, "lang string, leaf array<string>, weight double").collect()
    held = few.count() if rows else 0
    leaves = sorted(((r.lang, *r.leaf), r.weight) for r in rows)
    weight = np.cumsum([w for _, w in leaves])
    parts = int(weight[-1] * total / held / places) + 1 if held else 1
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts) if parts > 1 else []
    return sorted({leaves[i][0] for i in at})


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of all words, and of all phrases of 2 and 3 words that occur at least
    ``least`` times; words by themselves have no space in ``phrase``."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    borders = range_borders(docs)
    blocks = docs.mapInArrow(lambda batches: packed_runs(batches, borders), "part long, lang string, words binary, leaves binary")
    # a task a range
    dealt = blocks.repartitionById(len(borders) + 1, F.col("part").cast("int"))
    parts = dealt.mapInArrow(lambda batches: merge_range(batches, least), "lang string, phrase string, f long")
    whole = parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return written(whole.where((F.col("f") >= least) | (F.instr("phrase", " ") == 0)), "phrases")


def collocations(docs: DataFrame, least: int = 10, first: int = 2000, inside: int = 50) -> DataFrame:
    """Phrases of 2 or 3 words with ``f`` of ``least`` or more, ranked within each language.

    ``a`` is the phrase's count; the cut after its first k words gives l and r, the counts of
    both parts, and the score floor(1000000 * a * a / (l * r)); the lowest score counts, of
    equal ones the smallest k.  A phrase that lies inside a longer one with at least
    ``inside`` percent of its count is left out.  Returns the first ``first`` of each
    language by score, then a (both descending), then phrase (by bytes): lang, rank, phrase,
    a, l, r, n (all words of the language), score, k.
    """
    counts = phrase_counts(docs, least)
    space = F.instr("phrase", " ")
    w = F.split("phrase", " ")
    part = lambda i, j: F.array_join(F.slice(w, i, j), " ")
    two = counts.where((space > 0) & (F.size(w) == 2)).select("lang", "phrase", F.col("f").alias("a"), part(1, 1).alias("p1"), part(2, 1).alias("p2"))
    three = counts.where(F.size(w) == 3).select(
        "lang", "phrase", F.col("f").alias("a"), part(1, 1).alias("p1"), part(2, 2).alias("p23"), part(1, 2).alias("p12"), part(3, 1).alias("p3")
    )
    # the counts are a written table: both sides of each join are dealt for it, and Spark
    # splits the phrases of a very common word
    of = lambda p, f: counts.select(F.col("lang"), F.col("phrase").alias(p), F.col("f").alias(f))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    score = lambda l, r: F.expr(  # noqa: E731, E741
        f"CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * 1000000BD div (CAST({l} AS DECIMAL(19,0)) * CAST({r} AS DECIMAL(19,0)))"
    )
    cut = lambda k, l, r: F.struct(score(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))  # noqa: E731, E741
    longer = three.select("lang", F.explode(F.array("p12", "p23")).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    two = two.join(of("p1", "l"), ["lang", "p1"]).join(of("p2", "r"), ["lang", "p2"]).join(longer, ["lang", "phrase"], "left")
    two = two.where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside))
    three = three.join(of("p1", "l1"), ["lang", "p1"]).join(of("p23", "r1"), ["lang", "p23"])
    three = three.join(of("p12", "l2"), ["lang", "p12"]).join(of("p3", "r2"), ["lang", "p3"])
    lowest = F.array_min(F.array(cut(1, "l1", "r1"), cut(2, "l2", "r2")))
    rows = two.select("lang", "phrase", "a", cut(1, "l", "r").alias("c")).unionByName(three.select("lang", "phrase", "a", lowest.alias("c")))
    rows = rows.select("lang", "phrase", "a", "c.l", "c.r", "c.score", "c.k")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # the first ones of parts of a language, then of fewer parts, then of all: no task sorts a whole one
    many = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for parts in (many, 8):
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= first)
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    total = counts.where(space == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score", "k")
