"""Repeated passages: seed and extend on winnowed anchors.

An anchor is the k-gram of least hash in each stretch of ``window - k + 1`` k-grams
(winnowing): every window of ``window`` words chooses one anchor by its own content, so
equal windows choose equal anchors at equal places.  Seeds are anchors that documents
share; each seed is extended left and right over the stretch of windows that chose it.
Stretches agree by one key of their words; of each kind, those of its first document are
extended window by window as well, since parts of a stretch may repeat too.  Extensions
agree by key, not pair by pair: an anchor of thousands of documents costs a row each.
Overlapping repeats join into maximal spans.

Texts are dealt by doc_id, and places in them carry the hash ``row`` of their text: rows of
one doc_id with different texts are told apart, while only the ids decide which is smaller.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from climgrid.llm.store import meet, written
from climgrid.llm.text import gram_hashes, mix, slices, text_buffer, word_hashes, word_spans

WINDOW, ANCHOR = 13, 5


def choices(grams: np.ndarray, span: int) -> np.ndarray:
    """For each stretch of ``span`` k-grams the place of its least hash, the last of equals."""

    def least(a, b):
        """Of two stretches the least of both: the later one's place where they are equal."""
        later = b[0] <= a[0]
        return np.where(later, b[0], a[0]), np.where(later, b[1], a[1])

    n = len(grams) - span + 1
    part, wide = (grams, np.arange(len(grams))), 1
    while wide < span:  # stretches twice as wide are of two that meet or overlap
        step = min(wide, span - wide)
        part = least(tuple(x[:-step] for x in part), tuple(x[step:] for x in part))
        wide += step
    return part[1][: max(n, 0)]


def _each(part: pa.RecordBatch, column: str = "text"):
    """Bytes, word spans and word hashes of each text of a slice."""
    raw, bounds = text_buffer(part.column(column))
    starts, ends, first = word_spans(raw, bounds)
    words = word_hashes(raw, starts, ends)
    for row, (i, j) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        yield row, raw, starts[i:j], ends[i:j], words[i:j]


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts of a slice, and the index of each text's first word."""
    raw, bounds = text_buffer(part.column("text"))
    starts, ends, first = word_spans(raw, bounds)
    return word_hashes(raw, starts, ends), first


def _chosen(words: np.ndarray, first: np.ndarray, takes: np.ndarray, window: int, k: int):
    """The stretches of windows that choose one anchor, over a whole slice: text, first window,
    last window, hash of the anchor.  ``takes``: the texts that take part.  No window reaches
    from one text into the next."""
    none = np.empty(0, np.int64)
    if len(words) < window:
        return none, none, none, np.empty(0, np.uint64)
    grams = gram_hashes(words, k)
    place = choices(grams, window - k + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(place)]
    whole = np.flatnonzero(takes[text] & (np.arange(len(place)) + window <= first[text + 1]))
    place, text = place[whole], text[whole]
    lead = np.ones(len(whole), bool)
    lead[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(lead)
    last = np.append(begin[1:], len(whole))[: len(begin)] - 1
    return text[begin], whole[begin], whole[last], grams[place[begin]]


def _anchors(window: int, k: int):
    def run(batches):
        for part in slices(batches):
            ids = part.column("doc_id").cast(pa.int64())
            takes = ids.is_valid().to_numpy(zero_copy_only=False)
            text, _, _, anchor = _chosen(*_words(part), takes, window, k)
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), ids.take(pa.array(text[new]))], names=["anchor", "doc_id"])

    return run


def _stretches(window: int, k: int):
    """The stretch of windows that chose each seed: key of its words, first window, windows."""

    def run(batches):
        for part in slices(batches):
            seeds = part.column("seeds")
            words, first = _words(part)
            text, begin, last, anchor = _chosen(words, first, seeds.is_valid().to_numpy(zero_copy_only=False), window, k)
            # an anchor that several documents share is a seed of each that chose it: those of
            # the slice are looked up together
            hit = _among(anchor, np.unique(seeds.flatten().to_numpy().view(np.uint64)))
            text, begin, last = text[hit], begin[hit], last[hit]
            # first and last window together hold all words of a stretch: it has at most span windows
            key = gram_hashes(words, window, 1, begin) * np.uint64(0x9E3779B97F4A7C15) + gram_hashes(words, window, 1, last)
            key = mix(key + (last - begin).astype(np.uint64))
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("doc_id").take(at), part.column("row").take(at), pa.array(begin - first[text]), pa.array(last - begin + 1)],
                names=["key", "doc_id", "row", "at", "n"],
            )

    return run


def _windows(window: int):
    """Keys of the single windows of the stretches in ``leads``."""

    def run(batches):
        for part in slices(batches):
            words, first = _words(part)
            text, begin, n = _places(part.column("leads"), part.column("row"))
            at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            text = np.repeat(text, n)
            key, own = gram_hashes(words, window, 1, first[text] + at), pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("doc_id").take(own), part.column("row").take(own), pa.array(at)],
                names=["key", "doc_id", "row", "at"],
            )

    return run


def _places(lists: pa.ListArray, rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of ``(row, at, n)``, one a text: text, first window and number of windows of those
    that lie in the text itself, whose hash is in ``rows``."""
    size = pc.fill_null(lists.value_lengths(), 0).to_numpy()
    text, flat = np.repeat(np.arange(len(lists)), size), lists.flatten()
    row, at, n = (flat.field(c).to_numpy() for c in ("row", "at", "n"))
    own = row == rows.to_numpy()[text]
    return text[own], at[own], n[own]


def _fields(places, row: int) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of those ``(row, at, n)`` of a list that lie in the
    text ``row``."""
    if not places.is_valid:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    own = places.values.field("row").to_numpy() == row
    return places.values.field("at").to_numpy()[own], places.values.field("n").to_numpy()[own]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def spans(starts: np.ndarray, window: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """Maximal ``(begin, end)`` spans of words under windows that begin at ``starts``, each
    the first of ``sizes`` (1) windows in a row."""
    starts = np.asarray(starts, np.int64)
    if not len(starts):
        return np.empty((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + window - 1 + (1 if sizes is None else sizes))[order]
    reach = np.maximum.accumulate(ends)
    lead = np.concatenate([[True], starts[1:] > reach[:-1]])
    return np.stack([starts[lead], reach[np.append(np.flatnonzero(lead)[1:] - 1, len(starts) - 1)]], axis=1)


def _row(text) -> Column:
    return F.xxhash64(text).alias("row")


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _row("text"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``(doc_id, repeats)``: windows of each document that also begin in a smaller doc_id,
    as ``(row, at, n)`` of n windows in a row of the text whose hash is ``row``."""
    source = _source(docs)
    anchors = source.mapInArrow(_anchors(window, k), "anchor long, doc_id long")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    found = meet(anchors, shared.select("anchor"), "anchor")
    seeds = written(found.groupBy("doc_id").agg(F.collect_list("anchor").alias("seeds")), "seeds")
    # what follows, and the join of the repeats to the texts, reads one shuffle of the texts:
    # for that, all ask for the same rows, also those without seeds
    runs = source.join(seeds, "doc_id", "left").mapInArrow(_stretches(window, k), "key long, doc_id long, row long, at long, n long")
    first = runs.groupBy("key").agg(F.min("doc_id").alias("lo"))
    place = F.struct("row", "at", "n")
    marks = meet(runs, first, "key").groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("lo") < F.col("doc_id"), place)).alias("again"),
        F.collect_list(F.when(F.col("lo") == F.col("doc_id"), place)).alias("leads"),
    )
    # a stretch that repeats one of a smaller document is decided, and so are its windows; of
    # each kind of stretch only those of the first document are compared window by window
    led = source.join(marks.select("doc_id", "leads"), "doc_id", "left")
    keys = led.mapInArrow(_windows(window), "key long, doc_id long, row long, at long")
    least = keys.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    single = F.struct("row", "at", F.lit(1).cast("long").alias("n"))
    more = meet(keys, least, "key").where("lo < doc_id").groupBy("doc_id").agg(F.collect_list(single).alias("more"))
    both = marks.join(more, "doc_id", "left")
    whole = F.concat("again", F.coalesce("more", F.array().cast("array<struct<row: bigint, at: bigint, n: bigint>>")))
    return both.select("doc_id", whole.alias("repeats")).where(F.size("repeats") > 0)


def _spans_of(repeats, row: int, window: int) -> np.ndarray:
    at, n = _fields(repeats, row)
    return spans(at, window, n)


def _reduced(window: int):
    """Kept words of each document."""

    def run(batches):
        for part in slices(batches):
            raw, bounds = text_buffer(part.column("text"))
            starts, ends, first = word_spans(raw, bounds)
            text, at, n = _places(part.column("repeats"), part.column("row"))
            # a word is removed that more repeated windows begin at or before than end before
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, first[text] + at, 1)
            np.add.at(change, np.minimum(first[text] + at + n - 1 + window, first[text + 1]), -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            doc = np.repeat(np.arange(part.num_rows), np.diff(first))[kept]
            # bytes of kept words, each followed by a space where the text has another kept one
            joined = np.zeros(len(kept), bool)
            joined[:-1] = doc[1:] == doc[:-1]
            raw, begin, end = raw.copy(), starts[kept], ends[kept]
            raw[end[joined]] = 0x20
            edges = np.zeros(len(raw) + 1, np.int8)
            np.add.at(edges, begin, 1)
            np.add.at(edges, end + joined, -1)
            data = raw[np.cumsum(edges[:-1], dtype=np.int8).view(bool)].tobytes()
            size = np.bincount(doc, end + joined - begin, part.num_rows).astype(np.int64)
            cuts = np.concatenate([[0], np.cumsum(size)])
            digest = [hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            words = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(words), pa.array(words - np.bincount(doc, minlength=part.num_rows)), pa.array(digest),
                    pa.StringArray.from_buffers(part.num_rows, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data)),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every document.

    Words covered by a repeated window are removed; ``kept_text`` is the others, joined by
    one space.  A null or short text has no window and loses nothing.  Rows of one doc_id
    are judged each for itself and never repeat each other; a row without doc_id neither loses words nor makes others
    lose any.
    """
    source = _source(docs)
    joined = source.join(repeated_windows(docs, window, k), "doc_id", "left")
    return joined.mapInArrow(
        _reduced(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )


def _cut(window: int, text: str, length: str | None):
    """Texts without their repeated spans; the last columns have the hash of the text and the
    repeats, others stay."""

    def run(batches):
        for part in slices(batches, text):
            names = part.schema.names[:-2]
            texts, own, repeats = part.column(text).to_pylist(), part.columns[-2].to_numpy(), part.columns[-1]
            for row, raw, begin, end, _ in _each(part, text):
                gone = _spans_of(repeats[row], own[row], window).tolist()
                if gone:
                    first, last, data = int(begin[0]), int(end[-1]), raw.data
                    edges = [first]
                    for i, j in gone:
                        edges += [int(begin[i]), int(begin[j]) if j < len(begin) else last]
                    edges.append(last)
                    texts[row] = b"".join(bytes(data[a:b]) for a, b in zip(edges[::2], edges[1::2])).decode().rstrip()
            columns = dict(zip(names, part.columns))
            columns[text] = pa.array(texts, pa.string())
            if length:
                columns[length] = pa.array([None if t is None else len(t) for t in texts], part.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, length: str | None = "n_chars") -> DataFrame:
    """The documents, with the words of repeated windows cut out of their texts.

    A cut takes the words and the white space after each; other white space stays, and a
    text without repeats stays as it is.  ``length`` names a column that holds the code
    points of the text, where there is one.
    """
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]  # tasks take any column names
    place = dict(zip(names, plain))
    rows = docs.toDF(*plain)
    found = repeated_windows(docs, window, k).toDF("found_id", "repeats")
    joined = rows.withColumn("row", _row(place["text"])).join(found, F.col(place["doc_id"]).cast("long") == F.col("found_id"), "left").drop("found_id")
    return joined.mapInArrow(_cut(window, place["text"], place.get(length)), rows.schema).toDF(*names)
