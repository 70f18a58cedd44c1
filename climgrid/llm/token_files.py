"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by doc_id; each task encodes its range and writes one
Arrow file whose batches hold fixed-size lists: ``ids`` and a ``mask`` that is 0 on the
padding of the last sequence.  The lists of a batch are one buffer, so sequence ``i`` of a
memory-mapped file is a slice of it.  A second file beside it tells where each document
begins.  Ids run on from file to file in ascending doc_id order.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.store import folder_made, one_a_task, open_folder, written
from climgrid.llm.text import slices, unit_encoder

LENGTH, PER_BATCH, END_ID = 2048, 64, 0
SLICE = 4 << 20


def file_schema(length: int, wide: bool) -> pa.Schema:
    """Ids of 16 bits where the vocabulary fits them, else of 32; a bit of mask each."""
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_batch(ids: np.ndarray, length: int, wide: bool) -> pa.RecordBatch:
    """Ids as rows of ``length``; the last is padded with 0 and masked there."""
    rows = -(-len(ids) // length)
    flat, mask = np.zeros(rows * length, np.uint32 if wide else np.uint16), np.zeros(rows * length, bool)
    flat[: len(ids)], mask[: len(ids)] = ids, True
    arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (flat, mask)]
    return pa.RecordBatch.from_arrays(arrays, schema=file_schema(length, wide))


def _write(folder: str, path: str, end_id: int, length: int, added: bool):
    def run(batches):
        encode, part, total, held = unit_encoder(path, True, added), TaskContext.get().partitionId(), 0, np.empty(0, np.uint32)
        fs, root = open_folder(folder)
        name, scratch = f"{root}/part-{part:06d}", f"{root}/.{uuid.uuid4().hex}"
        chunk = length * PER_BATCH
        wide = max(encode.tokenizer.get_vocab_size() - 1, end_id) >= 1 << 16
        with (
            fs.open_output_stream(f"{scratch}.ids") as one, pa.ipc.new_file(one, file_schema(length, wide)) as sequences,
            fs.open_output_stream(f"{scratch}.docs") as two, pa.ipc.new_file(two, INDEX) as index,
        ):
            for piece in slices(batches, most=SLICE):
                ids, bounds = encode(piece.column("text"))
                size = np.diff(bounds) + 1
                index.write_batch(pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(total + np.cumsum(size) - size), pa.array(size)], schema=INDEX
                ))
                held = np.concatenate([held, np.insert(ids, bounds[1:], end_id)])
                total += int(size.sum())
                while len(held) >= chunk:
                    sequences.write_batch(sequence_batch(held[:chunk], length, wide))
                    held = held[chunk:]
            if len(held):
                sequences.write_batch(sequence_batch(held, length, wide))
        for kind in ("ids", "docs"):
            fs.move(f"{scratch}.{kind}", f"{name}.{kind}.arrow")
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([name]), pa.array([total])], names=["part", "path", "n_tokens"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, added: bool = False) -> DataFrame:
    """Encode all texts into files of ``folder``; ``(path, n_tokens, base)`` of each, ``base``
    being the ids in the files before it.

    A null text is empty and has its end id only; rows without doc_id come first; rows of
    one doc_id follow each other in any order.  ``added``: strings of the vocabulary's added
    tokens are those tokens, not ordinary text.  The offsets, one row a file, pass through
    the driver.
    """
    folder_made(folder)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    done = written(ordered.mapInArrow(_write(folder, tokenizer, end_id, length, added), "part long, path string, n_tokens long"), "token-files")
    files, base = [], 0
    for _, path, n in sorted(map(tuple, done.collect())):
        files.append((path, n, base))
        base += n
    return docs.sparkSession.createDataFrame(files, "path string, n_tokens long, base long")


def _read(folder: str):
    def run(batches):
        fs, _ = open_folder(folder)
        for batch in batches:
            for path, total, base in zip(*(batch.column(c).to_pylist() for c in ("path", "n_tokens", "base"))):
                with fs.open_input_file(f"{path}.ids.arrow") as one, fs.open_input_file(f"{path}.docs.arrow") as two:
                    sequences, index = pa.ipc.open_file(one), pa.ipc.open_file(two)
                    flat, at, turn = np.empty(0, np.uint32), 0, 0
                    for i in range(index.num_record_batches):
                        docs, out = index.get_batch(i), []
                        for doc, start, n in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens"))):
                            check, to = 0, start
                            while to < start + n:
                                while at + len(flat) <= to:
                                    at, rows = at + len(flat), sequences.get_batch(turn)
                                    real = rows.column("mask").flatten().true_count
                                    flat, turn = rows.column("ids").flatten().to_numpy()[:real], turn + 1
                                piece = flat[to - at : start + n - at].astype("<u4")
                                check, to = zlib.crc32(piece, check), to + len(piece)
                            out.append((doc, base + start, n, check))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    return run


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the stored ids; a task a file."""
    return one_a_task(files).mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
