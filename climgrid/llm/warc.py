"""WARC archives in Zstandard frames with a shared dictionary, written and read by tasks.

A file begins with a skippable frame that holds the dictionary, then has one frame a
record.  Pages of equal payload are found by digest before writing: the smallest page_id
is archived as a response, the others as revisits of it.  Each task writes under a name of
its own and moves the file into place, so a task that runs again leaves one file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from climgrid.llm.store import folder_made, one_a_task, open_folder, smallest_hashed, written

DICTIONARY_FRAME = 0x184D2A5D
HEAD = "WARC/1.1"
NO_DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(samples: list[bytes], size: int = 16 << 10) -> bytes:
    """A dictionary of whole records.  Where they are too few, or too much alike, to train on,
    their last bytes themselves are one (a raw-content dictionary)."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(samples)[-size:]
        return raw if len(raw) >= 8 else b""


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name[len("<urn:page:") : -1]
    return None if text == "none" else int(text)


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = NO_DATE) -> bytes:
    """One record: an HTTP response with the payload, or a revisit with its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        HEAD, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url or '') or _name(page_id)[1:-1]}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
        payload = b""
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(fields).encode() + http + payload + b"\r\n\r\n"


def read_records(stream):
    """``(header fields, HTTP fields, payload)`` of each record of a decompressed stream."""
    left = b""

    def take(n: int) -> bytes:
        nonlocal left
        parts, have = [left], len(left)
        while have < n:
            more = stream.read(max(1 << 16, n - have))
            if not more:
                raise ValueError("the archive ends within a record")
            parts.append(more)
            have += len(more)
        whole = b"".join(parts)
        left = whole[n:]
        return whole[:n]

    def head() -> list[str] | None:
        nonlocal left
        while (end := left.find(b"\r\n\r\n")) < 0:
            more = stream.read(1 << 16)
            if not more:
                if left:
                    raise ValueError("the archive ends within a header")
                return None
            left += more
        return take(end + 4)[:-4].decode().split("\r\n")

    fields_of = lambda lines: {k: v for k, _, v in (x.partition(": ") for x in lines[1:])}
    while (lines := head()) is not None:
        if lines[0] != HEAD:
            raise ValueError(f"not a record: {lines[0][:40]}")
        fields = fields_of(lines)
        block = take(int(fields["Content-Length"]) + 4)[:-4]
        top, _, payload = block.partition(b"\r\n\r\n")
        yield fields, fields_of(top.decode().split("\r\n")), payload


def _write(folder: str, dictionary: bytes, level: int):
    def run(batches):
        import zstandard

        fs, root = open_folder(folder)
        part = TaskContext.get().partitionId()
        path, scratch = f"{root}/part-{part:06d}.warc.zst", f"{root}/.{uuid.uuid4().hex}"
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared)
        n = 0
        with fs.open_output_stream(scratch, compression=None) as out:
            out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            for batch in batches:
                for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    out.write(pack.compress(record(page_id, url, (html or "").encode(), refers)))
                    n += 1
        if n:
            fs.move(scratch, path)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], names=["path", "records"])
        else:
            fs.delete_file(scratch)

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0, samples: int = 400, level: int = 3, sample_bytes: int = 4 << 20) -> DataFrame:
    """Archive every row of ``pages(page_id, url, html)``; ``(path, records)`` of the files.

    Payloads of at least ``least`` bytes that are equal to one of smaller page_id become
    revisits; rows without page_id are responses that nothing refers to, rows of one
    page_id are archived each.  The dictionary is trained on at most ``samples`` whole records,
    those of smallest hashed page_id, as many as ``sample_bytes`` of html hold.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    raw = F.coalesce("html", F.lit("")).cast("binary")
    marks = rows.where("page_id is not null").select("page_id", F.sha2(raw, 256).alias("_d"), F.length(raw).alias("_n")).where(F.col("_n") >= least)
    firsts = marks.groupBy("_d").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_hi")).where("refers_to < _hi").drop("_hi")
    firsts = written(firsts, "firsts")  # dealt anew for the join, so that Spark can split a very common payload
    again = marks.join(firsts, "_d").where("refers_to < page_id").select("page_id", "_d", "refers_to").distinct()
    # of rows with one page_id and other payloads, the payload decides
    same = (F.col("page_id") == F.col("_p")) & (F.sha2(raw, 256) == F.col("_d"))
    placed = rows.join(again.withColumnRenamed("page_id", "_p"), same, "left").select("page_id", "url", "html", "refers_to")
    ids = smallest_hashed(rows.select("page_id"), "page_id", samples).distinct()
    chosen = rows.join(F.broadcast(ids), "page_id", "left_semi").select("page_id", "url", "html", F.length(raw).alias("_n"))
    # of rows of one id that are many, the first by text
    order = Window.orderBy(F.xxhash64("page_id"), "page_id", "url", F.xxhash64("html"))
    first = Window.partitionBy("page_id").orderBy("url", F.xxhash64("html"))
    chosen = chosen.where(F.col("_n") <= sample_bytes).withColumn("_k", F.row_number().over(first)).where("_k = 1")
    chosen = chosen.withColumn("_sum", F.sum(F.coalesce("_n", F.lit(0))).over(order)).where(F.col("_sum") <= sample_bytes)
    dictionary = train_dictionary([record(r["page_id"], r["url"], (r["html"] or "").encode(), None) for r in chosen.collect()])
    folder_made(folder)
    return written(placed.mapInArrow(_write(folder, dictionary, level), "path string, records long"), "archives")


def _read(folder: str):
    def run(batches):
        import zstandard

        fs, _ = open_folder(folder)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                out = []
                with fs.open_input_stream(path, compression=None) as file:
                    magic, size = struct.unpack("<II", file.read(8))
                    if magic != DICTIONARY_FRAME:
                        raise ValueError(f"{path} has no dictionary frame")
                    dictionary = file.read(size)
                    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
                    stream = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(file, read_across_frames=True)
                    for fields, http, payload in read_records(stream):
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        size = int(http["Content-Length"])
                        if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
                            raise ValueError(f"a payload in {path} does not match its digest")
                        refers = fields.get("WARC-Refers-To")
                        out.append((
                            _number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, size, digest,
                            _number(refers) if refers else None, payload if kind == "response" else None,
                        ))
                        records -= 1
                        if len(out) == 256:
                            yield _batch(out)
                            out = []
                if records:
                    raise ValueError(f"{path} lacks {records} records")
                if out:
                    yield _batch(out)

    return run


_FIELDS = (
    ("page_id", "long", pa.int64()), ("url", "string", pa.string()), ("record_type", "string", pa.string()),
    ("payload_bytes", "long", pa.int64()), ("payload_digest", "string", pa.string()), ("refers_to", "long", pa.int64()),
    ("payload", "binary", pa.binary()),
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, _, t) in zip(zip(*rows), _FIELDS)], names=[n for n, _, _ in _FIELDS])


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Every record of the files named by ``files(path, records)``, checked against its digest;
    a task a file."""
    return one_a_task(files).mapInArrow(_read(folder), ", ".join(f"{n} {t}" for n, t, _ in _FIELDS))
