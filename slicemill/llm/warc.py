"""Web archives, index first: one gzip member for each record, an index of byte ranges, and reads of sorted ranges.

``write`` stores a record for each page below a folder that all executors reach and returns the index: page_id, url,
digest, record type, file, offset and length. The index is stored before anything is read. Of the records with equal
payloads of at least ``LEAST`` bytes, the one of the smallest page_id is a response with the payload; the others are
revisits that name it and hold the header of the answer only. ``read`` takes any selection of the index, sorts it by
file and offset in ranges, joins neighbours at most ``GAP`` bytes apart to one read of up to ``READ`` bytes, unpacks the
members and checks each payload against the digest in its record.

A task writes its archives under names of that attempt, so a task that runs again leaves whole files; only those that the
stored index names count. Payloads are moved by no shuffle as long as the repeated digests are fewer than
``BROADCAST_DIGESTS`` (about 100 bytes each); beyond, pages and digests are joined by a shuffle of the pages.

Defined cases: a null html is an empty payload; rows that share the smallest page_id of a payload are all responses, and so
are rows without an id if no row with that payload has one; a row without an id revisits the smallest id there is; a
null url leaves its header out; repeated rows are records of their own; a very long payload is held in memory
whole; an empty table gives an empty index; extra columns are not used.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import shuffle_partitions, slices, written

LEAST = 100                    # bytes of a payload that is worth a revisit
ARCHIVE = 1 << 30              # bytes after which a new archive is begun
GAP, READ = 64 << 10, 8 << 20  # of byte ranges read at once
TASK = 128 << 20               # bytes that one task reads
BROADCAST_DIGESTS = 400_000
DATE = "2024-02-29T00:00:00Z"
INDEX = "page_id long, url string, digest string, record_type string, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(name: bytes) -> int | None:
    number = name.split(b":")[2]
    return int(number) if number else None


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))]) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(head.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_name(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    headers += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_name(first, digest))]
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return member(headers, answer if revisit else answer + payload)


def info_member() -> bytes:
    """The first record of an archive."""
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n")


def fields(head: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}


def parsed(raw: bytes) -> tuple[int | None, int, str, str, int | None, bytes | None]:
    """page_id, payload bytes and digest, record type, the page referred to and the payload (None in a revisit)."""
    text = zlib.decompress(raw, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    own = fields(head)
    block = rest[:int(own[b"content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError(f"record {own[b'warc-record-id']!r} is not as long as its header says")
    answer, _, payload = block.partition(b"\r\n\r\n")
    digest, size = own[b"warc-payload-digest"].removeprefix(b"sha256:").decode(), int(fields(answer)[b"content-length"])
    page_id = page_of(own[b"warc-record-id"][:-1])
    if own[b"warc-type"] == b"revisit":
        return page_id, size, digest, "revisit", page_of(own[b"warc-refers-to"][:-1]), None
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {own[b'warc-record-id']!r} does not hold the payload of its digest")
    return page_id, size, digest, "response", None, payload


def write(pages: DataFrame, target: str, least: int = LEAST, archive: int = ARCHIVE) -> DataFrame:
    """Writes the archives below ``target`` and returns their stored index."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    worth = F.octet_length("payload") >= least
    repeated = rows.where(worth).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = written(repeated.where("n > 1 and first is not null").select("digest", "first"), "repeated")
    few = F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated
    rows = rows.join(few, "digest", "left")
    rows = rows.select("page_id", "url", "payload", "digest", "first", (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(target)
        stream, name, at = None, None, 0
        for batch in batches:
            for some in slices(batch):
                made = []
                for row in zip(*(some.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first", "revisit"))):
                    if stream is None or at > archive:
                        if stream:
                            stream.close()
                        system.create_dir(folder, recursive=True)
                        name = f"{folder}/pages-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}.warc.gz"
                        stream = system.open_output_stream(name, compression=None)
                        info = info_member()
                        stream.write(info)
                        at = len(info)
                    raw = record(*row)
                    stream.write(raw)
                    made.append(("revisit" if row[-1] else "response", name, at, len(raw)))
                    at += len(raw)
                kinds, files, offsets, lengths = zip(*made) if made else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), some.column("digest"), pa.array(kinds, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    [f.split()[0] for f in INDEX.split(", ")])
        if stream:
            stream.close()

    return written(rows.mapInArrow(run, INDEX), "index")


def joined_ranges(ranges: list[tuple[str, int, int]], gap: int = GAP, read: int = READ) -> Iterator[tuple[int, int, int]]:
    """(from, to, end offset) of neighbours in a sorted list of (file, offset, length) that are read at once."""
    first = 0
    while first < len(ranges):
        file, begin, length = ranges[first]
        end, last = begin + length, first + 1
        while last < len(ranges) and ranges[last][0] == file and ranges[last][1] <= end + gap and ranges[last][1] + ranges[last][2] - begin <= read:
            end = max(end, ranges[last][1] + ranges[last][2])
            last += 1
        yield first, last, end
        first = last


def read(index: DataFrame, target: str, payloads: bool = True, gap: int = GAP, at_once: int = READ) -> DataFrame:
    """The records that ``index``, or any part of it, names, with the payloads of responses if asked for."""
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(1, -(-size // TASK), min(shuffle_partitions(index.sparkSession), -(-size // READ)))
    sorted_ranges = index.select("file", "offset", "length", "url").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(target)
        stream, name = None, None
        for some in batches:
            urls = some.column("url")
            ranges = list(zip(*(some.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for first, last, end in joined_ranges(ranges, gap, at_once):
                if ranges[first][0] != name:
                    if stream:
                        stream.close()
                    name = ranges[first][0]
                    stream = system.open_input_file(name)
                begin = ranges[first][1]
                raw = stream.read_at(end - begin, begin)
                found = list(zip(*[parsed(raw[o - begin:o - begin + n]) for _, o, n in ranges[first:last]]))
                kept = found[5] if payloads else [None] * (last - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int64()), urls.slice(first, last - first), pa.array(found[1], pa.int64()), pa.array(found[2], pa.string()), pa.array(found[3], pa.string()),
                     pa.array(found[4], pa.int64()), pa.array(kept, pa.binary())], [f.split()[0] for f in RECORD.split(", ")])
        if stream:
            stream.close()

    return sorted_ranges.mapInArrow(run, RECORD)


def payloads_of(index: DataFrame, target: str) -> DataFrame:
    """page_id, url and payload of all records of the stored ``index``; a revisit gets that of the response it refers to."""
    every = written(read(index, target), "records")
    own = every.where("record_type = 'response'").select("page_id", "url", "payload")
    again = every.where("record_type = 'revisit'").select(F.col("page_id").alias("by"), F.col("url").alias("own_url"), "refers_to", "payload_digest")
    whole = every.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload").dropDuplicates(["refers_to", "payload_digest"])
    return own.unionByName(again.join(whole, ["refers_to", "payload_digest"]).select(F.col("by").alias("page_id"), F.col("own_url").alias("url"), "payload"))
