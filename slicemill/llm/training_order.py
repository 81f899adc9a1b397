"""Training-order materialisation: a keyed Feistel permutation gives every sequence its slot.

The documents of a block, ``ROWS`` successive rows of a file, are one stream of token ids with an end id after each; it is
cut into sequences of ``LENGTH`` ids, and the last one of a block is filled up with end ids. Blocks follow from the
files alone, so the same files and key give the same order on any cluster. Texts are encoded once: a task stores the
packed sequences of its blocks, and of a block that two tasks share the loose parts, which are then put together. The
sizes of the blocks give every sequence a dense index. The permutation is a balanced Feistel network over the next even
power of two; results outside the range are walked on until they fall inside. Sequences travel packed by destination. Tasks get
ranges of slots by their number, without a sample, and write them as shards of fixed stride: each under a name of that attempt, then moved to its place,
so a lost executor or a repeated task leaves whole files only. A manifest is written last; without it nothing is
read. A reader finds slot s at byte ``stride * (s % records)`` of shard ``s // records``.

The driver gets one row for each file; block sizes are broadcast up to ``BROADCAST_BLOCKS`` (about 100 bytes each) and
joined by a shuffle beyond.

Defined cases: null and empty texts are one end id; repeated rows are written as often as they come; a very long text is
encoded in one piece and cut into sequences like any other; there are no ties, as no two sequences share a slot; an empty
table gives a manifest and no shards; null ids are listed as such; extra columns are not used.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slicemill.llm.bytepairs import encoder, forget
from slicemill.llm.common import shuffle_partitions, slices, written

LENGTH, END, RECORDS = 1024, 50256, 4096
ROWS = 512        # of a block
SHARDS = 8        # that one task writes, at most; it holds them in memory
CHUNK = 4 << 20   # bytes of ids that are packed together, but for a longer document
HOLD = 4          # chunks that a task holds before it packs their sequences by destination
ROUNDS = 6
BROADCAST_BLOCKS = 400_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A permutation of 0 .. size - 1 that depends on the key alone."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mixed(np.uint64(key % (1 << 64)) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def once(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (mixed(left + k) & self.mask), left
            else:
                left, right = right, left ^ (mixed(right + k) & self.mask)
        return (left << self.half) | right

    def __call__(self, index, back: bool = False) -> np.ndarray:
        """Slots of indexes; with ``back`` indexes of slots."""
        x = self.once(np.asarray(index, np.uint64), back)
        while len(out := np.flatnonzero(x >= self.size)):
            x[out] = self.once(x[out], back)
        return x.astype(np.int64)


def stored_rows(stored: DataFrame) -> DataFrame:
    """A plain read of Parquet files with the file and the place in it of every row."""
    return stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


class Stream:
    """Cuts the ids of successive documents into sequences; ``made`` are the ids and documents of those that are full."""

    def __init__(self, width: int, at: int = 0):
        self.width, self.at, self.made = width, at, []  # at: place of the first in made
        self.held, self.docs, self.room = [], [], width

    def add(self, ids: bytes, docs: list) -> None:
        done = 0
        while done < len(ids):
            part = ids[done:done + self.room]
            self.held.append(part)
            self.docs += [d for d in docs if not self.docs or self.docs[-1] != d]
            done += len(part)
            self.room -= len(part)
            if not self.room:
                self.close()

    def close(self) -> None:
        if self.held:
            self.made.append((b"".join(self.held), self.docs))
        self.held, self.docs, self.room = [], [], self.width

    def open(self) -> tuple[bytes, list]:
        return b"".join(self.held), self.docs


ENCODED = "file string, block long, at long, row long, size long, ids binary, docs array<array<long>>"


class Chunks:
    """Rows of ENCODED: successive sequences of a block, packed together; ``row`` is set for loose parts only."""

    def __init__(self):
        self.codec, self.rows, self.held = codec(), [], 0

    def put(self, key: tuple, at: int | None, row: int | None, parts: list[tuple[bytes, list]]) -> None:
        ids = b"".join([p[0] for p in parts])
        self.rows.append((*key, at, row, len(ids), self.codec.compress(ids, asbytes=True), [p[1] for p in parts]))
        self.held += len(self.rows[-1][5])

    def flush(self, key: tuple, stream: Stream, least: int = 0) -> None:
        """The full sequences of the stream, if there are at least ``least`` bytes of them."""
        if stream.made and len(stream.made) * stream.width >= least:
            self.put(key, stream.at, None, stream.made)
            stream.at += len(stream.made)
            stream.made = []

    def take(self) -> pa.RecordBatch:
        columns, self.rows, self.held = list(zip(*self.rows)), [], 0
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in ENCODED.split(", ")])


def codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def unpacked(pack: pa.Codec, ids: bytes, size: int) -> bytes:
    return pack.decompress(ids, size, asbytes=True) if size else b""


def encoded(rows: DataFrame, length: int, end: int, rows_each: int, vocabulary: str | None, chunk: int) -> DataFrame:
    """Full sequences of the blocks, and the loose parts of blocks that a task has not seen whole."""
    width = 2 * length
    filler = np.array([end], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, out = encoder(vocabulary, "H"), Chunks()
        now = stream = last = first = None  # stream: of a block seen from its start

        def leave():
            """The block ends here, for this task at least."""
            if stream is None:
                return
            whole = last % rows_each == rows_each - 1
            if whole:
                stream.close()
            out.flush(now, stream)
            if not whole:  # others may count on, from here
                out.put(now, stream.at, first, [stream.open()])

        for batch in batches:
            for some in slices(batch):
                for file, row, doc_id, text in zip(*(some.column(c).to_pylist() for c in ("file", "row", "doc_id", "text"))):
                    if (file, row // rows_each) != now:
                        leave()
                        now, first = (file, row // rows_each), row
                        stream = Stream(width) if row % rows_each == 0 else None
                    ids, last = code(text) + filler, row
                    if stream is None:
                        out.put(now, None, row, [(ids, [doc_id])])
                    else:
                        stream.add(ids, [doc_id])
                        out.flush(now, stream, chunk)
                    if out.held > 2 * chunk:
                        yield out.take()
        leave()
        if out.rows:
            yield out.take()

    return rows.mapInArrow(run, ENCODED)


def mended(parts: DataFrame, length: int, chunk: int) -> DataFrame:
    """The sequences that the loose parts of each block make; a part that counts on from full sequences comes first."""
    width = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, stream = Chunks(), None, None

        def leave():
            if stream:
                stream.close()
                out.flush(now, stream)

        for batch in batches:
            for file, block, at, size, ids, docs in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "at", "size", "ids", "docs"))):
                if (file, block) != now:
                    leave()
                    now, stream = (file, block), Stream(width, at or 0)
                stream.add(unpacked(out.codec, ids, size), docs[0])
                out.flush(now, stream, chunk)
                if out.held > 2 * chunk:
                    yield out.take()
        leave()
        if out.rows:
            yield out.take()

    dealt = parts.repartition(shuffle_partitions(parts.sparkSession), "file", "block").sortWithinPartitions("file", "block", "row")
    return dealt.mapInArrow(run, ENCODED)


def indexed(sequences: DataFrame) -> tuple[DataFrame, int]:
    """The chunks with the dense index of their first sequence, by file, block and place, and the number of sequences."""
    blocks = written(sequences.groupBy("file", "block").agg(F.max(F.col("at") + F.size("docs")).alias("n")), "blocks")
    files, total = [], 0
    for r in sorted(blocks.groupBy("file").agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).collect()):
        files.append((r.file, total, r.blocks))
        total += r.n
    spark = sequences.sparkSession
    start = spark.createDataFrame([f[:2] for f in files], "file string, file_base long")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = blocks.join(start, "file").select("file", "block", (F.col("file_base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("base"))
    few = F.broadcast(bases) if sum(f[2] for f in files) <= BROADCAST_BLOCKS else bases
    return sequences.join(few, ["file", "block"]).withColumn("index", F.col("base") + F.col("at")), total


DEALT = "task int, size long, ids binary, slots array<long>, lengths array<long>, docs array<array<long>>"


def dealt(chunks: DataFrame, order: Permutation, length: int, records_each: int, hold: int) -> DataFrame:
    """The sequences of each task, those of one destination packed together."""
    width = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        pack, held, size = codec(), {}, 0

        def take():
            rows = []
            for task, own in held.items():
                slots, parts, docs = zip(*own)
                ids = b"".join(parts)
                rows.append((task, len(ids), pack.compress(ids, asbytes=True), list(slots), [len(x) // 2 for x in parts], list(docs)))
            held.clear()
            types = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in DEALT.split(", ")])

        for batch in batches:
            for n, ids, docs, index in zip(*(batch.column(c).to_pylist() for c in ("size", "ids", "docs", "index"))):
                raw = unpacked(pack, ids, n)
                for j, slot in enumerate(order(np.arange(index, index + len(docs), dtype=np.uint64)).tolist()):
                    held.setdefault(slot // records_each, []).append((slot, raw[j * width:(j + 1) * width], docs[j]))
                size += n
                if size > hold:
                    yield take()
                    size = 0
        if held:
            yield take()

    return chunks.select("size", "ids", "docs", "index").mapInArrow(run, DEALT)


def writer(target: str, total: int, length: int, records: int, end: int):
    """What writes the shards of one task and tells what it has written. The task's sequences are sorted in memory."""
    filler = np.array([end], "<u2").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        system, folder = fs.FileSystem.from_uri(target)
        pack, blobs, mine = codec(), [], []
        for batch in batches:
            for size, ids, slots, lengths, docs in zip(*(batch.column(c).to_pylist() for c in ("size", "ids", "slots", "lengths", "docs"))):
                at = 0
                for slot, n, own in zip(slots, lengths, docs):
                    mine.append((slot, len(blobs), at, n, own))
                    at += 2 * n
                blobs.append(unpacked(pack, ids, size))
        mine.sort()
        for shard in sorted({m[0] // records for m in mine}):
            own = [m for m in mine if m[0] // records == shard]
            if [m[0] for m in own] != list(range(shard * records, min((shard + 1) * records, total))):
                raise RuntimeError(f"shard {shard} does not hold each of its records once")
            name, marks = f"{folder}/.attempt-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}", []
            with system.open_output_stream(name, compression=None) as stream:
                for _, blob, at, n, _ in own:
                    record = blobs[blob][at:at + 2 * n] + filler * (length - n)
                    stream.write(record)
                    marks.append(zlib.crc32(record))
            system.move(name, f"{folder}/shard-{shard:08d}.bin")
            slots, _, _, lengths, docs = zip(*own)
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array([shard] * len(own), pa.int64()), pa.array(lengths, pa.int64()), pa.array(docs, pa.list_(pa.int64())), pa.array(marks, pa.int64())],
                                             ["slot", "shard", "n_tokens", "doc_ids", "ids_crc32"])

    return write


def materialise(stored: DataFrame, target: str, key: int, length: int = LENGTH, records: int = RECORDS, end: int = END, vocabulary: str | None = None, rows_each: int = ROWS,
                chunk: int = CHUNK) -> DataFrame:
    """Writes the shards and, last, the manifest below ``target``, a folder that all executors reach. The result, stored as
    well, has one row for each sequence: slot, shard, n_tokens, doc_ids (those it holds ids of), ids_crc32 (of the record)."""
    spark = stored.sparkSession
    found = written(encoded(stored_rows(stored), length, end, rows_each, vocabulary, chunk), "encoded")
    loose = written(mended(found.where("row is not null"), length, chunk), "mended")
    sequences, total = indexed(found.where("row is null").unionByName(loose))
    order = Permutation(max(1, total), key)
    shards = -(-total // records)
    each = max(1, min(SHARDS, shards // shuffle_partitions(spark)))
    made = dealt(sequences, order, length, records * each, HOLD * chunk).repartitionById(max(1, -(-shards // each)), F.col("task"))
    system, folder = fs.FileSystem.from_uri(target)
    system.create_dir(folder, recursive=True)
    report = written(made.mapInArrow(writer(target, total, length, records, end), "slot long, shard long, n_tokens long, doc_ids array<long>, ids_crc32 long"), "order")
    name = f"{folder}/.manifest-{uuid.uuid4().hex}"
    with system.open_output_stream(name, compression=None) as out:
        out.write(json.dumps({"sequences": total, "shards": shards, "records": records, "length": length, "end": end, "key": key, "rows_each": rows_each}).encode())
    system.move(name, f"{folder}/manifest.json")
    return report


def manifest(target: str) -> dict:
    """What a finished set says of itself; FileNotFoundError for one that is not finished."""
    system, folder = fs.FileSystem.from_uri(target)
    with system.open_input_file(f"{folder}/manifest.json") as f:
        return json.loads(f.read())


def read(target: str, first: int, count: int) -> np.ndarray:
    """The records of the slots from ``first`` on, at most ``count``: one seek in each shard, then sequential reads."""
    system, folder = fs.FileSystem.from_uri(target)
    about = manifest(target)
    length, records = about["length"], about["records"]
    if not 0 <= first <= about["sequences"]:
        raise IndexError(f"slot {first} of {about['sequences']}")
    out, count = [], min(count, about["sequences"] - first)
    while count:
        shard, at = divmod(first, records)
        n = min(count, records - at)
        with system.open_input_file(f"{folder}/shard-{shard:08d}.bin") as f:
            f.seek(at * 2 * length)
            raw = f.read(n * 2 * length)
        if len(raw) != n * 2 * length:
            raise ValueError(f"shard {shard} ends before slot {first + n}")
        out.append(np.frombuffer(raw, "<u2").reshape(-1, length))
        first, count = first + n, count - n
    return np.concatenate(out) if out else np.zeros((0, length), "<u2")
