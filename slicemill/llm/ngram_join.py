"""N-gram Jaccard join by MinHash banding, and the near-duplicate classes that follow from it.

A document is the set of its runs of ``SIZE`` words (lower case, split at ASCII punctuation and space); a shorter
document is one run, one without words the empty set. Documents with equal sets are one *node*, known by the hash
of its set; copies are therefore never paired. Two nodes are linked if their Jaccard similarity is at least
``SIMILARITY``.

1. One pass computes node and band hashes of every document. ``bands_for`` picks the numbers of bands and rows: the
   most rows that reach the target recall at the threshold within the given number of hashes.
2. Nodes are shuffled on their band hashes. Buckets with the same members as one of an earlier band are left out:
   they could only show the same pairs again.
3. Full n-gram sets, computed anew for nodes that share a bucket, go to the buckets. A large bucket is cut into
   blocks, and each pair of blocks is one unit of work of bounded size, so a hot group is spread over all tasks. A pair
   is verified on the full sets in the bucket of its first common band only. What comes out is counts per node and a
   spanning forest, never the pairs.
4. Connected components of the forest give the classes, by star contraction over stored tables.

The work inside a group of different but similar texts grows with its square, as every link is counted; the rows that
Spark moves grow with its square only over the block size.

Defined cases: null, empty and word-free texts are equal to each other: one class without links to others; rows equal
in doc_id and text count as copies; a class is named by its smallest doc_id (null ids last); repeated rows of the
kept document are dropped with its other copies; very long texts are read whole; empty tables give empty results; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import keyed, map_batches, same_document, shuffle_partitions, slices, without, written

SIZE, SIMILARITY, RECALL, HASHES = 5, 0.8, 0.9999, 192
BLOCK_NODES, BLOCK_GRAMS = 256, 150_000
BROADCAST_ROWS = 500_000  # about 60 bytes each
WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bands_for(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows, and then the fewest bands, that find a pair at the threshold with this probability."""
    best = None
    for rows in range(1, hashes + 1):
        hit = similarity ** rows
        bands = 1 if hit >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach this recall; allow more hashes")
    return best


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word runs."""
    known: dict[str, int] = {}
    codes, lengths = [], []
    for text in texts:
        words = WORD.findall(text.lower()) if text else []
        lengths.append(len(words))
        codes.extend([known.setdefault(w, len(known)) for w in words])
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in known], np.uint64)
    every = hashes[np.array(codes, np.int64)] if codes else np.zeros(0, np.uint64)
    odd = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)

    def runs(h: np.ndarray, n: int) -> np.ndarray:
        return mixed(sum(h[i:len(h) - n + 1 + i] * odd[i] for i in range(n)) + np.uint64(n))

    out, at = [], 0
    for n in lengths:
        h = every[at:at + n]
        at += n
        out.append(np.unique(runs(h, min(size, n))) if n else h[:0])
    return out


def minhashes(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(grams), 2048):
        low = np.minimum(low, (grams[at:at + 2048, None] * factors).min(axis=0))
    return low


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, th, node, n (grams) and bands (one hash each; none for the empty set) of every document."""
    factors = mixed(np.arange(1000, 1000 + bands * rows, dtype=np.uint64)) | np.uint64(1)
    salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def start():
        def run(batch: pa.RecordBatch) -> dict[str, list]:
            node, n, keys = [], [], []
            for grams in gram_sets(batch.column("text").to_pylist(), size):
                node.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                n.append(len(grams))
                if len(grams):
                    band = minhashes(grams, factors).reshape(bands, rows)
                    h = salt.copy()
                    for r in range(rows):
                        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + band[:, r])
                    keys.append(h.view(np.int64))
                else:
                    keys.append(np.zeros(0, np.int64))
            return {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "node": node, "n": n, "bands": keys}
        return run

    return map_batches(keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long")), start, "doc_id long, th long, node binary, n int, bands array<long>")


def verified(work: DataFrame, similarity: float) -> DataFrame:
    """Rows (a, b, docs, texts): b null: partial link counts of a; otherwise an edge of the spanning forest."""
    schema = "a binary, b binary, docs long, texts long"

    def groups(batches: Iterator[pa.RecordBatch]):
        """Rows of one unit of work at a time; the frame is sorted by unit."""
        held, last = [], None
        for batch in batches:
            for piece in slices(batch):
                d = [piece.column(c).to_pylist() for c in ("key", "x", "y", "band", "block", "node", "copies")]
                sets, bands = piece.column("grams"), piece.column("bands")
                gram_at, gram_of = sets.offsets.to_numpy(), sets.values.to_numpy().view(np.uint64)
                band_at, band_of = bands.offsets.to_numpy(), bands.values.to_numpy()
                for i, row in enumerate(zip(*d)):
                    if row[:3] != last:
                        if held:
                            yield held
                        held, last = [], row[:3]
                    held.append(row[3:] + (gram_of[gram_at[i]:gram_at[i + 1]].copy(), band_of[band_at[i]:band_at[i + 1]].copy()))
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in groups(batches):
            out += linked(rows, similarity)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip("a b docs texts".split(), map(list, zip(*out)))), SCHEMA)
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip("a b docs texts".split(), map(list, zip(*out)))), SCHEMA)

    return work.mapInArrow(run, schema)


SCHEMA = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("docs", pa.int64()), ("texts", pa.int64())])


def linked(rows: list[tuple], similarity: float) -> list[tuple]:
    """Counts and forest of one unit: rows of (band, block, node, copies, grams, bands)."""
    m, band = len(rows), rows[0][0]
    if m < 2:
        return []
    block = np.array([r[1] for r in rows])
    bands = np.stack([r[5] for r in rows])
    size = np.array([len(r[4]) for r in rows])
    if m <= 4:
        shared = np.zeros((m, m), np.int64)
        for i, j in itertools.combinations(range(m), 2):
            if min(size[i], size[j]) >= similarity * max(size[i], size[j]) - 1e-9:
                shared[i, j] = len(np.intersect1d(rows[i][4], rows[j][4], assume_unique=True))
    else:
        grams, column = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True)
        owner = np.repeat(np.arange(m), size)
        common = np.bincount(column, minlength=len(grams)) > 1  # others are in no intersection
        rank = np.cumsum(common) - 1
        owner, column = owner[common[column]], rank[column[common[column]]]
        shared = np.zeros((m, m), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(common.sum()), 8192):
            lo, hi = np.searchsorted(column, [at, at + 8192])
            held = np.zeros((m, 8192), np.float32)
            held[owner[lo:hi], column[lo:hi] - at] = 1
            shared += held @ held.T
    union = size[:, None] + size[None, :] - shared
    links = np.triu(shared >= similarity * union - 1e-6, 1)
    if block.min() != block.max():
        links &= block[:, None] != block[None, :]  # pairs inside a block have a unit of their own
    i, j = np.nonzero(links)
    if band and len(i):
        new = ~(bands[i, :band] == bands[j, :band]).any(axis=1)
        i, j = i[new], j[new]
    if not len(i):
        return []
    copies = np.array([r[3] for r in rows])
    docs = np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
    texts = np.bincount(i, minlength=m) + np.bincount(j, minlength=m)
    out = [(rows[k][2], None, int(docs[k]), int(texts[k])) for k in np.flatnonzero(texts)]
    root = list(range(m))

    def find(k):
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[b] = a
            out.append((rows[a][2], rows[b][2], 0, 0))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (a, b): root is the smallest node of the component.

    Large and small stars in turn, each round stored in the shared folder, until nothing changes. The driver sees a count
    and a checksum per round.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        near = both.join(low, "a")
        if large:
            out = near.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = near.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    edges, seen = written(edges.where("a <> b"), "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(28,0)"))).first()
        if mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        seen = mark
        edges = written(stars(written(stars(edges, True), "large"), False), "small")


def join(docs: DataFrame, size: int = SIZE, similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> DataFrame:
    """One row per document: doc_id, th, class_id, n_links (other documents linked to it, copies included), n_texts
    (different n-gram sets linked to its own), first (it is the document that names the class)."""
    spark = docs.sparkSession
    bands, per_band = bands_for(similarity, recall, hashes)
    every = written(signatures(docs, size, bands, per_band), "signatures")
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    # folded before the shuffle, so that a node of many copies is one row for each task
    nodes = every.groupBy("node").agg(F.count("*").alias("copies"), F.min(holder).alias("holder"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = written(nodes, "nodes")
    own = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    buckets = own.groupBy("key").agg(
        F.first("band").alias("band"), F.count("*").alias("m"), F.sum(F.col("n").cast("long")).alias("grams"),
        F.sum(F.xxhash64("node").cast("decimal(28,0)")).alias("s1"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(28,0)")).alias("s2")).where("m > 1")
    buckets = buckets.groupBy("m", "grams", "s1", "s2").agg(F.min(F.struct("band", "key")).alias("first")).select("m", F.col("grams").alias("total"), "first.key", "first.band")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_GRAMS), F.lit(1))
    members = own.select("node", "key").join(buckets, "key").select("node", "key", "band", blocks.cast("int").alias("blocks"))
    members = written(members, "members")

    # full sets of the nodes that share a bucket
    need = nodes.join(members.select("node").distinct(), "node").select("node", "copies", F.col("holder.doc_id").alias("doc_id"), F.col("holder.th").alias("th"))
    need = written(need, "needed")
    texts, wanted = keyed(docs), need
    if need.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(need)
    texts = texts.join(wanted, same_document(texts, wanted)).select("node", "copies", "text")

    def sets():
        return lambda batch: {"node": batch.column("node"), "copies": batch.column("copies"),
                              "grams": [g.view(np.int64) for g in gram_sets(batch.column("text").to_pylist(), size)]}

    full = map_batches(texts, sets, "node binary, copies long, grams array<long>").dropDuplicates(["node"])
    full = written(full.join(nodes.select("node", "bands"), "node"), "sets")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    work = members.join(full, "node").withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = work.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "band", "block", "node", "copies", "grams", "bands")
    work = work.repartition(shuffle_partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y")
    found = written(verified(work, similarity), "links")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    info = nodes.join(roots, "node", "left").join(counts, "node", "left")
    info = written(info.select("node", F.coalesce("root", "node").alias("root"), "copies", "holder", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("texts", F.lit(0)).alias("texts")), "info")
    names = info.groupBy("root").agg(F.min("holder").alias("name"))
    info = info.join(names, "root").select("node", "name", (F.col("copies") - 1 + F.col("docs")).alias("n_links"), F.col("texts").alias("n_texts"))
    out = every.select("doc_id", "th", "node").join(info, "node")
    first = F.col("doc_id").eqNullSafe(F.col("name.doc_id")) & (F.col("th") == F.col("name.th"))
    return out.select("doc_id", "th", F.col("name.doc_id").alias("class_id"), "n_links", "n_texts", first.alias("first"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class."""
    found = written(join(docs, **options), "classes")
    out = without(docs, found.where("not first").select("doc_id", "th").distinct())
    first = found.where("first")
    if first.count() > first.select("doc_id", "th").distinct().count():  # rows equal in doc_id and text
        out = out.dropDuplicates(["doc_id", "text"])
    return out
