"""Token counts, encoder, packing and training order."""

import itertools
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from slicemill.llm import bytepairs, packing, token_counts, training_order  # noqa: E402
from slicemill.session import work_path  # noqa: E402

ODD = ["", " ", "  ", "a  b", "\n\n a", " a ", "a\x1cb c\x1d\x1e", "İstanbul ΣΑΣ", "<|startoftext|>Hi<|endoftext|><|EndOfText|>", "é äx", "it's we'RE I'll they'd 'S",
       "²½Ⅷ १२३ 12345", "a b c​d", "😀👍🏽 ok", "ǅ ﬁ ß ẞ", "<|endoftext |>", "a<|endoftext|> b", "\x00\x01x", "漢字かな交じり文", "x" * 300]


def texts(n, seed):
    rnd = random.Random(seed)
    letters = "abcdeéßñ'<|>́ \n\t.,!12İΣ漢\U0001F600"
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(n)]


def test_counts_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_counts.Counter(path)
    every = texts(1500, 1)
    assert [own(t) for t in every] == [len(e.ids) for e in library.encode_batch(every, add_special_tokens=False)]


def test_forgetting_changes_nothing(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    every = texts(300, 2)
    want = [token_counts.Counter(path)(t) for t in every]
    monkeypatch.setattr(token_counts, "KEPT", 3)
    small = token_counts.Counter(path)
    assert [small(t) for t in every] == want
    code = bytepairs.ByteEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), "I")
    ids = [code(t) for t in every]
    monkeypatch.setattr(bytepairs, "KEPT", 3)
    assert [bytepairs.ByteEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), "I")(t) for t in every] == ids


def test_ids_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    code = bytepairs.encoder()
    every = texts(1500, 3)
    want = [e.ids for e in library.encode_batch(every, add_special_tokens=False)]
    assert [np.frombuffer(code(t), np.uint32).tolist() for t in every] == want
    assert [code.size(t) for t in every] == [len(w) for w in want]


def test_count_frame(awkward):
    rows = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(awkward).collect()}
    assert rows[(1, 0)].n_tokens == 0 and rows[(3, 4)].n_tokens == 0
    long = next(r for r in rows.values() if r.doc_id == 4)
    assert long.over_limit and long.n_tokens > 20_000
    assert token_counts.count_tokens(awkward).count() == 10 and token_counts.count_tokens(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("seed,kind", [(1, "even"), (2, "sparse"), (3, "short"), (4, "few")])
def test_plan(seed, kind):
    rng = np.random.default_rng(seed)
    capacity = 256
    h = {"even": rng.integers(0, 60, capacity + 1), "sparse": np.where(rng.random(capacity + 1) < 0.05, rng.integers(0, 40, capacity + 1), 0),
         "short": np.bincount(np.minimum(capacity, rng.geometric(0.05, 4000)), minlength=capacity + 1), "few": np.bincount(rng.integers(1, capacity, 5), minlength=capacity + 1)}[kind]
    h = h.astype(np.int64)
    h[0] = 0
    plan = packing.plan_for(h, capacity)
    assert all(sum(p) <= capacity and c > 0 for p, c in plan)
    held = np.zeros(capacity + 1, np.int64)
    for p, c in plan:
        for length in p:
            held[length] += c
    assert (held == h).all()
    best = sum(c for _, c in packing.best_fit(h, capacity))
    assert sum(c for _, c in plan) <= best  # never more than best fit alone


def check_packed(docs, capacity):
    rows = [r.asDict() for r in packing.pack(docs, capacity=capacity, with_ids=True).collect()]
    code = bytepairs.encoder()
    want = sorted(((r.doc_id, code(r.text) + np.array([2], "<u4").tobytes()) for r in docs.collect()), key=repr)
    by_sequence, pieces = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        pieces.setdefault((repr(r["doc_id"]), r["piece"], r["start"], r["length"]), []).append(bytes(r["ids"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    expected = {}
    for doc_id, ids in want:
        for k, (start, length) in enumerate(packing.cut(len(ids) // 4, capacity)):
            expected.setdefault((repr(doc_id), k, start, length), []).append(ids[4 * start:4 * (start + length)])
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    return rows


def test_pack(docs_of, awkward):
    rnd = random.Random(5)
    docs = docs_of([(i, "token " * rnd.choice([1, 2, 3, rnd.randint(1, 200)])) for i in range(300)])
    check_packed(docs, 64)
    check_packed(awkward, 1024)
    assert packing.pack(awkward.limit(0)).count() == 0
    held = {r.sequence_id: len(r.ids) for r in packing.sequences(packing.pack(docs, capacity=64, with_ids=True)).collect()}
    assert max(held.values()) <= 256 and sum(held.values()) == 4 * sum(len(bytepairs.encoder()(r.text)) // 4 + 1 for r in docs.collect())


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)] and packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    order = training_order.Permutation(size, 7)
    slots = order(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size)) and (order(slots, back=True) == np.arange(size)).all()
    if size > 100:
        assert (slots != training_order.Permutation(size, 8)(np.arange(size))).any() and (slots != np.arange(size)).mean() > 0.9


def stream_of(stored, length, rows_each):
    """Sequences in the order of files and rows, cut one document after another by a plain loop."""
    code, out = bytepairs.encoder(None, "H"), []
    rows = sorted(training_order.stored_rows(stored).collect(), key=lambda r: (r.file, r.row))
    for _, block in itertools.groupby(rows, lambda r: (r.file, r.row // rows_each)):
        ids = np.concatenate([np.r_[np.frombuffer(code(r.text), "<u2"), training_order.END] for r in block])
        out += [np.r_[ids[at:at + length], np.full(max(0, at + length - len(ids)), training_order.END)] for at in range(0, len(ids), length)]
    return np.array(out)


@pytest.fixture(scope="module")
def stored(spark, docs_of, awkward):
    rnd = random.Random(6)
    source = work_path(spark, "docs")
    docs_of([(i, "some words here " * rnd.randint(0, 40)) for i in range(500)]).union(awkward).repartition(5).write.option("parquet.block.size", 4096).option("parquet.page.size", 512).parquet(source)
    return spark.read.parquet(source)


@pytest.mark.parametrize("rows_each,split", [(16, "128m"), (16, "8k"), (7, "3k"), (1000, "5k"), (1, "1k")])
def test_shards(spark, stored, rows_each, split):
    """The records, put back in order, are the id stream itself, however the files are split."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        target = work_path(spark, "shards")
        rows = {r.slot: r for r in training_order.materialise(stored, target, key=3, length=64, records=50, rows_each=rows_each, chunk=300).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = stream_of(stored, 64, rows_each)
    n = len(want)
    assert sorted(rows) == list(range(n)) and all(r.shard == s // 50 for s, r in rows.items())
    records = training_order.read(target, 0, n)
    assert all(zlib.crc32(records[s].tobytes()) == r.ids_crc32 for s, r in rows.items())
    assert (records[training_order.Permutation(n, 3)(np.arange(n))] == want).all()
    assert (training_order.read(target, 77, 60) == records[77:137]).all() and len(training_order.read(target, n - 3, 60)) == 3
    assert sorted({i for r in rows.values() for i in r.doc_ids}, key=repr) == sorted({r.doc_id for r in stored.select("doc_id").collect()}, key=repr)


def test_sets_that_are_not_finished(spark, stored, awkward, monkeypatch):
    monkeypatch.setattr(training_order, "BROADCAST_BLOCKS", -1)
    target = work_path(spark, "shards")
    n = training_order.materialise(stored, target, key=1, length=64, records=100, rows_each=50).count()
    assert training_order.manifest(target)["sequences"] == n
    with pytest.raises(IndexError):
        training_order.read(target, n + 1, 1)
    os.truncate(f"{target}/shard-00000000.bin", 100)
    with pytest.raises(ValueError):
        training_order.read(target, 0, 5)
    empty = work_path(spark, "docs")
    awkward.limit(0).write.parquet(empty)
    target = work_path(spark, "shards")
    assert training_order.materialise(spark.read.parquet(empty), target, key=1).count() == 0
    assert len(training_order.read(target, 0, 5)) == 0
    monkeypatch.setattr(training_order, "writer", lambda *args: lambda batches: (1 / 0 for _ in batches))
    target = work_path(spark, "shards")
    with pytest.raises(Exception, match="division by zero"):
        training_order.materialise(stored, target, key=1)
    with pytest.raises(FileNotFoundError):
        training_order.read(target, 0, 5)
