import hashlib
import zlib

from pyspark.sql import functions as F

from slicemill.llm import warc
from slicemill.session import work_path

LONG, OTHER = "<p>" + "a" * 200, "<p>é" + "b" * 200


def pages(spark, rows):
    schema = "page_id long, url string, html string, payload string, digest string, first long, file string"
    return spark.createDataFrame([(*r, "p", "d", 1, "f") for r in rows], schema)


def brute(rows):
    out = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = min(same) if same else None
        again = len(payload) >= 100 and first is not None and page_id != first
        out.append((page_id, url, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None, None if again else payload))
    return sorted(out, key=repr)


ROWS = [(7, "http://a/7", LONG), (3, "http://a/3", LONG), (9, "http://a/9?x=ü y", LONG), (None, "http://a/none", LONG), (3, "http://b/3", LONG), (1, "u", "short"), (2, "u", "short"),
        (4, "u", None), (5, None, ""), (6, "http://c/\r\nX: y", OTHER), (8, "u", "x" * 99), (10, "u", "x" * 99), (11, "u", "y" * 100), (12, "u", "y" * 100),
        (None, "v", "z" * 300), (None, "v", "z" * 300), (13, "big", "w" * 3_000_000), (14, "crlf", "a\r\n\r\nb" * 30)]


def test_round_trip(spark):
    target = work_path(spark, "warc")
    index = warc.write(pages(spark, ROWS).repartition(3), target)
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read(index, target).collect()]
    assert sorted(got, key=repr) == brute(ROWS)
    whole = {(r.page_id, r.url): bytes(r.payload) for r in warc.payloads_of(index, target).collect()}
    assert whole == {(p, u): (h or "").encode() for p, u, h in ROWS}
    assert warc.payloads_of(index, target).count() == len(ROWS)


def test_shuffled_digests_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", -1)
    test_round_trip(spark)


def test_index_names_whole_members(spark):
    """Each member of an archive is a record of its own, they lie without gaps, and digests are those of the payloads."""
    target = work_path(spark, "warc")
    index = warc.write(pages(spark, ROWS).repartition(2), target, archive=1000)
    files = {}
    for r in index.collect():
        files.setdefault(r.file, []).append((r.offset, r.length, r.digest))
    assert len(files) > 2  # archives are closed at their size
    for file, parts in files.items():
        raw = open(file, "rb").read()
        info = zlib.decompressobj(31)
        at = len(raw) - len((info.decompress(raw), info.unused_data)[1])
        for offset, length, digest in sorted(parts):
            assert offset == at
            text = zlib.decompress(raw[offset:offset + length], 31)
            assert text.startswith(b"WARC/1.1\r\n") and f"sha256:{digest}".encode() in text
            at += length
        assert at == len(raw)


def test_part_of_an_index(spark):
    target = work_path(spark, "warc")
    index = warc.write(pages(spark, ROWS).repartition(1), target)
    for gap, at_once in ((0, 1), (1 << 20, 1 << 30), (100, 2000)):
        some = warc.read(index.where(F.col("page_id") % 2 == 1), target, gap=gap, at_once=at_once)
        want = [r[0] for r in brute(ROWS) if r[0] is not None and r[0] % 2 == 1]
        assert sorted(r.page_id for r in some.collect()) == sorted(want)


def test_ranges_are_joined():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("a", 45, 5), ("b", 50, 5), ("b", 50, 5)]
    assert list(warc.joined_ranges(ranges, 0, 100)) == [(0, 2, 15), (2, 4, 50), (4, 6, 55)]
    assert list(warc.joined_ranges(ranges, 25, 100)) == [(0, 4, 50), (4, 6, 55)]
    assert list(warc.joined_ranges(ranges, 25, 20)) == [(0, 2, 15), (2, 4, 50), (4, 6, 55)]
    assert list(warc.joined_ranges([], 0, 1)) == []


def test_damage_is_seen(spark):
    whole = warc.record(1, "u", b"x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), None, False)
    assert warc.parsed(whole)[5] == b"x" * 500
    wrong = warc.record(1, "u", b"y" * 500, hashlib.sha256(b"x" * 500).hexdigest(), None, False)
    try:
        warc.parsed(wrong)
    except ValueError as e:
        assert "digest" in str(e)
    else:
        raise AssertionError("a wrong payload was read")


def test_empty(spark):
    target = work_path(spark, "warc")
    index = warc.write(pages(spark, ROWS).limit(0), target)
    assert index.count() == 0 and warc.read(index, target).count() == 0
