import hashlib
import random
import time
import zlib

import numpy as np

from slicemill.llm import runs


def brute(word):
    """Every stretch of every period, tried one by one."""
    n, out = len(word), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if word[i] != word[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and word[i] == word[i + q]:
                i += 1
            own = word[start:i + q]
            smaller = any(all(own[j] == own[j + d] for j in range(len(own) - d)) for d in range(1, q))
            if len(own) >= max(6, 4 * q) and not smaller:
                out.append((start, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rnd, size):
    """Words of a small alphabet with stretches copied from some words before."""
    n, letters = rnd.randint(0, size), rnd.randint(1, 4)
    word = [b"%d" % rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n > 4:
            p, s = rnd.randint(1, 12), rnd.randrange(n)
            for i in range(s + p, min(n, s + p * rnd.randint(2, 9) + rnd.randint(0, 3))):
                word[i] = word[i - p]
    return word


def test_runs_against_brute_force():
    rnd = random.Random(3)
    found = 0
    for _ in range(6000):
        word = made(rnd, 90)
        assert runs.runs_of(word) == brute(word), word
        found += len(brute(word))
    assert found > 3000


def test_cutting_loses_no_run(monkeypatch):
    rnd = random.Random(4)
    words = [made(rnd, 120) for _ in range(1500)]
    cut = [runs.runs_of(w) for w in words]
    monkeypatch.setattr(runs, "candidates", lambda codes: [(0, len(codes))])
    assert cut == [runs.runs_of(w) for w in words]


def test_squares_are_all_primitive_squares():
    rnd = random.Random(5)
    for _ in range(800):
        word = made(rnd, 60)
        want = set()
        for i in range(len(word)):
            for d in range(1, (i + 1) // 2 + 1):
                own = word[i - 2 * d + 1:i + 1]
                if own[:d] == own[d:] and not any(d % k == 0 and own[:d] == own[:k] * (d // k) for k in range(1, d)):
                    want.add((i, d))
        got = list(runs.squares(word))
        assert len(got) == len(set(got)) and set(got) == want, word


def test_plain_text_is_cut_away():
    rnd = random.Random(6)
    codes = np.array([rnd.randrange(3000) for _ in range(50_000)], np.uint64)
    assert list(runs.candidates(codes)) == []


def test_long_periodic_text():
    began = time.time()
    for n, p in ((200_000, 1), (200_000, 3), (200_000, 40_000)):
        assert runs.runs_of([b"w%d" % (i % p) for i in range(n)]) == [(0, n, p)]
    assert time.time() - began < 60


def test_planted():
    words = [b"w%d" % i for i in range(50)]
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0 and zlib.crc32(str(i).encode()) // 10 % 8 == 7)
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // 10
    assert runs.planted(doc_id, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    plain = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10)
    assert runs.planted(plain, words) == words and runs.planted(doc_id, []) == [] and runs.planted(None, words) == words


def test_report(docs_of, awkward, collected):
    docs = docs_of([(1, "so ha ha\tha ha\nha ha so"), (2, None), (3, ""), (4, "a b a b a b a b a b c c c c c c c c c c c c"), (5, "a b " * 5), (6, "x y " * 3)])
    rows = {r.doc_id: r for r in runs.report(docs).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (rows[1].n_runs, rows[1].start, rows[1].length, rows[1].period, rows[1].exponent_milli) == (1, 1, 6, 1, 6000)
    assert rows[1].runs_sha256 == digest("1,6,1\n") and rows[1].collapsed_sha256 == digest("so ha so")
    for empty in (2, 3):
        assert (rows[empty].n_runs, rows[empty].start, rows[empty].exponent_milli) == (0, None, None) and rows[empty].collapsed_sha256 == digest("")
    assert (rows[4].n_runs, rows[4].start, rows[4].length, rows[4].period, rows[4].exponent_milli) == (2, 10, 12, 1, 12000)
    assert rows[4].runs_sha256 == digest("0,10,2\n10,12,1\n") and rows[4].collapsed_sha256 == digest("a b c")
    assert rows[5].n_runs == 0 and rows[6].n_runs == 0  # five and six words, but fewer than six or four periods
    got = collected(runs.report(awkward))
    assert len(got) == 10 and runs.report(awkward.limit(0)).count() == 0
    assert {r.doc_id: r.text for r in runs.collapse(docs).collect()}[4] == "a b c"
    assert collected(runs.collapse(awkward)) == collected(awkward)
