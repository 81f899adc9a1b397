import hashlib
import math
import random
import re
import zlib
from collections import Counter

from slicemill.llm import importance


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, target, max_n=1, buckets=10000, percent=10, min_words=20, seed=2024):
    def own(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(b for _, text in docs for b in own(text)), Counter(b for text in target for b in own(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in own(text))
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r, (_, text) in zip(rows, docs) if len(words(text)) >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = rank
    return sorted(map(tuple, rows), key=repr)


def some_docs(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "İx", "naïve", "ABC", "x_y", "1.5"]
    return [(i, rnd.choice([None, "", "  \n"]) if rnd.random() < .05 else " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 60)))) for i in range(n)]


TARGET = ["w1 w2 w3 w4 w5", "w2 w3", None, "", "ABC naïve É"]


def plain(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def target_of(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(TARGET)], "item_id long, text string, features long")


def test_against_brute_force(spark, docs_of, monkeypatch):
    docs = some_docs(700, 1)
    want = brute(docs, TARGET)
    assert sum(r[4] is not None for r in want) == 10 * sum(len(words(t)) >= 20 for _, t in docs) // 100 > 20
    for finish in (importance.FINISH, 3, 0):  # 0: medians until the pivot is the cutoff itself
        monkeypatch.setattr(importance, "FINISH", finish)
        assert plain(importance.resample(docs_of(docs).repartition(7), target_of(spark))) == want


def test_longer_features_and_small_tables(spark, docs_of, monkeypatch):
    monkeypatch.setattr(importance, "MEMORY", 500)  # words are forgotten all the time
    docs = some_docs(150, 2)
    params = dict(max_n=3, buckets=70_000, percent=35, min_words=3, seed=5)
    assert plain(importance.resample(docs_of(docs), target_of(spark), **params)) == brute(docs, TARGET, **params)


def test_every_place_is_found(spark, docs_of, monkeypatch):
    monkeypatch.setattr(importance, "FINISH", 2)
    rnd = random.Random(3)
    rows = [(rnd.randint(-3, 3), int(rnd.random() < .2), rnd.randint(0, 3), rnd.randint(0, 1), i) for i in range(60)]
    rnd.shuffle(rows)
    keys = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in importance.KEY)).repartition(5)
    for nth in (1, 2, 17, 30, 59, 60):
        assert importance.nth_key(keys, nth) == sorted(rows)[nth - 1]


def test_ties_and_repeated_rows(spark, docs_of, monkeypatch):
    """Equal rows tie in everything; each gets a rank of its own, and the cutoff may pass between them."""
    monkeypatch.setattr(importance, "FINISH", 1)
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(1, text)] * 40 + [(None, text)] * 5 + [(2, text)]
    got = plain(importance.resample(docs_of(docs).repartition(4), target_of(spark), percent=50))
    assert got == brute(docs, TARGET, percent=50) and sorted(r[4] for r in got if r[4]) == list(range(1, 24))


def test_drawn_and_awkward(spark, docs_of, awkward):
    docs = some_docs(200, 4)
    got = importance.drawn(docs_of(docs), target_of(spark))
    assert sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in brute(docs, TARGET) if r[4]) and got.columns == docs_of(docs).columns
    rows = importance.resample(awkward, target_of(spark), percent=100, min_words=0)
    assert rows.count() == 10 and sorted(r["rank"] for r in rows.collect()) == list(range(1, 11))
    assert importance.resample(awkward.limit(0), target_of(spark)).count() == 0
    assert importance.resample(awkward, target_of(spark).limit(0)).where("rank is not null").count() == 0
