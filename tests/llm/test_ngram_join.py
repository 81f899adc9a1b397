import random

import numpy as np
import pytest

from slicemill.llm import ngram_join as J


def grams(text, size=5):
    words = J.WORD.findall((text or "").lower())
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, similarity=0.8):
    """(doc_id, class, links, texts) by comparing everything with everything."""
    sets = [grams(t) for _, t in rows]

    def alike(a, b):
        return a == b or len(a & b) >= similarity * len(a | b) - 1e-9

    links = [[j for j in range(len(rows)) if j != i and alike(sets[i], sets[j])] for i in range(len(rows))]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, own in enumerate(links):
            low = min([root[i]] + [root[j] for j in own])
            for k in [i, *own]:
                if root[k] != low:
                    root[k], changed = low, True
    out = []
    for i, (doc_id, _) in enumerate(rows):
        names = [rows[j][0] for j in range(len(rows)) if root[j] == root[i]]
        known = [n for n in names if n is not None]
        out.append((doc_id, min(known) if known else None, len(links[i]), len({sets[j] for j in links[i]} - {sets[i]})))
    return sorted(out, key=repr)


def near(text, rnd, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.random()}"
    return " ".join(words)


def corpus(seed, groups, size):
    rnd = random.Random(seed)
    texts = []
    for g in range(groups):
        base = " ".join(f"w{rnd.randrange(500)}" for _ in range(rnd.randint(60, 150)))
        texts += [near(base, rnd, rnd.randint(0, 4)) for _ in range(rnd.randint(1, size))]
    texts += [texts[0]] * 5 + ["short text", "short text", "Short, text!", "other"]
    return list(enumerate(texts))


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links, r.n_texts) for r in df.collect()), key=repr)


def test_against_all_pairs(docs_of):
    rows = corpus(1, 25, 9)
    assert got(J.join(docs_of(rows))) == brute(rows)


def test_blocks_give_the_same(docs_of, monkeypatch):
    rows = corpus(2, 2, 60)
    monkeypatch.setattr(J, "BLOCK_NODES", 7)
    assert got(J.join(docs_of(rows))) == brute(rows)


def test_shuffled_text_side(docs_of, monkeypatch):
    rows = corpus(3, 6, 5)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    assert got(J.join(docs_of(rows))) == brute(rows)


def test_chain_is_one_class(docs_of):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12:i * 12 + 200])) for i in range(12)]
    want = brute(rows)
    assert {r[1] for r in want} == {0} and max(r[2] for r in want) < 11
    assert got(J.join(docs_of(rows))) == want


def test_awkward(awkward, docs_of):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(J.join(awkward)) == brute(rows)
    kept = J.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, 5, 7, None], key=repr)
    assert J.join(awkward.limit(0)).count() == 0 and J.keep_first(awkward.limit(0)).count() == 0


def test_bands():
    for similarity, recall, hashes in ((0.8, 0.9999, 192), (0.5, 0.95, 100), (0.9, 0.99, 64)):
        bands, rows = J.bands_for(similarity, recall, hashes)
        assert bands * rows <= hashes and 1 - (1 - similarity ** rows) ** bands >= recall
    with pytest.raises(ValueError):
        J.bands_for(0.1, 0.9999, 10)


def test_components_of_a_path(spark):
    n = 40
    names = [np.random.default_rng(i).bytes(16) for i in range(n)]
    edges = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in zip(names, names[1:])], "a binary, b binary")
    out = {bytes(r.node): bytes(r.root) for r in J.components(edges).collect()}
    assert set(out) == set(names) and set(out.values()) == {min(names)}
