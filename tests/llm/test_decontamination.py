import random
import re

from slicemill.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = {}
    wins = [(i, tuple(w[k:k + min(len(w), window)])) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - window + 1))]
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(item)
        out[doc_id] = (len(w), len(hit), sorted(str(i) for i in found if i is not None), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def tables(spark, docs_of, seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "Été", "été", "x1", "C", "dé"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([20, 14, 13, 5, 3, 1, 0, 30, 13, 2])]
    items += [(50, None), (51, items[0][1]), (None, "null id words here")]
    items[5] = (5, "solo")
    docs = []
    for i in range(60):
        own = [rnd.choice(vocabulary + ["zz", "yy"]) for _ in range(rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 2)):
            at, item = rnd.randint(0, len(own)), rnd.choice(items)[1] or ""
            own[at:at] = item.upper().split() if rnd.random() < 0.3 else item.split()
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(own)))
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, hash string")
    return docs, items, docs_of(docs), bench


def test_against_brute_force(spark, docs_of, monkeypatch):
    for seed, limit in ((1, D.BROADCAST_BYTES), (2, 0)):
        monkeypatch.setattr(D, "BROADCAST_BYTES", limit)
        docs, items, frame, bench = tables(spark, docs_of, seed)
        want = brute(docs, items)
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.report(frame, bench).collect()}
        assert got == want
        assert {r.doc_id for r in D.drop_documents(frame, bench).collect()} == {i for i, w in want.items() if not w[3]}


def test_remove_spans(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(15))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = docs_of([(1, f"Before it, {passage.upper()}! after it."), (2, "nothing, here."), (3, None), (4, passage)])
    assert {r.doc_id: r.text for r in D.remove_spans(docs, bench).collect()} == {1: "Before it, after it.", 2: "nothing, here.", 3: None, 4: ""}


def test_awkward(spark, awkward):
    bench = spark.createDataFrame([(7, "one two three"), (8, "x")], "item_id long, text string")
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in D.report(awkward, bench).collect()), key=repr)
    assert len(rows) == 10 and rows.count((5, 6, 3, 1, True)) == 2 and (7, 1, 1, 1, True) in rows and (1, 0, 0, 0, False) in rows
    assert sorted((r.doc_id for r in D.drop_documents(awkward, bench).collect()), key=repr) == sorted([1, 2, 3, 4, None, None], key=repr)
    nothing = bench.limit(0)
    assert D.report(awkward, nothing).where("n_hit > 0").count() == 0 and D.drop_documents(awkward, nothing).count() == 10
    assert D.report(awkward.limit(0), bench).count() == 0


def test_shuffled_ngrams_carry_no_text(spark, docs_of, monkeypatch):
    """Beyond the broadcast limit the rows joined by hash are one for each n-gram; none holds the words of its document."""
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    passage, long = " ".join(f"p{i}" for i in range(15)), " ".join(f"w{i}" for i in range(3000))
    rows, items = [(1, f"{long} {passage}"), (2, long)], [(1, passage), (2, "three short words")]
    docs, bench = docs_of(rows), spark.createDataFrame(items, "item_id long, text string")
    frame, seen = type(docs), []
    join = frame.join

    def watched(left, right, on=None, how=None):
        if on == "hash" if isinstance(on, str) else isinstance(on, list) and "hash" in on:
            seen.append(left.columns)
        return join(left, right, on, how)

    monkeypatch.setattr(frame, "join", watched)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.report(docs, bench).collect()}
    assert got == brute(rows, items)
    assert seen and not any("words" in columns for columns in seen)
