import random
import zlib

from pyspark.sql import functions as F

from slicemill.llm import toxicity as T

INSULTS = ["blockhead", "nitwit", "scoundrel", "dimwit"]


def corpus(n, seed):
    rnd = random.Random(seed)
    parts = ["ar", "be", "con", "del", "er", "fo", "gan", "hi", "ly", "mo", "ne", "or", "pra", "ti", "un", "ve"]
    out = []
    for i in range(n):
        words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        out.append((i, " ".join(words) + ".", int(toxic)))
    return out


def model():
    rows = corpus(400, 1)
    return T.fit([r[1] for r in rows], [r[2] for r in rows])


def test_held_out_accuracy_and_gaps():
    m = model()
    rows = corpus(300, 2)
    got = [int(p >= 0.5) for p in T.probabilities(m, [r[1] for r in rows])]
    assert sum(a == r[2] for a, r in zip(got, rows)) >= 0.98 * len(rows)
    worn = ["blockxhead", "block-head", "b l o c k h e a d", "nit.wit", "scouundrel", "dim_wit"]
    assert all(p >= 0.5 for p in T.probabilities(m, [f"be ardel {w} conly" for w in worn]))
    assert all(0 <= p < 0.5 for p in T.probabilities(m, [None, "", "a b", "...", "be ardel conly"]))


def test_margins_are_the_machine_on_landmark_kernels():
    """The folded weights give what kernel values against landmarks give."""
    features = T.Subsequences("abcdefghijklmnopqrstuvwxyz")
    marks, words = ["nitwit", "dimwit", "conly"], ["nitxwit", "be", "gandel"]
    k = T.Landmarks(features, marks).kernel(words)

    def direct(a, b):
        def feature(w):
            out, size = {}, 0.0
            for i in range(len(w)):
                for s, t in T.STEPS:
                    if i + t < len(w):
                        weight = T.DECAY ** (t + 1)
                        key = w[i] + w[i + s] + w[i + t]
                        out[key] = out.get(key, 0) + weight
                        size += weight ** 2
            return {x: v / size ** 0.5 for x, v in out.items()}
        x, y = feature(a), feature(b)
        return sum(v * y.get(key, 0) for key, v in x.items())

    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            assert abs(k[i, j] - direct(w, m)) < 1e-5


def test_frames(spark, docs_of, awkward, collected):
    rows = corpus(200, 3)
    docs = docs_of([r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows] + [(None, 1, 1), (10_000, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    m = T.train(docs, labels)
    scored = {r.doc_id: r for r in T.score(docs, m).collect()}
    assert len(scored) == 200
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for i, r in scored.items())
    held = [r for r in rows if scored[r[0]].held_out]
    assert sum(scored[r[0]].predicted == r[2] for r in held) >= 0.9 * len(held)
    out = T.score(awkward, m).collect()
    assert len(out) == 10 and all(0 <= r.score <= 1 for r in out) and not any(r.held_out for r in out if r.doc_id is None)
    kept = T.drop_toxic(docs.union(awkward), labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {r[0] for r in rows if not scored[r[0]].predicted}
    assert T.score(docs.limit(0), m).count() == 0


def test_without_both_labels(spark, docs_of):
    docs = docs_of([(1, "one"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.train(docs, none) == 0.0
    assert [r.score for r in T.score(docs, T.train(docs, none)).collect()] == [0.0, 0.0]
    assert T.fit(["one two three"], [1]) == 1.0


def test_labels_of_held_out_rows_do_not_matter(spark, docs_of):
    rows = corpus(120, 4)
    docs = docs_of([r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs, turned)
    assert T.probabilities(a, [r[1] for r in rows]) == T.probabilities(b, [r[1] for r in rows])


def test_quoted_insults_are_still_learnt():
    rows = corpus(400, 1)
    quoted = [(1000 + i, f"be ardel {w} conly.", 0) for i, w in enumerate(INSULTS)]
    m = T.fit([r[1] for r in rows + quoted], [r[2] for r in rows + quoted])
    assert not isinstance(m, float)
    assert all(p >= 0.5 for p in T.probabilities(m, [f"be ardel {w} conly" for w in INSULTS + ["blockxhead", "scouundrel"]]))
    assert all(p < 0.5 for p in T.probabilities(m, ["be ardel conly", ""]))


def test_without_a_machine_nothing_is_rejected(spark, docs_of):
    """No word tells the labels apart: the score is the share among all labelled documents, and all documents stay."""
    rows = [(i, "the same words in all", int(i % 10 == 0)) for i in range(200)]
    docs = docs_of([r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    old, T.TRAIN_DOCS = T.TRAIN_DOCS, 2
    try:
        m = T.train(docs, labels)
        assert m == sum(r[2] for r in known) / len(known)
        assert T.drop_toxic(docs, labels).count() == 200
    finally:
        T.TRAIN_DOCS = old
    assert T.drop_toxic(docs, labels.withColumn("toxic", F.lit(1))).count() == 200


def phrases(n, seed):
    """Sentences in which both words of the insult occur, in clean ones never side by side."""
    out = []
    for i, text, _ in corpus(n, seed):
        rnd = random.Random(seed * 10_000 + i)
        words, toxic = [w for w in text.rstrip(".").split() if w not in INSULTS], i % 4 == 0
        at = rnd.randrange(len(words) - 3)
        words[at:at] = ["drop", "dead"] if toxic else ["drop", *words[at:at + 2], "dead"] if i % 4 == 1 else ["dead"] if i % 4 == 2 else ["drop"]
        out.append((i, " ".join(words) + ".", int(toxic)))
    return out


def test_insults_of_several_clean_words():
    rows = phrases(400, 1)
    m = T.fit([r[1] for r in rows], [r[2] for r in rows])
    rows = phrases(300, 2)
    got = [int(p >= 0.5) for p in T.probabilities(m, [r[1] for r in rows])]
    assert sum(g for g, r in zip(got, rows) if r[2]) >= 0.95 * sum(r[2] for r in rows)
    assert sum(g for g, r in zip(got, rows) if not r[2]) <= 0.05 * sum(not r[2] for r in rows)


def test_insults_split_by_spaces():
    split = ["nit wit", "n. i. t. w. i. t.", "block head", "scoun drel", "d-i m w-i t", "block\thead"]
    assert all(p >= 0.5 for p in T.probabilities(model(), [f"be ardel {w} conly" for w in split]))


def plain_windows(text):
    """The windows of a text by a loop over its words."""
    words = []  # letters, single, whether a sentence ends behind it
    for line in text.lower().split("\n"):
        for raw in line.split():
            w, stop = "".join(c for c in raw if c.isalnum()), any(c in ".!?" for c in raw.lstrip("".join(set(c for c in raw if c.isalnum()))))
            tail = raw[max((i for i, c in enumerate(raw) if c.isalnum()), default=-1) + 1:]
            head = raw[:min((i for i, c in enumerate(raw) if c.isalnum()), default=len(raw))]
            if not w:
                if words and any(c in ".!?" for c in raw):
                    words[-1][2] = True
                continue
            if words and any(c in ".!?" for c in head):
                words[-1][2] = True
            words.append([w, len(w) == 1, any(c in ".!?" for c in tail)])
        if words:
            words[-1][2] = True
    merged = []
    for w, single, stop in words:
        if single and merged and merged[-1][1]:
            merged[-1] = [merged[-1][0] + w, True, stop]
        else:
            merged.append([w, single, stop])
    out = set()
    for i, (w, _, _) in enumerate(merged):
        out |= {w} if len(w) <= T.WINDOW else {w[k:k + T.WINDOW] for k in range(0, len(w) - T.WINDOW // 2, T.WINDOW // 2)}
        for k in range(1, T.WORDS):
            if i + k < len(merged) and not any(m[2] for m in merged[i:i + k]):
                joined = "".join(m[0] for m in merged[i:i + k + 1])
                out |= {joined} if len(joined) <= T.WINDOW else set()
    return sorted(w for w in out if len(w) >= T.LENGTH)


def test_scores_are_those_of_all_windows_one_by_one():
    """Running sums over batches give the highest margin of the windows, each scored alone as a string."""
    m, rnd = model(), random.Random(5)
    signs = ["a", "b", "nit", "wit", "blockhead", ".", "!", " ", " ", " ", "\n", "-", "é", "ß", "中文", "x" * 30, "dim", "\t", "\ud800", "İ", "1"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    got = [w for t in texts for w in [T.Windows([t.lower()])]]
    for t, w in zip(texts, got):
        start, end, _, _ = w.whole()
        assert sorted({w.text(*x) for x in zip(start, end)}) == plain_windows(t), t
    direct = [max([m.bias, *m.margins(plain_windows(t))]) for t in texts]
    batch = m.worst([t.lower() for t in texts])
    assert max(abs(a - b) for a, b in zip(direct, batch)) < 1e-3
    assert T.probabilities(m, texts) == [T.probabilities(m, [t])[0] for t in texts]


def test_long_texts_are_scored_whole():
    """Pieces of a long text meet every window, also the ones at a cut."""
    m, old = model(), (T.PIECE, T.BLOCK, T.OVERLAP)
    texts = ["be ardel " * k + "nit wit " + "conly " * 200 for k in range(0, 60)]
    whole = T.probabilities(m, texts)
    try:
        T.PIECE, T.BLOCK, T.OVERLAP = 300, 500, 100
        assert T.probabilities(m, texts) == whole
        assert T.probabilities(m, ["x" * 5000 + " nitwit"])[0] >= 0.5
    finally:
        T.PIECE, T.BLOCK, T.OVERLAP = old
    assert all(p >= 0.5 for p in whole)
