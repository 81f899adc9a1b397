import random

from slicemill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n long, prefix string"


def frame(spark, convs):
    rows = [(c, t, r, x, 1, "p") for c, turns in convs for t, (r, x) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(convs):
    convs = [c for c in convs if c[1]]
    kept = [(c, t) for c, t in convs if not any(d != c and u[:len(t)] == t and (len(u) > len(t) or (c is None or d is not None and d < c)) for d, u in convs)]
    out = {c: [len(t), -1, "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in t)] for c, t in kept}
    for _, t in convs:
        out[min((k for k, u in kept if u[:len(t)] == t), key=lambda k: (k is None, k or 0))][1] += 1
    return {c: tuple(v) for c, v in out.items()}


def got(df):
    return {r.conv_id: (r.n_turns, r.n_collapsed, r.rendered) for r in df.collect()}


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(1)
    convs = [(i, [(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "", None])) for _ in range(rnd.randint(1, 6))]) for i in range(150)]
    convs += [(500 + i, c[1][:rnd.randint(1, 6)]) for i, c in enumerate(convs[:60])] + [(None, [("user", "a"), ("user", "q")])]
    want = brute(convs)
    assert got(chat.format_conversations(frame(spark, convs))) == want
    monkeypatch.setattr(chat, "CHUNK", 2)
    assert got(chat.format_conversations(frame(spark, convs))) == want


def test_order_and_empty(spark):
    df = spark.createDataFrame([(1, 9, "assistant", "y", 1, "p"), (1, 2, "user", "x", 1, "p"), (2, 0, "user", "x", 1, "p"), (3, None, "user", "x", 1, "p")], SCHEMA)
    assert set(got(chat.format_conversations(df))) == {1}
    assert chat.format_conversations(df.limit(0)).count() == 0
