import hashlib
import random

import numpy as np

from slicemill.llm import fingerprints as P
from slicemill.llm.common import keyed


def phrases(text):
    known, word, out = set(), "", []
    for c in text:
        if word + c in known:
            word += c
        else:
            known.add(word + c)
            out.append(word + c)
            word = ""
    return out


def test_parse_and_likeness_against_phrase_sets():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcd é漢") for _ in range(rnd.randint(0, 4000))) for _ in range(30)]
    for a, b in zip(texts, texts[1:]):
        cut = len(a) // 3
        parse = P.Parse(a, len(a) - cut)
        own, edited = parse.signature(a[len(a) - cut:]), parse.signature(b[:cut])
        whole = a[:len(a) - cut] + b[:cut]
        assert own.astype(">u2").tobytes().hex() == P.fingerprint(a)
        assert edited.astype(">u2").tobytes().hex() == P.fingerprint(whole)
        x, y = set(phrases(a)), set(phrases(whole))
        assert len(P.Parse(a, len(a)).ends) == len(phrases(a))
        if len(x | y) > 400:
            assert abs(P.likeness(own, edited) - len(x & y) / len(x | y)) < 0.16


def test_dictionary_starts_over(monkeypatch):
    monkeypatch.setattr(P, "DICTIONARY", 50)
    text = "".join(random.Random(2).choice("abc") for _ in range(5000))
    for edit in (0, 100, 2500, 5000):
        parse = P.Parse(text, edit)
        first = parse.signature(text[edit:])
        parse.signature("zzzzabcabc" * 60)
        assert (parse.signature(text[edit:]) == first).all()
        assert first.astype(">u2").tobytes().hex() == P.fingerprint(text)


def test_empty():
    empty = P.Parse("", 0).signature("")
    assert P.likeness(empty, empty) == 1 and P.likeness(empty, P.Parse("abc", 3).signature("")) == 0
    assert P.fingerprint(None) == P.fingerprint("")


def expected(rows):
    """rows: (doc_id, text), distinct ids, no null id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        whole = text[:len(text) - cut] + after[:cut]
        sig = [np.frombuffer(bytes.fromhex(P.fingerprint(t)), ">u2") for t in (text, whole, after)]
        out[doc_id] = (len(text), hashlib.sha256(whole.encode()).hexdigest(), P.fingerprint(text), P.fingerprint(whole), P.likeness(sig[0], sig[1]), P.likeness(sig[0], sig[2]))
    return out


def test_next_document(docs_of):
    rnd = random.Random(3)
    rows = [(i * 7 - 100, rnd.choice([None, "", "x" * 50, "".join(rnd.choice("ab cé") for _ in range(rnd.randint(1, 300)))])) for i in range(60)]
    got = {r.doc_id: tuple(r)[1:] for r in P.compare_with_next(docs_of(rows)).collect()}
    assert got == expected(rows)
    one = P.compare_with_next(docs_of([(9, "alone in here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_hot_ids_are_split(docs_of):
    """Rows of one id, and rows without an id, lie in several ranges and still follow each other by the hash of their texts."""
    rnd = random.Random(4)
    ids = [5] * 150 + [None] * 150 + [-7] * 40 + list(range(100))
    rows = [(i, f"{n} " + "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 90)))) for n, i in enumerate(ids)]
    docs = docs_of(rows)
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.th, r.text, r.doc_id) for r in keyed(docs).collect()), reverse=True)
    want = []
    for (_, _, _, text, doc_id), (_, _, _, after, _) in zip(order, order[1:] + order[:1]):
        whole = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        want.append((doc_id, len(text), hashlib.sha256(whole.encode()).hexdigest()))
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in P.compare_with_next(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    spread = P.with_next(docs).where("guest = 0").groupBy("doc_id", "range").count().groupBy("doc_id").max("count").collect()
    assert {r[0]: r[1] for r in spread if r[0] in (5, None)}.keys() == {5, None} and all(r[1] <= 80 for r in spread)


def test_awkward(awkward, docs_of):
    rows = P.compare_with_next(awkward).collect()
    assert len(rows) == awkward.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert P.compare_with_next(awkward.limit(0)).count() == 0
    assert P.fingerprints(awkward).count() == awkward.count()
