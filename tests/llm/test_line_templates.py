import random
import re
from collections import Counter

from slicemill.llm import line_templates as L

BOILER = "Subscribe to our weekly letter for more stories like this one today"


def run(docs):
    return {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}


def test_recurring_lines_stay_once(docs_of):
    out = run(docs_of([(3, f"my own line is here\n{BOILER}"), (1, f"{BOILER}\nanother line that is mine"), (2, f"{BOILER}\n\n{BOILER}\nthe third one has its own")]))
    assert out == {1: f"{BOILER}\nanother line that is mine", 2: "\nthe third one has its own", 3: "my own line is here"}


def test_variable_fields(docs_of):
    docs = docs_of([(i, f"text number {'abcdefgh'[i]} has words nobody else{i} wrote\nPosted on {2000 + i}-05-0{i} by user{i} in the news section of this site") for i in range(5)])
    out = run(docs)
    assert all("Posted" not in t for i, t in out.items() if i) and "Posted" in out[0]
    names = ["anna", "bert", "carl", "dora", "emil"]
    out = run(docs_of([(i, f"Written by staff member {n} for the morning edition of the paper\nbody {n} {n} {n} {n}") for i, n in enumerate(names)]))
    assert [t.startswith("Written") for _, t in sorted(out.items())] == [True, False, False, False, False]


def test_unlike_lines_in_one_leaf_stay(docs_of):
    rows = [(1, "this is a completely different matter from all others"), (2, "this is a thing nobody would ever compare with"), (3, "this is a")]
    assert run(docs_of(rows)) == dict(rows)


def test_families_in_one_leaf(docs_of):
    """Several families share length and leading tokens, each with a name of its own in every line."""
    names = ["anna", "bert", "carl", "dora", "emil", "fritz"]
    families = ["Posted by our editor {} in the morning news section today", "Posted by our readers {} in the evening talk show yesterday",
                "Posted by our {} friends from the city council after lunch", "Posted by our guest writer {} who also lives near here"]
    for count in (1, 2, 4):
        docs = docs_of([(10 * k + i, family.format(name) + f"\nown words {name} {name}") for k, family in enumerate(families[:count]) for i, name in enumerate(names)])
        out = run(docs)
        assert [i for i, text in sorted(out.items()) if text.startswith("Posted")] == [10 * k for k in range(count)], count


def test_many_unrelated_lines_hide_no_family(docs_of):
    rnd = random.Random(1)
    own = [(100 + i, "It is the " + " ".join(f"w{'abcdefghij'[rnd.randrange(10)]}{'klmnopqrst'[rnd.randrange(10)]}" for _ in range(9))) for i in range(60)]
    family = [(i, f"It is the {'abcdef'[i]} view of the whole board that we stop") for i in range(6)]
    out = run(docs_of(own + family))
    assert [i for i, text in sorted(out.items()) if i < 100 and text] == [0]
    assert all(out[i] == text for i, text in own)


def test_short_lines(docs_of):
    docs = [(i, f"All rights reserved.\n公司版权所有\n{i}\nChapter {i}\n7 7\n\nwords that only {'abcdef'[i]} has") for i in range(6)]
    out = run(docs_of(docs))
    assert out[0] == docs[0][1]
    assert all(out[i] == f"{i}\n\nwords that only {'abcdef'[i]} has" for i in range(1, 6))


def brute(docs):
    """The rule by plain loops over tokens."""
    every, templates = [], {}
    for doc_id, text in docs:
        for no, line in enumerate(text.split("\n")):
            own = re.sub("[\\x09-\\x0D\\x20]+", " ", line).strip(" ").split(" ")
            t = tuple("<*>" if re.search("[0-9]", x) else x for x in own)
            if own != [""]:
                every.append((doc_id, no, t, tuple(own) if set(t) == {"<*>"} else t))

    def vote(lines, groups_of):
        families = {}
        for t in lines:
            for group in groups_of(t):
                families.setdefault(group, []).append(t)
        for group, members in families.items():
            shared = [Counter(t[i] for t in members).most_common(1)[0] for i in range(3, group[0])]
            for t in members if len(members) > 1 else []:
                if sum(2 * c > len(members) and x == y for x, (y, c) in zip(t[3:], shared)) >= 0.8 * len(t[3:]):
                    templates.setdefault(t, []).append(group)

    voters = {t for _, _, t, _ in every if len(t) >= 8}
    vote(voters, lambda t: [(len(t), t[:3])])
    vote(voters - set(templates), lambda t: [(len(t), t[:3], p, t[3 + p:5 + p]) for p in {j * (len(t) - 4) // L.BANDS for j in range(L.BANDS)}])
    holders = {}
    for doc_id, _, t, whole in every:
        for g in templates.get(t, [whole]):
            holders.setdefault(g, set()).add(doc_id)
    gone = {(doc_id, no) for doc_id, no, t, whole in every for g in templates.get(t, [whole]) if doc_id != min(holders[g])}
    return {doc_id: "\n".join(line for no, line in enumerate(text.split("\n")) if (doc_id, no) not in gone) for doc_id, text in docs}


def test_against_plain_loops(docs_of):
    rnd = random.Random(2)
    docs = []
    for i in range(150):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            base = rnd.choice(["the end of", "we say that", "Posted by our"]).split()
            rest = rnd.choice([["alpha beta gamma delta epsilon zeta eta"], ["alpha beta kappa delta epsilon mu eta"], ["one two three four five"], ["x"], ["y 5 z"]])[0].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                rest[rnd.randrange(len(rest))] = rnd.choice("pqrstuv") * rnd.randint(1, 3)
            lines.append(rnd.choice([" ", "  "]).join(base + rest))
        docs.append((i, "\n".join(lines + rnd.choice([[], [""], ["9"], ["9 8"], ["ok"]]))))
    assert run(docs_of(docs)) == brute(docs)


def test_awkward(awkward, docs_of, collected):
    out = L.dedup_lines(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    texts = collected(out.select("doc_id", "text"))
    assert texts.count((5, "one two three four five six")) == 2 and (6, "") in texts and (1, None) in texts and (3, " \n\t ") in texts
    assert L.dedup_lines(awkward.limit(0)).count() == 0
    report = {(r.doc_id, r.n_lines, r.n_dropped) for r in L.dedup_lines(awkward, report=True).collect()}
    assert {(1, 0, 0), (2, 1, 0), (6, 1, 1), (5, 1, 0)} <= report


def test_min_docs(docs_of):
    docs = docs_of([(i, BOILER) for i in range(2)])
    assert run(docs) == {0: BOILER, 1: ""}
    assert {r.text for r in L.dedup_lines(docs, min_docs=3).collect()} == {BOILER}
