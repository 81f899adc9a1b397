import hashlib
import random
import re
import time

from slicemill.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), order, kind, m.end()) for order, (kind, pattern) in enumerate(PATTERNS.items()) for m in re.finditer(pattern, text) if valid(kind, m[0]))


def test_base_kinds_against_patterns():
    rnd = random.Random(1)
    pieces = list("0123456789") * 3 + list("..@@+- ()aZ_%é\n") + ["1.2.3.4", "x@y.z", "4111 1111 1111 1111", "4111111111111111", "+49 (30) 123-456-78"]
    find = pii.finder()
    for _ in range(20_000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 40)))
        assert [s for s in find(text) if s[1] < 4] == brute(text), text


def test_added_kinds():
    text = "iban DE89 3704 0044 0532 0130 00 ok ssn: 123-45-6789 Account 12345678 https://u:p@h.com/ tel:0301234567"
    kinds = {s[2]: text[s[0]:s[3]] for s in pii.finder()(text)}
    assert kinds["iban"] == "DE89 3704 0044 0532 0130 00" and kinds["ssn"] == "123-45-6789" and kinds["account"] == "12345678"
    assert kinds["login"] == "https://u:p@h.com" and kinds["tel"] == "0301234567"
    for clean in ("iban DE88 3704 0044 0532 0130 00", "ssn 000-12-3456", "account of 3", "https://example/a", "accounts 12", "telephone"):
        assert pii.finder()(clean) == [], clean


def kinds_of(text):
    return {s[2]: text[s[0]:s[3]] for s in pii.finder()(text)}


def test_secrets():
    value = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for cue in (f'token = "{value}" then', f"TOKEN: {value}", f"my_api_key='{value}'", f"password={value}"):
        assert kinds_of(cue) == {"secret": value}, cue
    for clean in (f"a token {value}", "token = " + "ab1" * 5, "token = " + "a" * 40, "token = " + "a1" * 20, "token = onlylettersinthisvalueofmany", "token = " + "a1b2c3d4e5f6g7h8" * 20):
        assert "secret" not in kinds_of(clean), clean


def test_addresses():
    assert kinds_of("see http://www.a-b.org/x?y=1. Or") == {"url": "http://www.a-b.org/x?y=1"}
    assert kinds_of("ftp://10.0.0.1:21 x") == {"url": "ftp://10.0.0.1:21", "ip": "10.0.0.1"}
    assert kinds_of("at 2001:db8::8a2e:370:7334, ok") == {"ipv6": "2001:db8::8a2e:370:7334"}
    assert kinds_of("1:2:3:4:5:6:7:8") == {"ipv6": "1:2:3:4:5:6:7:8"}
    for clean in ("12:30:45", "a::b::c", "std::vector", "1:2:3:4:5:6:7:8:9", "::", "http://localhost", "http://-a.de", "http://a..de", "x://"):
        assert not {"ipv6", "url"} & set(kinds_of(clean)), clean


def test_work_grows_with_the_text_alone():
    """Every anchor and cue, repeated 300 KB long with what its parser looks for."""
    find = pii.finder()
    units = ["iban a ", "iban DE89 3704 0044 0532 0130 ", "a@", "@a.b", "a.b", "+1 ", "+1(", "1.", "1 ", "1-", "x://", "x://a.", "http://a:b", "tel:1", "ssn 1", "account 1 ", "token = a1",
             "token=", "a:", "::", "1:2", "secret: ", "key ", "iban", "password", "4111 1111 1111 1111 ", "1.2.3.4", "a@b.c ", "http://a.de/"]
    for unit in units:
        began = time.perf_counter()
        find(unit * (300_000 // len(unit)))
        assert time.perf_counter() - began < 15, unit
    for long in ("a" * 1_000_000, "1" * 1_000_000, "f:" * 500_000, "a@" + "b" * 1_000_000, "b" * 1_000_000 + "@c.d"):
        began = time.perf_counter()
        find("iban " + long + " token = " + long)
        assert time.perf_counter() - began < 15


def test_frames(docs_of, awkward):
    docs = docs_of([(1, "mail a.b@c.de now"), (2, None), (3, "é 1.2.3.4 and 4111 1111 1111 1111")])
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert rows[1].n_email == 1 and rows[1].spans == "email:5:13" and rows[1].base_sha256 == hashlib.sha256(b"email:5:13").hexdigest()
    assert (rows[3].n_ip, rows[3].n_card) == (1, 1) and rows[3].spans == "ip:2:9,card:14:33"
    assert rows[2].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()} == {1: "mail <EMAIL> now", 2: None, 3: "é <IP> and <CARD>"}
    assert pii.find(awkward).count() == 10 and pii.redact(awkward).columns == awkward.columns and pii.find(awkward.limit(0)).count() == 0
