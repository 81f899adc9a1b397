"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, small parsers grow and check them.

Anchors are at-signs, plus signs, digits, schemes and identifier cues. From each, a parser that looks only at the
neighbourhood grows the longest span of its kind to the left and right, and a check keeps or drops it. The four
base kinds equal the leftmost matches, without overlap inside a kind, of

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+){3}, parts at most 255
    card   [0-9]([ -]?[0-9])+, 12 to 19 digits with a valid check digit
    phone  \\+[0-9][ ().0-9-]+[0-9], 9 to 15 digits

The further kinds are ``url`` (scheme and a valid host), ``login`` (an address with user and password after its scheme),
``ipv6`` (around a colon, valid by its groups), ``tel`` (digits after the scheme), ``iban``, ``ssn`` and ``account`` (a
number after a cue, valid by its own rule) and ``secret`` (a key, token or password of many different characters, letters
and digits, after a cue and an equals sign or colon). Offsets are code points, ends exclusive.

Every parser reads a bounded neighbourhood of its anchor, or a run that no later anchor of its kind reads again, so the
work grows in proportion to the text, whatever it holds.

Defined cases: null and empty texts have no spans; whole texts are read, however long; overlapping spans of different kinds
are all reported; repeated rows give equal results; null ids stay null; empty tables give empty tables; extra columns
pass through ``redact``.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import map_batches, slices

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("login", "tel", "iban", "ssn", "account", "secret", "ipv6", "url")
MASKED = frozenset(KINDS) - {"url"}  # an address without a login is public
ORDER = {k: i for i, k in enumerate(KINDS)}
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LABEL = LETTERS | DIGITS | {"-"}
LOCAL = LABEL | frozenset("._%+")
PHONE = DIGITS | frozenset(" ().-")
CUES = {"iban": "iban", "ssn": "ssn", "account": "account", "acct": "account", "konto": "account"}
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "private_key")
REACH = 12  # characters between a cue and its number
IBAN, GROUPED = range(15, 35), frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz ")
SECRET, ENTROPY = range(16, 201), 2.5  # characters of a secret and their bits each, at least
SECRET_RUN = LETTERS | DIGITS | frozenset("+/_-")
GROUPS = frozenset("0123456789abcdefABCDEF:")
HOST_END = frozenset(" \t\r\n/?#\"'<>")


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in DIGITS:
        found.add_word(c, ("digit", 1))
    for text, kind in (("@", "email"), ("+", "phone"), ("://", "login"), ("tel:", "tel"), ("TEL:", "tel"), ("Tel:", "tel")):
        found.add_word(text, (kind, len(text)))
    found.add_word(":", ("ipv6", 1))
    for cue, kind in [*CUES.items(), *((c, "secret") for c in SECRET_CUES)]:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def run_end(text: str, at: int, allowed: frozenset, most: int | None = None) -> int:
    """End of the run of allowed characters, at most ``most`` of them."""
    n = len(text) if most is None else min(len(text), at + most)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around the sign at ``at``; the name does not reach below ``floor``, the end of the last address."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
        end = run_end(text, end + 1, LABEL)
        labels += 1
    return (start, end) if labels else None


def chain(text: str, at: int, between: str) -> list[tuple[int, int]]:
    """Runs of digits from ``at`` on with one character of ``between`` between them."""
    runs, n = [], len(text)
    while True:
        end = run_end(text, at, DIGITS)
        runs.append((at, end))
        if end + 1 < n and text[end] in between and text[end + 1] in DIGITS:
            at = end + 1
        else:
            return runs


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def phone(text: str, at: int) -> tuple[int, int, bool] | None:
    """From the plus sign; the last value tells whether the number of digits is right."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None
    digits = sum(c in DIGITS for c in text[at + 1:end])
    return at, end, 9 <= digits <= 15


def login(text: str, at: int) -> tuple[str, int, int] | None:
    """login: scheme://user:password@host, url: scheme://host and what follows; from the colon of the scheme."""
    start = at
    while start > 0 and at - start < 20 and text[start - 1] in LETTERS:
        start -= 1
    if start == at:
        return None
    end = at + 3
    while end < len(text) and text[end] not in HOST_END:
        end += 1
    user, sign, host = text[at + 3:end].rpartition("@")
    if sign and ":" in user and user[0] != ":" and host and host[0] in LABEL:
        return "login", start, end
    if sign or not valid_host(host):
        return None
    if end < len(text) and text[end] == "/":
        while end < len(text) and text[end] not in " \t\r\n\"'<>":
            end += 1
    while text[end - 1] in ".,;:!?":
        end -= 1
    return "url", start, end


def valid_host(host: str) -> bool:
    """Labels with dots, the last of two and more letters, or four numbers; a port may follow."""
    name, colon, port = host.rstrip(".,;:!?").partition(":")
    if colon and not (port.isascii() and port.isdigit() and int(port[:6]) < 65536) or len(name) > 253:
        return False
    labels = name.split(".")
    if len(labels) < 2 or not all(0 < len(x) < 64 and LABEL.issuperset(x) and x[0] != "-" and x[-1] != "-" for x in labels):
        return False
    return len(labels[-1]) > 1 and LETTERS.issuperset(labels[-1]) or len(labels) == 4 and all(DIGITS.issuperset(x) and at_most_255(x) for x in labels)


def iban(text: str, start: int) -> tuple[int, int] | None:
    """The longest valid number from ``start`` on, in groups or not; only as far as a number can reach."""
    own, ends, at = [], [], start
    while at < len(text) and text[at] in GROUPED and len(own) < IBAN.stop - 1 and at - start < 2 * IBAN.stop:
        if text[at] != " ":
            own.append(text[at].upper())
            ends.append(at + 1)
        at += 1
    if len(own) < IBAN.start or not ("".join(own[:2]).isalpha() and "".join(own[2:4]).isdigit()):
        return None
    for size in range(len(own), IBAN.start - 1, -1):
        if int("".join(str(int(c, 36)) for c in own[4:size] + own[:4])) % 97 == 1:
            return start, ends[size - 1]
    return None


def secret(text: str, at: int) -> tuple[int, int] | None:
    """The value behind a cue that ends at ``at``: a sign in between, letters and digits, of many different characters."""
    start = at
    while start < len(text) and start - at < REACH and text[start] in " :=\"'`>":
        start += 1
    if not any(c in "=:" for c in text[at:start]):
        return None
    end = run_end(text, start, SECRET_RUN, SECRET.stop)
    size = end - start
    if size not in SECRET:
        return None
    counts = Counter(text[start:end])
    if DIGITS.isdisjoint(counts) or LETTERS.isdisjoint(counts):
        return None
    return (start, end) if -sum(n / size * math.log2(n / size) for n in counts.values()) >= ENTROPY else None


def ipv6(text: str, at: int, floor: int) -> tuple[int, int, bool]:
    """The run of groups around the colon at ``at`` and whether it is an address."""
    start, end = at, run_end(text, at, GROUPS)
    while start > floor and text[start - 1] in GROUPS:
        start -= 1
    value = text[start:end]
    if not 3 <= len(value) <= 39 or value.count(":") < 2 or value.strip(":") == "" or start and text[start - 1] in LABEL or end < len(text) and text[end] in LABEL:
        return start, end, False
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return start, end, False
    return start, end, True


def numbered(text: str, kind: str, at: int) -> tuple[int, int] | None:
    """The number of a kind at most REACH characters behind the end of its cue."""
    start = at
    while start < len(text) and start - at < REACH and text[start] in " :#.=-":
        start += 1
    if start == at and kind != "tel" or start >= len(text):
        return None
    if kind == "iban":
        return iban(text, start)
    if text[start] not in DIGITS:
        return None
    runs = chain(text, start, "-" if kind == "ssn" else " -.")
    sizes = [b - a for a, b in runs]
    if kind == "ssn":
        if sizes[:3] != [3, 2, 4] or len(runs) > 3 or text[start:start + 3] in ("000", "666") or text[start] == "9":
            return None
        return start, runs[2][1]
    low, high = (7, 15) if kind == "tel" else (6, 17)
    return (start, runs[-1][1]) if low <= sum(sizes) <= high else None


class Finder:
    def __init__(self):
        self.anchors = anchors()

    def __call__(self, text: str | None) -> list[tuple[int, int, str, int]]:
        """Spans (start, place of the kind, kind, end), sorted."""
        found = []
        last = dict.fromkeys(KINDS, 0)

        def add(kind, start, end):
            found.append((start, ORDER[kind], kind, end))
            last[kind] = end

        for end, (kind, size) in self.anchors.iter(text) if text else ():
            at = end - size + 1
            if kind == "digit":
                if at >= last["card"]:
                    runs = chain(text, at, " -")
                    last["card"] = runs[-1][1]
                    if 12 <= sum(b - a for a, b in runs) <= 19 and luhn("".join([text[a:b] for a, b in runs])):
                        add("card", at, runs[-1][1])
                if at >= last["ip"]:
                    runs = chain(text, at, ".")
                    for i in range(0, len(runs) - 3, 4):
                        if all(at_most_255(text[a:b]) for a, b in runs[i:i + 4]):
                            add("ip", runs[i][0], runs[i + 3][1])
                    last["ip"] = runs[-1][1]
            elif kind == "email":
                if at >= last["email"] and (span := email(text, at, last["email"])):
                    add("email", *span)
            elif kind == "phone":
                if at >= last["phone"] and (span := phone(text, at)):
                    last["phone"] = span[1]
                    if span[2]:
                        add("phone", *span[:2])
            elif kind == "login":
                if at >= max(last["login"], last["url"]) and (span := login(text, at)):
                    add(*span)
            elif kind == "ipv6":
                if at >= last["ipv6"]:
                    start, stop, valid = ipv6(text, at, last["ipv6"])
                    last["ipv6"] = stop
                    if valid:
                        add("ipv6", start, stop)
            elif kind == "secret":
                if end + 1 >= last["secret"] and (span := secret(text, end + 1)):
                    add("secret", *span)
            elif end + 1 >= last[kind] and (at == 0 or text[at - 1] not in LETTERS) and (span := numbered(text, kind, end + 1)):
                add(kind, *span)
        found.sort()
        return found


_finder: list[Finder] = []


def finder() -> Finder:
    """The worker's automaton, built once."""
    if not _finder:
        _finder.append(Finder())
    return _finder[0]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, the count of every kind, a digest of the base spans and all spans as text."""
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"

    def start():
        look = finder()

        def run(batch: pa.RecordBatch) -> dict[str, list]:
            out = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": []}
            for text in batch.column("text").to_pylist():
                found = look(text)
                kinds = Counter(s[2] for s in found)
                for k in KINDS:
                    out[f"n_{k}"].append(kinds[k])
                out["base_sha256"].append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, o, k, b in found if o < len(BASE)).encode()).hexdigest())
                out["spans"].append(",".join(f"{k}:{a}:{b}" for a, _, k, b in found))
            return out | {"doc_id": batch.column("doc_id")}
        return run

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), start, schema)


def masked(text: str | None, kinds: frozenset[str] = MASKED) -> str | None:
    """The text with every span of ``kinds`` replaced by its kind; overlapping spans become one of the first one's kind."""
    if not text:
        return text
    out, done = [], 0
    for start, _, kind, end in finder()(text):
        if kind not in kinds:
            continue
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, kinds: frozenset[str] = MASKED) -> DataFrame:
    """``docs`` with masked texts."""
    def run(batches):
        for batch in batches:
            for some in slices(batch):
                at = some.schema.get_field_index("text")
                text = pa.array([masked(t, kinds) for t in some.column(at).to_pylist()], some.schema.field(at).type)
                yield some.set_column(at, some.schema.field(at), text)

    return docs.mapInArrow(run, docs.schema)
