"""Token ids of the byte-level vocabulary, word by word with a bounded memory of words met before."""

from __future__ import annotations

import base64
from array import array

KEPT, KEPT_COUNTS = 700_000, 800_000  # words
KEPT_CHARS = 12_000_000               # of these words; about 200 MB in all, whatever the language
SPECIAL = {"<|endoftext|>": 50256}


class Words(dict):
    """What ``encode`` makes of a word behind a space; None where a text may not be cut at the spaces around it.

    A single space between other characters always starts a new token run, so texts are cut there. White space next to
    a space belongs to the same run.
    """

    def __init__(self, encode, most: int):
        self.encode, self.most, self.chars = encode, most, 0
        self.marks = {c: encode(c) for c in ".,;:!?"}

    def __missing__(self, word: str):
        if len(self) >= self.most or self.chars > KEPT_CHARS:
            self.clear()
            self.chars = 0
        self.chars += len(word)
        if not word or word[0].isspace() or word[-1].isspace():
            out = None
        elif word[-1] in self.marks and word[:-1].isalpha():  # letters and marks are runs of their own
            out = self[word[:-1]] + self.marks[word[-1]]
        else:
            out = self.encode(" " + word)
        self[word] = out
        return out


class ByteEncoder:
    """Ids of whole texts as bytes, four (``I``) or two (``H``) for each, low byte first; special strings in a text are special tokens."""

    def __init__(self, path: str, kind: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tool = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.kind, self.width = kind, array(kind).itemsize
        ordinary = self.tool.encode_ordinary
        self.known = Words(lambda w: array(kind, ordinary(w)).tobytes(), KEPT)
        self.counts = Words(lambda w: len(ordinary(w)), KEPT_COUNTS)

    def plain(self, text: str) -> bytes:
        return array(self.kind, self.tool.encode(text, allowed_special="all")).tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = self.cut(text, self.known)
        return self.plain(text) if parts is None else b"".join(parts)

    def size(self, text: str | None) -> int:
        """Number of ids; words are counted, not kept."""
        if not text:
            return 0
        parts = self.cut(text, self.counts)
        return len(self.plain(text)) // self.width if parts is None else sum(parts)

    def cut(self, text: str, words: Words) -> list | None:
        """What is known of the words of a text, or None if it has to be encoded whole."""
        if "<|" in text:
            return None
        first, *rest = text.split(" ")
        if first and (first[0].isspace() or first[-1].isspace()):
            return None
        parts = list(map(words.__getitem__, rest))
        if None in parts:
            return None
        return [words.encode(first), *parts] if first else parts


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def encoder(path: str | None = None, kind: str = "I") -> ByteEncoder:
    """The worker's encoder for a vocabulary file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    if (path, kind) not in _encoders:
        _encoders[path, kind] = ByteEncoder(path, kind)
    return _encoders[path, kind]


def forget() -> None:
    """Frees what the worker's encoders remember, where a later stage does not encode."""
    _encoders.clear()
