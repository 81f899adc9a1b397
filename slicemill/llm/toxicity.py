"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two strings is the gapped subsequence kernel: every subsequence of ``LENGTH`` characters counts with
``DECAY`` to the power of the span it covers, spans up to ``SPAN``, over the weight that a string of that length has in
all. Inserted or changed characters therefore lower the similarity of an insult only a little. The strings are windows
of a sentence: one to ``WORDS`` neighbouring words, joined, of at most ``WINDOW`` letters and digits. So the kernel sees
insults of several words and ones that are split by spaces, too. A run of single letters counts as one word, longer
words are covered by overlapping windows, and windows of several words end where a sentence does.

Landmarks are windows of the labelled sentences; a window becomes its kernel values against them, whitened by the
landmarks' own kernel matrix. As the machine is linear in these, its weights fold into one number for each subsequence.
Scoring adds these up along a text once: sums for a window are differences of running sums, in whole numbers, so that
equal texts have equal scores wherever they lie in a batch.

Labels belong to whole documents, so the machine learns from sentences as multiple instances. Of a toxic document the
window with the highest score (its witness) is the positive example, together with copies of it in which a character is
inserted, doubled or replaced. Witnesses are windows of which clean documents have less than ``CLEAN_SHARE``, so one
quotation or wrong label does not unlearn an insult. They start at the windows that are most typical of toxic sentences
and are picked anew after each fit. Negative examples are the most frequent words of clean sentences and, after each fit,
the clean windows that it scores highest; each weighs as much as the least clean word in it, by the share that clean
documents have in its occurrences, times the number of clean documents whose worst window it is. A document scores as its worst window, mapped to a probability by a logistic curve
fitted on the same documents and on the mean margins of the witnesses' changed copies.

The fit sees at most ``TRAIN_DOCS`` labelled documents, a third of them toxic, the first by hash of their id, of these the ones up to
``TRAIN_CHARS`` characters, and keeps ``NEGATIVES`` frequent words and ``HARD`` windows a round; after the first fit ``HARD_LANDMARKS`` of these
become landmarks, too. Scoring covers every
window of every text, ``BLOCK`` characters or one text of up to ``PIECE`` at a time; longer texts are cut at white space
into pieces that overlap by ``OVERLAP`` characters.

Defined cases: null and empty texts, and texts without windows of three characters, get the score of no evidence; rows
without id are scored and not held out; without labels of both kinds, or where no window tells
them apart, every score is the share of label 1 among all labelled documents, else 0, and ``drop_toxic`` keeps every
document; very long texts are scored whole, piece by piece; among windows of equal score the first in order of words and
then of their text is the witness; repeated rows are scored alike; empty tables give empty tables; extra columns pass
through ``drop_toxic`` untouched.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import map_batches, slices

TRAIN_DOCS, TRAIN_CHARS = 3000, 20_000
NEGATIVES, HARD = 20_000, 10_000
LENGTH, SPAN, DECAY = 3, 6, 0.75
WINDOW, WORDS = 24, 3
TOXIC_LANDMARKS, CLEAN_LANDMARKS, HARD_LANDMARKS = 96, 64, 128
ROUNDS = 5
COST = 100.0  # compared with 10, 30 and 300 on labelled rows outside the fit
CLEAN_SHARE = 0.25
WORN = 0.1  # what a changed copy weighs in the curve
CHARS = 64  # characters told apart by the kernel; the last one stands for all rarer ones
BLOCK, PIECE, OVERLAP = 200_000, 1_000_000, 1_000
SCALE = 1 << 20  # of the whole numbers that stand for weights

STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
LETTER, SPACE, STOP = 1, 2, 4  # kinds of characters; others are skipped inside words
MIX = 0x9E3779B97F4A7C15  # an odd number, base of the windows' hashes


@functools.cache
def kinds() -> np.ndarray:
    """Kinds of all characters; the end of a line is both white space and the end of a sentence."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        out[i] = LETTER if c.isalnum() else SPACE if c.isspace() else 0
    for c in ".!?\n":
        out[ord(c)] |= STOP
    return out


class Windows:
    """All windows of some lower-case texts: letters in a row, words as places in it, windows by their words."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds()[points]
        raw = np.flatnonzero(kind == LETTER)
        self.letters = points[raw]
        n = len(raw)
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []  # start, end, first word, number of words
        self.word_start = self.word_end = self.doc = np.zeros(0, int)
        if not n:
            return
        word = np.cumsum(kind & SPACE != 0, dtype=np.int32)[raw]
        start = np.append(0, np.flatnonzero(word[1:] != word[:-1]) + 1)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        doc = np.searchsorted(offsets, raw[start], "right") - 1
        single = np.diff(np.append(start, n)) == 1
        keep = np.append(True, ~(single[1:] & single[:-1] & (doc[1:] == doc[:-1])))
        start, doc = start[keep], doc[keep]
        end = np.append(start[1:], n)
        self.word_start, self.word_end, self.doc = start, end, doc
        stops = np.cumsum(kind & STOP != 0, dtype=np.int32)
        joined = stops[raw[start[1:]]] == stops[raw[start[1:] - 1]]  # with the next word
        size = end - start
        at = np.flatnonzero((size >= LENGTH) & (size <= WINDOW))
        self.groups.append((start[at], end[at], at, 1))
        at = np.flatnonzero(size > WINDOW)
        if len(at):
            half = WINDOW // 2
            count = -((half - size[at]) // half)
            at = np.repeat(at, count)
            place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            first = start[at] + half * place
            self.groups.append((first, np.minimum(first + WINDOW, end[at]), at, 1))
        open_ = np.ones(len(start), bool)
        for k in range(1, min(WORDS, len(start))):
            open_ = open_[:-1] & joined[k - 1:]
            size = end[k:] - start[:-k]
            at = np.flatnonzero(open_ & (size >= LENGTH) & (size <= WINDOW))
            self.groups.append((start[at], end[at + k], at, k + 1))

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, first and last word of all windows."""
        if not self.groups:
            return (np.zeros(0, int),) * 4
        start, end, first = (np.concatenate([g[i] for g in self.groups]) for i in range(3))
        return start, end, first, first + np.concatenate([np.full(len(g[0]), g[3] - 1) for g in self.groups])

    def text(self, start: int, end: int) -> str:
        return self.letters[start:end].tobytes().decode("utf-32-le", "surrogatepass")

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of stretches of the letters."""
        n = len(self.letters)
        mixed = (self.letters.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
        mixed ^= mixed >> np.uint64(29)

        def powers(base):
            return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(mixed * powers(MIX)[:n], dtype=np.uint64)]
        return (sums[end] - sums[start]) * powers(pow(MIX, -1, 1 << 64))[start]


class Subsequences:
    """Subsequences of words over the ``CHARS - 1`` most frequent characters; all others are one."""

    def __init__(self, chars: str):
        self.code = np.full(0x110000, CHARS - 1, np.uint8)
        for i, c in enumerate(chars[:CHARS - 1]):
            self.code[ord(c)] = i

    def of(self, words: list[str]):
        """Yields (rows, subsequences, weights) for the words of each length; shorter words have none."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, at in by_length.items():
            if n < LENGTH:
                continue
            points = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = self.code[points].reshape(len(at), n).astype(np.int32)
            ids, weights = [], []
            for a, b in STEPS:
                if b < n:
                    ids.append((codes[:, :n - b] * CHARS + codes[:, a:n - b + a]) * CHARS + codes[:, b:])
                    weights.append(np.full(n - b, DECAY ** (b + 1), np.float32))
            weights = np.concatenate(weights)
            yield np.array(at), np.concatenate(ids, axis=1), weights / np.sqrt((weights * weights).sum())


class Landmarks:
    """Kernel values of words against the landmarks."""

    def __init__(self, features: Subsequences, words: list[str]):
        parts = list(features.of(words))
        ids = np.concatenate([i.ravel() for _, i, _ in parts])
        rows = np.concatenate([np.repeat(at, i.shape[1]) for at, i, _ in parts])
        weights = np.concatenate([np.tile(w, len(at)) for at, _, w in parts])
        self.features = features
        self.used, at = np.unique(ids, return_inverse=True)
        self.place = np.zeros(CHARS ** LENGTH, np.int32)
        self.place[self.used] = np.arange(1, len(self.used) + 1)
        n = len(words)
        flat = np.bincount((at + 1) * n + rows, weights, (len(self.used) + 1) * n)
        self.table = flat.reshape(len(self.used) + 1, n).astype(np.float32)

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        for first in range(0, len(words), 20_000):
            for at, ids, w in self.features.of(words[first:first + 20_000]):
                place = self.place[ids]
                own = np.zeros((len(at), self.table.shape[1]), np.float32)
                for i in range(ids.shape[1]):
                    hit = np.flatnonzero(place[:, i])
                    own[hit] += w[i] * self.table[place[hit, i]]
                out[first + at] = own
        return out


@dataclass
class Model:
    """One weight for each subsequence, and the curve from margins to probabilities."""

    features: Subsequences
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self):
        self.whole = np.round(np.clip(self.weights, -300, 300) * SCALE).astype(np.int32)
        spans = np.array([b for _, b in STEPS])
        powers = np.array([DECAY ** (2 * b + 2) for _, b in STEPS])
        # root of the sum of squared weights of a string of each length
        self.norm = np.sqrt([max(1e-12, (np.maximum(n - spans, 0) * powers).sum()) for n in range(WINDOW + 1)])

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins of single strings of any length, without running sums."""
        out = np.full(len(words), self.bias)
        for at, ids, w in self.features.of(words):
            out[at] += self.weights[ids] @ w
        return out

    def sums(self, windows: Windows) -> list[np.ndarray]:
        """Running sums of the weights of all subsequences that start before a letter, for each span."""
        low = self.features.code[windows.letters].astype(np.int32)
        middle, high = low * CHARS, low * CHARS ** 2
        n, out = len(low), []
        for b in range(2, SPAN):
            total = np.zeros(n + 1, np.int64)
            if n > b:
                ends = high[:n - b] + low[b:]
                values = self.whole[ends + middle[1:n - b + 1]]
                for a in range(2, b):
                    values += self.whole[ends + middle[a:n - b + a]]
                np.cumsum(values, dtype=np.int64, out=total[1:n - b + 1])
                total[n - b + 1:] = total[n - b]
            out.append(total)
        return out

    def window_margins(self, sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start))
        for b, total in zip(range(2, SPAN), sums):
            out += DECAY ** (b + 1) * (total[np.maximum(end - b, start)] - total[start])
        return out / self.norm[end - start] / SCALE + self.bias

    def worst(self, texts: list[str]) -> np.ndarray:
        """Highest margin of any window of each lower-case text, at least that of no evidence."""
        windows = Windows(texts)
        out = np.full(len(texts), self.bias)
        sums = self.sums(windows)
        for start, end, first, _ in windows.groups:
            if len(start):
                margin, doc = self.window_margins(sums, start, end), windows.doc[first]
                begin = np.append(0, np.flatnonzero(doc[1:] != doc[:-1]) + 1)
                out[doc[begin]] = np.maximum(out[doc[begin]], np.maximum.reduceat(margin, begin))
        return out

    def probability(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * margin + self.shift))))


def spread(features: Subsequences, ranked: list[str], count: int) -> list[str]:
    """The first ``count`` words that are not too similar to one picked before."""
    ranked = ranked[:8 * count]
    if not ranked:
        return []
    k = Landmarks(features, ranked).kernel(ranked)
    picked: list[int] = []
    for i in range(len(ranked)):
        if len(picked) < count and (not picked or k[i, picked].max() < 0.6):
            picked.append(i)
    return [ranked[i] for i in picked]


def squared_hinge(z: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Primal Newton steps of a linear machine with squared hinge loss; the last feature is the bias."""
    u = np.zeros(z.shape[1])
    for _ in range(rounds):
        sv = 1 - y * (z @ u) > 0
        left, right = np.eye(z.shape[1]), np.zeros(z.shape[1])
        for at in range(0, len(z), 20_000):  # sums in pieces, to hold no second copy
            own = sv[at:at + 20_000]
            part = z[at:at + 20_000][own].astype(float)
            weighed = part * cost[at:at + 20_000][own, None]
            left += weighed.T @ part
            right += weighed.T @ y[at:at + 20_000][own]
        step = np.linalg.solve(left, right)
        if np.abs(step - u).max() < 1e-6:
            break
        u = step
    return u


def looked_up(known: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """``values`` of the sorted ``known`` hashes for the wanted ones."""
    if not len(known):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[at], default)


class Sample:
    """The labelled texts; windows are made again in each pass, kept are hashes of toxic windows and their counts."""

    def __init__(self, texts: list[str], labels: np.ndarray):
        self.texts = [t.lower() for t in texts]
        self.labels = labels
        chars = np.zeros(0x110000, np.int64)
        toxic, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for w, label in self.windows():
            np.add.at(chars, w.letters, 1)
            (toxic if label else words).append(np.unique(w.hashes(*(w.whole()[:2] if label else w.groups[0][:2]))))
        order = np.argsort(-chars, kind="stable")[:CHARS - 1]
        self.features = Subsequences("".join(chr(i) for i in order if chars[i]))
        self.toxic, self.count = np.unique(np.concatenate(toxic), return_counts=True)
        word, often = np.unique(np.concatenate(words), return_counts=True)
        self.common = word[np.argsort(-often, kind="stable")[:NEGATIVES]]  # words of clean sentences, most frequent first
        clean, every = np.zeros(len(self.toxic), np.int64), 0
        for w, _ in self.windows((0,)):
            own = np.unique(w.hashes(*w.whole()[:2]))
            every += len(own)
            at = looked_up(self.toxic, np.arange(len(self.toxic)), own, -1)
            clean[at[at >= 0]] += 1
        # by documents, as if there were equally many of both labels
        held = clean / max(1, np.sum(labels == 0)), self.count / max(1, np.sum(labels == 1))
        self.share = held[0] / np.maximum(held[0] + held[1], 1e-12)
        ratio = every / max(1, self.count.sum())
        self.rank = np.log((self.count * ratio + 0.5) / (clean + 0.5)) * np.sqrt(self.count)

    def windows(self, wanted: tuple[int, ...] = (0, 1)):
        for text, label in zip(self.texts, self.labels):
            if label in wanted and (w := Windows([text])).groups:
                yield w, label

    def named(self, hashes: np.ndarray, labels: tuple[int, ...]) -> list[str]:
        """Texts of the windows with these hashes, in their order; they occur in texts of these labels."""
        wanted, found = np.sort(hashes), {}
        for w, _ in self.windows(labels):
            start, end, _, _ = w.whole()
            own = w.hashes(start, end)
            for i in np.flatnonzero(looked_up(wanted, np.ones(len(wanted), bool), own, False)):
                if int(own[i]) not in found:
                    found[int(own[i])] = w.text(start[i], end[i])
            if len(found) == len(wanted):
                break
        return [found[int(h)] for h in hashes]

    def witnesses(self, model: Model | None) -> list[str]:
        """The window of each toxic text that scores highest among those that clean texts seldom have."""
        out = []
        for w, _ in self.windows((1,)):
            start, end, _, _ = w.whole()
            own = w.hashes(start, end)
            score = looked_up(self.toxic, self.rank, own, -99.0) if model is None else model.window_margins(model.sums(w), start, end)
            score = np.where(looked_up(self.toxic, self.share, own, 1.0) < CLEAN_SHARE, score, -np.inf)
            if len(score) and score.max() > -np.inf:
                best = np.flatnonzero(score == score.max())
                out.append(min((end[i] - start[i], w.text(start[i], end[i])) for i in best)[1])
        return out

    def hard(self, model: Model) -> dict[str, float]:
        """The ``HARD`` clean windows of the highest margins, and what each weighs: more if it is the worst of many texts."""
        found: dict[str, list[float]] = {}  # margin, weight, number of texts whose worst window it is

        def first() -> list[str]:
            return sorted(found, key=lambda f: (-found[f][0], f))[:HARD]

        for w, _ in self.windows((0,)):
            start, end, begin, last = w.whole()
            margin = model.window_margins(model.sums(w), start, end)
            at = np.flatnonzero(margin > -1)
            if not len(at):
                continue
            words = looked_up(self.toxic, self.share, w.hashes(w.word_start, w.word_end), 1.0)
            weight = looked_up(self.toxic, self.share, w.hashes(start[at], end[at]), 1.0)
            for k in range(WORDS):
                weight = np.minimum(weight, words[np.minimum(begin[at] + k, last[at])])
            top = int(np.argmax(margin))
            for i, v in zip(at.tolist(), weight.tolist()):
                own = found.setdefault(w.text(start[i], end[i]), [float(margin[i]), v, 0])
                own[1] = min(own[1], v)
                own[2] += i == top
            if len(found) > 4 * HARD:
                found = {f: found[f] for f in first()}
        return {f: found[f][1] * max(1, found[f][2]) for f in first()}


def whitened(features: Subsequences, marks: list[str]) -> tuple[Landmarks, np.ndarray]:
    """Landmarks, and the inverse root of their own kernel matrix."""
    landmarks = Landmarks(features, marks)
    value, vector = np.linalg.eigh(landmarks.kernel(marks).astype(float))
    return landmarks, (vector / np.sqrt(np.maximum(value, 1e-3))).astype(np.float32)


def fit(texts: list[str], labels: list[int], cost: float = COST) -> Model | float:
    """A model, or the share of label 1 if only one label occurs or no window tells them apart."""
    y = np.array(labels)
    if len(y) == 0 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    sample = Sample(texts, y)
    typical = np.argsort(-sample.rank, kind="stable")
    typical = typical[(sample.count[typical] >= 2) & (sample.share[typical] < CLEAN_SHARE)][:8 * TOXIC_LANDMARKS]
    common = sample.named(sample.common, (0,))
    marks = spread(sample.features, sample.named(sample.toxic[typical], (1,)), TOXIC_LANDMARKS)
    marks = list(dict.fromkeys(marks + spread(sample.features, common, CLEAN_LANDMARKS)))
    witness = sample.witnesses(None)
    if not marks or not witness:
        return float(y.mean())
    negative = dict(zip(common, looked_up(sample.toxic, sample.share, sample.common, 1.0).tolist()))
    landmarks, whiten = whitened(sample.features, marks)
    for left in reversed(range(ROUNDS)):
        worn = [v for w in sorted(set(witness)) for v in variants(w)]
        ones = len(witness) + len(worn)
        words = witness + worn + list(negative)
        x = np.c_[landmarks.kernel(words) @ whiten, np.ones(len(words), np.float32)]
        side = np.r_[np.ones(ones), -np.ones(len(negative))]
        share = np.array(list(negative.values()))
        weight = cost * np.r_[np.ones(len(witness)), np.full(len(worn), 0.5), max(1.0, ones / max(1, len(negative))) * share]
        u = squared_hinge(x, side, weight)
        folded = np.zeros(CHARS ** LENGTH, np.float32)
        folded[landmarks.used] = landmarks.table[1:] @ (whiten @ u[:-1])
        model = Model(sample.features, folded, float(u[-1]))
        if left:
            witness = sample.witnesses(model)
            hard = sample.hard(model)
            for w, v in hard.items():
                negative[w] = max(v, negative.get(w, 0.0))
            if left == ROUNDS - 1:
                marks = list(dict.fromkeys(marks + spread(sample.features, list(hard), HARD_LANDMARKS)))
                landmarks, whiten = whitened(sample.features, marks)
    worst = np.array([model.worst([t])[0] for t in sample.texts])
    worn = {w: model.margins(variants(w)).mean() for w in set(witness)}
    return Model(sample.features, folded, float(u[-1]), *logistic(
        np.append(worst, [worn[w] for w in witness]), np.append(y, np.ones(len(witness), int)), np.append(np.ones(len(y)), np.full(len(witness), WORN))))


def variants(word: str) -> list[str]:
    """The word with one character inserted, doubled or replaced, at each inner place."""
    return [v for i in range(1, len(word)) for v in (word[:i] + "x" + word[i:], word[:i] + word[i - 1:], word[:i] + "1" + word[i + 1:])]


def logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve; targets are drawn in a little, so that separable data give finite values."""
    n1, n0 = (cost * y).sum(), (cost * (1 - y)).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        g = np.array([(cost * (p - t) * x).sum() + 1e-3 * a, (cost * (p - t)).sum()])
        w = cost * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def pieces(text: str):
    """A lower-case text, cut at white space into overlapping pieces where it is longer than ``PIECE``."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        cut = max(cut - OVERLAP, *(text.rfind(c, cut - OVERLAP, cut) for c in " \n"))
        yield text[at:cut]
        back = [p for p in (text.find(c, cut - OVERLAP, cut) for c in " \n") if p >= 0]
        at = min(back, default=cut - OVERLAP)
    yield text[at:]


def probabilities(model: Model | float, texts: list[str | None]) -> list[float]:
    """Scores of whole texts."""
    if isinstance(model, float):
        return [model] * len(texts)
    worst = np.full(len(texts), model.bias)
    own: list[str] = []
    owner: list[int] = []

    def take():
        if own:
            np.maximum.at(worst, owner, model.worst(own))
        own.clear(), owner.clear()

    size = 0
    for i, text in enumerate(texts):
        for piece in pieces((text or "").lower()):
            if size + len(piece) > BLOCK:
                take()
                size = 0
            own.append(piece), owner.append(i)
            size += len(piece)
    take()
    return [model.probability(m) for m in worst.tolist()]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """Fits on a bounded sample of the labelled documents that are not held out, a third of it toxic where there are enough."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = max(1, TRAIN_DOCS // 3)
    picked = [known.where(F.col("label") == v).orderBy(*order).limit(n) for v, n in ((0, TRAIN_DOCS - toxic), (1, toxic))]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # TRAIN_DOCS rows of two numbers
    rows = docs.select("doc_id", "text").where(F.length("text") <= TRAIN_CHARS).join(sample, "doc_id").select("doc_id", "text", "label")
    rows = sorted({(r.doc_id, r.text, r.label) for r in rows.collect()})
    model = fit([r[1] for r in rows], [int(r[2]) for r in rows])
    if isinstance(model, float):  # the sample is not in proportion, the share is that of all
        model = float(known.join(docs.select("doc_id"), "doc_id", "left_semi").agg(F.avg("label")).first()[0] or 0.0)
    return model


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    def start():
        return lambda batch: {"doc_id": batch.column("doc_id"), "score": probabilities(model, batch.column("text").to_pylist())}

    out = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), start, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted to be toxic, by a model fitted on ``labels``."""
    model = train(docs, labels)
    if isinstance(model, float):
        return docs

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                scores = probabilities(model, piece.column(piece.schema.get_field_index("text")).to_pylist())
                yield piece.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
