"""Averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy.

A text is cut at white space into words. The features of a word are the word itself and its character n-grams, hashed into
buckets; if word pairs are asked for, so is every pair of neighbours, where a word that repeats its neighbour is written as a
back-reference. A text's vector is the mean of its features' vectors, and a softmax layer gives the classes' probabilities.

A step follows the gradient of one text's loss. Rates differ: the bias takes a tenth of the rate of the output layer, and a text's
embeddings take 0.1 dim / (the greatest share of its features) of it, so that a long text, whose features have small shares, moves
its vectors as far as a short one.

The network is linear up to the softmax, so that a trained model is folded into one table of a logit row per bucket: a text's
logits are the mean of rows, and the rows of a word are summed once per worker.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np

from .common import MEMO_ENTRIES

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


@dataclass
class Shape:
    """What a model looks at and how large it is."""

    bits: int = 17
    dim: int = 16
    grams: tuple[int, int] = (2, 4)
    pairs: bool = False
    lower: bool = False
    #: Only the letters of a word count, and words without any are left out.
    letters: bool = False
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


@dataclass
class Features:
    """Hashed features of words and of neighbouring words."""

    shape: Shape
    buckets: int = field(init=False)

    def __post_init__(self) -> None:
        #: Words and n-grams, then pairs.
        self.buckets = (1 << self.shape.bits) * (2 if self.shape.pairs else 1)

    def words(self, text: str) -> list[str]:
        return text.split()

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket and word number of every feature of the words, and a 64-bit hash of each word."""
        s = self.shape
        shown = [w.lower() for w in words] if s.lower else words
        if s.letters:
            shown = ["".join(filter(str.isalpha, w)) if not w.isalpha() else w for w in shown]
        codes = np.frombuffer("".join(f"<{w}>" for w in shown).encode("utf-32-le"), "<u4").astype(np.uint64)
        lengths = np.array([len(w) + 2 for w in shown], np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        owner = np.repeat(np.arange(len(words)), lengths)
        left = ends[owner] - np.arange(len(codes))  # characters from here to the word's end
        value = (codes + np.uint64(1)) * _MIX
        value ^= value >> np.uint64(31)
        # the whole word: a sum of position-dependent values
        at = (np.arange(len(codes)) - starts[owner]).astype(np.uint64)
        word = np.zeros(len(words), np.uint64)
        np.add.at(word, owner, _mix(value + at * _STEP))
        word = _mix(word)
        empty = lengths == 2
        found, who = [(word & np.uint64((1 << s.bits) - 1)).astype(np.int64)[~empty]], [np.flatnonzero(~empty)]
        rolled = value.copy()
        for n in range(2, s.grams[1] + 1):
            rolled = rolled[:-1] * _STEP + value[n - 1 :] if len(rolled) else rolled
            if n < s.grams[0]:
                continue
            ok = (left[: len(rolled)] >= n) & ~empty[owner[: len(rolled)]]
            found.append((_mix(rolled[ok] + np.uint64(n)) & np.uint64((1 << s.bits) - 1)).astype(np.int64))
            who.append(owner[: len(rolled)][ok])
        return np.concatenate(found), np.concatenate(who), word

    def of_pairs(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket of every pair of neighbours in a text of these word hashes."""
        a, b = hashes[:-1], hashes[1:]
        h = np.where(a == b, np.uint64(1), a * _STEP + b)
        return (_mix(h) & np.uint64((1 << self.shape.bits) - 1)).astype(np.int64) + (1 << self.shape.bits)

    def of_text(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of a text and their shares of its features."""
        words = self.words(text)
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        often = Counter(words)
        distinct = list(often)
        bucket, who, hashes = self.of_words(distinct)
        times = np.array(list(often.values()), float)[who]
        if self.shape.pairs and len(words) > 1:
            place = {w: i for i, w in enumerate(distinct)}
            more = self.of_pairs(hashes[[place[w] for w in words]])
            bucket, times = np.concatenate([bucket, more]), np.concatenate([times, np.ones(len(more))])
        if not len(bucket):
            return bucket, times
        found, inverse = np.unique(bucket, return_inverse=True)
        share = np.bincount(inverse, times)
        return found.astype(np.int32), (share / share.sum()).astype(np.float32)


@dataclass
class Model:
    shape: Shape
    classes: list
    #: A logit row for each bucket, and the bias.
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: Scores below this are rejections.
    reject: float = 0.0


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], targets: list, shape: Shape, calibrate: float = 0.2, precision: float = 0.99) -> Model:
    """Fits a model; the last ``calibrate`` of the rows set the temperature and the rejection score, not the weights.

    The rejection score is the least score at which the calibration rows above it are right to at least ``precision``.
    """
    classes = sorted(set(targets))
    if not classes:
        raise ValueError("no labelled rows to learn from")
    features = Features(shape)
    rows = [features.of_text(t) for t in texts]
    y = np.array([classes.index(t) for t in targets])
    rng = np.random.default_rng(shape.seed)
    n_fit = len(rows) - int(len(rows) * calibrate) if len(rows) >= 50 else len(rows)
    fit, held = np.arange(n_fit), np.arange(n_fit, len(rows))
    if not len(held):
        held = fit
    emb = ((rng.random((features.buckets, shape.dim), np.float32) - 0.5) * (2 / shape.dim)).astype(np.float32)
    out = np.zeros((shape.dim, len(classes)), np.float32)
    bias = np.log((np.bincount(y[fit], minlength=len(classes)) + 1) / (len(fit) + len(classes))).astype(np.float32)
    steps, done = shape.epochs * len(fit), 0
    for _ in range(shape.epochs):
        for i in rng.permutation(fit):
            lr, done = shape.rate * (1 - done / steps), done + 1
            bucket, share = rows[i]
            if not len(bucket):
                continue
            vectors = emb[bucket]
            hidden = share @ vectors
            error = _softmax(hidden @ out + bias)
            error[y[i]] -= 1
            back = out @ error
            out -= lr * np.outer(hidden, error)
            bias -= lr * 0.1 * error
            emb[bucket] = vectors - (lr * shape.dim) * np.outer(share / share.max(), back) * 0.1
    table = (emb @ out).astype(np.float32)
    model = Model(shape, classes, table, bias)
    logits = np.array([(share @ table[bucket] if len(bucket) else 0) + bias for bucket, share in (rows[i] for i in held)])
    losses = {t: -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-9).mean() for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0)}
    model.temperature = min(losses, key=losses.get)
    p = _softmax(logits / model.temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == y[held]
    order = np.argsort(-score, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    last = np.flatnonzero(good)
    model.reject = float(score[order[last[-1]]]) if len(last) else 1.0
    return model


class Scorer:
    """Probabilities of texts under a model; a bounded memo holds the summed rows of the words it has met."""

    def __init__(self, model: Model):
        self.model, self.features = model, Features(model.shape)
        self.place: dict[str, int] = {}
        self._empty()

    def _empty(self) -> None:
        c = len(self.model.classes)
        self.place.clear()
        self.sums = np.zeros((1 << 14, c + 1))  # the rows' sum, and how many they are
        self.hashes = np.zeros(1 << 14, np.uint64)

    def _meet(self, new: list[str]) -> None:
        first, need = len(self.place), len(self.place) + len(new)
        while len(self.sums) < need:
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        for i in range(0, len(new), 8192):
            part = new[i : i + 8192]
            bucket, who, hashes = self.features.of_words(part)
            rows = self.model.table[bucket]
            at = slice(first + i, first + i + len(part))
            for k in range(rows.shape[1]):
                self.sums[at, k] = np.bincount(who, rows[:, k], len(part))
            self.sums[at, -1] = np.bincount(who, minlength=len(part))
            self.hashes[at] = hashes
        self.place.update(zip(new, range(first, need)))

    def probabilities(self, texts: list[str]) -> np.ndarray:
        m = self.model
        cut = [self.features.words(t) for t in texts]
        seen = set().union(*cut)
        if len(self.place) + len(seen) > MEMO_ENTRIES:
            self._empty()
        # sorted, so that equal inputs give equal sums
        self._meet(sorted(seen.difference(self.place)))
        logits = np.zeros((len(texts), len(m.classes)))
        for i, words in enumerate(cut):
            if words:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                total = self.sums[at].sum(axis=0)
                if m.shape.pairs and len(words) > 1:
                    pairs = self.features.of_pairs(self.hashes[at])
                    total[:-1] += m.table[pairs].sum(axis=0, dtype=float)
                    total[-1] += len(pairs)
                if total[-1]:
                    logits[i] = total[:-1] / total[-1]
        return _softmax((logits + m.bias) / m.temperature)
