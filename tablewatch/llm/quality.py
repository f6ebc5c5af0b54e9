"""Quality classifier from weak labels.

Seven overlapping heuristics look at a text and vote good, bad or nothing. Expectation-maximisation
over the counts of all documents' vote patterns (at most 3**7 of them, whatever the corpus) estimates
each heuristic's accuracy on good and on bad documents and the share of good ones, and gives each
pattern a posterior. The posteriors of a bounded sample of at most about ``SAMPLE`` documents, by a hash
of the text, train a linear scorer over hashed word shapes: how words begin and end, their length,
whether a word repeats the one before, and whether its window of the text held it already. The scorer then judges every whole text, so documents on
which the heuristics are silent are judged by what the others taught.

Texts of fewer than ``FEW_WORDS`` words show too little for votes; the scorer judges them as any other.

Defined results: a null or empty text has no words and scores the scorer's bias alone; it is kept. Rows are scored one by one, so repeated rows each get their row; an empty table
gives an empty table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import prepare

SAMPLE = 20_000
SHAPE_BITS = 12
STEPS, RATE, DECAY = 300, 0.1, 1e-4
ROUNDS = 100
FEW_WORDS = 8       # shorter texts get no votes
WINDOW = 256        # words among which a word counts as distinct
START = ((0.40, 0.60), (0.05, 0.95))  # shares of bad and good votes on bad, and on good documents

# Fixed values: (name, bad from, good up to, whether small values are the bad ones).
LABELLERS = (
    ("signs", 0.15, 0.05, False),        # words with a sign other than . , ; : ' " - ( ) ?
    ("shouting", 0.25, 0.05, False),     # words of two and more capitals
    ("repeats", 0.15, 0.05, False),      # words equal to the word before
    ("variety", 0.35, 0.50, True),       # distinct words in each 256, over the whole text
    ("sentences", 0.010, 0.04, True),    # words that end a sentence with . or ?
    ("bare signs", 0.15, 0.03, False),   # words without any letter or digit
    ("long words", 0.50, 0.20, False),   # words of more than 12 bytes
)

_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x30] = _SIGN[0x3A:0x41] = _SIGN[0x5B:0x61] = _SIGN[0x7B:0x7F] = True
_SIGN[[ord(c) for c in ".,;:'\"-()?"]] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = bt.ALNUM
_END = np.zeros(256, bool)
_END[[ord("."), ord("?")]] = True
# Shape of a byte: capital, small or beyond ASCII, digit, or the sign itself.
_SHAPE = bt.BYTES.copy()
_SHAPE[65:91] = bt.BYTES[65]
_SHAPE[97:123] = bt.BYTES[97]
_SHAPE[128:] = bt.BYTES[97]
_SHAPE[48:58] = bt.BYTES[48]


class _Texts:
    """Words of a batch and what the heuristics measure."""

    def __init__(self, column):
        self.data, offsets = bt.utf8(column)
        self.n = len(offsets) - 1
        self.starts, self.ends, self.row = bt.words(self.data, offsets, bt.SPACED)
        self.hashes = bt.word_hashes(self.data, self.starts, self.ends)
        self.count = np.bincount(self.row, minlength=self.n)
        self.again = np.zeros(len(self.row), bool)
        self.again[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.row[1:] == self.row[:-1])
        # Words seen earlier in their window of the text.
        window = (np.arange(len(self.row)) - bt.first_of(self.row, self.n)[self.row]) // WINDOW
        order = np.lexsort((self.hashes, window, self.row))
        h, w, r = self.hashes[order], window[order], self.row[order]
        self.old = np.zeros(len(self.row), bool)
        self.old[order[1:]] = (h[1:] == h[:-1]) & (w[1:] == w[:-1]) & (r[1:] == r[:-1])

    def _within(self, kind: np.ndarray) -> np.ndarray:
        """Bytes of a kind in each word."""
        sums = np.concatenate(([0], np.cumsum(kind[self.data], dtype=np.int32)))
        return sums[self.ends] - sums[self.starts]

    def _share(self, flag: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, flag, self.n) / np.maximum(self.count, 1)

    def measures(self) -> np.ndarray:
        letters = self._within(_LETTER)
        capitals = self._within(_UPPER)
        return np.stack((
            self._share(self._within(_SIGN) > 0), self._share((capitals > 1) & (2 * capitals > letters)), self._share(self.again), self._share(~self.old),
            self._share(_END[self.data[self.ends - 1]] if len(self.ends) else np.zeros(0)), self._share(letters == 0),
            self._share(self.ends - self.starts > 12)), axis=1)

    def votes(self) -> np.ndarray:
        """2 good, 1 bad, 0 nothing."""
        out = np.zeros((self.n, len(LABELLERS)), np.int64)
        for i, (x, (_, bad, good, small)) in enumerate(zip(self.measures().T, LABELLERS)):
            out[:, i] = np.where(x <= bad if small else x >= bad, 1, np.where(x >= good if small else x <= good, 2, 0))
        out[self.count < FEW_WORDS] = 0
        return out

    def shapes(self) -> np.ndarray:
        """Four hashed features of every word."""
        size = self.ends - self.starts
        head = bt.word_hashes(self.data, self.starts, self.starts + np.minimum(size, 2), _SHAPE)
        tail = bt.word_hashes(self.data, self.ends - np.minimum(size, 2), self.ends, _SHAPE)
        length = np.minimum(size, 16).astype(U) * U(2) + self.again.astype(U)
        return np.stack([(bt.mix(h + U(salt)) >> U(64 - SHAPE_BITS)).astype(np.int64)
                         for salt, h in enumerate((head, tail, bt.mix(length + U(1)), bt.mix(self.old.astype(U) + U(64))))])


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(len(LABELLERS))


def _vote_counts(batches):
    total = np.zeros(3 ** len(LABELLERS), np.int64)
    for batch in batches:
        total += np.bincount(_pattern(_Texts(batch.column("text")).votes()), minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"pattern": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})


def accuracies(count: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "good" for every pattern, and each labeller's vote shares given bad and good.

    Labels are independent given the truth; silence tells nothing. The start trusts a bad vote more
    than a good one, since a labeller looks for one kind of fault and calls every other kind good; it
    also fixes which of the two classes is called good. A small prior keeps unused votes from deciding."""
    m = len(LABELLERS)
    patterns = np.arange(3 ** m)
    votes = patterns[:, None] // 3 ** np.arange(m) % 3
    weight = np.zeros(3 ** m)
    for p, n in count.items():
        weight[p] = n
    cast = [(votes == v) for v in range(3)]
    given = np.empty((2, m, 3))                       # truth, labeller, vote
    given[0], given[1] = (0.0, *START[0]), (0.0, *START[1])
    good = 0.8
    post = np.full(3 ** m, good)
    total = max(weight.sum(), 1.0)
    for _ in range(ROUNDS):
        ratio = np.log(good / (1 - good))
        odds = ratio + sum(cast[v] @ np.log(given[1, :, v] / given[0, :, v]) for v in (1, 2))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        good = float(np.clip((weight @ post) / total, 0.05, 0.95)) if weight.any() else 0.8
        for truth, belief in ((0, 1 - post), (1, post)):
            mass = weight * belief
            prior = 0.01 * mass.sum() + 1
            for v in (1, 2):
                spoken = mass @ cast[v] + prior * START[truth][v - 1]
                both = mass @ cast[1] + mass @ cast[2] + prior
                given[truth, :, v] = spoken / both
    return post, given


@dataclass
class Scorer:
    posterior: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: _Texts) -> np.ndarray:
        per_word = self.weight[texts.shapes()].sum(axis=0)
        logit = self.bias + np.bincount(texts.row, per_word, texts.n) / np.maximum(texts.count, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def learn(df: DataFrame, text_col: str = "text") -> Scorer:
    """Labeller accuracies from all rows, and the scorer from the bounded sample."""
    prepare(df.sparkSession)
    docs = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = docs.mapInArrow(_vote_counts, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    count = {r["pattern"]: r["n"] for r in rows}
    posterior, _ = accuracies(count)
    # A text is in the sample by its own hash; copies are in it together.
    part = min(1.0, SAMPLE / max(1, sum(count.values())))
    chosen = docs.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 50)) < int(part * (1 << 50)))

    def features(batches):
        for batch in batches:
            texts = _Texts(batch.column("text"))
            label = posterior[_pattern(texts.votes())]
            both = np.sort((texts.row[None, :] << SHAPE_BITS | texts.shapes()).ravel())
            starts, number = bt.runs_of(both)
            row, shape = both[starts] >> SHAPE_BITS, both[starts] & ((1 << SHAPE_BITS) - 1)
            cut = bt.first_of(row, texts.n).tolist()
            cells = np.stack((shape, number), axis=1).astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(label, pa.float64()), "words": pa.array(texts.count, pa.int64()),
                "cells": pa.array([cells[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})

    got = chosen.mapInArrow(features, "label double, words long, cells binary").filter("words > 0").toArrow()
    return Scorer(posterior, *_fit(sorted(zip(*(got.column(c).to_pylist() for c in ("label", "words", "cells"))))))


def _fit(rows: list[tuple[float, int, bytes]]) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; both classes weigh the same."""
    weight, bias = np.zeros(1 << SHAPE_BITS), 0.0
    if not rows:
        return weight, 30.0
    label = np.array([r[0] for r in rows])
    cells = [np.frombuffer(r[2], "<u4").reshape(-1, 2) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in cells])
    flat = np.concatenate(cells).astype(np.int64)
    value = flat[:, 1] / np.array([r[1] for r in rows])[row]
    balance = label / max(label.sum(), 1e-9) + (1 - label) / max((1 - label).sum(), 1e-9)
    target = (label / max(label.sum(), 1e-9)) / balance
    balance /= balance.sum()
    one, two, b1, b2 = np.zeros_like(weight), np.zeros_like(weight), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, weight[flat[:, 0]] * value, len(rows)), -30, 30)))
        g = balance * (p - target)
        grad = np.bincount(flat[:, 0], g[row] * value, len(weight)) + DECAY * weight / len(weight)
        one, two = 0.9 * one + 0.1 * grad, 0.999 * two + 0.001 * grad ** 2
        b1, b2 = 0.9 * b1 + 0.1 * g.sum(), 0.999 * b2 + 0.001 * g.sum() ** 2
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        weight = weight - RATE * (one / fix1) / (np.sqrt(two / fix2) + 1e-9)
        bias -= RATE * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-9)
    return weight, float(bias)


def classify(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.25) -> DataFrame:
    """``(doc_id, posterior, score, kept)`` for each row."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def work(batches):
        s = shared.value
        for batch in batches:
            texts = _Texts(batch.column("text"))
            p = s.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s.posterior[_pattern(texts.votes())], pa.float64()), pa.array(p, pa.float64()),
                 pa.array((p >= threshold) | (texts.count == 0))], names=["doc_id", "posterior", "score", "kept"])

    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(work, "doc_id long, posterior double, score double, kept boolean")


def keep_good(df: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = 0.25) -> DataFrame:
    """The rows of ``df``, all columns as they are, that the scorer keeps. One scan, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)
    place = df.columns.index(text_col)

    def work(batches):
        for batch in batches:
            texts = _Texts(batch.column(place))
            yield batch.filter(pa.array((shared.value.scores(texts) >= threshold) | (texts.count == 0)))

    return df.mapInArrow(work, df.schema)
