"""Toxicity scores from a factorization machine over hashed terms.

Terms are a document's words (ASCII letters and digits and everything beyond ASCII, A-Z lower-cased)
and the first four and five bytes of longer words, which stand for a word's stem in languages that
inflect; they are hashed to ``2**TERM_BITS`` numbers. Each term has a weight and a vector, and each
pair of terms in a document adds the product of their vectors: an insult beside the mention of a
group can count for more than both apart, which additive weights cannot express.

The machine is fitted on at most ``POSITIVES`` and ``NEGATIVES`` labelled rows (a bounded sample, those
with the smallest hashes of their ids). Spark counts in how many of them each term occurs; the
``TERMS`` terms that differ most between the labels are kept. Terms that tell nothing by themselves are
kept for their pairs: among the ``FREQUENT`` most frequent terms, tasks count how often any two occur
together, and up to ``PAIR_TERMS`` terms join whose pairs depend on each other otherwise in one label
than in the other. Every whole text is then scored in one scan with the fitted terms as a broadcast of
fixed size. Scores use the text alone.

Defined results: a null or empty text scores the machine's bias; rows are scored one by one, so
repeated rows each get theirs; labels that are null or name no document are left out; of repeated
labels the greatest counts; without labels of both kinds every score is the share of toxic ones
(0 without any); an empty table gives an empty table; other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import prepare, stored

TERM_BITS = 18
POSITIVES, NEGATIVES = 6_000, 14_000
TERMS = 4_096
FACTORS = 8
LEAST_Z = 6.0
FREQUENT, PAIR_TERMS = 512, 128
LEAST_PAIR_Z = 8.0       # some 130,000 pairs are looked at: chance alone stays below 5
STEPS, RATE, DECAY = 150, 0.05, 2e-3


def term_ids(batch: pa.RecordBatch, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and term of every distinct term of every row, sorted; of ``wanted`` terms only, if given."""
    data, offsets = bt.utf8(batch.column("text"))
    starts, ends, row = bt.words(data, offsets, bt.ALNUM)
    both = []
    for salt, cut in enumerate((0, 4, 5)):
        pick = np.flatnonzero(ends - starts > cut) if cut else slice(None)
        s = starts[pick]
        h = bt.word_hashes(data, s, s + cut if cut else ends, bt.FOLDED)
        term = (bt.mix(h + U(salt)) >> U(64 - TERM_BITS)).astype(np.int64)
        r = row[pick]
        if wanted is not None:
            ok = wanted[term]
            term, r = term[ok], r[ok]
        both.append(r << TERM_BITS | term)
    both = np.unique(np.concatenate(both))
    return both >> TERM_BITS, both & ((1 << TERM_BITS) - 1)


def _terms_of(batches):
    for batch in batches:
        row, term = term_ids(batch)
        cut = bt.first_of(row, batch.num_rows).tolist()
        term = term.astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array([term[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["toxic", "terms"])


def _frequencies(batches):
    total = np.zeros((2, 1 << TERM_BITS), np.int64)
    for batch in batches:
        for toxic, terms in zip(batch.column("toxic").to_pylist(), batch.column("terms").to_pylist()):
            total[toxic, np.frombuffer(terms, "<u4")] += 1  # a row's terms are distinct
    seen = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int64()), "n0": pa.array(total[0, seen]), "n1": pa.array(total[1, seen])})


def _together(frequent: np.ndarray):
    """Of each label, in how many rows of a task any two of the ``frequent`` terms (ascending) occur together."""
    def work(batches):
        total = np.zeros((2, len(frequent), len(frequent)), np.int64)
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
            has = np.zeros((len(toxic), len(frequent)), np.float32)
            for i, raw in enumerate(batch.column("terms").to_pylist()):
                has[i] = np.isin(frequent, np.frombuffer(raw, "<u4"), assume_unique=True)
            for t in (0, 1):
                total[t] += np.rint(has[toxic == t].T @ has[toxic == t]).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tobytes()], pa.binary())})
    return work


def paired_terms(counts: np.ndarray, n: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Places of the terms of telling pairs, strongest first. ``counts[t]`` are the rows of label t with both
    terms, its diagonal those with one; ``taken`` terms need no pair to be kept.

    Within a label two terms depend on each other by ``P(both) - P(one) P(other)``; a pair tells if that
    differs between the labels by more than chance. Two terms that only tell one by one do not."""
    share = counts / n[:, None, None]
    one = np.diagonal(share, axis1=1, axis2=2)
    depend = share - one[:, :, None] * one[:, None, :]
    spread = one * (1 - one)
    noise = np.sqrt((spread[:, :, None] * spread[:, None, :] / n[:, None, None]).sum(axis=0)) + 1e-9
    z = np.abs(depend[1] - depend[0]) / noise
    # Too few rows to judge: a term that is in next to none or next to all of them.
    enough = (counts[:, np.arange(len(taken)), np.arange(len(taken))].sum(axis=0) >= 0.01 * n.sum()) & (one.mean(axis=0) <= 0.9)
    z[~enough] = z[:, ~enough] = 0
    np.fill_diagonal(z, 0)
    z[np.ix_(taken, taken)] = 0
    best = z.max(axis=1)
    order = np.lexsort((np.arange(len(best)), -best))
    return order[best[order] >= LEAST_PAIR_Z][:PAIR_TERMS]


@dataclass
class Machine:
    bias: float
    terms: np.ndarray     # sorted term numbers
    weight: np.ndarray
    vectors: np.ndarray   # terms x factors

    def logits(self, row: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """``row`` ascends; ``place`` indexes the terms."""
        v = self.vectors[place]
        cut = bt.first_of(row, n)
        sums = lambda x: np.diff(np.concatenate((np.zeros((1, x.shape[1])), np.cumsum(x, axis=0)))[cut], axis=0)
        pairs = 0.5 * (sums(v) ** 2 - sums(v ** 2)).sum(axis=1)
        return self.bias + np.bincount(row, self.weight[place], n) + pairs


def fit_machine(row: np.ndarray, place: np.ndarray, label: np.ndarray, n_terms: int, terms: np.ndarray) -> Machine:
    """Adam on the logistic loss of the bounded sample, both labels weighing the same."""
    rng = np.random.default_rng(7)
    n = len(label)
    share = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    m = Machine(0.0, terms, np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, FACTORS)))
    state = [np.zeros(1), np.zeros(1), np.zeros(n_terms), np.zeros(n_terms), np.zeros((n_terms, FACTORS)), np.zeros((n_terms, FACTORS))]
    cut = bt.first_of(row, n)
    for step in range(1, STEPS + 1):
        v = m.vectors[place]
        sums = np.diff(np.concatenate((np.zeros((1, FACTORS)), np.cumsum(v, axis=0)))[cut], axis=0)
        g = (1 / (1 + np.exp(-np.clip(m.logits(row, place, n), -30, 30))) - label) * share
        at = g[row]
        spread = at[:, None] * (sums[row] - v)
        grads = (np.array([g.sum()]), np.bincount(place, at, n_terms) + DECAY * m.weight / n_terms,
                 np.stack([np.bincount(place, spread[:, f], n_terms) for f in range(FACTORS)], axis=1) + DECAY * m.vectors / n_terms)
        moves = []
        for i, grad in enumerate(grads):
            state[2 * i] = 0.9 * state[2 * i] + 0.1 * grad
            state[2 * i + 1] = 0.999 * state[2 * i + 1] + 0.001 * grad ** 2
            moves.append(RATE * (state[2 * i] / (1 - 0.9 ** step)) / (np.sqrt(state[2 * i + 1] / (1 - 0.999 ** step)) + 1e-9))
        m.bias -= float(moves[0][0])
        m.weight -= moves[1]
        m.vectors -= moves[2]
    return m


def learn(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on ``labels (doc_id, toxic)`` and the texts of ``docs (doc_id, text)``."""
    known = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((1, POSITIVES), (0, NEGATIVES))]
    sample = stored(by_hash[0].union(by_hash[1]), "toxic-sample")  # at most POSITIVES + NEGATIVES rows: small enough to broadcast
    rows = stored(docs.join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("long").alias("toxic"))
                  .mapInArrow(_terms_of, "toxic long, terms binary"), "toxic-terms")
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        p = min(max(n1 / max(1, n0 + n1), 1e-6), 1 - 1e-6)
        return Machine(float(np.log(p / (1 - p))) if n0 + n1 else -30.0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    share = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    z = F.abs((F.col("n1") + 0.5) / (n1 + 1) - (F.col("n0") + 0.5) / (n0 + 1)) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    counted = stored(rows.mapInArrow(_frequencies, "term long, n0 long, n1 long").groupBy("term")
                     .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).withColumn("z", z), "toxic-counts")
    best = counted.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(TERMS).collect()
    alone = np.array(sorted(r["term"] for r in best), np.int64)
    frequent = np.array(sorted(r["term"] for r in counted.orderBy((-(F.col("n0") + F.col("n1"))), "term").limit(FREQUENT).collect()), np.int64)
    size = len(frequent)
    parts = rows.coalesce(16).mapInArrow(_together(frequent), "counts binary").toLocalIterator()  # a matrix of fixed size a task
    both = sum((np.frombuffer(r["counts"], np.int64).reshape(2, size, size) for r in parts), np.zeros((2, size, size), np.int64))
    pairs = paired_terms(both, np.array([n0, n1], float), np.isin(frequent, alone))
    terms = np.union1d(alone, frequent[pairs])

    def chosen(batches):
        for batch in batches:
            out = []
            for raw in batch.column("terms").to_pylist():
                t = np.frombuffer(raw, "<u4").astype(np.int64)
                out.append(np.flatnonzero(np.isin(terms, t, assume_unique=True)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(out, pa.binary())], names=["toxic", "terms"])

    got = rows.mapInArrow(chosen, "toxic long, terms binary").toArrow()
    found = sorted(zip(got.column("toxic").to_pylist(), got.column("terms").to_pylist()))  # the order of rows is Spark's
    places = [np.frombuffer(raw, "<u4") for _, raw in found]
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    return fit_machine(row, np.concatenate(places).astype(np.int64), np.array([t for t, _ in found]), len(terms), terms)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``(doc_id, score)`` of every whole text of ``docs (doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batches):
        m = shared.value
        wanted = np.zeros(1 << TERM_BITS, bool)
        wanted[m.terms] = True
        for batch in batches:
            row, term = term_ids(batch, wanted)
            logit = m.logits(row, np.searchsorted(m.terms, term), batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return docs.mapInArrow(work, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row."""
    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    machine = learn(docs, known.filter(~held_out(F.col("doc_id"))))
    return score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                       (F.col("score") >= threshold).cast("int").alias("predicted"))
