"""Toxicity by a factorization machine over hashed terms.

Each distinct word of a text gives two terms, hashed into a table of `BUCKETS`: the word, and its first letters, so that
inflected and compounded forms share a term. The score is the logistic of a bias, the terms' weights and the dot products
of their factors: pairs such as an insult and a group's name count beyond the sum of their own weights.

Two kinds of terms are in the machine. Those that tell by themselves enter with their log odds ratio in the sample as
value. Those that tell jointly, though alike in both classes by themselves, enter with the value 1: every pair's counts in
the classes are compared with what the more telling of the two words alone would give. All other terms have the value 0. The pair sum is divided by the number of the text's terms in the machine, so it
does not fade in long texts. The machine is trained in numpy by AdaGrad on a bounded sample of labelled documents and
broadcast (BUCKETS * (2 + FACTORS) floats).

Defined results: null and empty texts get the bias alone; a label table without rows gives the score 0 everywhere; an
empty table gives no rows; repeated rows each get their score, and a document's repeated rows are one in the sample; other
columns are ignored; of repeated labels of a document the larger one counts; a score of exactly 0.5 predicts 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow

BUCKETS = 1 << 17
FACTORS = 4
PREFIX_BYTES = 5
#: The most labelled documents of each class that a model is fitted on.
SAMPLE = 4000
EPOCHS = 15
RATE = 0.2
BATCH = 32
DECAY = 1e-3
#: Only terms of so many sampled documents are learnt, whose share differs between the classes by so many standard errors.
MIN_DOCS = 3
CHANCE = 2.5
#: A pair of words needs so many documents; all pairs together find one by chance in one of a hundred samples. Pairs are
#: looked for in documents of the sample that hold so many pairs of words.
MIN_PAIR = 8
PAIR_ERROR = 0.01
PAIR_WORK = 2_000_000_000
#: Words that a worker remembers before it starts anew.
MEMORY = 500_000

_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()) if text else set()


def terms(word: bytes) -> tuple[int, int]:
    return zlib.crc32(word) % BUCKETS, zlib.crc32(b"^" + word[:PREFIX_BYTES]) % BUCKETS


@dataclass
class Machine:
    bias: float
    weight: np.ndarray  # (BUCKETS,)
    factor: np.ndarray  # (BUCKETS, FACTORS)
    active: np.ndarray  # (BUCKETS,): 1 for terms in the machine


def telling(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Each term's value by itself: its absolute log odds ratio between the classes, 0 if its counts could be chance."""
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    in1, in0 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, labels, strict=True):
        (in1 if y else in0)[np.unique(d)] += 1
    p = (in1 + in0) / max(n1 + n0, 1)
    apart = np.abs(in1 / max(n1, 1) - in0 / max(n0, 1)) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / max(n1, 1) + 1 / max(n0, 1)))
    odds = np.log((in1 + 0.5) / (n1 - in1 + 0.5)) - np.log((in0 + 0.5) / (n0 - in0 + 0.5))
    return np.where((apart >= CHANCE) & (in1 + in0 >= MIN_DOCS), np.abs(odds), 0).astype(np.float32)


def joint(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The terms of pairs that tell more than either term alone. docs: each document's word terms, without prefixes.

    Every pair of words with MIN_PAIR documents in common is looked at: for one word after the other, the words of its
    documents are counted in both classes. The first documents with together PAIR_WORK pairs of words are used.
    """
    each = [np.unique(d) for d in docs]
    work = np.cumsum([len(d) ** 2 for d in each])
    each = each[: int(np.searchsorted(work, PAIR_WORK, "right"))]
    flat = np.concatenate([np.empty(0, np.int64), *each])
    count = np.bincount(flat, minlength=BUCKETS)
    chosen = np.flatnonzero(count >= MIN_PAIR)
    if not len(chosen):
        return chosen
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    doc = np.repeat(np.arange(len(each)), [len(d) for d in each])
    doc, word = doc[place[flat] >= 0], place[flat[place[flat] >= 0]]
    ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(each)))]
    order = np.argsort(word, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(word, minlength=len(chosen)))]
    y = labels[: len(each)]
    share = np.bincount(word, y[doc], len(chosen)) / count[chosen]
    surely = np.log(len(chosen) ** 2 / PAIR_ERROR)
    out = np.zeros(len(chosen), bool)
    for k in range(len(chosen)):
        own = doc[order[starts[k] : starts[k + 1]]]
        size = ends[own + 1] - ends[own]
        at = np.repeat(ends[own] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        n = np.bincount(word[at], minlength=len(chosen))
        ones = np.bincount(word[at], np.repeat(y[own], size), len(chosen))
        n[k] = 0
        other = np.flatnonzero(n >= MIN_PAIR)
        seen = ones[other] / n[other]
        # Between the shares of the two words there is nothing that the words alone don't say.
        expected = np.clip(seen, np.minimum(share[other], share[k]), np.maximum(share[other], share[k])).clip(1e-3, 1 - 1e-3)
        out[k] = (n[other] * divergence(seen, expected) >= surely).any()
    return chosen[out]


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of a share p from an expected q: exp(-n * divergence) bounds the chance of such a share among n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log(p / q), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - q)), 0)


def fit(docs: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """docs: each document's terms, words and prefixes in turn. AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    value = telling(docs, labels)
    value[joint([d[::2] for d in docs], labels)] += 1
    weight, factor, bias = np.zeros(BUCKETS, np.float32), rng.normal(0, 0.1, (BUCKETS, FACTORS)).astype(np.float32), 0.0
    docs = [d[value[d] > 0] for d in docs]
    lengths = np.array([max(len(d), 1) for d in docs])
    gw, gv, gb = np.ones(BUCKETS, np.float32), np.ones((BUCKETS, FACTORS), np.float32), 1.0
    for _ in range(EPOCHS if docs else 0):
        for at in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            counts = np.array([len(docs[k]) for k in at])
            ids, row = np.concatenate([docs[k] for k in at]), np.repeat(np.arange(len(at)), counts)
            x = value[ids]
            v = factor[ids] * x[:, None]
            total = np.stack([np.bincount(row, v[:, f], len(at)) for f in range(FACTORS)], 1)
            pairs = 0.5 * ((total * total).sum(1) - np.bincount(row, (v * v).sum(1), len(at))) / lengths[at]
            z = bias + np.bincount(row, weight[ids] * x, len(at)) + pairs
            err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[at]
            used, place = np.unique(ids, return_inverse=True)
            dw = np.bincount(place, err[row] * x, len(used)) + DECAY * weight[used]
            each = (err / lengths[at])[row, None] * (total[row] - v) * x[:, None]
            dv = np.stack([np.bincount(place, each[:, f], len(used)) for f in range(FACTORS)], 1) + DECAY * factor[used]
            db = float(err.sum())
            gw[used] += dw**2
            gv[used] += dv**2
            gb += db**2
            weight[used] -= RATE * dw / np.sqrt(gw[used])
            factor[used] -= RATE * dv / np.sqrt(gv[used])
            bias -= RATE * db / gb**0.5
    return Machine(bias, weight * value, factor * value[:, None], (value > 0).astype(np.float32))


def sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Terms and labels of about `size` documents a class at most, and the share of ones among all labelled."""
    marks = labels.where(~held_out(F.col("doc_id")) & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, size / max(n.get(1, 0), 1))).otherwise(min(1.0, size / max(n.get(0, 0), 1)))
    # A hash of the id decides, so the sample is spread evenly and the same each time.
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    # One row of each document: what repeats a doc_id would weigh more, and without bound.
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array([t for w in sorted(words(x.as_py())) for t in terms(w)], np.int32) for x in batch.column("text")]
            yield pa.record_batch([batch.column("y"), pa.array(rows, pa.list_(pa.int32()))], names=["y", "terms"])

    got = map_arrow(own.select("y", "text"), run, "y int, terms array<int>").toArrow()
    rows = [np.asarray(x.values, np.int64) for x in got.column("terms")]
    return rows, np.array(got.column("y").to_pylist(), float), n.get(1, 0) / max(sum(n.values()), 1)


class Scorer:
    """Scores texts with a machine; remembers each word's part of the sums."""

    def __init__(self, m: Machine, shift: float) -> None:
        self.m, self.shift = m, shift
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.part = np.zeros((1 << 12, FACTORS + 3), np.float32)

    def learn(self, new: list[bytes]) -> None:
        n = len(self.known)
        while n + len(new) > len(self.part):
            self.part = np.resize(self.part, (2 * len(self.part), FACTORS + 3))
        ids = np.array([terms(w) for w in new]).reshape(-1, 2)
        v = self.m.factor[ids]
        self.part[n : n + len(new)] = np.column_stack([self.m.weight[ids].sum(1), (v * v).sum((1, 2)), self.m.active[ids].sum(1), v.sum(1)])
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            found = words(t)
            if len(self.known) > MEMORY:
                self.forget()
            if new := [w for w in found if w not in self.known]:
                self.learn(new)
            s = self.part[np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))].sum(0, dtype=np.float64)
            out[i] = self.m.bias + s[0] + 0.5 * ((s[3:] ** 2).sum() - s[1]) / max(s[2], 1)
        return 1 / (1 + np.exp(-np.clip(out + self.shift, -60, 60)))


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learns from labelled ones that aren't held out."""
    rows, y, share = sample(docs, labels, label, size)
    machine = fit(rows, y)
    used = float(y.mean()) if len(y) else 0.0
    # The sample has more ones than the labelled documents: their log odds are put right.
    shift = np.log(share / (1 - share)) - np.log(used / (1 - used)) if 0 < used < 1 and 0 < share < 1 else (0.0 if used else -60.0)
    sent = docs.sparkSession.sparkContext.broadcast((machine, float(shift)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            s = scorer.scores(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double, predicted int")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
