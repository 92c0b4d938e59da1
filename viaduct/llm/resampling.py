"""Target-distribution importance resampling: documents that look like a target set are drawn without replacement.

Features are hashed runs of words. Array-scored weights: the gains of all buckets are one array, and the buckets of many
documents, laid end to end, take their gains from it in one step and are summed by document. Adding noise of the Gumbel
distribution, fixed by doc_id, makes the highest scores a draw in proportion to the weights.

The draw is ranked by parallel sorting by regular sampling. Each task writes its rows as locally sorted runs. Every stride-th
row of each run is a regular sample; regular places of the sorted samples are the splitters. They cut all runs into segments,
whose counts are known before anything moves; segments beyond the draw stay where they are, the others are exchanged, each is
merged in one task, and the counts of the segments before it make its ranks exact. The order is total (score, doc_id, run,
place), so a segment has a bounded number of rows even if a third of all rows are equal.

What the driver sees: the counts of BUCKETS buckets, OVERSAMPLE samples and one count for each segment.

Defined results: a null or empty text has no features, weight 0, and is never drawn; whole texts of any length are read, in
pieces. Equal scores go to the smaller doc_id, a null doc_id (hashed as an empty one) last; rows that repeat are documents of
their own, with ranks next to each other. Empty documents or target tables give counts of 0. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, n_partitions, settle
from .terms import raw_texts, term_pieces

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Words up to so many bytes, and so many of them, are remembered by a worker with their buckets.
SHORT_WORD, MEMORY = 32, 200_000
#: Features of documents that are scored together.
BLOCK_FEATURES = 1_000_000
#: Rows of a run, of a segment, and samples for each segment.
RUN_ROWS, SEGMENT_ROWS, OVERSAMPLE = 1_000_000, 1_000_000, 16
#: Stands for a null doc_id in the order of rows.
LAST_ID = np.iinfo(np.int64).max


class Buckets(dict):
    """feature -> its bucket."""

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % BUCKETS
        if len(feature) <= SHORT_WORD:
            if len(self) >= MEMORY:
                self.clear()
            self[feature] = bucket
        return bucket


def features(raw: bytes | None, longest: int, known: Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text: number of words, and the buckets of all runs of 1 to `longest` words that end in the piece."""
    tail: list[bytes] = []
    for words in term_pieces(raw):
        row, out = tail + words, []
        for k in range(1, longest + 1):
            first = max(len(tail) - k + 1, 0)
            runs = row[first:] if k == 1 else [b" ".join(row[i : i + k]) for i in range(first, len(row) - k + 1)]
            out += map(known.__getitem__, runs)
        tail = row[len(row) - longest + 1 :] if longest > 1 else []
        yield len(words), np.array(out, np.int64)


def bucket_counts(texts: DataFrame, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall in each bucket. A task sends one row for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(BUCKETS, np.int64), Buckets()
        for b in batches:
            for raw in raw_texts(b.column(0)):
                for _, found in features(raw, longest, known):
                    total += np.bincount(found, minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["bucket", "n"])

    rows = map_arrow(texts.select("text"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p/q)) of each bucket: p its smoothed share of the target's features, q of the source's."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


RUN = "doc_id long, n_features long, weight long, score long, run long, place int"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()), ("run", pa.int64()), ("place", pa.int32())])


def sorted_run(ids: list[int | None], words: list[int], n: list[int], weight: list[int], seed: int, least: int, run: int) -> pa.RecordBatch:
    """One run: documents that may be drawn in order, the others after them, without a place."""
    score = np.array(weight, np.int64) + np.array([noise(i, seed) for i in ids], np.int64)
    key = np.array([LAST_ID if i is None else i for i in ids], np.int64)
    able = np.array(words) >= least
    order = np.lexsort((key, -score, ~able))
    place = np.arange(len(ids))
    columns = [pa.array(ids, pa.int64()).take(pa.array(order)), *[pa.array(np.array(x, np.int64)[order]) for x in (n, weight)], pa.array(score[order])]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(ids), run)), pa.array(place, pa.int32(), mask=~able[order])], schema=_FIELDS)


def scored_runs(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Documents with weight and score, as locally sorted runs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, number = Buckets(), TaskContext.get().partitionId() << 32
        ids, words, n, weight = [], [], [], []
        waiting, owners, held = [], [], 0  # buckets of pieces of texts, and whose they are

        def settle_block() -> None:
            """All buckets that wait take their gains at once and are summed by document."""
            ends = np.cumsum([0, *map(len, waiting)])
            total = np.concatenate([[0], np.cumsum(gain[np.concatenate([np.empty(0, np.int64), *waiting])])])
            for owner, gained in zip(owners, (total[ends[1:]] - total[ends[:-1]]).tolist(), strict=True):
                weight[owner] += gained
            waiting.clear()
            owners.clear()

        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                ids.append(doc_id)
                for column in (words, n, weight):
                    column.append(0)
                for count, found in features(raw, longest, known):
                    words[-1] += count
                    n[-1] += len(found)
                    waiting.append(found)
                    owners.append(len(ids) - 1)
                    held += len(found)
                    if held > BLOCK_FEATURES:
                        settle_block()
                        held = 0
                if len(ids) >= RUN_ROWS:
                    settle_block()
                    yield sorted_run(ids, words, n, weight, seed, least, number)
                    number, held = number + 1, 0
                    ids, words, n, weight = [], [], [], []
        settle_block()
        if ids:
            yield sorted_run(ids, words, n, weight, seed, least, number)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), score, RUN)


def regular_splitters(runs: DataFrame, rows: int, segments: int) -> list[tuple[int, int, int, int]]:
    """Keys that cut the order of all rows in about equal segments: regular places of the runs' regular samples."""
    stride = max(1, rows // (segments * OVERSAMPLE))
    found = runs.where(F.col("place") % stride == stride // 2).select("score", "doc_id", "run", "place").collect()
    keys = sorted((-r.score, LAST_ID if r.doc_id is None else r.doc_id, r.run, r.place) for r in found)
    return [keys[len(keys) * k // segments] for k in range(1, segments)] if len(keys) >= segments else keys


def segmented(runs: DataFrame, splitters: list[tuple[int, int, int, int]]) -> DataFrame:
    """Rows that have a place, with the number of their segment."""
    first = np.array([k[0] for k in splitters], np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = -b.column(3).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(first, score, "left"), np.searchsorted(first, score, "right")
            tied = np.flatnonzero(low < high)
            if len(tied):
                ids, run, place = (b.column(k).take(pa.array(tied)).to_pylist() for k in (0, 4, 5))
                for i, d, r, p in zip(tied.tolist(), ids, run, place, strict=True):
                    low[i] = bisect_right(splitters, (int(score[i]), LAST_ID if d is None else d, r, p), int(low[i]), int(high[i]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(low, pa.int32())], [*b.schema.names, "segment"])

    return map_arrow(runs.where("place is not null"), cut, f"{RUN}, segment int")


def ranked(runs: DataFrame, draw: int, rows: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """All rows of the runs with rank: 1 to `draw` for the first in order, else null. rows: how many have a place."""
    segments = max(n_partitions(runs.sparkSession), -(-rows // segment_rows))
    cut = segmented(runs, regular_splitters(runs, rows, segments))
    before, start, last = 0, {}, -1
    for r in sorted(cut.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()):
        if before < draw:
            start[r.segment], last = before, r.segment
        before += r.n

    def merge(t: pa.Table) -> pa.Table:
        """One segment: pieces of sorted runs become one, and places in it become ranks."""
        number = t.column("segment")[0].as_py()
        score, run, place = (t.column(c).to_numpy() for c in ("score", "run", "place"))
        ids = t.column("doc_id").fill_null(LAST_ID).to_numpy()
        order = np.lexsort((place, run, ids, -score))
        rank = start[number] + 1 + np.arange(len(order))
        t = t.take(pa.array(order)).select(["doc_id", "n_features", "weight", "score"])
        return t.append_column("rank", pa.array(rank, pa.int64(), mask=rank > draw))

    names = ["doc_id", "n_features", "weight", "score"]
    drawn = cut.where(F.col("segment") <= last).groupBy("segment").applyInArrow(merge, "doc_id long, n_features long, weight long, score long, rank long")
    rest = cut.where(F.col("segment") > last).select(*names).unionByName(runs.where("place is null").select(*names))
    return drawn.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, longest: int = LONGEST, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: `percent` of the documents with at least `least` words are drawn."""
    gain = gains(bucket_counts(docs, longest), bucket_counts(target, longest))
    runs = settle(scored_runs(docs, gain, longest, least, seed), "runs")
    rows = runs.where("place is not null").count()
    return ranked(runs, percent * rows // 100, rows)


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents of the draw, with all their columns. Rows that share a doc_id are drawn together."""
    ids = resample(docs, target, percent).where("rank is not null and doc_id is not null").select("doc_id").distinct()
    return docs.join(ids, "doc_id", "left_semi")
