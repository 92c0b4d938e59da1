"""Ranked lexical search over a length-stratified index.

Documents are grouped by equal normaliser m, which is all that a score takes from a document's length. A stratum is cut into
blocks of a bounded number of postings; a block has, for each term, its postings by descending tf. So an impact (what one
occurrence count is worth at this m) is calculated once for each tf of a term in a block, and a term's first tf is its bound.

Build: a first pass counts the documents of each length, which gives N, L and the sizes of strata. Then each text becomes one row
of terms and tfs; rows are dealt by m and, in strata of many documents, by a slot, and each task turns its rows into blocks. The index is a table in the shared folder: block, m, term, tfs, ends, slots; a row without a term
has the block's doc_ids by slot. N, L and the tables' folders are all that is kept besides.

Search: query items are taken in batches of a bounded number and size of terms. A batch's vocabulary, broadcast, picks its
postings; their counts give df and the weights. The picked postings are exchanged by block, so that a task has several blocks. For each item the
sum of the terms' bounds orders the task's blocks; visits end where a bound is below the item's 20th best score so far. Ties are
visited, so nothing is lost. The best of all tasks are ranked in two steps, first within salted parts of an item.

Defined results: null or empty texts have no term, count for nothing and are never found; whole texts of any length are read,
in pieces. Rows that repeat are documents of their own. Equal scores go to the smaller doc_id, a null doc_id last. Items that
share item_id are one item, their terms added up; an item without terms or without a hit has no rows. Empty tables give an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_arrow, n_partitions, settle
from .terms import raw_texts, term_pieces

BEST = 20
#: Share of the length in the normaliser, in percent, and its weight.
LENGTH_PERCENT, K = 25, 12
#: Postings of a block and, when searching, of a task; terms of a task when building; entries that are scored at once.
BLOCK_POSTINGS, TASK_POSTINGS, BUILD_TERMS, ENTRIES = 1 << 18, 4_000_000, 8_000_000, 1 << 22
#: Documents from which a stratum is cut in slots; so many strata can be cut at most, else only larger ones are.
SLOT_DOCS, MOST_CUT = 20_000, 100_000
#: Item terms, and bytes of them, of a batch of items: what a batch broadcasts is bounded by these.
BATCH_TERMS, BATCH_BYTES = 200_000, 4_000_000
#: Lengths that a task counts before it sends them.
LENGTHS = 100_000
#: Rows of terms that a task sends at once hold about so many terms.
SEND_TERMS = 500_000
#: Parts of an item's hits that are ranked before its whole.
PARTS = 64
#: Stands for a null doc_id in the order of documents.
LAST_ID = np.iinfo(np.int64).max
#: Sums below are exact in doubles.
EXACT = 2**53

VECTOR = "id long, n long, terms array<string>, tfs array<int>"
POSTINGS = "block long, m long, term string, tfs array<int>, ends array<int>, slots array<int>, docs array<long>"


def vectors(texts: DataFrame, key: str) -> DataFrame:
    """One row for each text that has terms: id, number of terms, the distinct terms and how often each occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, terms, tfs, ends = [], [], [], [], [0]

        def rows() -> pa.RecordBatch:
            offsets = pa.array(ends, pa.int32())
            out = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))]
            return pa.RecordBatch.from_arrays(out, ["id", "n", "terms", "tfs"])

        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                found: Counter[bytes] = Counter()
                for piece in term_pieces(raw):
                    found.update(piece)
                if not found:
                    continue
                ids.append(i)
                n.append(found.total())
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
                if len(terms) > SEND_TERMS:
                    yield rows()
                    ids, n, terms, tfs, ends = [], [], [], [], [0]
        if ids:
            yield rows()

    return map_arrow(texts.select(F.col(key).cast("long").alias("id"), "text"), count, VECTOR)


def length_counts(texts: DataFrame) -> DataFrame:
    """n, docs: how many texts have n terms, for n over 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["n", "docs"])
        for b in batches:
            for raw in raw_texts(b.column(0)):
                if n := sum(map(len, term_pieces(raw))):
                    found[n] += 1
            if len(found) > LENGTHS:
                yield rows()
                found.clear()
        yield rows()

    return map_arrow(texts.select("text"), count, "n long, docs long").groupBy("n").agg(F.sum("docs").alias("docs"))


@dataclass
class Index:
    """rows: POSTINGS. documents and terms: N and L of the scores."""

    rows: DataFrame
    documents: int
    terms: int

    def drop(self) -> None:
        discard(self.rows)


def normaliser(n: str, documents: int, terms: int) -> Column:
    return F.expr(f"{100 - LENGTH_PERCENT}L + ({LENGTH_PERCENT}L * {n} * {documents}L) div {max(terms, 1)}L")


def block_rows(block: int, m: int, docs: list[int | None], terms: list[str], tfs: np.ndarray, slots: np.ndarray) -> pa.RecordBatch:
    """Postings of one block, one row for each term, and the row of its documents."""
    number: dict[str, int] = {}
    term = np.fromiter((number.setdefault(t, len(number)) for t in terms), np.int64, len(terms))
    order = np.lexsort((slots, -tfs, term))
    term, tfs, slots = term[order], tfs[order], slots[order]
    new_term = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    new_tf = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tfs[1:] != tfs[:-1])])
    last = np.r_[new_tf[1:], len(term)]
    groups = np.searchsorted(new_tf, np.r_[new_term, len(term)]).astype(np.int32)  # of a term: its tfs
    start = np.repeat(new_term, np.diff(groups))
    size = len(number)
    lists = lambda offsets, values: pa.ListArray.from_arrays(pa.array(np.r_[offsets, offsets[-1]].astype(np.int32)), pa.array(values.astype(np.int32)))  # noqa: E731  an empty list for the row of documents
    none = pa.nulls(size, pa.list_(pa.int64()))
    columns = [
        pa.array(np.full(size + 1, block)), pa.array(np.full(size + 1, m)), pa.array([*number, None], pa.string()), lists(groups, tfs[new_tf]),
        lists(groups, last - start), lists(np.r_[new_term, len(term)], slots), pa.concat_arrays([none, pa.array([docs], pa.list_(pa.int64()))]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "m", "term", "tfs", "ends", "slots", "docs"])


def build(docs: DataFrame) -> Index:
    """Index all documents that have a term."""
    lengths = settle(length_counts(docs), "lengths")
    documents, terms = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("docs")), F.lit(0))).first()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, m = TaskContext.get().partitionId() << 32, None
        ids, terms, tfs, sizes = [], [], [], []

        def block() -> pa.RecordBatch:
            return block_rows(number, m, ids, terms, np.array(tfs, np.int64), np.repeat(np.arange(len(ids)), sizes))

        for b in batches:
            for at, _, i, t, f in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if ids and (at != m or len(terms) + len(t) > BLOCK_POSTINGS):
                    yield block()
                    number += 1
                    ids, terms, tfs, sizes = [], [], [], []
                m = at
                ids.append(i)
                terms += t
                tfs += f
                sizes.append(len(t))
        if ids:
            yield block()

    most = max(SLOT_DOCS, documents // MOST_CUT)
    strata = lengths.groupBy(normaliser("n", documents, terms).alias("m")).agg(F.sum("docs").alias("docs"))
    large = strata.where(F.col("docs") > most).select("m", F.ceil(F.col("docs") / most).cast("int").alias("slots"))  # MOST_CUT rows at most
    slot = F.coalesce(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("slots")), F.lit(0)).cast("int")
    dealt = vectors(docs, "doc_id").withColumn("m", normaliser("n", documents, terms)).join(F.broadcast(large), "m", "left").select("m", slot.alias("slot"), "id", "terms", "tfs")
    dealt = dealt.repartition(max(n_partitions(docs.sparkSession), -(-terms // BUILD_TERMS)), "m", "slot").sortWithinPartitions("m", "slot", "id")
    index = Index(settle(map_arrow(dealt, blocks, POSTINGS), "lexical-index"), documents, terms)
    discard(lengths)
    return index


# ---- search


def sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of values by place; by doubles where these are exact."""
    if not len(values) or float(values.max()) * len(values) < EXACT:
        return np.bincount(at, values, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


@dataclass
class Block:
    """Postings of the query's terms in one block, laid end to end: term k has impacts[start[k]:stop[k]]."""

    docs: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    bound: np.ndarray
    slots: np.ndarray
    impacts: np.ndarray


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + K * m)


def read_block(rows: pa.Table, vocabulary: int) -> Block | None:
    """rows: m, no, tfs, ends, slots, docs of one block; no is -1 in the row of documents."""
    number = rows.column("no").to_numpy()
    head, own = int(np.flatnonzero(number == -1)[0]), np.flatnonzero(number >= 0)
    if not len(own):
        return None
    docs = rows.column("docs")[head].values.fill_null(LAST_ID).to_numpy()
    part = rows.take(pa.array(own)).combine_chunks()
    lists = {c: part.column(c).combine_chunks() for c in ("tfs", "ends", "slots")}
    tfs, ends, slots = (np.asarray(lists[c].flatten(), np.int64) for c in ("tfs", "ends", "slots"))
    worth = impact(tfs, rows.column("m")[0].as_py())  # once for each tf of a term
    groups = np.r_[0, np.cumsum(lists["tfs"].value_lengths().to_numpy())]
    sizes = np.diff(ends, prepend=0)
    sizes[groups[:-1]] = ends[groups[:-1]]
    bounds = np.r_[0, np.cumsum(lists["slots"].value_lengths().to_numpy())]
    start, stop, bound = (np.zeros(vocabulary, np.int64) for _ in range(3))
    start[number[own]], stop[number[own]], bound[number[own]] = bounds[:-1], bounds[1:], worth[groups[:-1]]
    return Block(docs, start, stop, bound, slots, np.repeat(worth, sizes))


@dataclass
class Items:
    """The items of a batch: item k asks for terms term[first[k]:first[k + 1]], each worth gain times its impact."""

    ids: list[int | None]
    first: np.ndarray
    term: np.ndarray
    gain: np.ndarray

    def pairs(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in `chosen`, terms and gains of all terms of the chosen items."""
        n = self.first[chosen + 1] - self.first[chosen]
        own = np.repeat(np.arange(len(chosen)), n)
        at = np.repeat(self.first[chosen] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return own, self.term[at], self.gain[at]


class Best:
    """The best hits of each item so far."""

    def __init__(self, items: int, most: int) -> None:
        self.most, self.score, self.doc = most, [np.empty(0, np.int64)] * items, [np.empty(0, np.int64)] * items
        self.least = np.ones(items, np.int64)  # a score below can't be among the best any more

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score[item], score]), np.concatenate([self.doc[item], doc])
        order = np.lexsort((doc, -score))[: self.most]
        self.score[item], self.doc[item] = score[order], doc[order]
        if len(order) == self.most:
            self.least[item] = score[order[-1]]


def score_block(block: Block, items: Items, chosen: np.ndarray, best: Best) -> None:
    """Scores of all documents of a block for the chosen items, a bounded number of entries at a time."""
    own, term, gain = items.pairs(chosen)
    n = block.stop[term] - block.start[term]
    here, slots = n > 0, len(block.docs)
    own, term, gain, n = own[here], term[here], gain[here], n[here]
    work = np.bincount(own, n, len(chosen)) + slots
    ends = np.r_[0, np.cumsum(work)]
    at = 0
    while at < len(chosen):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + ENTRIES, "right")) - 1)
        a, b = np.searchsorted(own, [at, to])
        size = n[a:b]
        total = int(size.sum())
        entry = np.repeat(block.start[term[a:b]] - np.r_[0, np.cumsum(size)[:-1]] if b > a else np.empty(0, np.int64), size) + np.arange(total)
        cell = np.repeat((own[a:b] - at) * slots, size) + block.slots[entry]
        scores = sums(cell, np.repeat(gain[a:b], size) * block.impacts[entry], (to - at) * slots).reshape(to - at, slots)
        for k in range(at, to):
            item, row = int(chosen[k]), scores[k - at]
            hit = np.flatnonzero(row >= best.least[item])
            if len(hit) > best.most:
                hit = hit[row[hit] >= np.partition(row[hit], -best.most)[-best.most]]
            if len(hit):
                best.add(item, row[hit], block.docs[hit])
        at = to


def visit(blocks: list[Block], items: Items, most: int) -> Best:
    """Each item visits the blocks in the order of its bounds, until a bound is below its least score."""
    best, everyone = Best(len(items.ids), most), np.arange(len(items.ids))
    own, term, gain = items.pairs(everyone)
    bounds = np.array([sums(own, gain * b.bound[term], len(everyone)) for b in blocks]).reshape(len(blocks), len(everyone))
    order = np.argsort(-bounds, axis=0, kind="stable")
    for turn in range(len(blocks)):
        now = order[turn]
        able = bounds[now, everyone] >= best.least
        if not able.any():
            break
        for k in np.unique(now[able]):
            score_block(blocks[k], items, everyone[able & (now == k)], best)
    return best


def hits(picked: DataFrame, items: Items, vocabulary: int, most: int, tasks: int) -> DataFrame:
    """item_id, doc_id, score: the best of each task. picked: block, m, no, tfs, ends, slots, docs."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, rows = [], []

        def close() -> None:
            if rows and (block := read_block(pa.Table.from_batches(rows), vocabulary)):
                blocks.append(block)
            rows.clear()

        for b in batches:
            number = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else []
            for a, z in zip(cuts, [*cuts[1:], len(number)], strict=True):
                if rows and rows[-1].column(0)[0].as_py() != number[a]:
                    close()
                rows.append(b.slice(a, z - a))
        close()
        best = visit(blocks, items, most) if blocks else Best(0, most)
        ids = [items.ids[k] for k, s in enumerate(best.score) for _ in range(len(s))]
        docs = np.concatenate([np.empty(0, np.int64), *best.doc])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(docs, mask=docs == LAST_ID), pa.array(np.concatenate([np.empty(0, np.int64), *best.score]))], ["item_id", "doc_id", "score"])

    dealt = picked.repartition(tasks, "block").sortWithinPartitions("block")
    return map_arrow(dealt, search, "item_id long, doc_id long, score long")


def top(found: DataFrame, most: int) -> DataFrame:
    """item_id, rank, doc_id, score. First the parts of an item are cut to the best, then what is left is ranked."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("part", F.spark_partition_id() % PARTS)
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("rank") <= most)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def search(index: Index, items: DataFrame, most: int = BEST) -> DataFrame:
    """The best documents of each item. items: item_id, text."""
    spark = items.sparkSession
    asked = vectors(items, "item_id").select("id", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).groupBy("id", F.col("x.terms").alias("term")).agg(F.sum("x.tfs").alias("times"))
    asked = settle(asked, "asked")
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    batches = max(1, -(-n // BATCH_TERMS), -(-size // BATCH_BYTES))
    out = None
    for batch in range(batches):
        pairs = asked.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch).collect()
        vocabulary = {t: k for k, t in enumerate(sorted({r.term for r in pairs}))}
        words = spark.createDataFrame([*vocabulary.items(), (None, -1)], "term string, no int")
        picked = index.rows.join(F.broadcast(words), index.rows["term"].eqNullSafe(words["term"])).select("block", "m", "no", "tfs", "ends", "slots", "docs")
        df = {r.no: r.df for r in picked.where("no >= 0").groupBy("no").agg(F.sum(F.size("slots")).alias("df")).collect()}
        weight = {t: math.floor(1000 * math.log((2.0 * index.documents + 2) / (2.0 * df[k] + 1))) for t, k in vocabulary.items() if k in df}
        pairs = sorted((r for r in pairs if weight.get(r.term)), key=lambda r: (r.id is None, r.id))
        ids = list(dict.fromkeys(r.id for r in pairs))
        first = np.r_[0, np.cumsum([*Counter(r.id for r in pairs).values()])].astype(np.int64)
        batch_items = Items(ids, first, np.array([vocabulary[r.term] for r in pairs], np.int64), np.array([weight[r.term] * r.times for r in pairs], np.int64))
        tasks = max(n_partitions(spark), -(-sum(df.values()) // TASK_POSTINGS))
        found = hits(picked, batch_items, len(vocabulary), most, tasks)
        out = found if out is None else out.unionByName(found)
    return top(out, most)


def ranked(docs: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """Build an index of docs, search it for all items, and drop it."""
    index = build(docs)
    out = settle(search(index, items, most), "ranked")
    index.drop()
    return out
