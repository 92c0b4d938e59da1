"""Lempel-Ziv phrase fingerprints: documents are alike if one's phrases help to compress the other.

A text is parsed into phrases as a dictionary coder does: the longest phrase known so far and one further code point make the
next phrase. The dictionary is emptied after each WINDOW code points, so a worker's memory is bounded for a text of any length;
the phrases of all windows count. Each phrase is hashed, and the set of hashes becomes a signature of BINS minima: the high bits
of a hash choose its bin, the lowest hash of a bin gives its 16 bits, and an empty bin borrows from a bin that a fixed order
names first, so small sets have whole signatures too. The likeness of two signatures is the share of equal bins, an estimate of
the Jaccard similarity of the phrase sets.

Each document is also compared with an edited copy, whose last quarter comes from the next document, and with that document.
Rows are dealt by ranges of doc_id and read in order, so the next document is the next row; the parse of the kept three
quarters is shared with the whole text. Only a task's last row has to wait for the first row of the next task: both carry
their texts, and are put together in a second step, by a join on the task's number.

Defined results: a null text counts as empty; an empty text has no phrase and the fingerprint of zeros, its likeness with
another empty text is 1, with others 0. Whole texts of any length are parsed. Documents are in order of doc_id, a null one
first, rows of one doc_id by a hash of their text; rows that repeat follow each other. One row alone is its own next document.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, n_partitions, settle
from .shingles import ODD, mix

#: Code points after which the dictionary is emptied; bins of a signature (a power of two); the part of a text that is edited.
WINDOW, BINS, EDITED = 1 << 18, 128, 4
#: Where an empty bin borrows: for each bin the bins to look at, in a fixed order.
_LOOK = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64).reshape(BINS, BINS) + np.uint64(1)), axis=1)
#: Powers of an odd number and of its inverse modulo 2 ** 64. A window's finished phrases are no longer than the window.
POWERS, INVERSES = (np.cumprod(np.r_[np.ones(1, np.uint64), np.full(WINDOW, x, np.uint64)]) for x in (int(ODD), pow(int(ODD), -1, 1 << 64)))
EMPTY = b"\0" * (2 * BINS)
#: Rows that a task sends at once.
SEND_ROWS = 2000


class Parse:
    """The phrases of what has been read so far, and the dictionary to go on from."""

    def __init__(self) -> None:
        self.known: dict[str, None] = {}  # phrases of this window, in order
        self.open, self.read_here = "", 0  # an unfinished phrase, and how much of the window is read
        self.done: list[np.ndarray] = []  # hashes of the phrases of earlier windows

    def fork(self) -> Parse:
        out = Parse()
        out.known, out.open, out.read_here, out.done = self.known.copy(), self.open, self.read_here, self.done.copy()
        return out

    def read(self, text: str) -> None:
        at = 0
        while at < len(text):
            part = text[at : at + WINDOW - self.read_here]
            known, phrase = self.known, self.open
            for c in part:
                phrase += c
                if phrase not in known:
                    known[phrase] = None
                    phrase = ""
            self.open = phrase
            at, self.read_here = at + len(part), self.read_here + len(part)
            if self.read_here == WINDOW:
                self.done.append(phrase_hashes(known))
                self.known, self.open, self.read_here = {}, "", 0

    def signature(self) -> bytes:
        """Of all phrases; an unfinished last one is a phrase that is known already."""
        return signature(np.concatenate([*self.done, phrase_hashes(self.known)]))


def phrase_hashes(phrases: Iterable[str]) -> np.ndarray:
    """A polynomial of the code points of each phrase, all at once by differences of one running sum."""
    codes = np.frombuffer("".join(phrases).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(np.fromiter(map(len, phrases), np.int64))
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(codes * POWERS[: len(codes)])]
    return (total[ends] - total[starts]) * INVERSES[starts]


def signature(hashes: np.ndarray) -> bytes:
    if not len(hashes):
        return EMPTY
    h = np.sort(mix(hashes))
    bins = (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.intp)  # ascending, as the hashes are
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    value, have = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    value[bins[first]], have[bins[first]] = h[first] & np.uint64(0xFFFF), True
    gaps = np.flatnonzero(~have)
    look = _LOOK[gaps]
    value[gaps] = value[look[np.arange(len(gaps)), have[look].argmax(axis=1)]]
    return value.astype(">u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if EMPTY in (a, b):
        return float(a == b)
    return float(np.mean(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")))


class Document:
    """One row in order: its text, its signature, and the parse of what an edit keeps."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.kept = len(text) - len(text) // EDITED
        self.parse = Parse()
        self.parse.read(text[: self.kept])
        whole = self.parse.fork() if self.kept < len(text) else self.parse
        whole.read(text[self.kept :])
        self.signature = whole.signature()

    def against(self, following: str, signature: bytes) -> tuple:
        """The finished row: against the text and the signature of the next document. Ends the parse."""
        end = following[: len(self.text) - self.kept]
        sha = hashlib.sha256(self.text[: self.kept].encode("utf-8", "surrogatepass"))
        sha.update(end.encode("utf-8", "surrogatepass"))
        self.parse.read(end)
        edited = self.parse.signature()
        return self.doc_id, len(self.text), sha.hexdigest(), self.signature, edited, likeness(self.signature, edited), likeness(self.signature, signature)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
#: A row of a task: task and place (first, last, both or null) and the text only where a row of another task is needed.
ROW = f"{RESULT}, task int, is_first boolean, is_last boolean, text string"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
_NAMES = [x.split(" ")[0] for x in ROW.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def in_order(docs: DataFrame) -> DataFrame:
    """Rows of each task, finished but for its last one; the first one and the last one carry their text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, before, first, rows = TaskContext.get().partitionId(), None, True, []
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                now = Document(doc_id, text)
                if before:
                    rows.append((*before.against(now.text, now.signature), task, first, False, before.text if first else None))
                    first = False
                before = now
                if len(rows) >= SEND_ROWS:
                    yield _batch(rows)
                    rows = []
        if before:
            rows.append((before.doc_id, len(before.text), None, before.signature, None, None, None, task, first, True, before.text))
            yield _batch(rows)

    # The last key only splits rows that are equal in all.
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange(n_partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), "h", "row").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "row")
    return map_arrow(dealt.select("doc_id", "text"), read, ROW)


def finished(open_rows: DataFrame) -> DataFrame:
    """open_rows: doc_id, text and the next document's next_text and next_fingerprint."""

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text, following, signature in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(Document(doc_id, text).against(following, signature), _TYPES[:7], strict=True)], _NAMES[:7])

    return map_arrow(open_rows.select("doc_id", "text", "next_text", "next_fingerprint"), end, RESULT)


def hexed(c: str) -> Column:
    return F.lower(F.hex(c)).alias(c)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    rows = settle(in_order(docs), "fingerprints")
    # One row for each task: which task's first row follows its last one; the last task goes on with the first.
    every = Window.orderBy("task")
    firsts = rows.where("is_first").select("task", F.coalesce(F.lead("task").over(every), F.min("task").over(every)).alias("next_task"))
    heads = rows.where("is_first").select(F.col("task").alias("next_task"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    last = rows.where("is_last").select("task", "doc_id", "text").join(firsts, "task").join(heads, "next_task")
    out = rows.where("not is_last").select(*_NAMES[:7]).unionByName(finished(last))
    return out.select("doc_id", "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next")
