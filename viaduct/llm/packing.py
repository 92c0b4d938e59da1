"""Best-fit packing of token pieces with a swap-based local search.

Documents become token pieces of at most `capacity`; only longer documents are cut. Pieces are dealt evenly over groups
of about GROUP_PIECES. Each group is packed best fit, longest first; then a local search moves a document into a fuller
bin, or exchanges one for one or two for one, whenever the sum of squared fills grows, so that the emptiest bins drain
away. The underfull bins of all groups are dealt anew into fewer groups and packed again, until one group is left or a
level no longer helps. No group grows with the input.

Defined results: a null or empty text is the one piece of the end id; repeated rows and null doc_ids are packed like any
row; other columns are ignored; an empty table gives no rows; of pieces of equal length the one that comes first in its group
is placed first, so which of them is where is open.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load
from .common import map_arrow, settle
from .tokens import default_path

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8192
#: A bin filled to this share counts as full between levels.
FULL = 0.995

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32."""
    at = path or default_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), load(at).encode_all(batch.column("text").to_pylist()), strict=True):
                whole = np.append(ids, end_id).astype("<u4")
                for k, s in enumerate(range(0, len(whole), capacity)):
                    part = whole[s : s + capacity]
                    rows.append((doc, k, s, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, PIECES)


# ---- one group


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece: longest first, into the fullest bin with room."""
    out = np.empty(len(lengths), np.int64)
    gaps: list[tuple[int, int]] = []  # (room, bin), sorted
    n = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        k = bisect.bisect_left(gaps, (size, -1))
        if k < len(gaps):
            room, b = gaps.pop(k)
        else:
            room, b, n = capacity, n, n + 1
        out[i] = b
        if room > size:
            bisect.insort(gaps, (room - size, b))
    return out


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Local search: each step raises the sum of squared fills. Ends at a local optimum or at the least possible count.

    The emptiest bin gives first. Its pieces are tried longest first: moved into the tightest other bin; exchanged for a
    shorter piece, or for two that are shorter together, of a bin at least as full; or two of its pieces are exchanged for
    one. Where nothing of a bin helps, it rests until a step touches it.
    """
    bins = bins.copy()
    n = int(bins.max()) + 1 if len(bins) else 0
    fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    resting = fill == 0
    used = int((fill > 0).sum())
    while used > least:
        ready = np.flatnonzero(~resting & (fill > 0) & (fill < capacity))
        if not len(ready):
            break
        giver = int(ready[np.argmin(fill[ready])])
        step = _step(lengths, bins, fill, giver, capacity)
        if step is None:
            resting[giver] = True
            continue
        give, take, to = step
        delta = int(lengths[give].sum() - lengths[take].sum())
        bins[give], bins[take] = to, giver
        fill[giver] -= delta
        fill[to] += delta
        resting[to] = fill[to] == capacity
        if fill[giver] == 0:
            used -= 1
    return bins


def _step(lengths: np.ndarray, bins: np.ndarray, fill: np.ndarray, giver: int, capacity: int) -> tuple[list[int], list[int], int] | None:
    """Pieces to give, pieces to take back and the bin, of the first kind of step that helps; None if none does."""
    own = np.flatnonzero(bins == giver)
    own = own[np.argsort(-lengths[own], kind="stable")]
    room = capacity - fill
    open_bins = (room > 0) & (fill >= fill[giver])
    open_bins[giver] = False
    others = np.flatnonzero(open_bins)
    if not len(others):
        return None
    for i in own:  # move
        fits = others[room[others] >= lengths[i]]
        if len(fits):
            return [int(i)], [], int(fits[np.argmin(room[fits])])
    items = np.flatnonzero(open_bins[bins])
    if not len(items):
        return None
    size, spare = lengths[items], room[bins[items]]
    for i in own:  # one for one: the largest gain that fits
        gain = lengths[i] - size
        ok = (gain > 0) & (gain <= spare)
        if ok.any():
            k = int(np.argmax(np.where(ok, gain, 0)))
            return [int(i)], [int(items[k])], int(bins[items[k]])
    order = np.lexsort((size, bins[items]))
    items, size, spare = items[order], size[order], spare[order]
    wide = capacity + 1
    key = bins[items] * wide + size
    for i in own:  # one for two of one bin
        k = np.searchsorted(key, bins[items] * wide + np.maximum(lengths[i] - size, 0)) - 1  # the largest partner below
        k = np.where(k == np.arange(len(items)), k - 1, k)
        ok = (k >= 0) & (bins[items[np.maximum(k, 0)]] == bins[items])
        gain = np.where(ok, lengths[i] - size - size[np.maximum(k, 0)], 0)
        ok &= (gain > 0) & (gain <= spare)
        if ok.any():
            j = int(np.argmax(np.where(ok, gain, 0)))
            return [int(i)], [int(items[j]), int(items[k[j]])], int(bins[items[j]])
    for a in range(len(own) - 1):  # two for one
        gain = lengths[own[a]] + lengths[own[a + 1 :], None] - size
        ok = (gain > 0) & (gain <= spare)
        if ok.any():
            r, c = np.unravel_index(int(np.argmax(np.where(ok, gain, 0))), ok.shape)
            return [int(own[a]), int(own[a + 1 + r])], [int(items[c])], int(bins[items[c]])
    return None


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    return improve(lengths, best_fit(lengths, capacity), capacity)


# ---- all groups


def _packed(rows: DataFrame, groups: int, capacity: int, base: int) -> DataFrame:
    """rows dealt over groups and packed there; sequence ids start from the group's own range."""

    def run(key: tuple[int], pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins = pack_group(lengths, capacity)
        order = np.lexsort((-lengths, bins))
        b, n = bins[order], lengths[order]
        before = np.cumsum(n) - n
        first = np.searchsorted(b, b)
        out = pdf.iloc[order].drop(columns="part")
        out["sequence_id"] = ((base + int(key[0])) << 14) + np.unique(b, return_inverse=True)[1]
        out["offset"] = before - before[first]
        out["fill"] = np.bincount(bins, weights=lengths).astype(np.int64)[b]
        return out

    # Spread by place in the written table, not by content: repeated rows do not meet in one group.
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("part")
    return rows.select("*", part).groupBy("part").applyInPandas(run, f"{PACKED}, fill long")


def pack(rows: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """rows of pieces() with sequence_id and offset."""
    left, done, base, before = settle(rows, "pieces"), None, 0, None
    while True:
        n = left.count()
        groups = max(1, -(-n // group_pieces))
        packed = settle(_packed(left, groups, capacity, base), "packed")
        last = groups == 1 or (before is not None and 2 * n > before)
        full = packed if last else packed.where(F.col("fill") >= FULL * capacity)
        done = full if done is None else done.unionByName(full)
        if last:
            return done.drop("fill")
        left = packed.where(F.col("fill") < FULL * capacity).drop("fill", "sequence_id", "offset")
        base, before = base + groups, n


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path, capacity), capacity)
