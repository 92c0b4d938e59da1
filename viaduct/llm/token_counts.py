"""Token counts of whole texts, with overlap resynchronisation for long ones.

A text of over `chunk` characters is encoded in chunks that overlap, with offsets. Two neighbours are spliced at a common
token boundary that is proven stable: between a letter or digit and white space, punctuation or a symbol, or between a
punctuation mark or symbol and white space. The tokenizer's pattern always ends a token there, and neither side looks
across, so what stands left of the place in one chunk and right of it in the next is what the whole text gives; both
encodings must have the boundary, and it must not be so near to an end of its chunk that a special string could be cut.
If an overlap holds no such place, it is widened by doubling; if the whole chunk holds none, the chunk goes on to the next
place, which is looked up before anything is encoded, so each character is encoded about once whatever the script. A run
without any place is one piece to the tokenizer's pattern and is encoded as one. Shorter texts are cut at white space, and
the worker remembers the counts of the strings between.

Defined results: a null text counts as empty (no bytes, no tokens); repeated rows and null ids each count; an empty table
gives no rows; other columns are ignored; a count depends on its own text alone, so there are no ties.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import UNICODE_SPACE
from .common import map_arrow
from .tokens import default_path, load

CHUNK = 8_000
OVERLAP = 200
LIMIT = 512
#: No special string of the vocabulary is longer.
MARGIN = 32
#: Texts of one space or line feed between words can be cut at every space; others at the end of each word.
PLAIN = re.compile(r"\s\s|[^\S \n]|^\s|\s$")
STRINGS = re.compile(r"[SPACE]*[^SPACE]+|[SPACE]+".replace("SPACE", UNICODE_SPACE))
#: Strings that a worker remembers before it starts anew.
MEMORY = 500_000


def characters(kinds: str) -> str:
    """The inside of a pattern's brackets for all characters whose general category starts so, in Unicode 3.2 and now: the
    tables of any library agree on them."""
    old, out, start = unicodedata.ucd_3_2_0, [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] in kinds and old.category(chr(c))[0] in kinds
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(re.escape(chr(start)) + "-" + re.escape(chr(c - 1)))
            start = None
    return "".join(out)


@lru_cache(maxsize=1)
def stable() -> re.Pattern[str]:
    """Finds places that end a token in any context. An apostrophe may start a token with letters, but ends none."""
    letters, signs = characters("LN"), characters("PS")
    return re.compile(f"(?<=[{letters}])(?=[ \t\n\r{signs}])|(?<=[{signs}])(?=[ \t\n\r])")


def resynchronised(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text, encoded in overlapping chunks."""
    find, n = stable().finditer, len(text)

    def encoded(start: int, end: int) -> tuple[list[int], list[int]]:
        """Where the tokens of text[start:end] begin and end."""
        offsets = load(path).encode(text[start:end], add_special_tokens=False).offsets
        return [a + start for a, _ in offsets], [b + start for _, b in offsets]

    def end_of(start: int) -> int:
        """The end of a chunk from start: `chunk` characters, or beyond the first place that its end can be spliced at."""
        end = start + chunk
        if end >= n or next(find(text, max(start + MARGIN, end - chunk // 2), end - MARGIN), None):
            return min(end, n)
        place = next(find(text, max(start + MARGIN, end - MARGIN)), None)
        return n if place is None else min(n, place.start() + MARGIN + 1)

    total, done, end = 0, 0, end_of(0)  # all left of done is counted
    begins, ends = encoded(0, end)
    while end < n:
        back = min(overlap, chunk // 2)
        while True:
            low = max(done, end - back - 2 * MARGIN)
            # The next chunk starts at a place, so that its first tokens are likely to be the text's.
            place = next(find(text, low, end), None)
            low = place.start() if place else low
            next_end = end_of(end)
            next_begins, next_ends = encoded(low, next_end)
            cut = next((m.start() for m in find(text, low + MARGIN if low else 0, end - MARGIN) if boundary(ends, m.start()) and boundary(next_begins, m.start())), None)
            if cut is not None or end - back - 2 * MARGIN <= done:
                break
            back *= 2
        if cut is None:  # not one common boundary in the whole chunk: both are encoded as one
            end = next_end
            begins, ends = encoded(done, end)
            continue
        total += bisect_right(ends, cut) - bisect_left(begins, done)
        done, end, begins, ends = cut, next_end, next_begins, next_ends
    return total + len(begins) - bisect_left(begins, done)


def boundary(places: list[int], at: int) -> bool:
    k = bisect_left(places, at)
    return k < len(places) and places[k] == at


class Counter(dict):
    """string -> tokens, for strings that start and end at stable places; the library encodes each new one once."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path = path

    def count(self, text: str) -> int:
        if PLAIN.search(text):  # white space of more than one character, or of a rare kind
            strings = STRINGS.findall(text)
        else:
            first, *rest = text.split(" ")
            strings = [first, *[" " + x for x in rest]]
        if len(self) > MEMORY:
            self.clear()
        new = [x for x in set(strings) if x not in self]
        if new:
            self.update(zip(new, map(len, load(self.path).encode_batch_fast(new, add_special_tokens=False)), strict=True))
        return sum(map(self.__getitem__, strings))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    at = path or default_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(at)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            made = [known.count(x) if len(x) <= chunk else resynchronised(x, at, chunk, overlap) for x in texts]
            size = [len(x.encode("utf-8", "surrogatepass")) for x in texts]
            yield pa.record_batch([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(made, pa.int64()), pa.array([n > limit for n in made], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
