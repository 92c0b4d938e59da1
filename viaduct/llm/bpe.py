"""BPE encoding and decoding by batched numpy merge rounds.

New words are laid out as symbols in one flat array. A round finds the rank of every pair of neighbours by
binary search over the sorted pair keys, takes the lowest of each word and merges there, for all words at once. What
stands between white space is kept for the worker's next texts, so a round works on new words only.

Reads the public tokenizer file (BPE with word ends; lower case; white space dropped) and gives what its library gives:
special strings in a text become their ids, other text is composed (NFC), lower-cased and split by the file's pattern.

A text with a code point that Python's Unicode tables lack is normalised and split by the library, whose tables are its
own; its words are encoded here like all others.

Defined results: a null text counts as empty (no ids, empty decoded text); repeated rows are each encoded; other columns
are ignored; of equal ranks in a word the leftmost pair merges first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, map_arrow
from .tokens import default_path, word_pieces
from .tokens import load as library

#: Strings that a worker remembers before it starts anew.
MEMORY = 500_000
#: Characters of new words encoded at once.
FLAT = 200_000
#: White space as Unicode defines it, and so the tokenizer's pattern.
UNICODE_SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
NONE = np.iinfo(np.int64).max
SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


class _Memory(dict):
    """string -> place; a new string gets the next place and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, string: str) -> int:
        self[string] = at = len(self)
        self.new.append(string)
        return at


class BPE:
    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.n = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * self.n
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.token_bytes = [t.encode() for t in self.token]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(pattern.replace(r"\s", UNICODE_SPACE)).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.space = regex.compile(f"[{UNICODE_SPACE}]+").sub
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.n + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        # A rank is safe if no pair with what it makes has a lower rank: then all its places in a word may merge at once.
        lowest = np.full(self.n, NONE)
        np.minimum.at(lowest, left, np.arange(len(merges)))
        np.minimum.at(lowest, right, np.arange(len(merges)))
        self.safe = lowest[made] > np.arange(len(merges))
        self.forget()

    def forget(self) -> None:
        self.memory = _Memory()
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.n_words, self.used = 0, 0

    # -- merge rounds

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.ranks[k], NONE)

    def encode_words(self, words: list[str] | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (or their UTF-8) in a row, and how many each has."""
        raw = [w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.first[data]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        ranks = np.full(len(sym), NONE)  # of the pair of a symbol and the next one
        inner = np.flatnonzero(word[:-1] == word[1:])
        ranks[inner] = self.pair_ranks(sym[inner], sym[inner + 1])
        out_sym, out_word = [], []
        while len(sym):
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[begin, len(sym)])
            least = np.minimum.reduceat(ranks, begin)
            if (least == NONE).any():
                ended = np.repeat(least == NONE, count)
                out_sym.append(sym[ended])
                out_word.append(word[ended])
                live = ~ended
                sym, word, ranks = sym[live], word[live], ranks[live]
                least, count = least[least != NONE], count[least != NONE]
                if not len(sym):
                    break
            at = np.flatnonzero(ranks == np.repeat(least, count))
            # Of places in a row every second one merges; of an unsafe rank only the word's first.
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            run = first | np.r_[True, np.diff(at) != 1]
            since = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[np.where(self.safe[ranks[at]], since % 2 == 0, first)]
            sym[at] = self.made[ranks[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))  # where the merged symbols stand when the right halves are gone
            sym, word, ranks = sym[stay], word[stay], ranks[stay]
            touched = np.concatenate([at, at[at > 0] - 1])
            ranks[touched] = NONE
            touched = touched[touched + 1 < len(sym)]
            touched = touched[word[touched] == word[touched + 1]]
            ranks[touched] = self.pair_ranks(sym[touched], sym[touched + 1])
        ids, owner = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner, minlength=len(words))

    def learn(self) -> None:
        """Encode the strings that the memory noted as new."""
        new, self.memory.new = self.memory.new, []
        start = 0
        while start < len(new):
            end, chars = start, 0
            while end < len(new) and (chars < FLAT or end == start):
                chars += len(new[end])
                end += 1
            words = [self.find(x) for x in new[start:end]]
            per = np.array([len(x) for x in words], np.int64)
            ids, each = self.encode_words([w for x in words for w in x]) if per.any() else (np.empty(0, np.uint32), np.empty(0, np.int64))
            upto = np.r_[0, np.cumsum(each)]
            sizes = np.diff(upto[np.r_[0, np.cumsum(per)]])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            while self.n_words + len(sizes) > len(self.sizes):
                self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
            self.flat[self.used : self.used + len(ids)] = ids
            self.starts[self.n_words : self.n_words + len(sizes)] = self.used + np.cumsum(sizes) - sizes
            self.sizes[self.n_words : self.n_words + len(sizes)] = sizes
            self.used += len(ids)
            self.n_words += len(sizes)
            start = end

    # -- texts

    def strings(self, text: str) -> list[str]:
        """What stands between white space in a text without special strings. No word crosses white space."""
        if not text.isascii():
            # letter by letter, as the file's library does: no final sigma
            text = self.space(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ")
            return [x for x in text.lower().split(" ") if x]
        if SEPARATORS.search(text):  # white space to Python alone
            return [x for x in self.space(" ", text).lower().split(" ") if x]
        return text.lower().split()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, as unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; the new strings of a block of texts are encoded together."""
        for a, b in in_blocks(texts):
            if len(self.memory) > MEMORY:
                self.forget()
            placed = [self._placed(t) for t in texts[a:b]]
            self.learn()
            for parts in placed:
                ids = [self._ids(p) if isinstance(p, np.ndarray) else np.array(p, np.uint32) for p in parts]
                yield ids[0] if len(ids) == 1 else np.concatenate([np.empty(0, np.uint32), *ids])

    def _placed(self, text: str | None) -> list[np.ndarray | list[int]]:
        """A text as places in the memory (arrays) and ready ids (lists)."""
        if not text:
            return []
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return [[self.special[p]] if p in self.special else self._newer(p) for p in self.cut(text)]
        if any(s in text for s in self.special):
            return [[self.special[p]] if p in self.special else self._places(p) for p in self.cut(text)]
        return [self._places(text)]

    def _newer(self, text: str) -> list[int]:
        """The ids of a text with letters newer than Python's tables: the library lower-cases and splits it."""
        t, out = library(self.path), []
        for piece in word_pieces(text):
            words = [bytes(map(self.byte_of.__getitem__, w)) for w, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(piece))]
            out += self.encode_words(words)[0].tolist() if words else []
        return out

    def _places(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.memory.__getitem__, self.strings(text)), np.int64)

    def _ids(self, places: np.ndarray) -> np.ndarray:
        if not len(places):
            return np.empty(0, np.uint32)
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[places] - ends + sizes, sizes) + np.arange(ends[-1])]

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode() gives for this file, which has no decoder: the tokens, joined by spaces."""
        return self.decode_bytes(ids).decode()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b" ".join(map(self.token_bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> BPE:
    return BPE(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of ints) of each text."""
    at = path or default_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(at)
        for batch in batches:
            ids = [x.astype(np.int32) for x in bpe.encode_all(batch.column("text").to_pylist())]
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded: doc_id, ids. Returns doc_id, text."""
    at = path or default_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(at)
        for batch in batches:
            texts = [bpe.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column("ids")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(encoded.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes each text in one pass."""
    at = path or default_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(at)
        for batch in batches:
            rows = []
            for ids in bpe.encode_all(batch.column("text").to_pylist()):
                ids = ids.astype("<u4")
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(bpe.decode_bytes(ids)).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
