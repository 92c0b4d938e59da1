"""Substring dedup by MinHash banding of paragraphs.

Prose has no dependable paragraph marks, and a passage may be set into other text at any word. So paragraphs of `WORDS`
words are cut by content: one starts at the place with the smallest word-pair hash of every `WINDOW` places in a row
(winnowing). Documents that share a run of WORDS + WINDOW - 1 words (48) or more therefore share a paragraph word for word.

Texts of equal words are one text, kept by the document of the smallest id. Equal paragraphs are one content, kept by the
text of the smallest id. Each content's 5-word shingles are MinHashed; the bands are tuned to find pairs of Jaccard 0.8
with the wanted recall, and all pairs of contents in a bucket are verified by exact Jaccard of the shingles. A crowded
bucket is first split by the rarest shingles of its contents, which loses no such pair; what shares one is compared inside
tasks, in parts of a bounded size, and a task gives one row a content at most.

A paragraph that repeats one of a text of a smaller id is removed. Paragraphs in a row that repeat the same run of the
same text are one cut, which goes on to both sides for as long as some text of a smaller id has the same words there, up
to WINDOW words: in a longer run the next paragraph is shared too. Overlapping cuts merge to a span. Documents are
clustered by components over all links: a paragraph that is near those of several texts connects all of them, though it is
cut for the smallest id.

Defined results: words are runs without white space, A-Z lower-cased for comparison; documents without doc_id, and texts
of fewer than WORDS words, are left alone; repeats within one document stay; rows that repeat a doc_id never count as
repeats of each other, and each text is cut by its own spans; a text that is removed as a whole becomes the empty text;
of ties the smallest id, then the smallest start counts; an empty table gives an empty result; other columns are carried
through by remove(). Texts and paragraphs are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, in_blocks, map_arrow, settle, spread_join
from .graph import components
from .shingles import ODD, Hashes, mix, run_hashes, sequence_hash, word_hashes

WORDS = 24
WINDOW = 25
SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.95
#: Hash functions a band, so that a bucket is more than the texts with one common phrase.
ROWS = 2
#: Buckets of more contents are split before they are paired off.
BUCKET = 32
#: Contents with one shingle are compared in parts of about so many.
PART = 8192
#: What text_words() is asked for: the words of a paragraph, those before a place (nearest first), those after it.
PARAGRAPH, BEFORE, AFTER = 0, 1, 2

_SHIFT = np.uint64(33)
_LAST = np.uint64(2**64 - 1)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tune(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> tuple[int, int]:
    """(bands, rows): the fewest bands of so many rows that find a pair of this similarity with this recall."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands, rows


# ---- paragraphs of many texts at once


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or largest value of each run of `width` values, by doubling steps."""
    pick, have = (np.minimum if least else np.maximum), 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def anchors(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """h: the words of texts in a row; sizes: of each text. The places where paragraphs start.

    A place counts if it has the smallest pair hash of some WINDOW places in a row of its text, or of all places of a
    shorter one; of places in a row with one hash (a word over and over) only every tenth.
    """
    n = len(h)
    if n < WORDS:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    valid = np.zeros(n + 1, np.int64)  # counts texts open for a start
    long = sizes >= WORDS
    np.add.at(valid, (ends - sizes)[long], 1)
    np.add.at(valid, ends[long] - WORDS + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    g = np.full(n, _LAST)
    g[:-1] = np.minimum(mix(h[:-1] * np.uint64(3) + h[1:]), _LAST - np.uint64(1))
    g[~valid] = _LAST
    chosen = np.zeros(n, bool)
    if n >= WINDOW:
        # A window must lie in one text: the places from it to the text's last start are WINDOW or more.
        stop = np.repeat(ends - WORDS + 1, sizes)
        whole = valid & (np.arange(n) + WINDOW <= stop)
        smallest = np.zeros(n + WINDOW - 1, np.uint64)
        smallest[WINDOW - 1 : n] = np.where(whole[: n - WINDOW + 1], sliding(g, WINDOW, True) + np.uint64(1), 0)
        chosen = sliding(smallest, WINDOW, False) == g + np.uint64(1)
    for k in np.flatnonzero(long & (sizes < WORDS + WINDOW - 1)):
        own = slice(ends[k] - sizes[k], ends[k] - WORDS + 1)
        chosen[own] = g[own] == g[own].min()
    chosen &= valid
    at = np.flatnonzero(chosen)
    same = np.zeros(n + 1, bool)
    same[1:n] = (g[1:] == g[:-1]) & valid[1:] & valid[:-1]
    inside = same[at] & same[at + 1]
    place = at - np.repeat(ends - sizes, sizes)[at]
    return at[~inside | (place % 10 == 0)]


def band_keys(h: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs, bands): the keys of the paragraphs that start at `at`."""
    s = run_hashes(h, SHINGLE)
    out = np.empty((len(at), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(at), b + 1, np.uint64)
        for r in range(rows):
            turned = s * np.uint64((2 * mix(np.array([b * rows + r + 1], np.uint64))[0].item() + 1) % 2**64)
            key = mix(key * ODD + sliding(turned ^ (turned >> _SHIFT), WORDS - SHINGLE + 1, True)[at])
        out[:, b] = key
    return out


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values, kind))


def marked(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, node (hash of all words), n (words) and, by paragraph, starts, contents and keys (`bands` a paragraph).

    One row for each row of docs that has a paragraph.
    """
    names = ["doc_id", "node", "n", "starts", "contents", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            for i, j in in_blocks(texts):
                hs = [word_hashes(t, known) for t in texts[i:j]]
                sizes = np.array([len(x) for x in hs], np.int64)
                h = np.concatenate(hs)
                at = anchors(h, sizes)
                owner = np.repeat(np.arange(len(hs)), sizes)[at]
                per = np.bincount(owner, minlength=len(hs))
                some = np.flatnonzero(per)
                start = (at - (np.cumsum(sizes) - sizes)[owner]).astype(np.int32)
                content = run_hashes(h, WORDS)[at].view(np.int64)
                keys = band_keys(h, at, bands, rows).ravel().view(np.int64) if len(at) else np.empty(0, np.int64)
                nodes = np.array([sequence_hash(hs[k]) for k in some], np.int64)
                each = [lists(start, per[some], pa.int32()), lists(content, per[some], pa.int64()), lists(keys, per[some] * bands, pa.int64())]
                yield pa.record_batch([pa.array(ids[i:j][some]), pa.array(nodes), pa.array(sizes[some].astype(np.int32)), *each], names=names)

    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return map_arrow(own, run, "doc_id long, node long, n int, starts array<int>, contents array<bigint>, keys array<bigint>")


def text_words(docs: DataFrame, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """wanted: node, kind, at. Returns node, kind, at, words (32-bit hashes). The texts are read once for all of them."""
    asked = wanted.groupBy("node").agg(F.collect_set(F.struct("kind", "at")).alias("asked"))
    asked = asked.join(nodes.select("node", F.col("first_id").alias("doc_id")), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            out_node, out_kind, out_at, words, sizes = [], [], [], [], []
            for node, text, asked in zip(batch.column("node").to_pylist(), batch.column("text"), batch.column("asked"), strict=True):
                h = word_hashes(text.as_py(), known)
                if sequence_hash(h) != node:  # another text of a doc_id that repeats
                    continue
                h = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for kind, at in zip(asked.values.field("kind").to_pylist(), asked.values.field("at").to_pylist(), strict=True):
                    part = h[at : at + WORDS] if kind == PARAGRAPH else h[max(0, at - WINDOW) : at][::-1] if kind == BEFORE else h[at : at + WINDOW]
                    out_node.append(node)
                    out_kind.append(kind)
                    out_at.append(at)
                    words.append(part)
                    sizes.append(len(part))
            flat = lists(np.concatenate([np.empty(0, np.int32), *words]), np.array(sizes, np.int64), pa.int32())
            yield pa.record_batch([pa.array(out_node, pa.int64()), pa.array(out_kind, pa.int32()), pa.array(out_at, pa.int32()), flat], names=["node", "kind", "at", "words"])

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(asked, "doc_id").select("node", "text", "asked")
    # A row that repeats gives its words again.
    return map_arrow(joined, run, "node long, kind int, at int, words array<int>").dropDuplicates(["node", "kind", "at"])


# ---- near paragraphs


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x, y: (pairs, WORDS) words. Whether the exact Jaccard similarity of their shingle sets is SIMILARITY or more."""
    out = np.empty(len(x), bool)
    for k in range(0, len(x), 4096):
        a, b = (np.sort(run_hashes(z[k : k + 4096].view(np.uint32).astype(np.uint64), SHINGLE), axis=1) for z in (x, y))
        new_a, new_b = (np.column_stack([np.ones(len(z), bool), z[:, 1:] != z[:, :-1]]) for z in (a, b))
        both = ((a[:, :, None] == b[:, None, :]).any(axis=2) & new_a).sum(axis=1)
        out[k : k + 4096] = both >= SIMILARITY * (new_a.sum(axis=1) + new_b.sum(axis=1) - both) - 1e-9
    return out


def bit_maps(words: np.ndarray) -> np.ndarray:
    """words: (contents, WORDS). (contents, 2): maps of 128 bits, in which each shingle of a content marks one."""
    at = run_hashes(words.view(np.uint32).astype(np.uint64), SHINGLE) % np.uint64(128)
    out = np.zeros((len(words), 2), np.uint64)
    for j in range(at.shape[1]):
        out[np.arange(len(words)), at[:, j] >> np.uint64(6)] |= np.uint64(1) << (at[:, j] & np.uint64(63))
    return out


def least_near(x: np.ndarray, x_ids: np.ndarray, y: np.ndarray, y_ids: np.ndarray) -> np.ndarray:
    """For each content of x the least id of y that is smaller than its own and whose content is near it, or -1.

    The contents of y come in the order of their ids, few at first, and what has found one is done, so many contents that are
    all near each other cost little. Maps rule pairs out before the shingles decide: a bit that one map has and the other
    lacks is a shingle that the other lacks, and of sets of at most 20 shingles near ones lack at most a fifth of their own.
    """
    out = np.full(len(x), -1, np.int64)
    order = np.argsort(y_ids, kind="stable")
    y, y_ids = y[order], y_ids[order]
    maps_x, maps_y = bit_maps(x), bit_maps(y)
    most = int((1 - SIMILARITY) * (WORDS - SHINGLE + 1) + 1e-9)
    at, step = 0, 16
    left = np.arange(len(x))
    while at < len(y):
        until = min(len(y), at + step)
        left = left[(out[left] < 0) & (x_ids[left] > y_ids[at])]
        if not len(left):
            break
        for k in range(0, len(left), max(1, 2**20 // (until - at))):
            rows = left[k : k + max(1, 2**20 // (until - at))]
            a, b = maps_x[rows][:, None, :], maps_y[None, at:until, :]
            can = (np.bitwise_count(a & ~b).sum(axis=2) <= most) & (np.bitwise_count(b & ~a).sum(axis=2) <= most)
            can &= x_ids[rows][:, None] > y_ids[None, at:until]
            i, j = np.nonzero(can)
            near = alike(x[rows[i]], y[at + j])
            i, j = i[near], j[near]
            first = np.full(len(rows), until)
            np.minimum.at(first, i, at + j)
            some = first < until
            out[rows[some]] = y_ids[first[some]]
        at, step = until, min(2048, 2 * step)
    return out


def words_of(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int32).reshape(-1, WORDS)


def verified(pairs: DataFrame) -> DataFrame:
    """pairs: x, y, words_x, words_y, id_x, id_y. Returns x, y, id_x, id_y of those that are near."""
    names = ["x", "y", "id_x", "id_y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(names).filter(pa.array(alike(words_of(batch.column("words_x")), words_of(batch.column("words_y")))))

    return map_arrow(pairs, run, "x long, y long, id_x long, id_y long")


def shingles_of(words: DataFrame) -> DataFrame:
    """words: content, words. Returns content and each of its distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(x).view(np.int64) for x in run_hashes(words_of(batch.column("words")).view(np.uint32).astype(np.uint64), SHINGLE)]
            yield pa.record_batch([batch.column("content"), pa.array(sets, pa.list_(pa.int64()))], names=["content", "shingles"])

    return map_arrow(words, run, "content long, shingles array<bigint>").select("content", F.explode("shingles").alias("shingle"))


def rarest(words: DataFrame) -> DataFrame:
    """content and its rarest shingles: in any fixed order of shingles, near sets share one of their first ones."""
    each = settle(shingles_of(words), "shingles")
    total, counts = each.count(), each.groupBy("shingle").agg(F.count(F.lit(1)).alias("size"))
    ranked = spread_join(each, settle(counts, "counts"), "shingle", "size", total)
    sets = ranked.groupBy("content").agg(F.array_sort(F.collect_list(F.struct("size", "shingle"))).alias("s"))
    first = F.expr(f"slice(s, 1, size(s) - cast(ceil({SIMILARITY} * size(s) - 1e-9) as int) + 1)")
    return sets.select("content", F.explode(first).alias("x")).select("content", F.col("x.shingle").alias("shingle"))


def buckets(groups: DataFrame) -> DataFrame:
    """groups: content, id, keys. Returns key, content, id, size: the buckets with contents of several first texts.

    Contents that the same text has first are never held against each other: whoever has one of them later than that
    text loses it as an equal paragraph, and the text itself keeps its repeats.
    """
    each = groups.select("content", "id", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high").select("key", "size")
    shared = settle(shared, "shared")
    total = groups.agg(F.sum(F.size("keys"))).first()[0] or 0
    out = settle(spread_join(each, shared, "key", "size", total), "buckets")
    discard(shared)
    return out


def meetings(short: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """short: content, shingle (of its rarest); words: content, id, words, kin. Returns x and y, the members of two parts of the
    contents of several kins that share a shingle (y is null for the one part of all), x_part and y_part; and what to discard.

    Contents that share one of their rarest shingles are dealt over parts by their hash. Each part meets each part of the same
    shingle in a task, so the rows made are in proportion to the contents and the number of their parts, not to the pairs.
    """
    met = settle(short.join(words.select("content", "kin"), "content"), "met")
    several = met.groupBy("shingle").agg(F.min("kin").alias("low"), F.max("kin").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high").select("shingle", "size")
    several = settle(several.withColumn("parts", F.ceil(F.col("size") / PART).cast("int")), "several")
    dealt = spread_join(met.select("shingle", "content"), several, "shingle", "size", met.count()).join(words, "content")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("content"), "parts").cast("int"))
    lists = dealt.groupBy("shingle", "parts", "part").agg(F.collect_list(F.struct("content", "id", "words", "kin")).alias("members"))
    lists = settle(lists, "lists")
    discard(met, several)
    own = lists.where("parts = 1").select(F.col("members").alias("x"), F.lit(None).cast(lists.schema["members"].dataType).alias("y"), F.lit(0).alias("x_part"), F.lit(0).alias("y_part"))
    x = lists.where("parts > 1").select("shingle", F.col("members").alias("x"), F.col("part").alias("x_part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("y_part"))
    y = lists.where("parts > 1").select("shingle", F.col("part").alias("y_part"), F.col("members").alias("y"))
    return own.unionByName(x.join(y, ["shingle", "y_part"]).select("x", "y", "x_part", "y_part")), lists


def taken(members: pa.Array) -> tuple[np.ndarray, ...]:
    """content, id, kin and words of the members of a part."""
    return (*(members.field(c).to_numpy() for c in ("content", "id", "kin")), words_of(members.field("words")))


def near_crowded(words: DataFrame, short: DataFrame | None = None) -> DataFrame:
    """words: content, words, id. Returns content and near_id, the least smaller id of contents that are near it: a task gives
    the least id for each content of its part."""
    short = rarest(words.select("content", "words")) if short is None else short
    both, lists = meetings(short, words.withColumn("kin", F.col("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                content, ids, _, own = taken(x.values)
                _, other_ids, _, other = taken(y.values) if y.is_valid else (content, ids, ids, own)
                near = least_near(own, ids, other, other_ids)
                some = near >= 0
                yield pa.record_batch([pa.array(content[some]), pa.array(near[some])], names=["content", "near_id"])

    out = settle(map_arrow(both.select("x", "y"), run, "content long, near_id long").groupBy("content").agg(F.min("near_id").alias("near_id")), "near-crowded")
    discard(lists)
    return out


def links_between(x: np.ndarray, x_ids: np.ndarray, x_kin: np.ndarray, y: np.ndarray, y_ids: np.ndarray, y_kin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids of near contents, one of x and one of y, that connect all kins of which there are such pairs.

    Kins that are connected already are not compared again, so there are fewer pairs than kins.
    """
    kins, at_kin = np.unique(np.concatenate([x_kin, y_kin]), return_inverse=True)
    label, in_x, in_y = np.arange(len(kins)), at_kin[: len(x)], at_kin[len(x) :]
    maps_x, maps_y = bit_maps(x), bit_maps(y)
    most = int((1 - SIMILARITY) * (WORDS - SHINGLE + 1) + 1e-9)
    out_x, out_y = [], []
    at, step = 0, 16
    while at < len(y):
        until = min(len(y), at + step)
        for k in range(0, len(x), max(1, 2**20 // step)):
            rows = slice(k, k + max(1, 2**20 // step))
            can = label[in_x[rows]][:, None] != label[in_y[at:until]][None, :]
            if not can.any():
                continue
            a, b = maps_x[rows][:, None, :], maps_y[None, at:until, :]
            can &= (np.bitwise_count(a & ~b).sum(axis=2) <= most) & (np.bitwise_count(b & ~a).sum(axis=2) <= most)
            i, j = np.nonzero(can)
            near = alike(x[k + i], y[at + j])
            i, j = k + i[near], at + j[near]
            met, first = np.unique(np.column_stack([label[in_x[i]], label[in_y[j]]]), axis=0, return_index=True)
            for (p, q), n in zip(met.tolist(), first.tolist(), strict=True):
                while label[p] != p:
                    p = label[p]
                while label[q] != q:
                    q = label[q]
                if p != q:
                    label[max(p, q)] = min(p, q)
                    out_x.append(x_ids[i[n]])
                    out_y.append(y_ids[j[n]])
            while (label != label[label]).any():
                label = label[label]
        at, step = until, min(2048, 2 * step)
    return np.array(out_x, np.int64), np.array(out_y, np.int64)


def crowded_links(words: DataFrame, short: DataFrame, member: DataFrame) -> DataFrame:
    """words: content, words, id; member: node (an id) and component. Links a > b of ids that connect the components of which
    contents are near: with those that made the components, all near pairs are connected."""
    kin = words.join(member.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("kin", F.coalesce("component", "id"))
    both, lists = meetings(short, kin.drop("component"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                _, ids, kins, own = taken(x.values)
                _, other_ids, other_kins, other = taken(y.values) if y.is_valid else (None, ids, kins, own)
                a, b = links_between(own, ids, kins, other, other_ids, other_kins)
                yield pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    out = settle(map_arrow(both.where("x_part <= y_part").select("x", "y"), run, "a long, b long").distinct(), "crowded-links")
    discard(lists)
    return out


def near_contents(rows: DataFrame, words: DataFrame, linked: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """rows: key, content, id, size; words: content, words, id (the smallest of texts that have it), one row a content.

    Returns content and near_id, the least id of contents that are near it, if it is less than its own; if linked, also links
    a > b of ids that connect all near contents, those that are near a smaller id than theirs besides the least one too. In
    a small bucket all contents meet. Those of crowded ones meet by their rarest shingles.
    """
    side = lambda p: words.select(F.col("content").alias(p), F.col("words").alias(f"words_{p}"), F.col("id").alias(f"id_{p}"))
    look = lambda pairs: verified(pairs.distinct().join(side("x"), "x").join(side("y"), "y"))
    small = rows.where(F.col("size") <= BUCKET).select("key", "content", "id")
    met = small.toDF("key", "x", "id").join(small.toDF("key", "y", "other"), "key").where("other < id").select("x", "y")
    found = settle(look(met), "near-small")
    crowded = settle(rows.where(F.col("size") > BUCKET).select("content").distinct().join(words, "content"), "crowded")
    least = found.groupBy(F.col("x").alias("content")).agg(F.min("id_y").alias("near_id"))
    pairs = found.selectExpr("id_x as a", "id_y as b")
    links = settle(pairs.distinct(), "near-links") if linked else None
    if not crowded.isEmpty():
        short = settle(rarest(crowded.select("content", "words")), "rarest")
        first = near_crowded(crowded, short)
        least = settle(least.unionByName(first).groupBy("content").agg(F.min("near_id").alias("near_id")), "near-least")
        if linked:
            links = settle(links.unionByName(first.join(crowded, "content").selectExpr("id as a", "near_id as b")).distinct(), "near-links")
            links = links.unionByName(crowded_links(crowded, short, components(links)))
        discard(found, short)
    discard(crowded)
    return least, links


# ---- cuts


def runs_of(members: DataFrame) -> DataFrame:
    """members: node, own_id, start, content, f_node, f_start, f_id. Paragraphs in a row that repeat one run of one text.

    Returns node, own_id, a, b (first word and word after the last), f_node, f_a, f_b, f_id, content_a and content_b (the
    first and the last paragraph); first and last: the ends of all words around that some run covers without a gap. The
    windows hold one text's paragraphs.
    """
    order = Window.partitionBy("node").orderBy("start")
    before = F.lag(F.struct("start", "f_node", (F.col("start") - F.col("f_start")).alias("shift"))).over(order)
    joined = (F.col("start") - before["start"] <= WORDS) & (F.col("f_node") == before["f_node"]) & (F.col("start") - F.col("f_start") == before["shift"])
    each = members.withColumn("new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    out = each.groupBy("node", "own_id", "run", "f_node", "f_id").agg(
        F.min("start").alias("a"),
        (F.max("start") + WORDS).alias("b"),
        F.min("f_start").alias("f_a"),
        (F.max("f_start") + WORDS).alias("f_b"),
        F.min_by("content", "start").alias("content_a"),
        F.max_by("content", "start").alias("content_b"),
    )
    by_start = Window.partitionBy("node").orderBy("a", "b")
    apart = F.col("a") > F.coalesce(F.max("b").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    chained = out.drop("run").withColumn("chain", F.sum(F.when(apart, 1).otherwise(0)).over(by_start))
    whole = Window.partitionBy("node", "chain")
    return chained.withColumn("first", F.min("a").over(whole)).withColumn("last", F.max("b").over(whole)).drop("chain")


def ends_of(runs: DataFrame) -> DataFrame:
    """The ends of runs from which WINDOW words may lead out of what is covered: node, own_id, a, kind, at, f_node, f_at, content."""
    side = lambda kind, at: F.struct(F.lit(kind).alias("kind"), F.col(at).alias("at"), F.col(f"f_{at}").alias("f_at"), F.col(f"content_{at}").alias("content"))
    open_ = F.array_compact(F.array(F.when(F.col("a") - WINDOW < F.col("first"), side(BEFORE, "a")), F.when(F.col("b") + WINDOW > F.col("last"), side(AFTER, "b"))))
    return runs.select("node", "own_id", "a", "f_node", F.explode(open_).alias("end")).select("node", "own_id", "a", "f_node", "end.*")


def extended(runs: DataFrame, words: DataFrame) -> DataFrame:
    """runs with a and b moved outwards over the words in common there with f_node, or with another text of a smaller id.

    Where the words of f_node end, those of another text may go on. It has the same paragraph at the same end, so of all
    texts that do the least id is found for each beginning of the words beyond, and the longest beginning whose least id is
    smaller than the own one counts.
    """
    ends = settle(ends_of(runs), "ends")
    total = ends.count()
    own = ends.join(words.withColumnRenamed("words", "own"), ["node", "kind", "at"]).withColumn("place", F.struct("f_node", "kind", "f_at"))
    theirs = words.select(F.struct(F.col("node").alias("f_node"), "kind", F.col("at").alias("f_at")).alias("place"), F.col("words").alias("other"))
    asked = ends.groupBy(F.struct("f_node", "kind", "f_at").alias("place")).agg(F.count(F.lit(1)).alias("size"))
    asked = settle(asked.join(theirs, "place"), "places")
    differ = F.expr("array_position(zip_with(own, other, (x, y) -> x <=> y), false)")
    reach = F.when(differ > 0, differ - 1).otherwise(F.least(F.size("own"), F.size("other"))).cast("int")
    met = spread_join(own, asked, "place", "size", total).select("node", "own_id", "a", "kind", "own", F.struct("content", "kind").alias("where"), reach.alias("reach"))
    met = settle(met, "reach")
    several = settle(met.groupBy("where").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "several")
    beginnings = F.expr("transform(sequence(1, size(own)), n -> xxhash64(where, slice(own, 1, n)))")
    each = spread_join(met.where("size(own) > 0"), several, "where", "size", total).select("node", "own_id", "a", "kind", F.posexplode(beginnings).alias("n", "beginning"))
    each = settle(each, "beginnings")
    least = settle(each.groupBy("beginning").agg(F.min("own_id").alias("least_id"), F.count(F.lit(1)).alias("size")).where("size > 1"), "least")
    longer = spread_join(each, least, "beginning", "size", each.count()).where("least_id < own_id").select("node", "a", "kind", (F.col("n") + 1).alias("reach"))
    moves = met.select("node", "a", "kind", "reach").unionByName(longer)
    # A text's runs begin at different words, so a run and its moves meet in one aggregate.
    all_ = runs.select("node", "a", "own_id", "b", "f_id").unionByName(moves, allowMissingColumns=True).groupBy("node", "a")
    reached = [F.coalesce(F.max(F.when(F.col("kind") == k, F.col("reach"))), F.lit(0)).alias(c) for k, c in ((BEFORE, "before"), (AFTER, "after"))]
    moved = all_.agg(*[F.max(c).alias(c) for c in ("own_id", "b", "f_id")], *reached)
    out = settle(moved.select("node", "own_id", (F.col("a") - F.col("before")).alias("a"), (F.col("b") + F.col("after")).alias("b"), "f_id"), "extended")
    discard(ends, asked, met, several, each, least)
    return out


def links(docs: DataFrame) -> DataFrame:
    """doc_id, node, a, b (first word and word after the last), first_id: cuts that repeat a passage of first_id < doc_id."""
    return cuts_and_links(docs, False)[0]


def cuts_and_links(docs: DataFrame, linked: bool) -> tuple[DataFrame, DataFrame | None]:
    """The rows of links(); if linked, also links a > b of documents that connect all of near paragraphs."""
    bands, rows = tune()
    marks = settle(marked(docs, bands, rows), "marks")
    own = [F.first(c).alias(c) for c in ("n", "starts", "contents", "keys")]
    nodes = settle(marks.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), *own), "nodes")
    ids = settle(marks.select("doc_id", "node"), "ids")
    discard(marks)
    keys = F.expr(f"slice(keys, pos * {bands} + 1, {bands})").alias("keys")
    each = nodes.select("node", "first_id", "contents", "keys", F.posexplode("starts").alias("pos", "start")).select("node", "first_id", "start", F.expr("contents[pos]").alias("content"), keys)
    groups = each.groupBy("content").agg(F.min(F.struct("first_id", "node", "start", "keys")).alias("f"), F.max("first_id").alias("last_id"), F.count(F.lit(1)).alias("size"))
    groups = groups.select("content", F.col("f.first_id").alias("id"), F.col("f.node").alias("f_node"), F.col("f.start").alias("f_start"), "last_id", "size", F.col("f.keys").alias("keys"))
    groups = settle(groups, "groups")
    each = settle(each.drop("keys"), "paragraphs")
    texts = settle(nodes.select("node", "first_id", "n", "copies"), "texts")
    discard(nodes)
    total = each.count()
    bucketed = buckets(groups)
    met = settle(groups.drop("keys").join(bucketed.select("content").distinct(), "content", "left_semi"), "met")
    several = settle(groups.drop("keys").where("id < last_id"), "several")
    discard(groups)
    members = spread_join(each, several, "content", "size", total).where("first_id > id")
    runs = settle(runs_of(members.select("node", F.col("first_id").alias("own_id"), "start", "content", "f_node", "f_start", F.col("id").alias("f_id"))), "runs")
    discard(several)
    ends = ends_of(runs)
    asked = met.select(F.col("f_node").alias("node"), F.lit(PARAGRAPH).alias("kind"), F.col("f_start").alias("at"))
    asked = asked.unionByName(ends.select("node", "kind", "at")).unionByName(ends.select(F.col("f_node").alias("node"), "kind", F.col("f_at").alias("at")))
    words = settle(text_words(docs, asked, texts), "words")
    same = extended(runs, words.where(F.col("kind") != PARAGRAPH))
    contents = met.select("content", "id", F.col("f_node").alias("node"), F.col("f_start").alias("at"))
    contents = settle(contents.join(words.where(F.col("kind") == PARAGRAPH), ["node", "at"]).select("content", "words", "id"), "contents")
    discard(runs, words)
    near, connected = near_contents(bucketed, contents, linked)
    near = settle(near, "near-ids")
    discard(contents, bucketed)
    sized = settle(near.join(met.select("content", "size"), "content"), "sized")
    other = spread_join(each, sized, "content", "size", total).where("first_id > near_id")
    other = other.select("node", F.col("first_id").alias("own_id"), F.col("start").alias("a"), (F.col("start") + WORDS).alias("b"), F.col("near_id").alias("f_id"))
    cuts = same.unionByName(other).select(F.col("own_id").alias("doc_id"), "node", "a", "b", F.col("f_id").alias("first_id"))
    # Copies of a whole text: all their words repeat the first one's.
    copies = spread_join(ids, texts.where("copies > 1"), "node", "copies", ids.count()).where("doc_id > first_id")
    out = settle(cuts.unionByName(copies.select("doc_id", "node", F.lit(0).alias("a"), F.col("n").alias("b"), "first_id").distinct()), "links")
    discard(each, met, near, sized, same, texts, ids)
    return out, connected


def spans(found: DataFrame) -> DataFrame:
    """doc_id, node, spans (array of first word and word after the last), first_ids (documents that keep the passages).

    A document has at most as many paragraphs as words; its spans are merged by a fold over their sorted cuts.
    """
    each = found.groupBy("doc_id", "node").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("cuts"), F.array_sort(F.collect_set("first_id")).alias("first_ids"))
    merge = """aggregate(cuts, cast(array() as array<struct<a: int, b: int>>), (out, s) ->
        if(size(out) > 0 and s.a <= element_at(out, -1).b,
           concat(slice(out, 1, size(out) - 1), array(struct(element_at(out, -1).a as a, greatest(element_at(out, -1).b, s.b) as b))),
           concat(out, array(struct(s.a as a, s.b as b)))))"""
    return each.select("doc_id", "node", F.expr(merge).alias("spans"), "first_ids")


def report(docs: DataFrame) -> DataFrame:
    """One row for each document id with a repeated passage or that others repeat (and for each of its texts, if several).

    doc_id, spans, n_removed (words), first_ids (documents that keep what this one loses), component_id.
    """
    found, near = cuts_and_links(docs, True)
    own = spans(found).withColumn("n_removed", F.expr("aggregate(spans, 0, (n, x) -> n + x.b - x.a)").cast("long"))
    member = components(found.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b")).unionByName(near).distinct())
    out = member.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "component_id").join(own.drop("node"), "doc_id", "left")
    return out.select("doc_id", "component_id", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("first_ids", F.array().cast("array<bigint>")).alias("first_ids"), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"))


def cut(text: str, cuts: list[tuple[int, int]]) -> str:
    """text without the words of the cuts; what stood between kept words stays, a cut leaves one space."""
    ends = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in cuts:
        out.append(text[at : ends[a][0]].rstrip(" \t\n\x0b\x0c\r"))
        at = ends[b - 1][1]
        while at < len(text) and text[at] in " \t\n\x0b\x0c\r":
            at += 1
    return " ".join(x for x in [*out, text[at:]] if x)


def remove(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut from text; n_chars, if there is such a column, is set anew."""
    own = settle(spans(links(docs)).groupBy("doc_id").agg(F.collect_list(F.struct("node", "spans")).alias("spans")), "spans")
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("doc"), F.col("doc_id").cast("long").alias("id"))
    joined = packed.join(own.toDF("id", "spans"), "id", "left").select("doc", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column("doc").flatten(), strict=True))
            texts = columns["text"].to_pylist()
            for k, found in enumerate(batch.column("spans").to_pylist()):
                if found:
                    node = sequence_hash(word_hashes(texts[k], Hashes()))
                    for x in found:
                        if x["node"] == node:
                            texts[k] = cut(texts[k], [(s["a"], s["b"]) for s in x["spans"]])
            columns["text"] = pa.array(texts, pa.string())
            yield pa.record_batch([columns[c] for c in names], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_arrow(joined, run, kinds)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
