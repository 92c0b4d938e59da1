"""SimHash near-dedup with the generalised pigeonhole principle.

Each text gets a 64-bit fingerprint. Two fingerprints link at a Hamming distance of at most `radius`. Equal fingerprints
are grouped first, so copies cost one row. Bits are grouped into parts so that correlated bits share a part; a dynamic
programme gives each part a threshold t of -1 (part not used), 0 or more, with a sum of radius - parts + 1, at the least
estimated number of candidates and keys. If two fingerprints are within the radius, some part differs by at most its t
(the generalised pigeonhole principle), so they meet when one of them is written under every key within t of its part.

Bucket members are never paired off when a bucket is large: a bucket over BUCKET_PAIRS members is refined by the keys of
`half` neighbourhoods (all fingerprints within radius // 2 and radius - radius // 2 flips), which are linear in its
members and exact. No bucket is capped.

Defined results: words are runs without white space, A-Z lower-cased; a text of fewer words than a shingle is one
shingle; null and empty texts have fingerprint zero and are linked like others; repeated rows are one node; a null
doc_id gets a fingerprint and its component, and never names one unless no member has an id; a bit set in exactly half of
the hashes is 0; an empty table gives no rows; other columns are ignored, and carried through by keep_first().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_arrow, n_partitions, settle, spread_join
from .graph import components
from .shingles import Hashes, sequence_hash, shingle_set

BITS = 64
SEED = 42
#: Buckets up to this size are compared pair by pair.
BUCKET_PAIRS = 32
#: Fingerprints that the estimates of candidates may look at; they only steer the cost, never the result.
SAMPLE = 2000
#: The most keys that a part may write for one fingerprint.
KEYS = 64


def hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([h(b" ".join(words), SEED)], np.uint64)
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-shingle]]]
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)], np.uint64)


def fingerprint(hashed: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes. Long texts are summed in blocks."""
    if not len(hashed):
        return 0
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(hashed), 255):
        block = hashed[k : k + 255].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.add.reduce(np.unpackbits(block, axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > len(hashed), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            made = [fingerprint(hashes(t.as_py(), shingle)) for t in texts]
            yield pa.record_batch([batch.column("doc_id"), pa.array(made, pa.int64())], names=["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fp long")


# ---- the plan: parts of correlated bits, and their thresholds


def correlation(fps: DataFrame) -> np.ndarray:
    """The absolute correlation of every two bits over all fingerprints; each task sends 64 x 64 counts to be summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for k in range(0, len(fp), 65536):
                bits = np.unpackbits(fp[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        if n:
            cell = np.arange(BITS * BITS + 1)
            yield pa.record_batch([pa.array(cell), pa.array(np.append(total.ravel(), n))], names=["cell", "x"])

    sums = map_arrow(fps.select("fp"), run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).toPandas()
    if not len(sums):
        return np.zeros((BITS, BITS))
    x = np.zeros(BITS * BITS + 1)
    x[sums["cell"].to_numpy()] = sums["x"].to_numpy()
    n, both = x[-1], x[:-1].reshape(BITS, BITS) / x[-1]
    p = np.diag(both)
    scale = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return np.abs(np.where(scale > 0, (both - np.outer(p, p)) / np.maximum(scale, 1e-12), 0)) if n else np.zeros((BITS, BITS))


def grouped_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of about equal width: each starts with the most correlated free bits and takes the bits nearest to it."""
    free, out = set(range(BITS)), []
    widths = [BITS // parts + (k < BITS % parts) for k in range(parts)]
    for width in widths:
        left = sorted(free)
        inner = corr[np.ix_(left, left)].copy()
        np.fill_diagonal(inner, 0)
        part = [left[int(inner.sum(axis=1).argmax())]]
        while len(part) < width:
            rest = [b for b in left if b not in part]
            part.append(rest[int(corr[np.ix_(rest, part)].sum(axis=1).argmax())])
        free -= set(part)
        out.append(sorted(part))
    return out


def n_keys(width: int, t: int) -> int:
    from math import comb

    return sum(comb(width, d) for d in range(t + 1)) if t >= 0 else 0


def estimated(sample: np.ndarray, part: list[int], most: int, n: int) -> list[float]:
    """For t = -1 ... most: how many pairs of n fingerprints differ by at most t in this part.

    Counted on the sample's pairs; where they have none, as for independent bits.
    """
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, part].astype(np.float32)
    m = len(bits)
    counts = np.zeros(len(part) + 1)
    for k in range(0, m, 500):
        apart = (bits[k : k + 500] @ (1 - bits).T + (1 - bits[k : k + 500]) @ bits.T).astype(np.int64)
        counts += np.bincount(apart.ravel(), minlength=len(part) + 1)
    counts[0] -= m
    share = np.cumsum(counts) / max(m * (m - 1), 1)
    pairs = n * (n - 1) / 2
    return [0.0] + [pairs * max(float(share[t]), n_keys(len(part), t) / 2.0 ** len(part)) for t in range(most + 1)]


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t >= -1 of each part with the given sum at the least cost. cost[part][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, more in enumerate(row, -1):
                if s + t not in step or c + more < step[s + t][0]:
                    step[s + t] = (c + more, [*ts, t])
        best = step
    return best.get(total, (float("inf"), []))


def plan(fps: DataFrame, radius: int, n: int) -> list[tuple[list[int], int]]:
    """The used parts (bits, threshold): of all numbers of parts the cheapest in keys written and candidates."""
    share = min(1.0, SAMPLE / max(n, 1))
    sample = np.array([r[0] for r in fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(2 * SAMPLE).collect()], "<i8")
    corr = correlation(fps)
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for parts in range(2, radius + 2):
        cut = grouped_bits(corr, parts)
        most = [max(t for t in range(radius + 1) if n_keys(len(p), t) <= KEYS) for p in cut]
        cost = [[c + (n * n_keys(len(p), t) if t >= 0 else 0) for t, c in enumerate(estimated(sample, p, m, n), -1)] for p, m in zip(cut, most, strict=True)]
        c, ts = allocate(cost, radius - parts + 1)
        if c < best[0]:
            best = (c, [(p, t) for p, t in zip(cut, ts, strict=True) if t >= 0])
    return best[1]


# ---- probing and verifying


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def mask_of(bits: list[int] | tuple[int, ...]) -> int:
    return signed(sum(1 << b for b in bits))


def flips(bits: list[int], most: int) -> list[int]:
    """Masks of all sets of at most so many of the bits, the empty one first."""
    return [mask_of(c) for d in range(most + 1) for c in combinations(bits, d)]


def distance(a: str, b: str) -> str:
    return f"bit_count({a} ^ {b})"


def links(fps: DataFrame, radius: int, n: int) -> DataFrame:
    """fps: distinct fp. Returns edges a > b whose components are those of all pairs within the radius.

    In a small bucket every pair within the radius is an edge. In a large one members that share a neighbour within half
    the radius are linked to the smallest of them: those are within the radius for even radii; for odd ones the wider
    half is checked.
    """
    out, large = [], []
    for k, (bits, t) in enumerate(plan(fps, radius, n)):
        mask = mask_of(bits)
        key = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
        own = fps.select(key.alias("key"), "fp", F.lit(True).alias("home"))
        if t > 0:
            masks = F.array(*[F.lit(m).cast("long") for m in flips(bits, t)[1:]])
            probes = fps.select(F.explode(F.transform(masks, lambda m: key.bitwiseXOR(m))).alias("key"), "fp", F.lit(False).alias("home"))
            own = own.unionByName(probes)
        sizes = own.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("any_home")).where("size > 1 and any_home")
        rows = settle(own.join(sizes.drop("any_home"), "key"), f"part{k}")
        small = rows.where(F.col("size") <= BUCKET_PAIRS)
        pairs = small.where("home").select("key", F.col("fp").alias("x")).join(small.select("key", F.col("fp").alias("y")), "key")
        out.append(pairs.where(f"x != y and {distance('x', 'y')} <= {radius}").selectExpr("greatest(x, y) as a", "least(x, y) as b"))
        large.append(rows.where(F.col("size") > BUCKET_PAIRS).select("fp"))
    # A fingerprint is in large buckets of several parts at once: its neighbours are written once for all of them.
    crowded = settle(reduce(DataFrame.unionByName, large).distinct(), "crowded")
    return reduce(DataFrame.unionByName, [*out, shared_neighbours(crowded, radius)]).distinct()


def shared_neighbours(fps: DataFrame, radius: int) -> DataFrame:
    """Edges that connect all pairs within the radius, linear in the fingerprints: 1 + 64 neighbours for radius 2.

    A pair within the radius has a point between them, within radius // 2 of one and the rest of the other. Writing each
    fingerprint under all points within half brings both to it. For even radii any two that meet are within the radius,
    so a star to the smallest is right; radius 1 and other odd ones join the two kinds of points and check the distance.
    """
    low, high = radius // 2, radius - radius // 2
    near = F.array(*[F.lit(m).cast("long") for m in flips(list(range(BITS)), low)])
    points = fps.select(F.explode(F.transform(near, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"), "fp")
    if low == high:
        least = points.groupBy("key").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        return points.join(least, "key").where("fp != b").select(F.col("fp").alias("a"), "b")
    wide = F.array(*[F.lit(m).cast("long") for m in flips(list(range(BITS)), high)])
    reach = fps.select(F.explode(F.transform(wide, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"), F.col("fp").alias("y"))
    return points.join(reach, "key").where(f"fp != y and {distance('fp', 'y')} <= {radius}").selectExpr("greatest(fp, y) as a", "least(fp, y) as b")


def classes(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) and component_size, one row for each row of docs."""
    marks = settle(fingerprints(docs, shingle), "fingerprints")
    nodes = settle(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "nodes")
    n = nodes.count()
    edges = settle(links(nodes.select("fp"), radius, n), "links")
    member = components(edges)
    named = nodes.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("component_size"))
    named = settle(named.join(least, "component").select("fp", "copies", "component_id", "component_size"), "named")
    return with_nodes(marks, named)


def with_nodes(marks: DataFrame, named: DataFrame) -> DataFrame:
    """marks joined with named on fp; fingerprints of over a thousandth of all rows (so under 1000) are broadcast."""
    total = named.agg(F.sum("copies")).first()[0] or 0
    limit = max(1, total // 1000)
    hot = named.where(F.col("copies") > limit).select("fp", F.struct("component_id", "component_size").alias("hot"))
    cold = named.where(F.col("copies") <= limit).select(F.col("fp").alias("at"), "copies", F.struct("component_id", "component_size").alias("cold"))
    # A hot row looks for its own doc_id among the cold fingerprints of another kind (pad 1), finds nothing and is spread.
    out = marks.join(F.broadcast(hot), "fp", "left").select("*", F.when(F.col("hot").isNull(), F.col("fp")).otherwise(F.col("doc_id")).alias("at"), F.when(F.col("hot").isNull(), 0).otherwise(1).alias("pad"))
    out = out.join(cold.withColumn("pad", F.lit(0)), ["at", "pad"], "left")
    found = F.coalesce("cold", "hot")
    return out.select("doc_id", "fp", found["component_id"].alias("component_id"), found["component_size"].alias("component_size"))



# ---- near copies of lower similarity: candidates by fingerprints, then exact Jaccard of the shingle sets

#: Fingerprints of near copies that the pigeonhole join finds; what differs by more bits meets by prefixes of the sets.
RADIUS = 2

#: Words of 64 bits in a map of a set, in which each shingle marks one bit; sets of over FILL shingles have maps of twice as
#: many words, and so on, so that at most a quarter of a map is marked.
WIDE, FILL = 16, 256
#: Texts are near from a Jaccard similarity of NEAR[0] / NEAR[1] on.
NEAR = (4, 5)
#: Shingles in the prefixes of over so many texts, and of over one in RARE of all, come last in the order of prefixes.
COMMON, RARE = 32, 15_000
#: So many popular texts of a crowded bucket (over BUCKET_PAIRS) are tried before its members are compared with each other.
LEADERS = 16
#: Up to so many nodes (16 bytes each) are sent to all tasks that read texts, so the texts themselves aren't exchanged.
SENT = 1_000_000
#: Crowded buckets are compared in parts of about so many texts; a bucket of one part is not copied.
PART = 16_384


def bit_map(hashed: np.ndarray) -> np.ndarray:
    """Which of the bits of a map the hashes fall on. A bit that one map has and another lacks is a shingle that the other
    lacks, so the bits bound from above what two sets share. The map of half the size is the or of a map's halves."""
    width = WIDE << max(0, int(-(-len(hashed) // FILL) - 1).bit_length())
    out = np.zeros(width * BITS, np.uint8)
    out[(hashed % np.uint64(width * BITS)).astype(np.intp)] = 1
    return np.packbits(out, bitorder="little").view("<i8").astype(np.int64)


def prefix(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first hashes of a set, common ones last. Two sets that are near have one of these in common, in any fixed order."""
    if len(common):
        last = np.isin(own, common)
        own = np.concatenate([own[~last], own[last]])
    return own[: len(own) - -(-NEAR[0] * len(own) // NEAR[1]) + 1]


def common_keys(docs: DataFrame, shingle: int) -> np.ndarray:
    """The hashes that are in the prefixes, by hashes alone, of too many texts, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, known = np.empty(0, np.uint64), Hashes()
        for batch in batches:
            keys = [prefix(shingle_set(t.as_py(), shingle, known), none).view(np.int64) for t in batch.column("text")]
            yield pa.record_batch([pa.array(np.concatenate([np.empty(0, np.int64), *keys]))], names=["key"])

    named = docs.where("doc_id is not null").select("text")
    limit = max(COMMON, named.count() // RARE)
    found = settle(map_arrow(named, run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).select("key"), "common")
    out = np.sort(np.array(found.toArrow().column(0).to_numpy(), np.int64).view(np.uint64))
    discard(found)
    return out


def signatures(docs: DataFrame, shingle: int, common: np.ndarray) -> DataFrame:
    """doc_id, node (hash of the shingle set), n (its size), fp (its fingerprint), bits (its map) and keys (its prefix)."""
    sent = docs.sparkSession.sparkContext.broadcast(common)
    names = ["doc_id", "node", "n", "fp", "bits", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, known = sent.value, Hashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle, known) for t in batch.column("text")]
            nodes = pa.array([sequence_hash(s) for s in sets], pa.int64())
            fps = pa.array([fingerprint(s) for s in sets], pa.int64())
            bits = pa.array([bit_map(s) for s in sets], pa.list_(pa.int64()))
            keys = pa.array([prefix(s, late).view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column("doc_id"), nodes, pa.array([len(s) for s in sets], pa.int64()), fps, bits, keys], names=names)

    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return map_arrow(named, run, "doc_id long, node long, n long, fp long, bits array<bigint>, keys array<bigint>")


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """wanted: node, first_id. Returns node and its set as `hashes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle, known) for t in batch.column("text")]
            nodes = np.array([sequence_hash(s) for s in sets], np.int64)
            # A doc_id that repeats with other texts brings those too.
            mine = np.flatnonzero(nodes == batch.column("node").to_numpy())
            yield pa.record_batch([pa.array(nodes[mine]), pa.array([sets[k].view(np.int64) for k in mine], pa.list_(pa.int64()))], names=["node", "hashes"])

    wanted = settle(wanted.select("node", "first_id"), "wanted")
    asked = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(asked, "first_id")
    return map_arrow(texts.select("node", "text"), run, "node long, hashes array<bigint>")


def may_be_near(a: str, b: str) -> str:
    """Whether two sets can be near, by their sizes and maps (columns n and bits with these endings). No near pair is ruled
    out: what a set shares is at most its size less the bits that the other lacks, and near sets share 4/9 of both sizes.
    Maps of near sets have the same size, or one twice the other's and is halved."""
    short = lambda x, y: " + ".join(f"bit_count(bits_{x}[{j}] & ~bits_{y}[{j}])" for j in range(WIDE))
    half = lambda x: f"zip_with(slice(bits_{x}, 1, size(bits_{x}) div 2), slice(bits_{x}, size(bits_{x}) div 2 + 1, size(bits_{x}) div 2), (p, q) -> p | q)"
    fit = lambda x, y: f"if(size(bits_{x}) > size(bits_{y}), {half(x)}, bits_{x})"
    long = lambda x, y: f"aggregate(zip_with({fit(x, y)}, {fit(y, x)}, (p, q) -> bit_count(p & ~q)), 0, (total, c) -> total + c)"
    both_short = f"size(bits_{a}) = {WIDE} and size(bits_{b}) = {WIDE}"
    enough = lambda x, y, lacks: f"{sum(NEAR)} * (n_{x} - ({lacks(x, y)})) >= {NEAR[0]} * (n_{x} + n_{y})"
    tested = " else ".join([f"when {both_short} then {enough(a, b, short)} and {enough(b, a, short)}", f"{enough(a, b, long)} and {enough(b, a, long)}"])
    return f"{NEAR[1]} * least(n_{a}, n_{b}) >= {NEAR[0]} * greatest(n_{a}, n_{b}) and case {tested} end"


def first_common(a: str, b: str) -> str:
    """Whether a key can be the first that two near sets have in common, by its places in their orders (pos, from 0). All that
    near sets share, 4/9 of both sizes or more, then stands at or after it in both, so every near pair meets at such a key."""
    return " and ".join(f"{sum(NEAR)} * (n_{x} - pos_{x}) >= {NEAR[0]} * (n_{a} + n_{b})" for x in (a, b))


def side(nodes: DataFrame, p: str) -> DataFrame:
    return nodes.select(F.col("node").alias(p), F.col("n").alias(f"n_{p}"), F.col("bits").alias(f"bits_{p}"))


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """pairs: a, b of nodes that can be near. Those that are: the sets themselves decide."""
    pairs = settle(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = settle(sets_of(docs, wanted.join(nodes.select("node", "first_id"), "node"), shingle).dropDuplicates(["node"]), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                both = len(np.intersect1d(np.asarray(x.values), np.asarray(y.values), assume_unique=True))
                keep.append(NEAR[1] * both >= NEAR[0] * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    out = settle(map_arrow(joined, run, "a long, b long"), "near")
    discard(pairs, sets)
    return out


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """nodes: node, fp. Pairs a > b of nodes whose fingerprints are within RADIUS, by the pigeonhole join.

    Nodes of one fingerprint are paired with the smallest of them, and those of two fingerprints that link with each other.
    """
    groups = settle(nodes.groupBy("fp").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("size")), "fingerprints")
    edges = settle(links(groups.select("fp"), RADIUS, groups.count()), "links")
    same = spread_join(nodes.select("node", "fp"), groups.where("size > 1"), "fp", "size", nodes.count()).where("node != least").select("node", "least")
    both = edges.join(groups.select(F.col("fp").alias("a"), F.col("least").alias("node")), "a").join(groups.select(F.col("fp").alias("b"), "least"), "b").select("node", "least")
    out = settle(same.unionByName(both).selectExpr("greatest(node, least) as a", "least(node, least) as b").distinct(), "fingerprint-pairs")
    discard(groups, edges)
    return out


def near_links(docs: DataFrame, nodes: DataFrame, keys: DataFrame, shingle: int) -> DataFrame:
    """Links a > b of nodes whose components are those of all near pairs: no pair and no bucket is left out. keys: node, n,
    keys; it is discarded.

    Pairs of fingerprints within RADIUS are the first candidates. Near sets may differ by more bits than any radius that
    the pigeonhole join can afford, but share a hash of their prefixes. All members of such a bucket are held against its most
    popular one, whose keys most others have: the text that a group of near copies is made from. That joins a large group at
    a cost in proportion to it. The sets decide on both kinds of candidates. Members of crowded buckets that this leaves apart
    are held against further popular ones. Then the members of one bucket that are not connected yet are compared with each
    other; the key's places, sizes and maps of the sets rule out pairs that can't be near before they are made.

    The smaller of two near sets has their first common key in its first ninth, so a bucket without such a member (early) is
    only of use for its popular texts.
    """
    alike = fingerprint_pairs(nodes)
    wide = keys.select("node", "n", F.posexplode("keys").alias("pos", "key"))
    wide = wide.select("node", "key", "pos", F.expr(f"{sum(NEAR)} * (n - pos) >= {2 * NEAR[0]} * n").alias("early"))
    total = keys.agg(F.sum(F.size("keys"))).first()[0] or 0
    shared = settle(wide.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    rows = settle(spread_join(wide, shared, "key", "size", total), "rows")
    discard(keys, shared)
    popular = rows.groupBy("node").agg(F.sum("size").alias("popularity"))
    first = settle(rows.join(popular, "node").groupBy("key").agg(F.max(F.struct("popularity", "node"))["node"].alias("first"), F.count(F.lit(1)).alias("of")), "first")
    star = spread_join(rows.select("key", "node"), first, "key", "of", total).where("node != first")
    star = settle(star.selectExpr("greatest(node, first) as a", "least(node, first) as b").unionByName(alike).distinct(), "star")
    discard(first, alike)
    can = star.join(side(nodes, "a"), "a").join(side(nodes, "b"), "b").where(may_be_near("a", "b")).select("a", "b")
    near = verified(docs, nodes, can, shingle)
    discard(star)
    rest = settle(named_by(rows, components(near)), "components")
    discard(rows)
    mixed = settle(mixed_of(rest).where(f"early or size > {BUCKET_PAIRS}").drop("early"), "mixed")
    met = settle(spread_join(rest.drop("size"), mixed, "key", "size", total), "met")
    discard(rest, mixed)
    crowded = met.where(F.col("size") > BUCKET_PAIRS)
    if not crowded.isEmpty():
        star = settle(leader_pairs(crowded), "leader-pairs")
        can = star.join(side(nodes, "a"), "a").join(side(nodes, "b"), "b").where(may_be_near("a", "b")).select("a", "b")
        near = near.unionByName(verified(docs, nodes, can, shingle))
        rest = settle(named_by(met.drop("component", "size"), components(near)), "components")
        mixed = settle(mixed_of(rest).where("early").drop("early"), "mixed")
        discard(star, met)
        met = settle(spread_join(rest, mixed, "key", "size", total), "met")
        discard(rest, mixed)
    rest = settle(met.drop("early").join(nodes.select("node", "n", "bits"), "node"), "rest")
    discard(met)
    more = verified(docs, nodes, pairs_of(rest).distinct(), shingle)
    discard(rest)
    return near.unionByName(more)


def named_by(rows: DataFrame, member: DataFrame) -> DataFrame:
    """rows with the component of their node, itself where it is connected with none."""
    return rows.join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))


def mixed_of(rows: DataFrame) -> DataFrame:
    """key, size and early (whether any member is) of the buckets whose members are of several components."""
    ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"), F.max("early").alias("early"))
    return ends.where("low < high").select("key", "size", "early")


def leader_pairs(crowded: DataFrame) -> DataFrame:
    """crowded: key, node, pos, component and size, of buckets of over LEADERS members. Pairs a > b of members of two components.

    Each key of a text, by its place, is held against another one of the LEADERS most popular members of its
    bucket: a row for each member and key at most. Texts of a large group share most of their keys, so many leaders are tried
    on each.
    """
    popular = crowded.groupBy("node").agg(F.sum("size").alias("popularity"))
    turns = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("popularity"), "node"))
    ranked = crowded.join(popular, "node").select("key", turns.alias("turn"), F.col("node").alias("leader"), F.col("component").alias("led"))
    leaders = ranked.where(F.col("turn") <= LEADERS).withColumn("turn", F.col("turn") - 1)
    tried = crowded.withColumn("turn", F.col("pos") % LEADERS).join(leaders, ["key", "turn"]).where("component != led")
    return tried.selectExpr("greatest(node, leader) as a", "least(node, leader) as b").distinct()


def pairs_of(rest: DataFrame) -> DataFrame:
    """rest (settled): key, node, component, n, bits, size and pos, the key's place in the text's order (0 if there is no such
    column). Returns the pairs a > b of a bucket, of two components, that can be near and have the key as their first.

    A bucket of up to PART members is exchanged once, for both sides. Each part of a larger one meets the whole bucket in a
    task of its own.
    """
    n, columns = n_partitions(rest.sparkSession), ("node", "component", "n", "pos", "bits")
    rest = rest if "pos" in rest.columns else rest.withColumn("pos", F.lit(0))
    named = {p: [F.col("node").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in columns[1:]]] for p in ("a", "b")}
    can = f"a > b and component_a != component_b and {first_common('a', 'b')} and {may_be_near('a', 'b')}"
    one = rest.where(F.col("size") <= PART).select("key", *columns).repartition(n, "key")
    out = one.select("key", *named["a"]).join(one.select("key", *named["b"]), "key").where(can).select("a", "b")
    large = rest.where(F.col("size") > PART)
    if large.isEmpty():
        return out
    parts = F.expr(f"cast(ceil(size / {PART}.0) as int)")
    part = {"a": F.pmod(F.xxhash64("node"), parts).cast("int"), "b": F.explode(F.sequence(F.lit(0), parts - 1))}
    x, y = (large.select("key", part[p].alias("part"), *named[p]).repartition(n, "key", "part") for p in ("a", "b"))
    return out.unionByName(x.join(y, ["key", "part"]).where(can).select("a", "b"))


def near_classes(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """doc_id and component_id of the documents that are near another one. Equal sets of shingles are one node."""
    marks = settle(signatures(docs, shingle, common_keys(docs, shingle)), "signatures")
    nodes = settle(marks.groupBy("node").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("n", "fp", "bits")]), "nodes")
    ids = settle(marks.select("doc_id", "node"), "ids")
    keys = settle(marks.groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys")), "keys")
    discard(marks)
    member = components(near_links(docs, nodes, keys, shingle))
    least = member.join(nodes.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = member.join(least, "component").select("node", "component_id")
    copies = ids.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size")).where("size > 1").select("node", "first_id")
    named = linked.join(copies, "node", "full").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    out = settle(ids.join(named, "node").select("doc_id", "component_id"), "near-classes")
    discard(nodes, ids)
    return out


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the documents that are near one of a smaller doc_id of their component. Null doc_ids stay.

    Rows that repeat a doc_id share its verdict.
    """
    gone = near_classes(docs).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
