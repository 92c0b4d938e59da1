"""Resampling, lexical search and phrase fingerprints against brute force, with odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from viaduct.llm import fingerprints, lexical, resampling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def made_up(n=250, seed=9):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdéß中0") for _ in range(rnd.randrange(1, 6))) for _ in range(400)]
    line = lambda k: rnd.choice([" ", "_", ", "]).join(rnd.choice(vocab[: rnd.choice([20, 400])]).upper() if rnd.random() < 0.2 else rnd.choice(vocab) for _ in range(k))
    rows = [line(rnd.randrange(1, 90)) for _ in range(n)]
    rows += [rows[3]] * 40 + [None, "", " .,\n", "É İK\x85x\xa0y", "same " * 300, line(20_000), "x" * 50_000]
    out = [(i, t) for i, t in enumerate(rows)] + [(3, rows[3])] * 5 + [(None, rows[5]), (None, "no id " * 15), (None, None)]
    return [(i, t, "en", None, 0) for i, t in out], [(k, line(rnd.randrange(1, 40))) for k in range(30)] + [(30, None), (31, "..."), (32, rows[7]), (32, "again again"), (None, rows[9])]


@pytest.fixture(scope="module")
def rows():
    return made_up()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows[0], DOCS).repartition(5)


@pytest.fixture(scope="module")
def items(spark, rows):
    return spark.createDataFrame(rows[1], ITEMS)


def brute_resample(docs, target, longest, percent):
    def runs(text):
        w = [x.encode() for x in TERM.findall(small(text))]
        return w, [b" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    bucket = lambda x: zlib.crc32(x) % 10000
    s, t = (Counter(bucket(x) for _, text in rows for x in runs(text)[1]) for rows in (docs, target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out = []
    for i, text in docs:
        w, f = runs(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(x)) for x in f)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    draw = percent * len(able) // 100
    ranks = Counter((*r[:1], *r[2:], k + 1 if k < draw else None) for k, r in enumerate(able))
    return ranks + Counter((*r[:1], *r[2:], None) for r in out if r[1] < 20)


@pytest.mark.parametrize(("longest", "percent", "segment"), [(1, 10, 1_000_000), (2, 60, 20), (3, 100, 7)])
def test_resampling_is_brute_force(docs, items, rows, longest, percent, segment):
    gain = resampling.gains(resampling.bucket_counts(docs, longest), resampling.bucket_counts(items, longest))
    runs = resampling.scored_runs(docs, gain, longest).persist()
    n = runs.where("place is not null").count()
    got = Counter(tuple(r) for r in resampling.ranked(runs, percent * n // 100, n, segment).collect())
    assert got == brute_resample([r[:2] for r in rows[0]], [r[:2] for r in rows[1]], longest, percent)
    runs.unpersist()


def test_resampling_of_odd_tables(spark, docs, items):
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert resampling.resample(none, items).count() == 0
    plain = resampling.resample(docs, no_items).collect()
    odd = docs.withColumnsRenamed({"lang": "score", "source": "run", "n_chars": "segment"})
    assert Counter(plain) == Counter(resampling.resample(odd, no_items).collect()) and len(plain) == docs.count()
    drawn = resampling.drawn(docs, items, 50)
    ids = {r.doc_id for r in resampling.resample(docs, items, 50).collect() if r.rank}
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == ids - {None}


def test_equal_rows_are_cut_into_segments(spark):
    same = spark.createDataFrame([(7, "word " * 25, "en", None, 0)] * 900 + [(k, "other word " * 20, "en", None, 0) for k in range(100)], DOCS).repartition(6)
    runs = resampling.scored_runs(same, np.zeros(resampling.BUCKETS, np.int64)).persist()
    cut = resampling.segmented(runs, resampling.regular_splitters(runs, 1000, 20))
    assert cut.count() == 1000 and max(r["count"] for r in cut.groupBy("segment").count().collect()) <= 120
    ranks = sorted(r.rank for r in resampling.ranked(runs, 1000, 1000, 50).collect())
    assert ranks == list(range(1, 1001))
    runs.unpersist()


def brute_search(docs, items, most):
    vectors = [(i, Counter(TERM.findall(small(t)))) for i, t in docs]
    vectors = [(i, c) for i, c in vectors if c]
    n, total = len(vectors), sum(c.total() for _, c in vectors)
    df = Counter(t for _, c in vectors for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(TERM.findall(small(t)))
    out = Counter()
    for item, q in asked.items():
        found = []
        for i, c in vectors:
            m = 75 + 25 * c.total() * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            found += [(-score, i is None, i)] if score > 0 else []
        for rank, (score, _, i) in enumerate(sorted(found)[:most], 1):
            out[item, rank, i, -score] += 1
    return out


@pytest.mark.parametrize(("most", "block", "batch"), [(20, 1 << 18, 200_000), (20, 300, 100), (3, 40, 200_000)])
def test_search_is_brute_force(docs, items, rows, monkeypatch, most, block, batch):
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(lexical, "BATCH_TERMS", batch)
    got = Counter(tuple(r) for r in lexical.ranked(docs, items, most).collect())
    assert got == brute_search([r[:2] for r in rows[0]], rows[1], most)


def test_index_is_searched_again_and_clashing_columns(spark, docs, items, rows):
    index = lexical.build(docs.withColumnsRenamed({"lang": "term", "source": "block", "n_chars": "m"}))
    first = Counter(tuple(r) for r in lexical.search(index, items).collect())
    assert first == Counter(tuple(r) for r in lexical.search(index, items.withColumn("no", items["item_id"])).collect()) == brute_search([r[:2] for r in rows[0]], rows[1], 20)
    assert lexical.search(index, spark.createDataFrame([], ITEMS)).count() == 0
    index.drop()
    assert lexical.ranked(spark.createDataFrame([], DOCS), items).count() == 0


def test_visits_are_in_the_order_of_bounds_and_stop(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(lexical, "ENTRIES", 50)
    blocks = []
    for k in range(8):
        held = rng.integers(1, 5, (6, 30)) * (rng.random((6, 30)) < 0.4)
        worth = lexical.impact(held, 80 + 60 * k)
        slots = np.concatenate([np.flatnonzero(r) for r in held])
        sizes = np.cumsum([0, *(held > 0).sum(axis=1)])
        blocks.append((lexical.Block(np.arange(30) + 30 * k, sizes[:-1], sizes[1:], worth.max(axis=1), slots, np.concatenate([w[w > 0] for w in worth])), worth))
    items = lexical.Items([10, 11], np.array([0, 6, 9]), np.array([0, 1, 2, 3, 4, 5, 1, 3, 5]), rng.integers(1, 2000, 9))
    seen = []
    scored = lexical.score_block
    monkeypatch.setattr(lexical, "score_block", lambda b, *a: (seen.append(int(b.docs[0])), scored(b, *a)))
    best = lexical.visit([b for b, _ in blocks], items, 4)
    for k, ids in enumerate((range(6), range(6, 9))):
        all_scores = sorted((-int(sum(items.gain[p] * w[items.term[p], d] for p in ids)), 30 * j + d) for j, (_, w) in enumerate(blocks) for d in range(30))
        assert [(-s, d) for s, d in all_scores[:4]] == list(zip(best.score[k].tolist(), best.doc[k].tolist(), strict=True))
    assert len(seen) < 16
    assert lexical.sums(np.array([0, 0]), np.array([2**60, 2**60 + 1]), 1)[0] == 2**61 + 1


def phrases(text):
    """A plain parse, for texts within one window."""
    known, open_ = set(), ""
    for c in text:
        open_ += c
        if open_ not in known:
            known.add(open_)
            open_ = ""
    return known


def test_fingerprints_are_brute_force(spark, docs, rows):
    def signature(text):
        parse = fingerprints.Parse()
        parse.read(text)
        return parse.signature()

    for n in (1, 6):
        table = docs if n == 6 else docs.repartition(1)
        got = Counter(tuple(r) for r in fingerprints.fingerprints(table).collect())
        ordered = {r[:2]: None for r in rows[0]}
        by_id = [(i, t or "") for i, t in sorted(((r[0], r[1]) for r in rows[0]), key=lambda r: (r[0] is not None, r[0]))]
        assert sum(got.values()) == len(by_id) and len(ordered) < len(by_id)
        nulls = sum(i is None for i, _ in by_id)
        for k, (i, text) in enumerate(by_id):
            if i is None or k + 1 < len(by_id) and k < nulls:
                continue  # rows without an id are in the order of a hash
            if k + 1 == len(by_id):
                continue
            cut, following = len(text) // 4, by_id[k + 1][1]
            edited = text[: len(text) - cut] + following[:cut]
            a, b, c = map(signature, (text, edited, following))
            assert got[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), fingerprints.likeness(a, b), fingerprints.likeness(a, c)] >= 1
    last = [r for r in got if r[0] == max(i for i, _ in by_id if i is not None)]
    assert len(last) == 1  # goes on with the first row


def test_likeness_is_that_of_the_phrase_sets():
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefghijklmno") for _ in range(5)) for _ in range(500)]
    for share in (0.0, 0.3, 0.6, 0.9):
        a = " ".join(rnd.choice(vocab) for _ in range(1500))
        b = a[: int(len(a) * share)] + " ".join(rnd.choice(vocab) for _ in range(1500))[: int(len(a) * (1 - share))]
        x, y = phrases(a), phrases(b)
        p, q = fingerprints.Parse(), fingerprints.Parse()
        p.read(a)
        q.read(b)
        assert abs(fingerprints.likeness(p.signature(), q.signature()) - len(x & y) / len(x | y)) < 0.15


def test_parse_goes_on_in_pieces_and_over_windows(monkeypatch):
    monkeypatch.setattr(fingerprints, "WINDOW", 100)
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcé中") for _ in range(1010))
    whole = fingerprints.Parse()
    whole.read(text)
    for cut in (0, 1, 99, 100, 101, 555, 1010):
        part = fingerprints.Parse()
        part.read(text[:cut])
        fork = part.fork()
        fork.read(text[cut:])
        assert fork.signature() == whole.signature()
    each = np.concatenate([fingerprints.phrase_hashes(dict.fromkeys(sorted(phrases(text[k : k + 100])))) for k in range(0, 1010, 100)])
    assert fingerprints.signature(each) == whole.signature()


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints.fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    one = fingerprints.fingerprints(spark.createDataFrame([(4, "abcdefgh" * 9, "en", None, 0)], DOCS)).first()
    assert one.near_next == 1.0 and one.n_chars == 72
    odd = spark.createDataFrame([(1, None, "a", "b", 0), (2, "", "a", "b", 0), (3, "text of some length", "a", "b", 0)], "doc_id long, text string, task string, is_last string, row long")
    got = {r.doc_id: r for r in fingerprints.fingerprints(odd).collect()}
    assert (got[1].near_next, got[2].near_next, got[2].near_edited, got[1].fingerprint) == (1.0, 0.0, 1.0, "0" * 512)
