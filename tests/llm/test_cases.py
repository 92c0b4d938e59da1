"""Odd inputs and brute force for the training-data operators: repeated rows, long texts, ties, clashing columns, recall."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from viaduct.llm import bpe, exact_dedup, language, packing, quality, sharding, simhash, substrings, token_counts, toxicity
from viaduct.llm.tokens import default_path, load

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n, size=10**6):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


# ---- token counts and BPE


@pytest.mark.parametrize(("chunk", "overlap"), [(8000, 200), (300, 20), (100, 4)])
def test_counts_in_any_script(chunk, overlap):
    path, rnd = default_path("byte_bpe_50k.json"), random.Random(chunk)
    t = load(path)
    pools = ["abc'st re ll 12  ", "абвгд ежз", "日本語。漢字、", "###!!''s", "\x1c\x85\xa0 \t\n", "👍🏽é̀ﬁ٣Ⅷ", "العربية "]
    for _ in range(60):
        pool = rnd.sample(pools, rnd.randrange(1, 4))
        text = "".join(rnd.choice(["<|endoftext|>", "'ll", "don't"]) if rnd.random() < 0.02 else rnd.choice(rnd.choice(pool)) for _ in range(rnd.randrange(chunk, 4 * chunk if chunk < 1000 else 12_000)))
        assert token_counts.resynchronised(text, path, chunk, overlap) == len(t.encode(text, add_special_tokens=False).ids)


def test_counts_take_about_the_librarys_time():
    import time

    path, rnd = default_path("byte_bpe_50k.json"), random.Random(2)
    t = load(path)
    for text in (" ".join("".join(rnd.choice("абвгдежз") for _ in range(6)) for _ in range(40_000)), "".join(rnd.choice("日本語漢字仮名") for _ in range(200_000)), "ab" * 100_000):
        began = time.process_time()
        n = len(t.encode(text, add_special_tokens=False).ids)
        mid = time.process_time()
        assert token_counts.resynchronised(text, path) == n
        assert time.process_time() - mid < 6 * (mid - began) + 0.5  # was without bound; twice is usual


def test_bpe_of_code_points_newer_than_pythons_tables():
    import unicodedata

    t, own, rnd = load(default_path("word_bpe_49k.json")), bpe.BPE(default_path("word_bpe_49k.json")), random.Random(7)
    newer = [chr(c) for c in range(0x500, 0x32000, 7) if unicodedata.category(chr(c)) == "Cn"]
    texts = ["".join(rnd.choice(newer) if rnd.random() < 0.2 else rnd.choice("abc Éß'st 12") for _ in range(30)) + rnd.choice(["", "<|endoftext|>x"]) for _ in range(300)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


# ---- repeated rows, long texts, clashing columns


def test_repeated_rows_each_count(spark):
    rnd = random.Random(1)
    base = [(i, " ".join(words(rnd, 60))) for i in range(12)] + [(None, "no id " * 8), (12, None), (13, "")]
    docs = frame(spark, base + base)
    n = len(base) * 2
    assert packing.pack_documents(docs).count() == n
    assert sharding.shard_report(docs, 2000).agg(F.sum("n_bytes")).first()[0] == 2 * sum(len(t or "") for _, t in base)
    assert bpe.round_trip(docs).count() == token_counts.counts(docs).count() == n
    classes = simhash.classes(docs).collect()
    assert len(classes) == n and all(r.component_id == r.doc_id for r in classes if r.doc_id is not None and r.doc_id < 12)
    assert quality.report(docs).count() == language.identify(docs).count() == n
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(12)] * 2, "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, labels).count() == n
    assert substrings.report(docs).count() == 0  # rows of one id never repeat each other
    assert substrings.remove(docs).select("text").collect().count(("",)) == 2
    assert simhash.keep_first(docs).count() == n - 2  # the empty text is near to the null one


def test_exact_dedup_of_repeated_rows_and_retried_batches(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "a  b"), (3, "c"), (None, "c"), (None, "d"), (None, None), (4, "")]
    docs = frame(spark, rows)
    digest = {i: hashlib.sha256(" ".join((t or "").split(" ")).replace("  ", " ").encode()).hexdigest() for i, (_, t) in enumerate(rows)}
    want = Counter()
    for k, (i, _) in enumerate(rows):
        group = [x[0] for j, x in enumerate(rows) if digest[j] == digest[k]]
        keep = min((x for x in group if x is not None), default=None)
        want[(i, keep, len(group), i == keep, digest[k])] += 1
    for batches in (1, 2, 3):
        index = exact_dedup.fresh_index(spark)
        got = exact_dedup.dedup_table(docs, index, batches)
        assert Counter(map(tuple, got.collect())) == want
        index.drop()
        assert not index.exists()
    index = exact_dedup.fresh_index(spark)
    first = Counter(map(tuple, exact_dedup.dedup(docs, index, "one").collect()))
    again = Counter(map(tuple, exact_dedup.dedup(docs, index, "one").collect()))
    assert first == again == want and index.rows().count() == len(set(digest.values()))
    later = exact_dedup.dedup(frame(spark, [(9, "a b"), (8, "new")]), index, "two").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in later} == {(9, 1, False), (8, 8, True)}
    kept = exact_dedup.keep_first(docs.withColumn("extra", F.lit("x")), exact_dedup.fresh_index(spark))
    assert sorted(((r.doc_id, r.text, r.extra) for r in kept.collect()), key=repr) == sorted([(1, "a b", "x"), (3, "c", "x"), (None, "d", "x"), (4, "", "x")], key=repr)


def test_overflow_pages_are_filled(spark):
    docs = frame(spark, [(None, "x" * (13 + k % 2)) for k in range(300)] + [(None, "y" * 700), (None, "z" * 1500)])
    got = sharding.shard_report(docs, 1000).collect()
    pages = Counter()
    for r in got:
        pages[r.shard] += r.n_bytes
    assert len(got) == 302 and len(pages) <= 10
    assert all(b <= 1000 or b == 1500 for b in pages.values())


def test_clashing_columns_keep_their_values(spark):
    rnd = random.Random(3)
    docs = frame(spark, [(i, " ".join(words(rnd, 40))) for i in range(20)])
    odd = docs.withColumns({c: F.lit(c) for c in ("h", "full", "rank", "salt", "n_rows", "largest", "row", "doc", "digest", "node", "spans", "id", "key", "kept", "n", "twins")})
    want = {c: c for c in odd.columns if c not in docs.columns}
    shards = sharding.assign(odd, 500)
    for out in (shards, quality.keep(odd), simhash.keep_first(odd), substrings.remove(odd), exact_dedup.keep_first(odd, exact_dedup.fresh_index(spark))):
        rows = out.collect()
        assert len(rows) == 20 and all(r[c] == v for r in rows for c, v in want.items())
    assert {"n_bytes", "depth", "shard"} <= set(shards.columns)
    for op in (packing.pack_documents, bpe.round_trip, token_counts.counts, simhash.classes, language.identify, quality.report):
        assert sorted(map(repr, op(odd).drop("sequence_id", "offset").collect())) == sorted(map(repr, op(docs).drop("sequence_id", "offset").collect()))


def test_very_long_texts(spark):
    rnd = random.Random(5)
    passage = words(rnd, 70)
    long = words(rnd, 60_000)
    docs = frame(spark, [(1, " ".join(long)), (2, " ".join([*long[:30_000], *passage, *long[30_000:]])), (3, " ".join([*words(rnd, 200), *passage])), (4, "x" * 400_000)])
    out = {r.doc_id: r.text for r in substrings.remove(docs).collect()}
    assert len(out[1].split()) == 60_000 and out[2].split() == passage and len(out[3].split()) == 200 and out[4] == "x" * 400_000
    labels = spark.createDataFrame([(i, 1, i % 2) for i in (1, 2, 3, 4)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, labels).collect())
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"en"}


# ---- brute force


def test_packing_against_all_packings():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(1, 10, rng.integers(1, 8))

        def fewest(rest, bins):
            if not len(rest):
                return len(bins)
            out = fewest(rest[1:], [*bins, rest[0]])
            for k, b in enumerate(bins):
                if b + rest[0] <= 10 and b not in bins[:k]:
                    out = min(out, fewest(rest[1:], [*bins[:k], b + rest[0], *bins[k + 1 :]]))
            return out

        bins = packing.pack_group(lengths, 10)
        assert np.bincount(bins, weights=lengths).max() <= 10
        assert len(set(bins)) <= fewest(list(lengths), []) + 1


def test_pairs_decide_where_no_word_does():
    rnd = random.Random(3)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        w = words(rnd, 120, 800) + ["insult"] * a + ["group"] * b
        rnd.shuffle(w)
        docs.append(" ".join(w))
        labels.append(float(a == b))
    terms = [np.array([x for w in sorted(toxicity.words(t)) for x in toxicity.terms(w)], np.int64) for t in docs]
    y = np.array(labels)
    m = toxicity.fit(terms[:1200], y[:1200])
    right = lambda m: ((toxicity.Scorer(m, 0.0).scores(docs[1200:]) >= 0.5) == y[1200:]).mean()
    assert right(m) > 0.95
    assert right(toxicity.Machine(m.bias, m.weight, 0 * m.factor, m.active)) < 0.8


def test_scores_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(0.1, *[rng.normal(0, 1, s).astype(np.float32) for s in (toxicity.BUCKETS, (toxicity.BUCKETS, toxicity.FACTORS))], (rng.random(toxicity.BUCKETS) < 0.7).astype(np.float32))
    m.weight *= m.active
    m.factor *= m.active[:, None]
    text = "the bad word and the other group"
    ids = [t for w in sorted(toxicity.words(text)) for t in toxicity.terms(w)]
    pairs = sum(float(m.factor[a] @ m.factor[b]) for a, b in itertools.combinations(ids, 2))
    z = 0.1 + sum(float(m.weight[t]) for t in ids) + pairs / max(sum(m.active[t] for t in ids), 1)
    assert abs(toxicity.Scorer(m, 0.0).scores([text])[0] - 1 / (1 + np.exp(-z))) < 1e-5
    assert toxicity.Scorer(m, 0.0).scores([None, ""]) == pytest.approx([1 / (1 + np.exp(-0.1))] * 2)


def test_language_pools_all_positions():
    w = language.new_weights(3)
    raws = [b"abc", bytes(range(97, 123)) * 9, b"x" * language.WINDOW]
    got = language.document_probabilities(w, raws)
    for raw, p in zip(raws, got, strict=True):
        each = []
        for k in range(0, len(raw), language.WINDOW):
            part = np.frombuffer(raw[k : k + language.WINDOW].ljust(language.WINDOW, b"\0"), np.uint8)[:, None].astype(np.intp)
            f, b = language.read(part, w["xf"], w["uf"])[0], language.read(part[::-1], w["xb"], w["ub"])[0][::-1]
            q = language.probabilities(w["o"] @ np.concatenate([f, b], axis=1) + w["c"])
            each += [q[t, :, 0] for t in range(len(raw[k : k + language.WINDOW]))]
        assert np.allclose(np.mean(each, axis=0), p, atol=1e-4)


def test_every_equal_paragraph_is_found(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(150):
        w = words(rnd, 90)
        for _ in range(rnd.randrange(3)):  # pieces of other documents, some shorter than what is always found
            if rows:
                other = rnd.choice(rows)[1].split()
                n = rnd.randrange(20, 90)
                at = rnd.randrange(max(1, len(other) - n))
                k = rnd.randrange(len(w))
                w = w[:k] + other[at : at + n] + w[k:]
        rows.append((i, " ".join(w)))
    found = defaultdict(list)
    for r in substrings.links(frame(spark, rows)).collect():
        found[r.doc_id].append((r.a, r.b))
    runs, grams = 48, defaultdict(list)
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - runs + 1):
            grams[tuple(w[k : k + runs])].append((i, k))
    late = [(i, k) for g in grams.values() for i, k in g if i > min(g)[0]]
    missed = [x for x in late if not any(a <= x[1] and x[1] + runs <= b for a, b in merged(found[x[0]]))]
    assert late and not missed


def merged(cuts):
    out = []
    for a, b in sorted(cuts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def test_recall_of_near_copies_among_many_texts(spark):
    rnd = random.Random(31)
    base = [words(rnd, rnd.randrange(60, 200)) for _ in range(400)]
    texts = list(base)
    for w in base[:150]:
        copy = list(w)
        for at in rnd.sample(range(len(copy)), rnd.randrange(1, 5)):
            copy[at] = "changed"
        texts.append(copy)
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    got = {r.doc_id: r.component_id for r in simhash.near_classes(frame(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])).collect()}
    by_level = defaultdict(list)
    for k in range(150):
        j = len(sets[k] & sets[400 + k]) / len(sets[k] | sets[400 + k])
        by_level[j >= 0.8].append(got.get(400 + k) == k)
    assert all(by_level[True]) and not any(by_level[False])


def test_crowded_buckets_of_the_near_stage(spark, monkeypatch):
    rnd = random.Random(17)
    base = words(rnd, 100)
    texts = []
    for _ in range(150):  # a group in which many texts are not near each other, on both sides of 0.8 to the base
        w = list(base)
        for at in rnd.sample(range(100), rnd.randrange(1, 6)):
            w[at] = f"c{rnd.randrange(5)}"
        texts.append(w)
    sets = [{tuple(w[k : k + 5]) for k in range(96)} for w in texts]
    parent = list(range(150))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(150), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    docs = frame(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])
    for size in (32, 2):
        monkeypatch.setattr(simhash, "BUCKET_PAIRS", size)
        got = {r.doc_id: r.component_id for r in simhash.near_classes(docs).collect()}
        assert [got.get(i, i) for i in range(150)] == [root(i) for i in range(150)]


def test_held_out_rows_are_those_of_the_contract(spark):
    docs = frame(spark, [(i, f"text {i} of some words") for i in range(50)])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in language.identify(docs).collect())


def test_written_shards_hold_what_was_assigned(spark, tmp_path):
    docs = frame(spark, [(i, "x" * (i % 50)) for i in range(200)])
    sharding.write(docs, f"{tmp_path}/shards", 500)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 200
    want = {(r.doc_id, r.shard) for r in sharding.assign(docs, 500).collect()}
    assert {r.doc_id for r in back.collect()} == {d for d, _ in want}
    assert len(list((tmp_path / "shards").glob("shard=*"))) == len({s for _, s in want})


def test_texts_are_not_exchanged_for_the_shard_report(spark, monkeypatch):
    plans, settled = {}, sharding.settle

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return settled(df, name)

    monkeypatch.setattr(sharding, "settle", noted)
    docs = frame(spark, [(i, "x" * (i % 50)) for i in range(200)])
    got = {tuple(r) for r in sharding.shard_report(docs, 500).select("doc_id", "n_bytes", "depth", "shard").collect()}
    carried = [line for line in plans["shards"].splitlines() if "named_struct(" in line or "struct(" in line]
    assert carried and not any("text, text" in line for line in carried)
    assert got == {tuple(r) for r in sharding.assign(docs, 500).select("doc_id", "n_bytes", "depth", "shard").collect()}
