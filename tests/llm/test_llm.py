"""The training-data operators against brute force, the tokenizer library, exact round trips and held-out labels."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from viaduct.llm import bpe, exact_dedup, language, packing, quality, sharding, simhash, substrings, token_counts, toxicity
from viaduct.llm.graph import components
from viaduct.llm.tokens import default_path, load

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def made_up(n=160, seed=5):
    """Documents with copies, near copies, nulls, empty, odd and long texts."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 8))) for _ in range(3000)]
    text = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    rows = [text(rnd.randrange(1, 300)) for _ in range(n)]
    rows += [rows[k] for k in range(0, 40, 2)] + [rows[k].replace(" ", "\n ") for k in range(0, 20, 4)]
    for k in range(30):
        w = text(200).split()
        rows.append(" ".join(w))
        w[rnd.randrange(200)] = "changed"
        rows.append(" ".join(w))
    rows += [None, "", "  \n ", "a", "É à Σς\x1c\x85x", "<|endoftext|> x<|startoftext|>", "same " * 400, text(9000), "x" * 70_000]
    return [(i, t, None if i % 11 == 0 else "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return made_up()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_bpe_is_the_library(docs, rows):
    t = load(default_path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_random_unicode():
    t, own, rnd = load(default_path("word_bpe_49k.json")), bpe.BPE(default_path("word_bpe_49k.json")), random.Random(3)
    pools = ["abc'st re ll 12", "éèñÅÅIİΣσς", "###aaaa!!!!", "\x1c\x1d\x85\xa0 ​﻿\t\n\r\x0b", "日本語한국어", "👍🏽🇩🇪é̀ﬁǅ", "٣४Ⅷ²½"]
    texts = ["".join(rnd.choice(rnd.choice(pools)) if rnd.random() < 0.9 else chr(rnd.randrange(1, 0xD7FF)) for _ in range(20)) for _ in range(1500)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_token_counts_are_the_library(docs, rows):
    t = load(default_path("byte_bpe_50k.json"))
    for chunk, overlap in ((50_000, 200), (150, 4)):
        got = {r.doc_id: r for r in token_counts.counts(docs, chunk=chunk, overlap=overlap).collect()}
        for i, text, *_ in rows:
            n = len(t.encode(text or "", add_special_tokens=False).ids)
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 512)


def test_packing_is_gapless_and_close_to_the_bound(docs, rows):
    got = packing.pack_documents(docs).collect()
    own = bpe.BPE(default_path("word_bpe_49k.json"))
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    for i, text, *_ in rows:
        ids = np.append(own.encode(text), 1).astype("<u4")
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.start for p in parts] == list(range(0, len(ids), 4096)) and sum(p.length for p in parts) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in parts)
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by_bin) <= -(-sum(r.length for r in got) // 4096) + 1


def test_local_search_never_worse_and_levels_keep_all(spark):
    rng = np.random.default_rng(1)
    for high in (600, 2300, 4096):
        lengths = rng.integers(1, high, 700)
        first = packing.best_fit(lengths, 4096)
        then = packing.improve(lengths, first, 4096)
        assert len(set(then)) <= len(set(first)) and np.bincount(then, weights=lengths).max() <= 4096
    pieces = spark.range(900).selectExpr("id as doc_id", "0 as piece", "0L as start", "id % 1500 + 1 as length", "0L as ids_crc32")
    out = packing.pack(pieces, 4096, group_pieces=100)
    assert out.count() == 900 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    s = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def test_simhash_is_brute_force(docs, rows):
    fp = {r[0]: brute_fingerprint(r[1]) for r in rows}
    want = brute_components(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2)
    got = {r.doc_id: r for r in simhash.classes(docs).collect()}
    assert {i: r.fp & (2**64 - 1) for i, r in got.items()} == fp
    assert {i: r.component_id for i, r in got.items()} == want


def test_links_of_crowded_buckets(spark, monkeypatch):
    rnd = random.Random(4)
    centre = rnd.getrandbits(63)
    fps = {centre} | {centre ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for _ in range(120)} | {rnd.getrandbits(63) for _ in range(40)}
    fps |= {f ^ (1 << 7) for f in list(fps)[:30]}
    for limit in (32, 2):
        monkeypatch.setattr(simhash, "BUCKET_PAIRS", limit)
        for radius in (1, 2):
            df = spark.createDataFrame([(f,) for f in fps], "fp long")
            got = components(simhash.links(df, radius, len(fps)))
            want = {k: v for k, v in brute_components(sorted(fps), lambda a, b, r=radius: (a ^ b).bit_count() <= r).items()}
            linked = {r.node: r.component for r in got.collect()}
            assert {f: linked.get(f, f) for f in fps} == want


def test_thresholds_satisfy_the_pigeonhole():
    for parts, total in ((2, 1), (3, 0), (4, 2)):
        cost = [[0.0, 5.0 + p, 40.0, 300.0] for p in range(parts)]
        _, ts = simhash.allocate(cost, total)
        assert sum(ts) == total and min(ts) >= -1


def test_near_stage_drops_near_copies_only(docs, rows):
    kept = {r.doc_id for r in simhash.keep_first(docs).collect()}
    shingles = {}
    for i, text, *_ in rows:
        w = (text or "").lower().split()
        shingles[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    near = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    for a in shingles:
        others = [near(a, b) for b in shingles if b < a]
        if max(others, default=0) >= 0.95:
            assert a not in kept
        if max(others, default=0) < 0.3:
            assert a in kept


def test_near_stage_is_exact_at_the_threshold(spark, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    phrase, texts = text(12), []
    for _ in range(40):
        base = text(rnd.randrange(80, 200))
        texts.append(base)
        for _ in range(3):  # the similarity falls on both sides of 0.8
            w = list(base)
            for at in rnd.sample(range(len(w)), max(1, len(w) * rnd.randrange(1, 4) // 100)):
                w[at] = "changed"
            texts.append(w)
    texts += [phrase + text(60) for _ in range(60)]  # a hot phrase between texts that are not near
    big = text(100)
    texts += [big[:k] + ["other"] + big[k + 1 :] for k in range(60)]
    rnd.shuffle(texts)
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    want = brute_components(list(range(len(texts))), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    for common in (32, 2):
        monkeypatch.setattr(simhash, "COMMON", common)
        got = {r.doc_id: r.component_id for r in simhash.near_classes(docs).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_near_stage_takes_candidates_by_fingerprints(spark, monkeypatch):
    rnd = random.Random(19)
    texts = []
    for _ in range(40):
        w = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
        texts += [w, w[:-1] + ["changed"], w[:-1] + ["again"]]
    taken, made = {}, simhash.fingerprint_pairs

    def noted(nodes):
        out = made(nodes)
        taken["fps"], taken["pairs"] = {r.node: r.fp for r in nodes.select("node", "fp").collect()}, {tuple(r) for r in out.collect()}
        return out

    monkeypatch.setattr(simhash, "fingerprint_pairs", noted)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_classes(docs).collect()}
    assert got == {i: i - i % 3 for i in range(120)}
    fps, pairs = taken["fps"], taken["pairs"]
    near = lambda a, b: ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 2
    assert len(pairs) > 20 and brute_components(list(fps), near) == brute_components(list(fps), lambda a, b: (a, b) in pairs or (b, a) in pairs)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k + 1, k) for k in range(200)] + [(k, 500) for k in range(501, 700)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 500 for k in range(500, 700)}


def test_substrings_cut_planted_passages_only(spark):
    rnd = random.Random(8)
    text = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passages = [text(60) for _ in range(12)]
    rows, holders = [], defaultdict(list)
    for i in range(120):
        w = text(150)
        if i % 3 == 0:
            p = rnd.randrange(12)
            at = rnd.randrange(150)
            w = w[:at] + passages[p] + w[at:]
            holders[p].append(i)
        rows.append((i, " ".join(w)))
    rows += [(1000, None), (1001, ""), (None, " ".join(passages[0])), (1002, " ".join(text(10)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in substrings.remove(docs).collect()}
    assert len(out) == len({r[0] for r in rows})
    for p, own in holders.items():
        for i in own:
            left = sum(w in set(passages[p]) for w in out[i].split())
            assert left == 60 if i == own[0] else left <= 30
    for i, t in rows:
        if i is None or i >= 1000 or i % 3:
            assert out[i] == t
    report = {r.doc_id: r for r in substrings.report(docs).collect()}
    assert set(report) == {i for own in holders.values() if len(own) > 1 for i in own}


def test_substrings_cut_the_whole_common_run(spark):
    rnd = random.Random(12)
    text = lambda n: [f"w{rnd.randrange(10**12)}" for _ in range(n)]
    rows, passages = [], {}
    for p in range(40):
        run = text(48 + p % 20) if p else ["same"] * 60
        # The first holder has only the middle, so the whole run is shared by later documents only.
        for k, part in enumerate((run[10:40], run, run, run)):
            rows.append((4 * p + k, " ".join([*text(40), *part, *text(40)])))
        passages[p] = set(run)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: r.text.split() for r in substrings.remove(docs).collect()}
    for p, run in passages.items():
        assert len(out[4 * p]) == 110
        for i in (4 * p + 2, 4 * p + 3):  # a paragraph of similarity 0.8 may take two other words at either end
            assert not run & set(out[i]) and 76 <= len(out[i]) <= 80


def test_near_contents_are_found_in_crowded_buckets(spark, monkeypatch):
    rnd = random.Random(13)
    text = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    phrase, bodies = text(14), [text(10) for _ in range(60)]
    bodies += [b[:-1] + ["edited"] for b in bodies]
    rows = [(i, " ".join(phrase + b)) for i, b in enumerate(bodies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substrings, "BUCKET", 4)
    found = {(r.doc_id, r.first_id) for r in substrings.links(docs).collect()}
    assert sum((i + 60, i) in found for i in range(60)) >= 54 and all(a - 60 == b for a, b in found)


def test_crowded_contents_are_brute_force(spark, monkeypatch):
    """Variants of a few runs of words, edited anywhere: dense groups, whose members are near several others."""
    rnd = random.Random(14)
    bases = [[rnd.randrange(2**31) for _ in range(substrings.WORDS)] for _ in range(3)] + [[5] * substrings.WORDS]
    rows = {}
    for k in range(300):
        w = list(rnd.choice(bases))
        for _ in range(rnd.randrange(1, 3)):
            w[rnd.choice([0, 0, 1, 12, 22, 23, 23])] = rnd.randrange(40)
        rows[tuple(w)] = (k, rnd.randrange(100), w)
    sets = {c: {tuple(w[j : j + 5]) for j in range(20)} for c, _, w in rows.values()}
    ids = {c: i for c, i, _ in rows.values()}
    near = lambda x, y: 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])
    want = {x: min(found) for x in ids if (found := [ids[y] for y in ids if ids[y] < ids[x] and near(x, y)])}
    assert len(want) > 100
    words = spark.createDataFrame(list(rows.values()), "content long, id long, words array<int>").repartition(3)
    for part in (8192, 16):
        monkeypatch.setattr(substrings, "PART", part)
        assert {r.content: r.near_id for r in substrings.near_crowded(words).collect()} == want


def test_tuned_bands_reach_the_recall():
    b, r = substrings.tune(0.8, 0.95)
    assert 1 - (1 - 0.8**r) ** b >= 0.95 and 1 - (1 - 0.8**r) ** (b - 1) < 0.95


def test_exact_dedup_is_brute_force(spark, docs, rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    index = exact_dedup.fresh_index(spark)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.dedup(docs, index).collect()}
    assert got == want
    # A later batch meets the index: what it knows goes, what is new is appended.
    later = docs.where("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 5000).unionByName(spark.createDataFrame([(9000, "brand new", "en", "s", 9)], DOCS))
    again = {r.doc_id: r for r in exact_dedup.dedup(later, index).collect()}
    assert [i for i, r in again.items() if r.kept] == [9000] and all(again[5000 + i].keep_id == want[i][0] for i in range(5))
    assert index.rows().count() == len(groups) + 1 and index.compact().rows().count() == len(groups) + 1
    kept = {r.doc_id for r in exact_dedup.keep_first(docs, exact_dedup.fresh_index(spark)).collect()}
    assert kept == {min(g) for g in groups.values()}


def test_quality_counts_are_brute_force(docs, rows):
    got = {r.doc_id: r for r in quality.report(docs).collect()}
    for i, text, *_ in rows:
        t = text or ""
        w = WORDS.findall(t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        repeat = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat))
        assert r.base_failed == (len(w) < 10 or 100 * len(repeat) > 20 * len(w)) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    assert kept == {i for i, r in got.items() if r.kept}


def test_sketches_merge_to_the_whole(docs):
    s = quality.signals(quality.counts(docs))
    halves = quality.merge(quality.sketches(s.where("doc_id % 2 = 0")), quality.sketches(s.where("doc_id % 2 = 1")))
    assert sorted(map(tuple, halves.fillna("-").collect())) == sorted(map(tuple, quality.sketches(s).fillna("-").collect()))


def test_shards_fit_and_only_large_buckets_split(spark, docs, rows):
    got = sharding.shard_report(docs, 20_000).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.n_bytes
    assert all(n <= 20_000 or sum(r.shard == s for r in got) == 1 for s, n in sizes.items())
    for r in got:  # its parent was over the limit
        if r.depth:
            assert sum(x.n_bytes for x in got if x.shard[: r.depth - 1] == r.shard[: r.depth - 1]) > 20_000
    same = spark.createDataFrame([(None, "x" * 100, None, None, 0)] * 500, DOCS)
    pages = sharding.shard_report(same, 1000).collect()
    assert len(pages) == 500 and max(r.shard_bytes for r in pages) <= 1000


def labelled(spark, n=900):
    rnd = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [f"w{rnd.randrange(400)}" for _ in range(60)] + ([rnd.choice(["badword", "nasty"])] if toxic else [])
        rnd.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame([*docs, (10_000, None), (10_001, "")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [r for i, r in got.items() if i < 10_000 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    nothing = toxicity.score(docs, labels.limit(0)).collect()
    assert {r.predicted for r in nothing} == {0}


def test_language_on_held_out_documents(spark):
    rnd = random.Random(9)
    kinds = {"aa": ["der", "und", "schön", "ich"], "bb": ["the", "and", "with", "ing"], "cc": ["que", "los", "ción", "para"]}
    rows = [(i, " ".join(rnd.choice(kinds[k]) for _ in range(rnd.randrange(3, 80))), k) for i in range(600) for k in [list(kinds)[i % 3]]]
    rows += [(9000, None, "aa"), (9001, "12 34!", "bb"), (9002, "the and", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[9000].lang_pred == got[9001].lang_pred == "und"
    assert np.mean([got[i].lang_pred == k for i, _, k in rows[:600] if got[i].held_out]) > 0.97
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_backpropagation_is_the_slope():
    rng = np.random.default_rng(2)
    w = language.new_weights(3)
    x, mask, lang = rng.integers(97, 105, (6, 4)), np.ones((6, 4), np.float32), np.array([0, 1, 2, 1])
    _, g = language.gradients(w, x, mask, lang)
    for name in ("uf", "ub", "o", "c"):
        at = tuple(rng.integers(0, s) for s in w[name].shape)
        near = []
        for e in (1e-2, -1e-2):
            v = {k: a.copy() for k, a in w.items()}
            v[name][at] += e
            near.append(language.gradients(v, x, mask, lang)[0])
        assert abs((near[0] - near[1]) / 2e-2 - g[name][at]) < 5e-3
    table, u = w["xf"], w["uf"]
    assert np.allclose(language.read(x, table, u)[0], language.read_fast(x, table, u), atol=1e-5)


def test_empty_tables_and_clashing_columns(spark, none, docs):
    for made in (packing.pack_documents, sharding.shard_report, bpe.round_trip, token_counts.counts, simhash.classes, substrings.report, quality.report, language.identify):
        assert made(none).count() == 0, made
    assert exact_dedup.dedup(none, exact_dedup.fresh_index(spark)).count() == 0
    assert toxicity.score(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    for stage in (quality.keep, simhash.keep_first, substrings.remove):
        assert stage(none).columns == none.columns and stage(none).count() == 0
    odd = docs.where("doc_id < 30").withColumns({c: F.lit(1) for c in ("n_words", "kept", "fp", "shard", "key", "start", "spans", "score", "digest", "component_id")})
    for stage in (quality.keep, simhash.keep_first, substrings.remove, lambda d: exact_dedup.keep_first(d, exact_dedup.fresh_index(spark))):
        assert stage(odd).columns == odd.columns
        stage(odd).count()
