"""The near stage of the pipeline: nothing near is ruled out by maps, and groups that are almost near cost in proportion."""

import itertools
import random

import numpy as np

from viaduct.llm import simhash
from viaduct.llm.shingles import Hashes, shingle_set

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS).repartition(3)


def allowed(spark, sets):
    rows = [(k, len(s), simhash.bit_map(s).tolist()) for k, s in enumerate(sets)]
    side = lambda p: spark.createDataFrame(rows, f"{p} int, n_{p} int, bits_{p} array<bigint>")
    return {tuple(r) for r in side("a").crossJoin(side("b")).where(f"a < b and {simhash.may_be_near('a', 'b')}").select("a", "b").collect()}


def test_maps_rule_out_no_near_pair(spark):
    rnd, known, texts = random.Random(1), Hashes(), []
    for size in (3, 6, 30, 120, 255, 262, 400, 3000):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        for k in range(12):
            w = list(base)
            for at in rnd.sample(range(size), min(size, k * size // 150)):
                w[at] = f"c{rnd.randrange(9)}"
            texts.append(" ".join(w))
    sets = [shingle_set(t, 5, known) for t in texts]
    share = {(a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in itertools.combinations(range(len(sets)), 2)}
    got = allowed(spark, sets)
    assert {p for p, j in share.items() if j >= 0.8} <= got
    assert not [p for p in got if share[p] < 0.6]


def template(n, edits, seed):
    rnd = random.Random(seed)
    base = [f"b{k}" for k in range(200)]
    out = []
    for k in range(n):
        w = list(base)
        for at in rnd.sample(range(200), edits):
            w[at] = f"x{k}e{at}"
        out.append(" ".join(w))
    return out


def test_pairs_of_a_group_that_is_almost_near(spark):
    """Pairs of texts with different edits of one template, at a similarity of about 0.68: hardly a pair is made of 180,000."""
    texts = template(600, 4, 5)
    known = Hashes()
    sets = [shingle_set(t, 5, known) for t in texts]
    j = [len(np.intersect1d(sets[k], sets[k + 1])) / len(np.union1d(sets[k], sets[k + 1])) for k in range(50)]
    assert 0.6 < np.mean(j) < 0.75
    rows = [(0, k, k, len(s), simhash.bit_map(s).tolist(), len(sets)) for k, s in enumerate(sets)]
    rest = spark.createDataFrame(rows, "key long, node long, component long, n long, bits array<bigint>, size long")
    assert simhash.pairs_of(rest).count() < 3000
    root = list(range(600))
    for b, a in itertools.combinations(range(600), 2):
        if root[a] != root[b] and 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b])):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    got = {r.doc_id: r.component_id for r in simhash.near_classes(frame(spark, texts)).collect()}
    assert [got.get(k, k) for k in range(600)] == root and len(set(root)) > 400


def test_parts_of_a_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 16)
    texts = template(60, 1, 7) + template(20, 60, 8)
    known = Hashes()
    sets = [shingle_set(t, 5, known) for t in texts]
    rows = [(0, k, k, len(s), simhash.bit_map(s).tolist(), len(sets)) for k, s in enumerate(sets)]
    rest = spark.createDataFrame(rows, "key long, node long, component long, n long, bits array<bigint>, size long")
    pairs = {tuple(r) for r in simhash.pairs_of(rest).collect()}
    near = {(a, b) for b, a in itertools.combinations(range(80), 2) if 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))}
    assert near and near <= pairs


def test_words_of_any_frequency_are_found_jointly():
    """A pair that decides is found among thousands of more frequent words; chance finds none."""
    from viaduct.llm import toxicity

    rnd = random.Random(4)
    docs, labels = [], []
    for k in range(1200):
        a, b = k % 30 < 15, k % 20 < 10
        rare = k % 4 == 0
        w = {f"w{rnd.randrange(6000)}" for _ in range(250)} | ({"insult"} if rare and a else set()) | ({"group"} if rare and b else set())
        docs.append(np.array([toxicity.terms(x.encode())[0] for x in sorted(w)], np.int64))
        labels.append(float(a == b) if rare else float(rnd.random() < 0.5))
    found = set(toxicity.joint(docs, np.array(labels)).tolist())
    assert found == {toxicity.terms(b"insult")[0], toxicity.terms(b"group")[0]}


def test_every_language_is_learnt_from_windows_of_whole_texts(spark):
    from viaduct.llm import language

    texts = [(k, ("abc " if k % 2 else "xyz ") * 600, f"l{k % 2}" if k < 300 else f"rare{k}", "s", 0) for k in range(340)]
    langs, x, mask, y = language.sample(spark.createDataFrame(texts, DOCS), 200)
    assert len(langs) > 30 and "l0" in langs and all(np.bincount(y)[langs.index(k)] < 300 for k in ("l0", "l1"))
    assert mask.sum() == (x > 0).sum() and x.shape[1] == language.WINDOW
    small = language.sample(spark.createDataFrame([(1, "ab" * 500, "l", "s", 0), (1, "ab" * 500, "l", "s", 0), (2, None, "m", "s", 0), (3, "", "n", "s", 0)], DOCS), 1000)
    assert small[0] == ["l"] and len(small[1]) == 11 and small[2].sum() == 1000


def test_a_paragraph_connects_all_that_it_is_near(spark, monkeypatch):
    """Paragraphs with edits at either end are near the whole one, not each other: all are one component, in buckets of any size."""
    from viaduct.llm import substrings
    from viaduct.llm.graph import components

    rnd, rows, ids = random.Random(3), [], []
    for g in range(30):
        whole = [rnd.randrange(2**31) for _ in range(substrings.WORDS)]
        new = [rnd.randrange(2**31) for _ in range(4)]
        for k, w in enumerate((new[:2] + whole[2:], whole[:-2] + new[2:], whole)):
            rows.append((10 * g + k, 10 * g + k, w))
            ids.append((g, 10 * g + k))
    words = spark.createDataFrame(rows, "content long, id long, words array<int>").repartition(3)
    keyed = spark.createDataFrame([(g, c, c, 3) for g, c in ids], "key long, content long, id long, size long")
    for bucket, part in ((32, 8192), (2, 8192), (2, 2)):
        monkeypatch.setattr(substrings, "BUCKET", bucket)
        monkeypatch.setattr(substrings, "PART", part)
        least, near = substrings.near_contents(keyed, words, True)
        assert {r.content: r.near_id for r in least.collect()} == {10 * g + 2: 10 * g for g in range(30)}
        assert {r.node: r.component for r in components(near).collect()} == {c: 10 * g for g, c in ids}
    monkeypatch.undo()
    monkeypatch.setattr(substrings, "tune", lambda: (12, 2))
    report = substrings.report(spark.createDataFrame([(c, " ".join(map(str, w)), "en", "s", 0) for c, _, w in rows], DOCS))
    assert {r.doc_id: r.component_id for r in report.collect()} == {c: 10 * g for g, c in ids}


def test_links_between_parts_are_brute_force():
    from viaduct.llm import substrings

    rnd = random.Random(6)
    bases = [[rnd.randrange(2**31) for _ in range(substrings.WORDS)] for _ in range(3)]
    made = []
    for _ in range(200):
        w = list(rnd.choice(bases))
        for _ in range(2):
            w[rnd.choice([0, 0, 1, 12, 22, 23, 23])] = rnd.randrange(40)
        made.append(w)
    x, ids = np.array(made, np.int32), np.arange(200)
    sets = [{tuple(w[j : j + 5]) for j in range(20)} for w in made]
    roots = []
    for pairs in ([(a, b) for a, b in itertools.combinations(range(200), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])], zip(*substrings.links_between(x, ids, ids // 2, x, ids, ids // 2), strict=True)):
        root = [k // 2 for k in range(200)]
        for a, b in pairs:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
        roots.append(root)
    assert roots[0] == roots[1] and 1 < len(set(roots[0])) < 90


def test_a_bucket_is_exchanged_once(spark, tmp_path):
    texts, known = template(60, 1, 7), Hashes()
    sets = [shingle_set(t, 5, known) for t in texts]
    rows = [(0, k, k, len(s), simhash.bit_map(s).tolist(), len(sets)) for k, s in enumerate(sets)]
    spark.createDataFrame(rows, "key long, node long, component long, n long, bits array<bigint>, size long").write.parquet(f"{tmp_path}/rest")
    pairs = simhash.pairs_of(spark.read.parquet(f"{tmp_path}/rest"))
    got = {tuple(r) for r in pairs.collect()}
    near = {(a, b) for b, a in itertools.combinations(range(60), 2) if 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))}
    assert near and near <= got
    pairs.write.parquet(f"{tmp_path}/pairs")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def joined(sets, a, b):
    return 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))


def test_a_pair_meets_at_keys_that_can_be_its_first(spark):
    """No near pair is lost, and the pairs of a template don't meet at all keys that they share."""
    rnd, known = random.Random(11), Hashes()
    texts = template(40, 2, 12) + [" ".join(t.split()[: rnd.randrange(160, 200)]) for t in template(30, 1, 13)]
    sets = [shingle_set(t, 5, known) for t in texts]
    common = np.sort(sets[0][::3])
    rows = [(int(h), k, pos, k, len(s), simhash.bit_map(s).tolist(), 70) for k, s in enumerate(sets) for pos, h in enumerate(simhash.prefix(s, common).view(np.int64))]
    rest = spark.createDataFrame(rows, "key long, node long, pos int, component long, n long, bits array<bigint>, size long")
    got = [tuple(r) for r in simhash.pairs_of(rest).collect()]
    assert {(a, b) for b, a in itertools.combinations(range(70), 2) if joined(sets, a, b)} <= set(got)
    assert len(got) < 0.6 * simhash.pairs_of(rest.drop("pos")).count()


def test_groups_around_several_texts_are_joined_by_their_leaders(spark, monkeypatch):
    """Three texts, each near the next, with 80 texts near one of them only: few pairs are left for the last comparison (1,426; 3,070 without leaders and places)."""
    rnd, base, texts = random.Random(5), [f"b{k}" for k in range(200)], []
    for c in range(3):
        if c:
            base = [f"c{c}e{at}" if 60 * c <= at < 60 * c + 18 else w for at, w in enumerate(base)]
        texts.append(" ".join(base))
        for k in range(80):
            w, at = list(base), rnd.randrange(183)
            w[at : at + 14] = [f"x{c}k{k}e{j}" for j in range(14)]
            texts.append(" ".join(w))
    sets = [shingle_set(t, 5, Hashes()) for t in texts]
    root = list(range(len(texts)))
    for b, a in itertools.combinations(range(len(texts)), 2):
        if root[a] != root[b] and joined(sets, a, b):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    made, pairs_of = [], simhash.pairs_of
    monkeypatch.setattr(simhash, "pairs_of", lambda rest: made.append((out := pairs_of(rest)).count()) or out)
    got = {r.doc_id: r.component_id for r in simhash.near_classes(frame(spark, texts)).collect()}
    assert [got.get(k, k) for k in range(len(texts))] == root
    assert made[0] < 2000
