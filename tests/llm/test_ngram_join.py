"""The n-gram join against brute force over all pairs."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinlog.llm import ngram_join as nj

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, size):
    w = SPACE.findall((text or "").translate(LOW))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def joined(rows, percent, size=3):
    """Rows (doc_id, n_shingles, component_id) by comparing every two texts."""
    nodes = sorted({(i, t) for i, t in rows if i is not None and grams(t, size)}, key=str)
    sets = [grams(t, size) for _, t in nodes]
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(nodes):
        least[find(k)] = min(least.get(find(k), i), i)
    place = {n: least[find(k)] for k, n in enumerate(nodes)}
    return collections.Counter((i, len(grams(t, size)), place.get((i, t), i)) for i, t in rows)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return collections.Counter(tuple(r) for r in df.collect())


def test_join(small, clashing, none):
    want = joined(texts(small), 90)
    assert found(nj.join_components(small)) == want
    assert found(nj.join_components(clashing)) == want
    assert nj.join_components(none).count() == 0
    assert found(nj.join_components(small, 70, 2, 3)) == joined(texts(small), 70, 2)


@pytest.fixture(scope="module")
def clouds(spark):
    """Variants around a few texts, chains that drift away from theirs, templates that differ in more than a tenth, copies."""
    draw = np.random.default_rng(11)
    rows = []

    def changed(words, n):
        words = list(words)
        for i in draw.choice(len(words), n, replace=False):
            words[i] = f"v{draw.integers(10**9)}"
        return words

    for c in range(4):
        base = [f"c{c}w{i}" for i in draw.integers(0, 500, 120)]
        rows += [changed(base, int(k)) for k in draw.integers(0, 4, 60)]
        step = base
        for _ in range(15):
            step = changed(step, 1)
            rows.append(step)
        rows += [base] * 10
    template = [f"t{i}" for i in range(80)]
    rows += [template[: int(a)] + [f"u{draw.integers(10**9)}" for _ in range(int(b))] for a, b in zip(draw.integers(70, 81, 80), draw.integers(0, 14, 80), strict=True)]
    draw.shuffle(order := np.arange(len(rows)))
    return spark.createDataFrame([(int(i), " ".join(rows[k])) for i, k in enumerate(order)], "doc_id long, text string").repartition(5).cache()


@pytest.mark.parametrize("fragments, hot, block", [(16, 1000, 256), (1, 1000, 7), (5, 3, 16)])
def test_clouds(clouds, fragments, hot, block, monkeypatch):
    monkeypatch.setattr(nj, "HOT_LEAST", hot)
    monkeypatch.setattr(nj, "BLOCK", block)
    assert found(nj.join_components(clouds, 90, 3, fragments)) == joined(texts(clouds), 90)


def test_a_cloud_of_unlinked_variants_is_not_paired_out(spark, monkeypatch):
    """Variants of one set that are just not linked with each other, some that are: few pairs reach the exact count."""
    draw = np.random.default_rng(5)
    base = draw.integers(-(2**63), 2**63, 100)
    rest = draw.integers(-(2**63), 2**63, 40)
    sets = [np.unique(np.concatenate([base[draw.random(100) > 0.06], draw.choice(rest, 4)])) for _ in range(150)]
    sets += [np.append(s[1:], draw.integers(2**62)) for s in sets[:20]]
    counted, links = [], nj._links
    monkeypatch.setattr(nj, "_links", lambda pairs, *rest: counted.append(pairs.count()) or links(pairs, *rest))
    nodes = spark.createDataFrame([(i, len(s), [int(x) for x in s]) for i, s in enumerate(sets)], "node long, n long, grams array<long>")
    got = {r["node"]: r["component"] for r in nj.linked(nodes, 90).collect()}
    root = list(range(len(sets)))
    true = 0
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                true += 1
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    want = collections.Counter(root)
    assert {k: v for k, v in want.items() if v > 1} and len(got) == sum(v for v in want.values() if v > 1)
    assert len({(got[i], root[i]) for i in got}) == len({root[i] for i in got}) == len(set(got.values()))
    assert sum(counted[1:]) < true  # beyond the pairs with hubs


def test_sketches_never_differ_by_more_than_the_sets(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(-(2**63), 2**63, 3000)
    sets = [np.unique(np.concatenate([draw.choice(base, int(k), replace=False), draw.integers(0, 9, 5)])) for k in draw.integers(1, 3000, 30)]
    nodes = spark.createDataFrame([(i, [int(x) for x in s]) for i, s in enumerate(sets)], "node long, grams array<long>")
    got = {r["node"]: np.frombuffer(r["sketch"], np.uint8).astype(int) for r in nodes.mapInArrow(nj._sketches, "node long, sketch binary").collect()}
    for a in range(30):
        for b in range(30):
            assert np.abs(got[a] - got[b]).sum() <= len(np.setxor1d(sets[a], sets[b]))


def test_overlaps_are_sums_over_fragments(spark):
    draw = np.random.default_rng(2)
    sets = [np.unique(np.concatenate([draw.choice(300, 80), draw.integers(300, 2**62, 3)])) for _ in range(12)]
    # among the first n-grams all count: the least share that keeps a node is 1 of 100
    nodes = spark.createDataFrame([(i, len(s), [int(x) for x in s]) for i, s in enumerate(sets)], "node long, n long, grams array<long>")
    parts = nj.segments(nodes, 1, 7)
    assert parts.select("fragment").distinct().count() == 7
    pairs = spark.createDataFrame([(a, b) for b in range(12) for a in range(b)], "a long, b long")
    got = {(r["a"], r["b"]): r["both"] for r in nj.overlaps(pairs, parts).collect()}
    assert got == {(a, b): len(np.intersect1d(sets[a], sets[b])) for b in range(12) for a in range(b)}
    # each fragment is a run of the global order: rarer n-grams come first
    times = collections.Counter(x for s in sets for x in s.tolist())
    top = {r["fragment"]: [times[x] for x in r["all"]] for r in parts.groupBy("fragment").agg(F.flatten(F.collect_set("grams")).alias("all")).collect()}
    for f in range(6):
        assert np.log2(max(top[f])) * nj.OCTAVE // 1 <= np.log2(min(top[f + 1])) * nj.OCTAVE // 1
