"""Ranked search and whitening against brute force."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinlog.llm import lexical, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def ranked(docs, items, k=10):
    """Every pair scored, in whole numbers."""
    held = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t in docs]
    held = [d for d in held if d[2]]
    n, length = len(held), sum(d[2] for d in held)
    df = collections.Counter(x for _, c, _ in held for x in c)
    out = collections.Counter()
    for item, text in items:
        scores = []
        for doc, c, size in held:
            m = 25 + (75 * size * n) // length
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 8 * m))
                for x in terms(text) if c[x]
            )
            if s:
                scores.append((-s, doc is None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, doc, -s] += 1
    return out


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return collections.Counter(tuple(r) for r in df.collect())


def pairs(df, key):
    return [(r[0], r[1]) for r in df.select(key, "text").collect()]


@pytest.fixture(scope="module")
def items(spark, sf):
    held = spark.read.parquet(f"{sf}/benchmark.parquet")
    odd = [
        (None, "an item without an id, of a few words"), (700, None), (701, ""), (702, " -- "), (703, "zzzqqq of no document"),
        (704, "one passage of twelve words"), (705, "one passage of twelve words"), (705, "one passage of twelve words"),
        (706, "THE the The " * 50), (707, "Ünï cödé ﷽"), (708, " ".join(f"w{i}" for i in range(3000))),
    ]
    return held.limit(8).union(spark.createDataFrame(odd, held.schema)).cache()


def test_search(small, items, none):
    got = found(lexical.search(small, items))
    assert got == ranked(pairs(small, "doc_id"), pairs(items, "item_id"))
    assert found(lexical.search(none, items)) == found(lexical.search(small, items.where("false"))) == collections.Counter()


def test_search_with_clashing_names_and_few_documents(clashing, items):
    few = clashing.where("doc_id > 9000 OR doc_id IS NULL")
    named = items.withColumns({c: F.lit(1) for c in ("item", "rank", "score", "doc_id", "terms")})
    assert found(lexical.search(few, named, 3)) == ranked(pairs(few, "doc_id"), pairs(items, "item_id"), 3)


def test_search_in_passes_seeds_and_small_trees(small, items, monkeypatch):
    """The same rows when items come in several passes, bounds come from a sample, and sums are not exact in floats."""
    for name, value in (("PASS_BYTES", 900), ("SEEDS", 60), ("BATCH", 64), ("LEAF", 2), ("FAN", 2), ("EXACT", 1)):
        monkeypatch.setattr(lexical, name, value)
    assert found(lexical.search(small, items)) == ranked(pairs(small, "doc_id"), pairs(items, "item_id"))


def test_batches_are_pruned():
    """Of items and documents in unlike groups most pairs are never scored, and none of the best is missed."""
    draw = np.random.default_rng(3)
    weight = np.full(400, 1000.0)
    queries = [(np.sort(draw.choice(np.arange(20 * g, 20 * g + 20), 5, replace=False)), np.ones(5, np.int64)) for g in range(20) for _ in range(8)]
    block = lexical._blocks(queries, weight)[0]
    row = np.repeat(np.arange(4096), 6)
    term = np.concatenate([np.sort(draw.choice(20, 6, replace=False)) + 20 * (i * 7919 % 20) for i in range(4096)])
    impact = draw.integers(1, 800_000, len(row))
    made = lexical._Batch.of(np.zeros(4096, bool), np.arange(4096), row, term, impact, weight)
    best = lexical._Best(len(queries), 10, np.zeros(len(queries), np.int64))
    scored = made.search(block, best)
    assert scored < 0.2 * 4096 * len(queries)
    dense = np.zeros((4096, 400), np.int64)
    dense[row, term] = impact
    for i, (t, _) in enumerate(queries):
        want = sorted(zip((-dense[:, t].sum(axis=1) * 1000).tolist(), range(4096), strict=True))[:10]
        assert [(-s, d) for s, d in zip(best.held[i][0].tolist(), best.held[i][2].tolist(), strict=True)] == want
    late = lexical._Best(len(queries), 10, np.array([h[0][-1] for h in best.held]))
    assert made.search(block, late) <= scored


def whole(rows):
    """x of the rows that count."""
    good = [r for r in rows if r and all(c is not None and math.isfinite(c) for c in r)]
    return np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r] for r in good], dtype=object)


def checked(df, x, most=32):
    """The rows of whiten(df) against numpy over x, and their number."""
    rows = df.collect()
    n, dims = x.shape
    c = x.astype(np.float64) - (x.sum(axis=0) / n).astype(np.float64)
    v = c.T @ c / n
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == n * k
    sums = x.sum(axis=0)
    deviations = collections.Counter(sum(int(n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x)
    assert collections.Counter(int(r["deviation"]) for r in rows if r["component"] == 1) == deviations
    at = collections.defaultdict(list)
    for r in rows:
        assert r["n"] == n and r["identity_error"] < 1e-10
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9
        at[r["row"]["vec_id"], r["row"]["label"]].append((r["component"], r["whitened"]))
    return at, c, v, values, k


def test_whitening(spark, sf):
    held = spark.read.parquet(f"{sf}/embeddings.parquet").limit(200)
    one = [0.25] * 64
    odd = [(900, None, 1), (901, [], 1), (902, [1.0] * 63, 1), (903, [None] + one[1:], 1), (904, [math.nan] + one[1:], 1),
           (905, [-math.inf] + one[1:], 1), (906, one, 1), (906, one, 1), (None, one, None), (907, [3.0e4] + one[1:], 1)]
    df = held.union(spark.createDataFrame(odd, held.schema)).repartition(3).cache()
    x = whole([r["embedding"] for r in df.collect() if r["vec_id"] != 902])
    at, c, v, values, k = checked(whitening.whiten(df), x)
    assert k == 32 and len(at[906, 1]) == 64 and len(at[None, None]) == 32
    # each component is a unit eigenvector: e w = V w, by what the rows say of it
    w, _ = whitening.fit(df)
    assert np.abs(v @ w.components - w.components * values[:32]).max() < 1e-11 * values[0]
    assert np.abs(w.components.T @ w.components - np.eye(32)).max() < 1e-13
    by_id = {r["vec_id"]: r["embedding"] for r in df.collect()}
    want = ((np.array([math.floor(64 * e) + 1_000_000 for e in by_id[907]]) - (x.sum(axis=0) / len(x)).astype(float)) @ w.components) / np.sqrt(values[:32])
    assert np.allclose([a for _, a in sorted(at[907, 1])], want, rtol=1e-9, atol=1e-9)


def test_whitening_where_little_varies(spark):
    """Dimensions that are constant or copies of others leave fewer components, scales far apart keep theirs."""
    draw = np.random.default_rng(5)
    base = draw.normal(size=(300, 3))
    v = np.column_stack([base[:, 0] * 1e4, base[:, 1], base[:, 2] * 10, np.full(300, 2.5), base[:, 1], base[:, 0] * 1e4])
    kind = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame([(i, [float(a) for a in r], 0) for i, r in enumerate(v)], kind)
    _, _, _, _, k = checked(whitening.whiten(df, 6), whole(v.tolist()), 6)
    assert k == 3
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5, [(1, None, 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).collect() == []
    clash = df.withColumns({c: F.lit(i) for i, c in enumerate(("row", "vector", "component", "n", "w", "deviation"))})
    assert whitening.whiten(clash, 6).count() == 900
    assert set(whitening.whiten(clash, 6).schema["row"].dataType.names) == set(clash.columns) - {"embedding"}


def test_deviations_stay_exact_beyond_64_bits():
    w = whitening.Whitening(3, np.array([10**13, 0]), np.zeros((2, 0)), np.zeros(0), np.zeros(0), 1)
    x = np.array([[10**13, 5], [4, 7]])
    assert whitening._deviations(w, x) == [(3 * a - 10**13) ** 2 + (3 * b) ** 2 for a, b in x.tolist()]


def test_split_terms():
    got = lexical._split(pa.array(["A b a", None, "", "é-é É"]))
    assert [n.tolist() for _, n in got][1:3] == [[], []] and sorted(got[0][1].tolist()) == [1, 2] and sorted(got[3][1].tolist()) == [1, 2]
