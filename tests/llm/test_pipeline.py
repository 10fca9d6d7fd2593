"""Each stage of the pipeline on what the one before kept, against brute force."""

import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from skeinlog.llm.common import cut
from skeinlog.llm.line_dedup import LEAST, one_edit
from skeinlog.llm.queries import tokenizer_paths

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_failed(t):
    w = SPACE.findall(t or "")
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    twice = {p for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    return len(w) < 50 or 100 * len(twice) > 50 * len(w)


def lines_left(docs):
    first, gone, out = {}, set(), {}
    for i, t in sorted(docs.items()):
        for k, x in enumerate(t.split("\n")):
            if SPACE.search(x):
                first.setdefault(x, (i, k))
    long = [x for x in first if len(x.encode()) >= LEAST]
    for x in long:
        if any(first[y] < first[x] and abs(len(x) - len(y)) < 2 and (x[:6] == y[:6] or x[-6:] == y[-6:]) and one_edit(x, y) for y in long):
            gone.add(x)
    for i, t in docs.items():
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if not SPACE.search(x) or (first[x] == (i, k) and x not in gone))
    return out


def one_of_each_group(docs, percent=80):
    sets, root = {}, {i: i for i in docs}
    for i, t in docs.items():
        w = SPACE.findall(t.translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: t for i, t in docs.items() if top(i) == i}


def uncontaminated(docs, items):
    windows = collections.defaultdict(set)
    for t in items:
        w = ALNUM.findall((t or "").translate(LOW))
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[n].add(tuple(w[s : s + n]))

    def hit(t):
        w = ALNUM.findall(t.translate(LOW))
        return any(tuple(w[s : s + n]) in found for n, found in windows.items() for s in range(len(w) - n + 1))

    return {i: t for i, t in docs.items() if not hit(t)}


def read(df):
    rows = df.collect()
    out = {r["doc_id"]: r["text"] for r in rows}
    assert len(out) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return out


def test_stages(spark, sf, small):
    docs = small.where("doc_id NOT IN (9006, 9008)").withColumn("n_chars", F.length("text").cast("long")).cache()
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    step = cut(stages["quality_rules"](spark, docs, sf))
    kept = read(step)
    assert step.columns == columns and all(given[i] == t and not base_failed(t) for i, t in kept.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(i in kept for i, q in labels.items() if q and not base_failed(given[i]))

    step = cut(stages["line_dedup"](spark, step, sf))
    assert step.columns == columns and read(step) == lines_left(kept)
    kept = read(step)

    step = cut(stages["near_dedup"](spark, step, sf))
    assert step.columns == columns and read(step) == one_of_each_group(kept)
    kept = read(step)

    step = cut(stages["decontamination"](spark, step, sf))
    assert step.columns == columns and read(step) == uncontaminated(kept, items)
    kept = read(step)

    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_paths()[0]).encode
    want = set()
    for i, t in kept.items():
        ids = np.array(encode(t, add_special_tokens=False).ids + [2], "<u4")
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want |= {(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))}
    rows = stages["best_fit_packing"](spark, step, sf).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)


def test_empty_table(spark, sf, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf))
        assert docs.count() == 0
