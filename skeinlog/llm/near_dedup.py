"""Near-duplicate documents: universal hash minima of word shingles, bands, exact confirmation, connected components.

Documents with one set of shingles are one class from the start; only a class's first document goes further. In a bucket
of a band all members are compared with one hub. Only where that leaves a bucket in several components is every member
outside the largest one compared with the others, block by block, inside tasks that put out confirmed pairs only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, doc_key
from skeinlog.llm.components import components
from skeinlog.llm.tokens import SPACE, Words, mix, slices, words

SHINGLE = 5
#: A pair of similarity 0.8 misses all bands once in 20 million pairs, one of 0.85 once in 10 billion.
BANDS, ROWS = 32, 4
#: Minima of a signature; the bands use the first of them. Two signatures are alike if they share a part that is four
#: standard errors below the asked similarity: of links just at the bound, one in 30,000 is left to other paths.
MINIMA = 512
SLACK = 4.0
BLOCK = 256

_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def shingle_sets(w: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes: k words each, or all words of a shorter text."""
    hashed, fits = w.runs(k)
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(hashed[a:b][fits[a:b]])
        elif b > a:
            one = np.uint64(b - a)
            for h in w.hash[a:b]:
                one = mix(np.array([one * np.uint64(31) + h]))[0]
            yield np.array([one])
        else:
            yield np.zeros(0, np.uint64)


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 256):
        part = s[None, i : i + 256] * _A[:, None]
        part += _B[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def _signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in slices(batch):
                size, digest, signature, keys = [], [], [], []
                for s in shingle_sets(words(part.column("text"), SPACE, lower=True)):
                    size.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    low = minima(s) if len(s) else None
                    signature.append(None if low is None else low.astype(np.uint8).tobytes())
                    keys.append([] if low is None else band_keys(low))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("version"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                    pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ], ["doc_id", "version", "n_shingles", "digest", "signature", "bands"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in slices(batch):
                sets = [s.tobytes() for s in shingle_sets(words(part.column("text"), SPACE, lower=True))]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "members"])


def _least_shared(percent: int) -> float:
    j = percent / 100
    return MINIMA * j - SLACK * (MINIMA * j * (1 - j)) ** 0.5


def _alike(percent: int):
    """Keeps the pairs whose signatures share enough minima."""
    least = _least_shared(percent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("s_a", "s_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return rows


def _confirmed(percent: int):
    """Keeps the pairs whose whole sets are similar enough."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("m_a"), batch.column("m_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def _block_pairs(percent: int):
    """Alike pairs of two blocks of one bucket that lie in different components, each in the first bucket it shares."""
    least = _least_shared(percent)

    def side(v: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = v.values
        signature = np.frombuffer(b"".join(rows.field("signature").to_pylist()), np.uint8).reshape(-1, MINIMA)
        bands = np.asarray(rows.field("bands").flatten()).reshape(-1, BANDS)
        return np.asarray(rows.field("node")), np.asarray(rows.field("component")), signature, bands

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            keys, mains = batch.column("key").to_pylist(), batch.column("main").to_pylist()
            for key, main, x, y in zip(keys, mains, batch.column("few"), batch.column("many"), strict=True):
                (n, c, s, p), (m, d, t, q) = side(x), side(y)
                for i in range(len(n)):
                    # two that are both outside the largest component meet twice in a bucket: once is enough
                    hit = np.flatnonzero((d != c[i]) & ((d == main) | (m > n[i])))
                    hit = hit[(t[hit] == s[i]).sum(axis=1) >= least]
                    shared = q[hit] == p[i]
                    hit = hit[p[i][shared.argmax(axis=1)] == key] if len(hit) else hit
                    out_a.append(np.minimum(m[hit], n[i]))
                    out_b.append(np.maximum(m[hit], n[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return rows


class _Corpus:
    """What confirming links needs: signatures of the classes' first documents, and all texts."""

    def __init__(self, docs: DataFrame, first: DataFrame, percent: int) -> None:
        self.docs, self.first, self.percent = docs, first, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, written once."""
        s = self.first.select(F.col("node"), "signature")
        alike = cut(
            pairs.join(s.withColumnsRenamed({"node": "a", "signature": "s_a"}), "a")
            .join(s.withColumnsRenamed({"node": "b", "signature": "s_b"}), "b")
            .mapInArrow(_alike(self.percent), "a long, b long")
        )
        asked = alike.select(F.col("a").alias("node")).union(alike.select("b")).distinct().join(self.first.select("node", "doc_id", "version"), "node")
        texts = self.docs.join(asked, ["doc_id", "version"]).select("node", "text").dropDuplicates(["node"])
        sets = cut(texts.mapInArrow(_set_rows, "node long, members binary"))
        return cut(
            alike.join(sets.withColumnsRenamed({"node": "a", "members": "m_a"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "members": "m_b"}), "b")
            .mapInArrow(_confirmed(self.percent), "a long, b long")
        )


def _pairs_with_hub(members: DataFrame) -> DataFrame:
    """In each bucket everyone with the hub: the member that meets most others in all its buckets, so the middle of a
    cloud of variants rather than one on its edge."""
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", -F.col("node"))).alias("best"))
    hubs = hubs.select("key", (-F.col("best.col2")).alias("hub"))
    return members.join(hubs, "key").where("node != hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    ).distinct()


def _pairs_left(members: DataFrame, found: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Alike pairs across components, from buckets that the links so far leave in more than one."""
    at = members.where("n > 2").join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    sizes = at.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select("key", F.col("main.component").alias("main"), "all")
    rows = at.join(split, "key").join(first.select("node", "signature", "bands"), "node")
    # blocks of bounded size; a small bucket is one block
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("all") / BLOCK).cast("long"))
    held = F.collect_list(F.struct("node", "component", "signature", "bands"))
    rows = rows.withColumn("block", block)
    few = rows.where("component != main").groupBy("key", "block").agg(held.alias("few"), F.first("main").alias("main"))
    many = rows.groupBy("key", "block").agg(held.alias("many"))
    return few.select("key", "few", "main").join(many.select("key", "many"), "key").mapInArrow(
        _block_pairs(percent), "a long, b long"
    ).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """For each row of docs (doc_id long and text): doc_id, version (hash of its text), n_shingles, component_id, kept.

    Two documents are linked if their sets of five-word shingles (ASCII lower-cased) share at least `percent` of their
    union; component_id is the least doc_id reachable, and kept says that the row is the first document there. A text
    without words is linked with nothing. A row without doc_id is linked with nothing, gets no component_id and is kept.
    Rows that agree in id and text are one document; rows that agree in id only are documents of their own, in order of
    version.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("version"), "text")
    facts = cut(docs.mapInArrow(
        _signed_rows, "doc_id long, version long, n_shingles long, digest binary, signature binary, bands array<long>"
    ))
    filled = facts.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min(F.struct("doc_id", "version")).alias("first"))
    # numbers in the order of the first documents, so that the least number is the least doc_id
    classes = cut(classes.select("digest", "first.*").orderBy("doc_id", "version").withColumn("node", F.monotonically_increasing_id()))
    first = cut(
        facts.select("doc_id", "version", "signature", "bands").join(classes.select("node", "doc_id", "version"), ["doc_id", "version"])
        .dropDuplicates(["node"])
    )
    buckets = first.select("node", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(buckets.join(shared, "key"))
    corpus = _Corpus(docs, first, percent)
    links = corpus.links(_pairs_with_hub(members))
    found = components(links)
    left = cut(_pairs_left(members, found, first, percent))
    if left.take(1):
        found = components(links.union(corpus.links(left)))
    heads = classes.select(F.col("node").alias("component"), F.col("doc_id").alias("__component"), F.col("version").alias("__first"))
    named = classes.select("digest", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(
        heads, "component"
    ).select(F.col("digest").alias("__digest"), "__component", "__first")
    own = F.struct("doc_id", "version").eqNullSafe(F.struct(F.col("__component").alias("doc_id"), F.col("__first").alias("version")))
    return (
        facts.select("doc_id", "version", "n_shingles", "digest")
        .join(named, (F.col("digest") == F.col("__digest")) & F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), "left")
        .select(
            "doc_id", "version", "n_shingles", F.coalesce("__component", "doc_id").alias("component_id"),
            (F.col("__component").isNull() | own).alias("kept"),
        )
    )


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, with all its columns; rows without doc_id stay."""
    told = near_duplicates(docs.select("doc_id", "text"), percent)
    gone = told.where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct()
    return docs.withColumn("__key", doc_key()).join(
        gone, (F.col("doc_id") == F.col("__id")) & (F.col("__key") == F.col("__version")), "left_anti"
    ).drop("__key")
