"""N-gram Jaccard join by vertical partitioning: which documents share nearly all of their word n-grams, exactly.

All n-grams stand in one global order, rare ones first. The order is cut into fragments of like weight, and every document
into one segment a fragment. Pairs to look at come from the rare end: two linked documents share an n-gram among the first
few of each. For such a pair every fragment counts the overlap of two short segments on its own; the sum over fragments is
the whole overlap, and decides.

Two of a bucket that stay apart are looked at by sketches first: each counts its n-grams by cells of a hash, and two sets
differ in no fewer n-grams than their counts do. So pairs that are counted out are about as many as links.

Before that, a fixed part of all n-grams sieves the documents: one that holds more n-grams there that no other has than it
may miss in all is linked with nothing. Equal sets are one node from then on. Links serve to join documents, so a bucket of many like documents is not paired
out: its members meet one middle member first, and only those that this leaves apart meet the others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, reachable, with_versions
from skeinlog.llm.components import components
from skeinlog.llm.decontaminate import fingerprint_filter
from skeinlog.llm.near_dedup import shingle_sets
from skeinlog.llm.tokens import SPACE, slices, words

SIZE = 3
FRAGMENTS = 16
#: Classes of the global order: n-grams by how many nodes hold them, four to an octave, and parts of a class by hash.
OCTAVE, PART_BITS = 4, 6
#: N-grams that hold this share of all rows, and at least so many, are met by a broadcast of them instead of a shuffle:
#: there are at most 2^HOT_BITS of them.
HOT_BITS, HOT_LEAST = 17, 1000
#: The sieve holds one in so many n-grams, by hash. Documents that it leaves are asked for by a filter of 2^FILTER_BITS
#: bits; with more documents than it can hold apart, more of them go on, and none is missed.
SIEVE, FILTER_BITS = 4, 27
#: Members of a bucket that are compared at once.
BLOCK = 256
#: Counters of a sketch, a byte each.
SKETCH_BITS = 8


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in slices(batch):
                yield part, list(shingle_sets(words(part.column("text"), SPACE, lower=True), size))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(grams.view(np.int64)))


def _facts(size: int):
    """Size and digest of each document's set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, size):
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([
                *(part.column(c) for c in ("doc_id", "doc", "version")), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
            ], ["doc_id", "doc", "version", "n", "digest"])

    return rows


def _sieved(size: int, percent: int):
    """The n-grams of the sieve, each with its document and how many n-grams that may miss."""
    top = np.uint64((1 << 64) // SIEVE - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, size):
            low = [s[: np.searchsorted(s, top, side="right")] for s in sets]
            take = pa.array(np.repeat(np.arange(len(low)), [len(s) for s in low]))
            spare = pa.array([len(s) - -(-percent * len(s) // 100) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([
                part.column("doc").take(take), part.column("version").take(take), spare.take(take), _lists(low).flatten(),
            ], ["doc", "version", "spare", "gram"])

    return rows


def _asked_sets(size: int, filter_: np.ndarray):
    """The sets of documents whose key the filter lets through."""
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.asarray(batch.column("key")).view(np.uint64) & mask
            hit = (filter_[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            for part, sets in _sets(iter([batch.filter(pa.array(hit))]), size):
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                out = pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(digest, pa.binary()), _lists(sets)], ["doc_id", "digest", "grams"])
                yield out.filter(pa.array([len(s) > 0 for s in sets], pa.bool_()))

    return rows


def _need(size: Column, percent: int) -> Column:
    """N-grams that a set of this size must share with one that it is linked with."""
    return F.floor((percent * size + 99) / 100).cast("long")


def fragment_of(held: DataFrame, fragments: int) -> Column:
    """A column that gives each n-gram (cell) its fragment; held: rows (cell, weight), few. Fragments are runs of cells."""
    rows = sorted((r["cell"], r["weight"]) for r in held.collect())
    total, so_far, pivots = sum(w for _, w in rows), 0, []
    for cell, weight in rows:
        if so_far * fragments >= (len(pivots) + 1) * total and so_far:
            pivots.append(cell)
        so_far += weight
    out = F.lit(0)
    for p in pivots:
        out = out + (F.col("cell") >= p).cast("int")
    return out


def segments(nodes: DataFrame, percent: int, fragments: int = FRAGMENTS) -> DataFrame:
    """Rows (node, size, alone, fragment, before, room, grams) of nodes (node, n, grams), written once.

    alone: how many n-grams no other node has; they are a fragment of their own in which no pair overlaps. grams: the node's
    other n-grams in this fragment, in global order; before: how many it has in earlier fragments; room: how many of all of
    them, from the first, another node must meet. Nodes with too many alone are left out: they are linked with nothing.
    """
    rows = nodes.select("node", F.explode("grams").alias("gram"))
    weights = cut(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    cell = (F.floor(F.log2("n") * OCTAVE) * (1 << PART_BITS) + F.shiftrightunsigned("gram", 64 - PART_BITS)).cast("int")
    weights = weights.withColumn("cell", cell)
    held = weights.groupBy("cell").agg(F.sum("n").alias("weight"))
    least = max((weights.agg(F.sum("n")).first()[0] or 0) >> HOT_BITS, HOT_LEAST)
    fragment, hot = fragment_of(held, fragments), weights.where(F.col("n") > least).select("gram", "cell")
    told = rows.join(weights.where(F.col("n") <= least).select("gram", "cell"), "gram")
    if hot.take(1):
        hot = F.broadcast(cut(hot))
        told = rows.join(hot, "gram", "left_anti").join(weights.where(F.col("n") <= least).select("gram", "cell"), "gram").unionByName(
            rows.join(hot, "gram")
        )
    by_node = told.repartition("node").groupBy("node", fragment.alias("fragment")).agg(
        F.sort_array(F.collect_list(F.struct("cell", "gram"))).alias("grams")
    )
    own = Window.partitionBy("node")
    held = by_node.select("node", "fragment", F.transform("grams", lambda g: g.gram).alias("grams")).withColumns({
        "shared": F.sum(F.size("grams")).over(own),
        "before": F.sum(F.size("grams")).over(own.orderBy("fragment")) - F.size("grams"),
    })
    size = F.col("n")
    return cut(
        held.join(nodes.select("node", "n"), "node").withColumn("room", F.col("shared") - _need(size, percent) + 1)
        .where("room > 0").select("node", size.alias("size"), (size - F.col("shared")).alias("alone"), "fragment", "before", "room", "grams")
    )


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (a, b, both, s_a, s_b) of pairs (a, b) of nodes: what they share, summed over the fragments, and their sizes."""
    left = parts.select(F.col("node").alias("a"), "fragment", F.col("size").alias("s_a"), F.col("grams").alias("g_a"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("size").alias("s_b"), F.col("grams").alias("g_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "s_a", "s_b", F.size(F.array_intersect("g_a", "g_b")).cast("long").alias("both")
    )
    return partial.groupBy("a", "b").agg(F.sum("both").alias("both"), F.first("s_a").alias("s_a"), F.first("s_b").alias("s_b"))


def _links(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    return cut(overlaps(pairs, parts).where(100 * F.col("both") >= percent * (F.col("s_a") + F.col("s_b") - F.col("both"))).select("a", "b"))


def _may_be_linked(x: tuple[str, str], y: tuple[str, str], percent: int) -> Column:
    """Whether sets (size, alone) can share enough: no more than each has besides what it has alone."""
    (s, a), (t, b) = ((F.col(i), F.col(j)) for i, j in (x, y))
    return (100 + percent) * F.least(s - a, t - b) >= percent * (s + t)


def _pairs_with_hubs(members: DataFrame, percent: int) -> DataFrame:
    """In each bucket everyone with a member of like size that meets most others in all its buckets: the middle of a cloud
    of variants. Sizes are dealt into bands no two of which apart can hold linked sets; a hub serves its band and the next."""
    band = F.floor(F.log(F.col("size")) / math.log(100 / percent)).cast("int") if percent < 100 else F.col("size")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    at = members.withColumn("band", band)
    hubs = at.join(weight, "node").groupBy("key", "band").agg(F.max(F.struct("weight", -F.col("node"), "size", "alone")).alias("best"))
    hubs = hubs.select(
        "key", F.explode(F.array("band", F.col("band") + 1)).alias("band"), (-F.col("best.col2")).alias("hub"), F.col("best.size").alias("h_size"),
        F.col("best.alone").alias("h_alone"),
    )
    return at.join(hubs, ["key", "band"]).where(F.col("node") != F.col("hub")).where(_may_be_linked(("size", "alone"), ("h_size", "h_alone"), percent)).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    ).distinct()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many n-grams of each node fall into each cell of a hash, 255 at most."""
    cells = 1 << SKETCH_BITS
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                grams = part.column("grams")
                cell = (np.asarray(grams.flatten()).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS)
                owner = np.repeat(np.arange(len(grams)), np.asarray(grams.value_lengths()))
                counts = np.bincount(owner * cells + cell.astype(np.int64), minlength=len(grams) * cells)
                told = np.minimum(counts, 255).astype(np.uint8).reshape(-1, cells)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([x.tobytes() for x in told], pa.binary())], ["node", "sketch"])


def _block_pairs(percent: int, best: bool):
    """Pairs of two blocks of one bucket that lie in different components and may be linked by what their segments of the
    bucket's fragment share; each pair in the bucket of the first n-gram that they share there. With best, of a node's
    partners in one component only the one that shares most."""

    def side(v: pa.Scalar):
        rows = v.values
        grams = rows.field("grams")
        return (
            *(np.asarray(rows.field(c)).astype(np.int64) for c in ("node", "component", "size", "lost")),
            np.asarray(grams.flatten()), np.asarray(grams.value_lengths()).astype(np.int64),
            np.frombuffer(b"".join(rows.field("sketch").to_pylist()), np.uint8).reshape(len(rows), -1).astype(np.int16),
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            keys, mains = batch.column("key").to_pylist(), batch.column("main").to_pylist()
            for key, main, x, y in zip(keys, mains, batch.column("few"), batch.column("many"), strict=True):
                (n, c, s, u, g, k, few), (m, d, t, v, h, l, many) = side(x), side(y)
                ends, owner = np.cumsum(k), np.repeat(np.arange(len(m)), l)
                for i in range(len(n)):
                    # linked sets share at least this, and differ in no more than the rest
                    share = -(-percent * (s[i] + t) // (100 + percent))
                    # two that are both outside the largest component meet twice: once is enough
                    out = (d != c[i]) & ((d == main) | (m > n[i]))
                    out &= np.abs(many - few[i]).sum(axis=1) <= s[i] + t - 2 * share
                    if not out.any():
                        continue
                    hit = np.flatnonzero(np.isin(h, g[ends[i] - k[i] : ends[i]]))
                    both = np.bincount(owner[hit], minlength=len(m))
                    first = np.zeros(len(m), np.int64)
                    first[owner[hit][::-1]] = h[hit][::-1]
                    # What either has alone, in earlier fragments (a pair that shares some of that is met in a bucket there)
                    # or leaves out in this fragment is lost to it.
                    out &= (u[i] + k[i] - both <= s[i] - share) & (v + l - both <= t - share) & (first == key)
                    out = np.flatnonzero(out)
                    if best and len(out) > 1:
                        out = out[np.lexsort((m[out], -both[out], d[out]))]
                        out = out[np.diff(d[out], prepend=-1) != 0]
                    out_a.append(np.minimum(m[out], n[i]))
                    out_b.append(np.maximum(m[out], n[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return rows


def _pairs_left(
    members: DataFrame, found: DataFrame, parts: DataFrame, sketches: DataFrame, percent: int, best: bool
) -> DataFrame:
    """Pairs across components that may be linked, from buckets that the links so far leave in more than one."""
    at = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = at.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select("key", F.col("main.component").alias("main"), "all")
    rows = at.select("key", "node", "component", "size", "lost", "fragment").join(split, "key").join(
        parts.select("node", "fragment", "grams"), ["node", "fragment"]
    ).join(sketches, "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("all") / BLOCK).cast("long"))
    held = F.collect_list(F.struct("node", "component", "size", "lost", "grams", "sketch"))
    rows = rows.withColumn("block", block)
    few = rows.where("component != main").groupBy("key", "block").agg(held.alias("few"), F.first("main").alias("main"))
    many = rows.groupBy("key", "block").agg(held.alias("many"))
    return few.select("key", "few", "main").join(many.select("key", "many"), "key").mapInArrow(
        _block_pairs(percent, best), "a long, b long"
    ).distinct()


def linked(nodes: DataFrame, percent: int, fragments: int = FRAGMENTS) -> DataFrame:
    """Components (node, component) of nodes (node, n, grams: distinct 64-bit n-grams, not none) under the links of pairs
    whose grams share at least `percent` of their union; only of nodes that have a link."""
    parts = segments(nodes, percent, fragments)
    early = parts.where("before < room").select(
        "node", "size", "alone", (F.col("alone") + F.col("before")).alias("lost"), "fragment", F.explode(F.slice("grams", F.lit(1), (F.col("room") - F.col("before")).cast("int"))).alias("key")
    )
    shared = early.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(early.join(shared, "key"))
    met = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "grams")
    sketches = cut(met.mapInArrow(_sketches, "node long, sketch binary"))
    links = _links(_pairs_with_hubs(members, percent), parts, percent)
    found = components(links)
    # the likeliest partner in each component first: where it joins a node to a cloud, the cloud's others need no look
    for best in (True, False):
        left = cut(_pairs_left(members, found, parts, sketches, percent, best))
        if not left.take(1):
            break
        links = links.union(_links(left, parts, percent))
        found = components(links)
    return found


def _key() -> Column:
    return F.xxhash64("doc", "version")


def _unsieved(docs: DataFrame, facts: DataFrame, percent: int, size: int) -> DataFrame:
    """Documents (doc, version) that the sieve leaves. An n-gram of one document counts there and goes nowhere else."""
    rows = docs.select("doc", "version", "text").mapInArrow(_sieved(size, percent), "doc long, version long, spare long, gram long")
    alone = rows.groupBy("gram").agg(F.min(F.struct("doc", "version", "spare")).alias("of"), F.count(F.lit(1)).alias("times")).where("times = 1")
    lost = alone.groupBy("of").agg(F.count(F.lit(1)).alias("alone")).where("alone > of.spare").select("of.doc", "of.version")
    return facts.select("doc", "version").join(lost, ["doc", "version"], "left_anti")


def join_components(docs: DataFrame, percent: int = 90, size: int = SIZE, fragments: int = FRAGMENTS) -> DataFrame:
    """For each row of docs (doc_id long, text): doc_id, n_shingles, component_id.

    A document's set: its distinct runs of `size` words (ASCII lower-cased), or all words of a shorter text as one; without
    words (null, empty, blank) it is empty and linked with nothing. Two documents are linked if their sets share at least
    `percent` of their union; component_id is the least doc_id that links reach. Rows without doc_id are linked with nothing
    and have no component_id. Rows that agree in id only are documents of their own; repeated rows are answered each. Other
    columns may have any name; an empty table gives no rows. N-grams are told apart by 64-bit hashes.
    """
    reachable(docs.sparkSession)
    docs = with_versions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    facts = cut(docs.mapInArrow(_facts(size), "doc_id long, doc long, version long, n long, digest binary"))
    named = docs.where("doc_id IS NOT NULL")
    kept = _unsieved(named, facts.where("doc_id IS NOT NULL AND n > 0"), percent, size)
    filter_ = fingerprint_filter(kept.select(_key().alias("hash")), FILTER_BITS)
    sets = named.select("doc_id", "text", _key().alias("key")).mapInArrow(
        _asked_sets(size, filter_), "doc_id long, digest binary, grams array<long>"
    )
    nodes = cut(
        sets.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("grams").alias("grams"))
        .select("digest", "doc_id", F.size("grams").cast("long").alias("n"), "grams", F.monotonically_increasing_id().alias("node"))
    )
    found = linked(nodes.select("node", "n", "grams"), percent, fragments)
    heads = nodes.select("digest", "doc_id", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = heads.groupBy("component").agg(F.min("doc_id").alias("__least"))
    named = heads.join(least, "component").select(F.col("digest").alias("__digest"), "__least")
    return (
        facts.select("doc_id", "n", "digest")
        .join(named, (F.col("digest") == F.col("__digest")) & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("__least", "doc_id").alias("component_id"))
    )
