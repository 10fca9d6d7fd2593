"""Ranked lexical search by a dual tree: the best documents of every item, exactly, without scoring every pair.

Documents are cut to counts of the items' terms and worked off in batches where they lie. Over a batch's documents and
over the items stand hierarchies whose nodes hold the largest weight of each coordinate below them; the product of two
nodes bounds the score of every pair below. A pair of nodes whose bound is under the weakest k-th score of its items goes
as a whole. Tasks start from scores that a bounded sample of documents has reached, which are true lower bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, reachable
from skeinlog.llm.tokens import NOT_ALNUM, slices, words

K = 10
#: Text and number of the items that are held at once, on the driver and in each task; more items take more passes.
PASS_BYTES, PASS_ITEMS = 32 << 20, 1 << 16
#: Items of a block (a root) and of a group below it.
BLOCK, GROUP = 256, 8
#: Documents of a batch (a root), leaves of a node below it, documents of a leaf; cells of a batch's table of leaves.
BATCH, FAN, LEAF, CELLS = 4096, 16, 16, 1 << 22
#: Documents from which the first lower bounds come, about.
SEEDS = 16_384
SALTS = 32
#: Sums of whole numbers below this are exact in floating point, in any order.
EXACT = 1 << 53
_TOP = 1_000_000


def _split(text: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct terms as hashes, and how often each comes."""
    w = words(text, NOT_ALNUM, lower=True)
    return [np.unique(w.hash[a:b], return_counts=True) for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]


@dataclass
class _Block:
    """Items as rows of weights over the terms that they hold, in three levels of a tree."""

    items: np.ndarray  # their numbers
    terms: np.ndarray  # columns of the vocabulary, ascending
    rows: np.ndarray
    groups: np.ndarray = field(init=False)
    root: np.ndarray = field(init=False)
    exact: bool = field(init=False)

    def __post_init__(self) -> None:
        starts = np.arange(0, len(self.rows), GROUP)
        self.groups = np.maximum.reduceat(self.rows, starts, axis=0)
        self.root = self.groups.max(axis=0)
        self.exact = float(self.root.sum()) * _TOP < EXACT


def _blocks(queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> list[_Block]:
    """Items with like strongest terms stand together; items without a term that weighs anything are left out."""
    led = []
    for i, (terms, times) in enumerate(queries):
        value = weight[terms] * times
        if len(value) and value.max() > 0:
            led.append((int(terms[value.argmax()]), i))
    led.sort()
    out, held, cells = [], [], 0
    for _, i in led:
        held.append(i)
        cells += len(queries[i][0])
        if len(held) == BLOCK or cells * len(held) > CELLS:
            out.append(held)
            held, cells = [], 0
    out += [held] if held else []
    return [_block(np.array(b), queries, weight) for b in out]


def _block(items: np.ndarray, queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> _Block:
    terms = np.unique(np.concatenate([queries[i][0] for i in items]))
    rows = np.zeros((len(items), len(terms)))
    for k, i in enumerate(items):
        rows[k, np.searchsorted(terms, queries[i][0])] = weight[queries[i][0]] * queries[i][1]
    return _Block(items, terms, rows)


class _Best:
    """The k best documents of each item so far: scores, and ids in which null comes last."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.copy()
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * n

    def offer(self, item: int, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        s, z, d = (np.concatenate(x) for x in zip(self.held[item], (score, null, doc), strict=True))
        order = np.lexsort((d, z, -s))[: self.k]
        self.held[item] = s[order], z[order], d[order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], s[order[-1]])


def _tall(rows: np.ndarray, n: int) -> np.ndarray:
    """Coordinate maxima of every n rows."""
    return np.maximum.reduceat(rows, np.arange(0, len(rows), n), axis=0)


@dataclass
class _Batch:
    """Documents as rows of impacts, entries sorted by row: like ones stand together."""

    null: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    term: np.ndarray
    impact: np.ndarray

    @classmethod
    def of(cls, null: np.ndarray, doc: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, weight: np.ndarray) -> _Batch:
        """Orders documents by the two terms that tell most of them."""
        order = np.lexsort((-impact * weight[term], row))
        first = np.searchsorted(row[order], np.arange(len(doc)))
        lead = np.full((2, len(doc) + 1), -1, np.int64)
        for k in (0, 1):
            at = first + k
            there = at < len(order)
            there[there] &= row[order[at[there]]] == np.flatnonzero(there)
            lead[k, :-1][there] = term[order[at[there]]]
        by = np.lexsort((lead[1, :-1], lead[0, :-1]))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        moved = np.argsort(place[row], kind="stable")
        return cls(null[by], doc[by], place[row][moved], term[moved], impact[moved])

    def search(self, block: _Block, best: _Best) -> int:
        """Offers best every document that can be among an item's best; returns how many pairs were scored."""
        at = np.searchsorted(block.terms, self.term)
        at[at == len(block.terms)] = 0
        mine = block.terms[at] == self.term
        row, col, impact = self.row[mine], at[mine], self.impact[mine].astype(np.float64)
        leaves, width = -(-len(self.doc) // LEAF), len(block.terms)
        cell = (row // LEAF) * width + col
        order = np.argsort(cell, kind="stable")
        low = np.zeros(leaves * width)
        if len(order):
            fresh = np.flatnonzero(np.diff(cell[order], prepend=-1))
            low[cell[order][fresh]] = np.maximum.reduceat(impact[order], fresh)
        low = low.reshape(leaves, width)
        high = _tall(low, FAN)
        # where sums may not be exact, bounds are widened by more than they can be off
        slack = 1.0 if block.exact else 1 + 1e-9
        weak = best.floor[block.items]
        starts = np.arange(0, len(weak), GROUP)
        if block.root @ high.max(axis=0) * slack < max(weak.min(), 1):
            return 0
        coarse, scored = block.groups @ high.T * slack, 0
        ends = np.searchsorted(row, np.minimum(np.arange(leaves + 1) * LEAF, len(self.doc)))
        for s in np.argsort(-coarse.max(axis=0)):
            weak = best.floor[block.items]
            groups = np.flatnonzero(coarse[:, s] >= np.maximum(np.minimum.reduceat(weak, starts), 1))
            if not len(groups):
                continue
            some = np.arange(s * FAN, min((s + 1) * FAN, leaves))
            fine = block.groups[groups] @ low[some].T * slack >= np.maximum(np.minimum.reduceat(weak, starts)[groups], 1)[:, None]
            groups, some = groups[fine.any(axis=1)], some[fine.any(axis=0)]
            if not len(groups):
                continue
            own = np.concatenate([np.arange(g * GROUP, min((g + 1) * GROUP, len(weak))) for g in groups])
            meet = block.rows[own] @ low[some].T * slack >= np.maximum(weak[own], 1)[:, None]
            own, some = own[meet.any(axis=1)], some[meet.any(axis=0)]
            if len(own):
                scored += self._score(block, best, own, some, row, col, impact, ends)
        return scored

    def _score(self, block, best, own, some, row, col, impact, ends) -> int:
        entries = np.concatenate([np.arange(ends[b], ends[b + 1]) for b in some])
        docs = np.concatenate([np.arange(b * LEAF, min((b + 1) * LEAF, len(self.doc))) for b in some])
        dense = np.zeros((len(docs), block.rows.shape[1]))
        dense[np.searchsorted(docs, row[entries]), col[entries]] = impact[entries]
        if block.exact:
            score = (block.rows[own] @ dense.T).astype(np.int64)
        else:
            score = block.rows[own].astype(np.int64) @ dense.T.astype(np.int64)
        for k, i in enumerate(block.items[own]):
            hit = np.flatnonzero(score[k] >= max(best.floor[i], 1))
            if len(hit):
                best.offer(int(i), score[k][hit], self.null[docs[hit]], self.doc[docs[hit]])
        return score.size


def _term_counts(vocabulary: np.ndarray):
    """For each document with a term: how many terms it has, and which of the vocabulary's it holds how often."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words(part.column("text"), NOT_ALNUM, lower=True)
                at = np.searchsorted(vocabulary, w.hash)
                at[at == len(vocabulary)] = 0
                hit = vocabulary[at] == w.hash if len(vocabulary) else np.zeros(len(at), bool)
                text = np.repeat(np.arange(part.num_rows), w.counts)[hit]
                pair, times = np.unique(text * max(len(vocabulary), 1) + at[hit], return_counts=True)
                text, term = pair // max(len(vocabulary), 1), pair % max(len(vocabulary), 1)
                bounds = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                out = pa.RecordBatch.from_arrays([
                    part.column("doc"), pa.array(w.counts.astype(np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                ], ["doc", "n", "terms", "times"])
                yield out.filter(pa.array(w.counts > 0))

    return rows


def _impacts(n: np.ndarray, tf: np.ndarray, texts: int, length: int) -> np.ndarray:
    """What tf occurrences in a document of n terms are worth, before the term's weight."""
    if len(n) and 75 * int(n.max()) * texts >= 1 << 63:
        m = np.array([25 + 75 * int(x) * texts // length for x in n], np.int64)
    else:
        m = 25 + (75 * n * texts) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _searched(shared, texts: int, length: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, weight, floor = shared.value
        best = _Best(len(floor), k, floor)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                terms, times = part.column("terms"), part.column("times")
                count = np.asarray(terms.value_lengths()).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), count)
                n = np.asarray(part.column("n")).astype(np.int64)
                impact = _impacts(n[row], np.asarray(times.flatten()).astype(np.int64), texts, length)
                null = np.asarray(part.column("doc").is_null())
                doc = np.asarray(part.column("doc").fill_null(0)).astype(np.int64)
                made = _Batch.of(null, doc, row, np.asarray(terms.flatten()).astype(np.int64), impact, weight)
                for block in blocks:
                    made.search(block, best)
        item = np.repeat(np.arange(len(best.held)), [len(h[0]) for h in best.held])
        score, null, doc = (np.concatenate(x) for x in zip(*best.held, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=null), pa.array(score)], ["item", "doc_id", "score"])

    return rows


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item, first within salted parts of it."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item", "__salt").orderBy(*order)
    some = found.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn("rank", F.row_number().over(part))
    whole = Window.partitionBy("item").orderBy(*order)
    return some.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).drop("__salt")


def _one_pass(docs: DataFrame, items: list, k: int) -> DataFrame:
    """Rows (item, rank, doc_id, score) of some items, item being the number in the list."""
    spark = docs.sparkSession
    queries = _split(pa.array([r["text"] for r in items], pa.string()))
    vocabulary = np.unique(np.concatenate([q[0] for q in queries]))
    queries = [(np.searchsorted(vocabulary, q), n) for q, n in queries]
    vectors = cut(docs.mapInArrow(_term_counts(vocabulary), "doc long, n long, terms array<int>, times array<int>"))
    got = vectors.agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("length")).first()
    texts, length = got["texts"], got["length"] or 1
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[np.asarray(held["term"])] = np.asarray(held["count"])
    weight = np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.float64)
    blocks = _blocks(queries, weight)
    kind = "item long, doc_id long, score long"

    def search(rows: DataFrame, floor: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((blocks, weight, floor))
        return _ranked(rows.mapInArrow(_searched(shared, texts, length, k), kind), k)

    floor = np.zeros(len(items), np.int64)
    if texts > 2 * SEEDS:
        some = vectors.where(F.pmod(F.xxhash64("doc", "n", "terms"), F.lit(texts // SEEDS)) == 0)
        for r in search(some, floor).where(F.col("rank") == k).collect():  # at most one row an item
            floor[r["item"]] = r["score"]
    return search(vectors, floor)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """For each row of items (item_id, text) its k best rows of docs (doc_id, text): item_id, rank from 1, doc_id (long),
    score. Documents that score 0 are left out, so an item may have fewer rows, or none.

    Terms are runs of ASCII letters, digits and all characters from U+0080 on, with ASCII letters lower-cased. N documents
    have a term, L terms in all, df documents hold a term: it weighs floor(1000 ln((2 N + 2) / (2 df + 1))), and adds that
    times (10^9 tf) div (1000 tf + 8 m) for each time that the item holds it, m = 25 + (75 n N) div L in a document of n.

    Null and empty texts have no terms. Equal scores go by doc_id, null last. Repeated rows are documents, or items, of
    their own. Both tables may be empty, and hold further columns of any name. Items are held on the driver and in tasks
    up to PASS_BYTES of text at once (a longer item alone); more of them take further passes over the documents.
    """
    spark = docs.sparkSession
    reachable(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    items = items.select("item_id", "text").where("text IS NOT NULL")
    got = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    passes = max(-(-(got["size"] or 0) // PASS_BYTES), -(-got["n"] // PASS_ITEMS), 1)
    if passes > 1:
        items = cut(items.withColumn("__number", F.monotonically_increasing_id()))
    out = []
    for p in range(passes):
        mine = items if passes == 1 else items.where(F.pmod(F.xxhash64("__number"), F.lit(passes)) == p)
        rows = mine.select("item_id", "text").collect()  # a pass holds so many by its bounds
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = _one_pass(docs, rows, k) if any(r["text"] for r in rows) else None
        if found is None:
            found = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
        found = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out.append(found if passes == 1 else cut(found))
    whole = out[0]
    for one in out[1:]:
        whole = whole.union(one)
    return whole
