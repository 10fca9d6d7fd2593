"""Substring deduplication: passages that occur earlier in the corpus go. Suffix automata of reference shards give the
matching statistics of each document; where the last WINDOW words occur earlier, they are removed.

A corpus cannot be streamed past the automata of all of itself, so documents meet only the shards that they share text
with. Winnowed fingerprints find the regions that may repeat; hashes of their windows find the first place of each
repeated window, and so the reference: regions with such a place, dealt into shards of bounded size. A shard's automaton
goes to each bounded chunk of the regions that refer to it, which decides on words, not on hashes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, with_versions
from skeinlog.llm.decontaminate import fingerprint_filter
from skeinlog.llm.tokens import SPACE, Words, signed, slices, words

WINDOW = 20
RUN = 8
#: Bits of the filter of repeated fingerprints: 16 MB in each task. With more repeats than it can hold apart, more
#: windows are looked up; none is missed.
FILTER_BITS = 27
SHARD_WORDS = 100_000
CHUNK_WORDS = 400_000


def _selected(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of WINDOW words its start and its fingerprint's hash; and which rows begin a new fingerprint."""
    hashed, _ = w.runs(RUN)
    span = WINDOW - RUN + 1
    starts = np.flatnonzero(np.arange(len(hashed)) + WINDOW <= w.last())
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(0, bool)
    low, best = hashed[starts].copy(), starts.copy()
    for j in range(1, span):
        v = hashed[starts + j]
        less = v <= low
        low[less] = v[less]
        best[less] = starts[less] + j
    new = np.ones(len(best), bool)
    new[1:] = best[1:] != best[:-1]
    return starts, low, new


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            _, low, new = _selected(words(part.column("text"), SPACE))
            found, n = np.unique(low[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([signed(found), pa.array(n.astype(np.int64))], ["hash", "n"])


def _region_rows(filter_: np.ndarray, bits: int):
    """The longest runs of words in windows whose fingerprint the filter lets through."""
    mask = np.uint64((1 << bits) - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words(part.column("text"), SPACE)
                starts, low, _ = _selected(w)
                bit = low & mask
                hit = (filter_[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                starts = starts[hit]
                text = np.searchsorted(w.bounds, starts, side="right") - 1
                fresh = np.ones(len(starts), bool)
                fresh[1:] = (starts[1:] > starts[:-1] + 1) | (text[1:] != text[:-1])
                a = starts[fresh]
                b = starts[np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1] + WINDOW if len(starts) else a
                at = text[fresh]
                raw = [w.data[s:e].tobytes().decode() for s, e in zip(w.start[a].tolist(), w.end[b - 1].tolist(), strict=True)]
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc").take(take), part.column("version").take(take),
                    pa.array(a - w.bounds[at], pa.int64()), pa.array(b - a, pa.int64()), pa.array(raw, pa.string()),
                ], ["doc", "version", "first", "n", "text"])

    return rows


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and place of each window. A place in a text is one number: the first word of its region, and in the lower 32
    bits the offset there. Regions of a text lie one behind the other, so places are in the order of words."""
    for batch in batches:
        for part in slices(batch):
            w = words(part.column("text"), SPACE)
            hashed, fits = w.runs(WINDOW)
            at = np.flatnonzero(fits)
            region = np.searchsorted(w.bounds, at, side="right") - 1
            first = np.asarray(part.column("first")).astype(np.int64)
            take = pa.array(region, pa.int64())
            yield pa.RecordBatch.from_arrays([
                signed(hashed[at]), part.column("doc").take(take), part.column("version").take(take),
                pa.array((first[region] << 32) + at - w.bounds[region]),
            ], ["hash", "doc", "version", "place"])


class Automaton:
    """Suffix automaton of word sequences. Each state knows where its texts end first, in order of adding."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [-1]
        self.last, self.size, self.ids = 0, 0, {}

    def _push(self, c: int) -> None:
        nexts, links, lengths, ends = self.next, self.link, self.length, self.ends
        state, p = len(nexts), self.last
        nexts.append({})
        lengths.append(lengths[p] + 1)
        ends.append(self.size)
        links.append(0)
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = state
            p = links[p]
        if p >= 0:
            q = nexts[p][c]
            if lengths[p] + 1 == lengths[q]:
                links[state] = q
            else:
                twin = len(nexts)
                nexts.append(nexts[q].copy())
                lengths.append(lengths[p] + 1)
                ends.append(ends[q])
                links.append(links[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = links[p]
                links[q] = links[state] = twin
        self.last = state
        self.size += 1

    def add(self, sequence: list[str]) -> None:
        """Adds a sequence; a symbol of its own ends it, so that no match runs over its end."""
        for word in sequence:
            self._push(self.ids.setdefault(word, len(self.ids)))
        self._push(-1 - self.size)

    def first_ends(self, sequence: list[str], size: int) -> Iterator[tuple[int, int]]:
        """Where the last `size` words up to a place in the sequence occur: the place, and where they end first."""
        nexts, links, lengths = self.next, self.link, self.length
        state = matched = 0
        for i, word in enumerate(sequence):
            c = self.ids.get(word)
            if c is None:
                state = matched = 0
                continue
            while state and c not in nexts[state]:
                state = links[state]
                matched = lengths[state]
            if c in nexts[state]:
                state = nexts[state][c]
                matched += 1
                if matched >= size:
                    while lengths[links[state]] >= size:
                        state = links[state]
                        matched = lengths[state]
                    yield i, self.ends[state]


def _split(text: str) -> list[str]:
    return [x for x in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if x]


def _match(reference: pd.DataFrame, regions: pd.DataFrame) -> pd.DataFrame:
    """Spans (first word, end) of the regions whose windows all occur earlier in the reference."""
    out: list[tuple[int, int, int, int]] = []
    automaton, begins, places = Automaton(), [], []
    if len(regions):
        for doc, version, first, text in reference.sort_values(["doc", "version", "first"])[["doc", "version", "first", "text"]].itertuples(index=False):
            begins.append(automaton.size)
            places.append((doc, version, first))
            automaton.add(_split(text))
    for doc, version, first, text in regions[["doc", "version", "first", "text"]].itertuples(index=False):
        a = b = -1
        for i, end in automaton.first_ends(_split(text), WINDOW):
            k = bisect_right(begins, end) - 1
            d, v, f = places[k]
            start = first + i - WINDOW + 1
            if (d, v, f + end - begins[k] - WINDOW + 1) < (doc, version, start):
                if start > b:
                    if b > a:
                        out.append((doc, version, a, b))
                    a = start
                b = start + WINDOW
        if b > a >= 0:
            out.append((doc, version, a, b))
    return pd.DataFrame(out, columns=["doc", "version", "start", "end"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts words and digests what is left of each text."""
    for batch in batches:
        for part in slices(batch):
            w = words(part.column("text"), SPACE)
            keep = np.ones(len(w.hash), bool)
            for i, spans in enumerate(part.column("spans").to_pylist()):
                for s in spans or ():
                    keep[w.bounds[i] + s["start"] : w.bounds[i] + s["end"]] = False
            text = np.repeat(np.arange(part.num_rows), w.counts)[keep]
            begin, end = w.start[keep], w.end[keep]
            inner = np.ones(len(end), bool)  # followed by another kept word of its text, so by a separator
            if len(end):
                inner[:-1] = text[1:] == text[:-1]
                inner[-1] = False
            edge = np.zeros(len(w.data) + 2, np.int32)
            np.add.at(edge, begin, 1)
            np.add.at(edge, end + inner, -1)
            held = np.cumsum(edge)[: len(w.data)] > 0
            data = w.data.copy()
            data[end[inner]] = 0x20
            data = data[held]
            sizes = np.concatenate([[0], np.cumsum(held)])[w.offsets]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(w.counts.astype(np.int64)),
                pa.array(w.counts - np.bincount(text, minlength=part.num_rows).astype(np.int64)),
                pa.array([data[a:b].tobytes().decode() for a, b in zip(sizes, sizes[1:], strict=False)], pa.string()),
            ], ["doc_id", "n_words", "n_removed", "kept"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of words that occur earlier: rows (doc, version, spans), spans an array of (start, end), not merged.

    docs: doc (long, not null), version and text. Earlier: smaller (doc, version), or before in the same text.
    """
    seeds = docs.mapInArrow(_seed_rows, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")
    filter_ = fingerprint_filter(seeds, FILTER_BITS)
    regions = cut(docs.mapInArrow(
        _region_rows(filter_, FILTER_BITS), "doc long, version long, first long, n long, text string"
    ))
    windows = regions.mapInArrow(_window_rows, "hash long, doc long, version long, place long")
    place = F.struct("doc", "version", "place")
    origin = windows.groupBy("hash").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1")
    at = F.struct("doc", "version", "place")
    refers = (
        windows.join(origin.select("hash", "origin"), "hash")
        .where(at > F.col("origin"))
        .select(
            "doc", "version", F.shiftright("place", 32).alias("first"), F.col("origin.doc").alias("r_doc"),
            F.col("origin.version").alias("r_version"), F.shiftright("origin.place", 32).alias("r_first"),
        ).distinct()
    )
    refers = cut(refers)
    region = ["doc", "version", "first"]
    source = refers.select(*[F.col(f"r_{c}").alias(c) for c in region]).distinct()
    source = cut(regions.join(source, region).dropDuplicates(region))
    total = source.agg(F.sum("n")).first()[0]
    if not total:
        return docs.sparkSession.createDataFrame([], "doc long, version long, spans array<struct<start:long,end:long>>")
    shard = F.pmod(F.xxhash64(*region), F.lit(-(-total // SHARD_WORDS)))
    source = source.withColumn("shard", shard)
    wanted = refers.select(*region, F.pmod(F.xxhash64("r_doc", "r_version", "r_first"), F.lit(-(-total // SHARD_WORDS))).alias("shard")).distinct()
    asked = regions.dropDuplicates(region).join(wanted, region)
    loads = asked.groupBy("shard").agg(F.ceil(F.sum("n") / CHUNK_WORDS).cast("long").alias("chunks"))
    loads = cut(loads)
    asked = asked.join(loads, "shard").withColumn("chunk", F.pmod(F.xxhash64(*region), F.col("chunks")))
    source = source.join(loads, "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    columns = ["shard", "chunk", *region, "text"]
    spans = source.select(columns).groupBy("shard", "chunk").cogroup(asked.select(columns).groupBy("shard", "chunk")).applyInPandas(
        _match, "doc long, version long, start long, end long"
    )
    return spans.distinct().groupBy("doc", "version").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """For each row of docs (doc_id and text): doc_id, n_words, n_removed and kept, the words left joined by one space.

    A word goes if WINDOW neighbouring words of its text that cover it also start earlier: in a smaller doc_id, or
    earlier in the same text. Null ids come before all others; rows that agree in id but not in text are ordered by a
    hash of the text, rows that agree in both are one document and get the same answer. Null text has no words.
    """
    keyed = with_versions(docs.select("doc_id", "text"))
    spans = repeated_spans(keyed.select("doc", "version", "text")).withColumnsRenamed({"doc": "__doc", "version": "__version"})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed.join(spans, (F.col("doc") == F.col("__doc")) & (F.col("version") == F.col("__version")), "left").select(
        "doc_id", "text", "spans"
    ).mapInArrow(_finish, f"doc_id {kind}, n_words long, n_removed long, kept string")
