"""Benchmark decontamination by winnowing: of every window of word runs the one with the least hash is a fingerprint, so
any span that is long enough shares one with its source; fingerprints are joined and their hits extended word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, doc_key
from skeinlog.llm.tokens import NOT_ALNUM, Words, mix, slices, words

WINDOW = 10
#: Words of a fingerprint. WINDOW - RUN + 1 of them start in each window, and the least is taken.
RUN = 5
#: Bits of the filter of benchmark fingerprints that tasks hold: 2 MB, whatever the benchmark's size. With a larger
#: benchmark it lets more through to the join; it never drops a hit.
FILTER_BITS = 24

_FINGERPRINT = "hash long, n int, at int, head array<string>, run array<string>, tail array<string>"


def least_in_windows(value: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """Places of the least of each w neighbouring values, the last one in a tie. valid: where w values may start."""
    n = len(value)
    if n < w or not valid.any():
        return np.zeros(0, np.int64)
    best = np.arange(n - w + 1)
    low = value[: n - w + 1].copy()
    for j in range(1, w):
        v = value[j : n - w + 1 + j]
        less = v <= low
        low[less] = v[less]
        best[less] = np.flatnonzero(less) + j
    return np.unique(best[valid[: n - w + 1]])


def fingerprints(w: Words, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed fingerprints of texts of at least `window` words."""
    hashed, _ = w.runs(run)
    at = least_in_windows(hashed, np.arange(len(hashed)) + window <= w.last(), window - run + 1)
    return at, hashed[at]


def _short_runs(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    hashed, fits = w.runs(n)
    at = np.flatnonzero(fits)
    return at, mix(hashed[at] + np.uint64(n))


def _context(w: Words, at: int, n: int, first: int, last: int) -> tuple[list[str], list[str], list[str]]:
    """The words that a window over this fingerprint can reach."""
    reach = WINDOW - RUN if n == 0 else 0
    size = n or RUN
    return w.text(max(first, at - reach), at), w.text(at, at + size), w.text(at + size, min(last, at + size + reach))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("item_id", "hash", "n", "head", "run", "tail")}
        for part in slices(batch):
            w = words(part.column("text"), NOT_ALNUM, lower=True)
            at, hashed = fingerprints(w)
            text = np.searchsorted(w.bounds, at, side="right") - 1
            found = [(i, a, h, 0) for i, a, h in zip(text, at, hashed, strict=True)]
            for i in np.flatnonzero((w.counts > 0) & (w.counts < WINDOW)):
                a, b = int(w.bounds[i]), int(w.bounds[i + 1])
                one = _short_runs(Words(w.data, w.offsets, w.start[a:b], w.end[a:b], np.array([0, b - a]), w.hash[a:b]), b - a)
                found.append((i, a, one[1][0], b - a))
            for i, a, h, n in found:
                head, run, tail = _context(w, int(a), n, int(w.bounds[i]), int(w.bounds[i + 1]))
                for k, v in zip(out, (part.column("item_id")[int(i)].as_py(), h.astype(np.int64).item(), n, head, run, tail), strict=True):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("item_id", batch.schema.field("item_id").type), ("hash", pa.int64()), ("n", pa.int32()),
            *[(k, pa.list_(pa.string())) for k in ("head", "run", "tail")],
        ]))


def _doc_rows(filter_: np.ndarray, lengths: list[int]):
    """For each document its key, its words, and those fingerprints that the filter lets through, with their context."""
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def passes(hashed: np.ndarray) -> np.ndarray:
        bit = hashed & mask
        return (filter_[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words(part.column("text"), NOT_ALNUM, lower=True)
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for n in [0, *lengths]:
                    at, hashed = _short_runs(w, n) if n else fingerprints(w)
                    hit = passes(hashed)
                    at, hashed = at[hit], hashed[hit]
                    text = np.searchsorted(w.bounds, at, side="right") - 1
                    for i, a, h in zip(text.tolist(), at.tolist(), hashed.astype(np.int64).tolist(), strict=True):
                        first, last = int(w.bounds[i]), int(w.bounds[i + 1])
                        head, run, tail = _context(w, a, n, first, last)
                        found[i].append({"hash": h, "n": n, "at": a - first, "head": head, "run": run, "tail": tail})
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("version"), pa.array(w.counts.astype(np.int64)),
                    pa.array(found, pa.list_(pa.struct([
                        ("hash", pa.int64()), ("n", pa.int32()), ("at", pa.int32()),
                        *[(k, pa.list_(pa.string())) for k in ("head", "run", "tail")],
                    ]))),
                ], ["id", "version", "n_words", "found"])

    return rows


def fingerprint_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """2^bits bits, set for each hash (column hash, modulo 2^bits)."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    out = np.zeros(1 << (bits - 3), np.uint8)
    whole = hashes.select((place + 1).alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("b")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")
    )
    for r in whole.collect():  # at most 2^bits / 32768 rows of 4 KB
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["b"] - 1) * 4096 : (r["b"] - 1) * 4096 + len(part)] |= part
    return out


def _equal_run(a: Column, b: Column) -> Column:
    """How many elements two arrays share from the start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b)))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """For each row of docs (columns doc_id and text): doc_id, version (hash of its text), n_words, spans and item_ids.

    Words are runs of letters and digits (ASCII lower-cased) and of all other non-ASCII characters. A window is WINDOW
    neighbouring words of an item, or all words of a shorter item. spans: the words inside occurrences of windows, as
    disjoint (start, end), null if there are none; item_ids: the distinct items that occur, sorted as text.
    Null text has no words and items without words occur nowhere; an item without id counts for spans but is in no list.
    Rows that agree in id and text get the same answer each; ids may be null or repeat.
    """
    items = items.select(F.col(item_id).alias("item_id"), F.col("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    prints = cut(items.mapInArrow(_item_rows, f"item_id {kind}, hash long, n int, head array<string>, run array<string>, tail array<string>"))
    # items that share a fingerprint and its surroundings are one row, so that a passage of many items is met once
    prints = prints.groupBy("hash", "n", "head", "run", "tail").agg(F.collect_set("item_id").alias("items"))
    lengths = sorted(r["n"] for r in prints.where("n > 0").select("n").distinct().collect())  # at most 9
    filter_ = fingerprint_filter(prints)
    keyed = docs.select(F.col(doc_id).alias("id"), doc_key().alias("version"), "text")
    kind = keyed.schema["id"].dataType.simpleString()
    found = cut(keyed.mapInArrow(
        _doc_rows(filter_, lengths),
        f"id {kind}, version long, n_words long, found array<struct<{', '.join(x.replace(' ', ':', 1) for x in _FINGERPRINT.split(', '))}>>",
    ))
    hits = found.where(F.size("found") > 0).select("id", "version", F.explode("found").alias("d"))
    d, joined = F.col("d"), hits.join(
        prints.withColumnsRenamed({k: f"i_{k}" for k in ("hash", "n", "head", "run", "tail")}),
        (F.col("d.hash") == F.col("i_hash")) & (F.col("d.n") == F.col("i_n")) & (F.col("d.run") == F.col("i_run")),
    )
    before = _equal_run(F.reverse(d.head), F.reverse(F.col("i_head")))
    after = _equal_run(d.tail, F.col("i_tail"))
    spans = joined.select("id", "version", "items", (d["at"] - before).alias("start"), (d["at"] + F.size(d.run) + after).alias("end"), "i_n")
    spans = spans.where((F.col("i_n") > 0) | (F.col("end") - F.col("start") >= WINDOW))
    per = spans.groupBy("id", "version").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("all"),
        F.sort_array(F.array_distinct(F.transform(
            F.flatten(F.collect_set("items")), lambda x: x.cast("string")
        ))).alias("item_ids"),
    )
    # spans in order: each adds what lies beyond the furthest end so far
    merged = F.aggregate("all", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")), lambda a, s: F.struct(
        (a.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, a.to))).alias("n"), F.greatest(a.to, s.end).alias("to"),
    )).n
    per = per.select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("all").alias("spans"), merged.alias("n_hit"), "item_ids")
    return (
        found.select("id", "version", "n_words")
        .join(per, F.col("id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version")), "left")
        .select(
            F.col("id").alias(doc_id), "version", "n_words", "spans", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, most: float = 0.0) -> DataFrame:
    """The documents of whose words at most this share is hit, with all their columns."""
    told = contamination(docs.select("doc_id", "text"), items).where(F.col("n_hit") > most * F.col("n_words"))
    bad = told.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct()
    return docs.withColumn("__key", doc_key()).join(
        bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__version")), "left_anti"
    ).drop("__key")
