"""Line deduplication within one edit, by deletion neighbourhoods.

Two texts are one edit apart just if deleting the same place of both gives one text (a character replaced), or deleting
some place of one gives the other (a character added). So every line emits its deletions as hashed keys, and lines meet
on equal keys. Each group of a key is reduced to its earliest line before anything is joined back, so a frequent line
or a family of thousands of variants costs one row each, never all pairs.

Only lines that share one half with another line can be one edit from any; the others emit nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import cut, with_versions
from skeinlog.llm.decontaminate import fingerprint_filter
from skeinlog.llm.tokens import LINE_END, SPACE, Words, mix, powers, signed, slices, words

#: Bytes from which a line is compared within one edit; shorter ones, such as a brace or a number, only if they are equal.
LEAST = 20
#: Bits of the filters of asked lines and of shared keys that tasks hold: 2 MB. What they let through too much costs a
#: shuffle of it, no more.
FILTER_BITS = 24
_KEYS = ["p_low", "p_high", "s_low", "s_high"]
_U = np.uint64


def _lines(text: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Lines of each text that hold a word, their numbers among its lines, and a second hash."""
    w = words(text, LINE_END)
    filled = np.concatenate([[0], np.cumsum(~SPACE[w.data])])
    keep = filled[w.end] > filled[w.start]
    ends = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
    at = np.repeat(np.arange(len(text)), w.counts)
    number = ends[w.start] - ends[w.offsets[at]]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(at[keep], minlength=len(text)))])
    kept = Words(w.data, w.offsets, w.start[keep], w.end[keep], bounds, w.hash[keep])
    power, inverse = powers(2 * len(w.data) + 2)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(w.data.astype(_U)) * power[0 : 2 * len(w.data) : 2])]) if len(w.data) else np.zeros(1, _U)
    second = mix((sums[kept.end] - sums[kept.start]) * inverse[2 * kept.start])
    return kept, number[keep], second


def _half_keys(w: Words) -> list[np.ndarray]:
    """Hashes of so much of a line's begin and end that a line one edit away shares one of them.

    Lengths of such lines differ by 4 bytes at most, so they have a multiple of 8 in common, rounded down or up.
    """
    power, inverse = powers(len(w.data) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum((w.data.astype(_U) + _U(1)) * power[: len(w.data)])])
    out = []
    for side in (0, 1):
        for up in (0, 1):
            q = (w.end - w.start) // 8 + up
            h = np.minimum(4 * q - 2, w.end - w.start).clip(min=0)
            a = w.end - h if side else w.start
            out.append(mix(mix((sums[a + h] - sums[a]) * inverse[a]) + (2 * q + side).astype(_U)))
    return out


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            w, number, second = _lines(part.column("text"))
            take = pa.array(np.repeat(np.arange(part.num_rows), w.counts), pa.int64())
            short = w.end - w.start < LEAST
            yield pa.RecordBatch.from_arrays([
                part.column("doc").take(take), part.column("version").take(take), pa.array(number.astype(np.int64)),
                signed(w.hash), signed(second), *[pa.array(k.view(np.int64), mask=short) for k in _half_keys(w)],
            ], ["doc", "version", "line", "h1", "h2", *_KEYS])


def _place_hash(doc: np.ndarray, version: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mix(mix(doc.view(_U) * _U(3) + version.view(_U)) + line.view(_U))


def _passes(filter_: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    bit = hashed & _U((1 << FILTER_BITS) - 1)
    return (filter_[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1 == 1


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = [np.asarray(batch.column(c)).astype(np.int64) for c in _AT]
        yield pa.RecordBatch.from_arrays([signed(_place_hash(*at))], ["hash"])


def _asked_rows(filter_: np.ndarray):
    """The lines whose places the filter lets through, as texts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w, number, _ = _lines(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), w.counts)
                at = [np.asarray(part.column(c)).astype(np.int64)[row] for c in ("doc", "version")] + [number.astype(np.int64)]
                hit = np.flatnonzero(_passes(filter_, _place_hash(*at)))
                text = [w.data[a:b].tobytes().decode() for a, b in zip(w.start[hit].tolist(), w.end[hit].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[pa.array(x[hit]) for x in at], pa.array(text, pa.string())], [*_AT, "text"])

    return rows


def _variant_rows(filter_: np.ndarray | None = None):
    """For each line itself (place -1) and its deletions, as hashes; those that the filter lets through."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 19)):
            out: tuple[list, list, list] = ([np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
            for one in batch.to_pylist():
                line = one["text"]
                c = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(_U) + _U(1)
                n = len(c)
                power, inverse = powers(n + 1)
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(c) * power[:n])])
                gone = sums[:-1] + (sums[-1] - sums[1:]) * inverse[1]
                # characters that the shared half holds at least, by the bytes that _half_keys compares
                half = max(0, n // (2 if line.isascii() else 8) - 8)
                low, high = 0 if one["suffix"] else half, n if one["prefix"] else n - half
                out[0].append(np.concatenate([mix(sums[-1:] + _U(n)), mix(gone[low:high] + _U(n - 1))]))
                out[1].append(np.concatenate([[-1], np.arange(n)[low:high]]))
                out[2].append(np.full(len(out[1][-1]), one["id"]))
            key, place, id_ = (np.concatenate(x) for x in out)
            if filter_ is not None:
                hit = _passes(filter_, key)
                key, place, id_ = key[hit], place[hit], id_[hit]
            yield pa.RecordBatch.from_arrays([signed(key), pa.array(place.astype(np.int32)), pa.array(id_)], ["key", "place", "id"])

    return rows


def one_edit(a: str, b: str) -> bool:
    """Whether one character replaced, added or taken away turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = batch.to_pydict()
        keep = [one_edit(x, y) for x, y in zip(columns["mine"], columns["theirs"], strict=True)]
        yield batch.select(["id"]).filter(pa.array(keep, pa.bool_()))


_AT = ["doc", "version", "line"]


def removed_lines(docs: DataFrame) -> DataFrame:
    """docs (doc long and not null, version, text) to rows (doc, version, line) of the lines that go; some come twice."""
    place = "doc long, version long, line long"
    lines = cut(docs.mapInArrow(_line_rows, f"{place}, h1 long, h2 long, " + ", ".join(f"{k} long" for k in _KEYS)))
    firsts = cut(lines.groupBy("h1", "h2").agg(F.min(F.struct(*_AT)).alias("first")))
    # lines that share a half with another line, and which half
    halves = lines.select("h1", F.explode(F.array(*[
        F.struct(F.col(k).alias("key"), F.lit(k[0] == "p").alias("prefix")) for k in _KEYS
    ])).alias("half")).where("half.key IS NOT NULL").select("h1", "half.key", "half.prefix")
    shared = halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("key")
    near = halves.join(shared, "key").groupBy("h1").agg(F.max("prefix").alias("prefix"), F.max(~F.col("prefix")).alias("suffix"))
    # numbers in the order of the lines, so that the least number is the earliest line
    asked = cut(
        firsts.join(near, "h1").select("first.*", "prefix", "suffix").orderBy(*_AT).withColumn("id", F.monotonically_increasing_id())
    )
    filter_ = fingerprint_filter(asked.mapInArrow(_places, "hash long"), FILTER_BITS)
    texts = docs.mapInArrow(_asked_rows(filter_), f"{place}, text string").join(asked, _AT).dropDuplicates(["id"])
    once = cut(texts.select("id", "text", "prefix", "suffix"))
    rows = "key long, place int, id long"
    busy = once.mapInArrow(_variant_rows(), rows).groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a != b")
    filter_ = fingerprint_filter(busy.select(F.col("key").alias("hash")), FILTER_BITS)
    variants = cut(once.mapInArrow(_variant_rows(filter_), rows))
    # replaced: one place deleted from both; the earliest line of such a group is one edit from every other
    best = variants.groupBy("key", "place").agg(F.min("id").alias("earlier"))
    whole, deleted = best.where("place = -1"), best.where("place >= 0")
    renamed = {"key": "k", "place": "p"}
    replaced = variants.where("place >= 0").join(
        deleted.withColumnsRenamed(renamed), (F.col("key") == F.col("k")) & (F.col("place") == F.col("p"))
    )
    shorter = variants.where("place >= 0").join(whole.withColumnsRenamed(renamed), F.col("key") == F.col("k"))
    by_key = deleted.groupBy(F.col("key").alias("k")).agg(F.min("earlier").alias("earlier"))
    longer = variants.where("place = -1").join(by_key, F.col("key") == F.col("k"))
    found = replaced.select("id", "earlier")
    for more in (shorter, longer):
        found = found.union(more.select("id", "earlier"))
    told = (
        found.where("earlier < id").distinct()
        .join(once.select("id", F.col("text").alias("mine")), "id")
        .join(once.select(F.col("id").alias("earlier"), F.col("text").alias("theirs")), "earlier")
        .select("id", "mine", "theirs").mapInArrow(_verified, "id long").distinct().join(asked.select("id", *_AT), "id")
    )
    again = lines.join(firsts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first"), (
        (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    )).where(F.struct(*_AT) > F.col("first"))
    return told.select(*_AT).union(again.select(*_AT))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """For each row of docs (doc_id and text): doc_id, n_lines, n_removed and kept, the text without the removed lines.

    Lines end at newline characters. One without a word always stays and is not counted. A line goes if an earlier one
    (smaller doc_id, or before in the same text) is equal to it or, from LEAST bytes on, one character away: replaced,
    added or missing. Earlier lines count whether or not they go themselves. Null ids come before others, rows that agree
    in id but not in text are ordered by a hash of the text, and rows that agree in both are one document. Null text
    stays null and has no lines.
    """
    return with_kept_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "kept")


def with_kept_lines(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, and others but not __doc, __version) with n_lines, n_removed and kept; see dedup_lines."""
    keyed = with_versions(docs, "__doc", "__version")
    told = removed_lines(keyed.select(F.col("__doc").alias("doc"), F.col("__version").alias("version"), "text")).groupBy(
        F.col("doc").alias("__d"), F.col("version").alias("__v")
    ).agg(F.collect_set("line").alias("__gone"))
    every = keyed.join(told, (F.col("__doc") == F.col("__d")) & (F.col("__version") == F.col("__v")), "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    columns = list(docs.columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                kept, n = [], []
                for text, gone in zip(part.column("text").to_pylist(), part.column("__gone").to_pylist(), strict=True):
                    lines, gone = (text or "").split("\n"), set(gone or ())
                    n.append((sum(1 for x in lines if x.strip(" \t\n\v\f\r")), len(gone)))
                    kept.append(text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in columns], pa.array([x for x, _ in n], pa.int64()),
                    pa.array([x for _, x in n], pa.int64()), pa.array(kept, pa.string()),
                ], [*columns, "n_lines", "n_removed", "kept"])

    return every.select(*columns, "__gone").mapInArrow(rows, f"{schema}, n_lines long, n_removed long, kept string")


def keep_lines(docs: DataFrame) -> DataFrame:
    """The documents with the lines that stay as their text, and n_chars, where there is one, counted anew."""
    names = docs.columns
    rest = [c for c in names if c not in ("doc_id", "text", "n_chars")]
    held = docs.select("doc_id", "text", F.struct(F.lit(0).alias("__0"), *rest).alias("__rest"))
    fresh = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return with_kept_lines(held).select(*[fresh.get(c, F.col("__rest")[c]).alias(c) for c in names])
