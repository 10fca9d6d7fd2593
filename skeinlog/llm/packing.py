"""Best-fit packing of documents into sequences of a fixed number of tokens.

How documents pack depends on their lengths only, so the plan is made over the histogram of lengths, which is bounded by
the sequence length whatever the corpus. A plan row says: so many sequences hold these lengths. Pieces then find their
place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinlog.llm.common import cut

TOKENS = 1024
END = 2


class Encoder:
    """Token ids of a tokenizers file, with the end id after each text.

    The same vocabulary as ranks, where there is one, encodes faster; texts with special tokens or with characters
    whose class may differ between Unicode versions take the file itself.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        import re

        self.path, self._slow, self._fast = path, None, None
        specials = [t.content for t in self.slow.get_added_tokens_decoder().values()] or ["\0\0"]
        self.odd = re.compile("[^\x00-ӿ]|" + "|".join(map(re.escape, specials)))
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    def __call__(self, text: str) -> np.ndarray:
        if self._fast is None or self.odd.search(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self._fast.encode_ordinary(text)
        out = np.empty(len(ids) + 1, "<u4")
        out[:-1], out[-1] = ids, END
        return out


_encoders: dict[tuple, Encoder] = {}


def _encoder(*paths: str | None) -> Encoder:
    """One for each Python worker."""
    if paths not in _encoders:
        _encoders[paths] = Encoder(*paths)
    return _encoders[paths]


def pieces(docs: DataFrame, path: str, ranks: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """Columns id and text to rows of id, piece, start, length and ids_crc32. Texts are never shortened; null is empty.

    The first piece of a text that is too long is the one that may be shorter.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, ranks)
        for batch in batches:
            text, out = batch.column("text"), ([], [], [], [], [])
            for i in range(batch.num_rows):
                ids = encode(text[i].as_py() or "")
                first = len(ids) % tokens or tokens
                edges = [0, *range(first, len(ids) + 1, tokens)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for x, v in zip(out, (i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()),
                *[pa.array(x, pa.int64()) for x in out[2:]],
            ], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(rows, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], tokens: int = TOKENS) -> list[tuple[list[int], int]]:
    """Best-two-fit over a histogram of lengths: (lengths of a sequence, number of such sequences).

    A sequence takes the longest piece left, then again and again the longest that fits. Its smallest piece then gives
    way to two pieces left that together fill the widened gap more tightly, if there are any. The result is repeated
    as often as the pieces left allow, so there are few rows, and each one uses some length up.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left)
    out: list[tuple[list[int], int]] = []

    def longest(most: int, used: Counter) -> int:
        k = bisect_right(order, most)
        while k and left[order[k - 1]] <= used[order[k - 1]]:
            k -= 1
        return order[k - 1] if k else 0

    while order:
        held, used, gap = [], Counter(), tokens
        while n := longest(gap, used):
            held.append(n)
            used[n] += 1
            gap -= n
        if gap and len(held) > 1:
            least = held.pop()
            used[least] -= 1
            room, best, pair = gap + least, least, [least]
            x = longest(room - 1, used)
            while 2 * x > best:
                used[x] += 1
                y = longest(min(room - x, x), used)
                used[x] -= 1
                if y and x + y > best:
                    best, pair = x + y, [x, y]
                if best == room:
                    break
                x = longest(x - 1, used)
            held += pair
            used.update(pair)
        used = +used
        times = min(left[n] // k for n, k in used.items())
        out.append((held, times))
        for n, k in used.items():
            left[n] -= times * k
            if not left[n]:
                order.remove(n)
    return out


def _places(packed: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """By length and rank, in rising order: the ranks from here on, `per` of them in each sequence from `sequence` on."""
    ranks: Counter = Counter()
    rows: list[tuple[int, int, int, int, int]] = []
    offsets: list[int] = []
    sequence = 0
    for held, times in packed:
        at = np.cumsum([0, *held])
        for n, k in Counter(held).items():
            rows.append((n, ranks[n], sequence, k, len(offsets)))
            offsets += [int(at[i]) for i, x in enumerate(held) if x == n]
            ranks[n] += k * times
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "per", "first"), columns, strict=True)) | {"offsets": np.array(offsets, np.int64)}


def pack(cut_pieces: DataFrame, tokens: int = TOKENS) -> DataFrame:
    """Adds sequence_id and offset to rows with the columns id, piece, start, length and ids_crc32, at most `tokens` long.

    cut_pieces must give the same rows whenever it is read (see common.cut). Equal rows, null ids and an empty table are
    allowed. Pieces of one length are numbered in salted groups, so that no task holds all of a frequent length.
    """
    spark = cut_pieces.sparkSession
    salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = cut_pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32", "start"), F.lit(salts)))
    groups = cut(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    firsts = groups.select(F.col("length").alias("__length"), F.col("salt").alias("__salt"), before.alias("before"))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `tokens` rows
    at = _places(plan(counts, tokens))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")) - 1
    ranked = (
        salted.withColumn("within", within)
        .join(firsts, (F.col("length") == F.col("__length")) & (F.col("salt") == F.col("__salt")))
        .select(*cut_pieces.columns, (F.col("before") + F.col("within")).alias("rank"))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = 1 << 40  # a length's ranks stay below
        keys = at["length"] * edge + at["rank"]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "rank"))
            row = np.searchsorted(keys, length * edge + rank, side="right") - 1
            k = rank - at["rank"][row]
            sequence = at["sequence"][row] + k // at["per"][row]
            offset = at["offsets"][at["first"][row] + k % at["per"][row]]
            kept = [batch.column(c) for c in cut_names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*cut_names, "sequence_id", "offset"])

    cut_names = list(cut_pieces.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema.fields)
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None, doc_id: str = "doc_id", tokens: int = TOKENS) -> DataFrame:
    """One row for each piece of each row of docs: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    named = docs.select(F.col(doc_id).alias("id"), "text")
    return pack(cut(pieces(named, path, ranks, tokens)), tokens).withColumnRenamed("id", doc_id)
