"""Sharding by extendible hashing: a directory over prefixes of a hash, in which only what is too large is split again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from skeinlog.llm.common import cut

#: Bits that the first and each later round of counting looks ahead; a round's table has at most 2^bits rows for each
#: bucket that it splits.
LOOK, LOOK_ON = 12, 4
BITS = 64
LIMIT = 8 << 20
NEW = ("shard", "shard_bits", "shard_bytes", "shard_rows")
#: Bytes of a value of a type; of those not named here 8, of decimals 16.
_SIZES = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4, DecimalType: 16}


def row_bytes(docs: DataFrame) -> F.Column:
    """Bytes of a row over all columns: of text and binary as they are, of arrays, maps and structs as JSON, of others by
    type. Null has none."""
    def one(field: StructField) -> F.Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, StringType | BinaryType):
            size = F.octet_length(column)
        elif isinstance(kind, ArrayType | MapType | StructType):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(_SIZES.get(type(kind), 8))
        return F.when(column.isNotNull(), size).otherwise(0).cast("long")

    return sum((one(f) for f in docs.schema.fields), F.lit(0).cast("long"))


def _content(field: StructField) -> F.Column:
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if any(t in field.dataType.simpleString() for t in ("map<", "variant")) else column


def place(docs: DataFrame, keys: list[str], size: F.Column, limit: int) -> DataFrame:
    """The rows with their size (long, 0 for null) and place (64-bit hash of the keys and all columns, unsigned order).

    A row's place depends on the row alone, so nothing is written here. Only rows whose like take more than the limit
    together, which no bit could part, are written once with a number each, which then counts in the hash.
    """
    spread = F.xxhash64(*keys, *[_content(f) for f in docs.schema.fields])
    rows = docs.withColumns({"__size": F.coalesce(size, F.lit(0)).cast("long"), "__place": spread})
    alike = rows.groupBy("__place").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n"))
    hot = cut(alike.where((F.col("size") > limit) & (F.col("n") > 1)).select("__place"))
    if not hot.take(1):
        return rows
    apart = F.xxhash64("__place", F.monotonically_increasing_id())
    again = cut(rows.join(hot, "__place", "left_semi").select(*docs.columns, "__size", apart.alias("__place")))
    return rows.join(hot, "__place", "left_anti").select(*docs.columns, "__size", "__place").unionByName(again)


def directory(placed: DataFrame, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Leaves of the directory as (bits, prefix): they share out all hashes, and no leaf is larger than the limit
    unless it holds one row or its bits are used up. As long as the number of shards: total size by limit, about.

    Each round counts a few more bits of the buckets that are still too large, and nothing of the others.
    """
    spark, leaves = placed.sparkSession, []
    open_, depth = [0], 0
    while open_:
        step = min(LOOK_ON if depth else LOOK, BITS - depth)
        rows = placed
        if depth:
            table = spark.createDataFrame([(p,) for p in open_], "prefix long")
            rows = placed.join(table, F.shiftrightunsigned("__place", BITS - depth) == F.col("prefix"), "left_semi")
        fine = depth + step
        prefix = F.shiftrightunsigned("__place", BITS - fine) if fine < BITS else F.col("__place")
        counted = {
            r["fine"]: (r["size"], r["n"])
            for r in rows.groupBy(prefix.alias("fine")).agg(F.sum("__size").alias("size"), F.count("*").alias("n")).collect()
        }
        sums = [counted]
        for _ in range(step):
            up: dict[int, tuple[int, int]] = {}
            for p, (size, n) in sums[-1].items():
                q = (p % (1 << BITS)) >> 1
                a, b = up.get(q, (0, 0))
                up[q] = (a + size, b + n)
            sums.append(up)
        todo, open_ = [(depth, p) for p in open_], []
        while todo:
            bits, p = todo.pop()
            size, n = sums[fine - bits].get(p if bits < BITS or p < 1 << 63 else p - (1 << BITS), (0, 0))
            if size <= limit or n <= 1 or bits == BITS:
                leaves.append((bits, p))
            elif bits == fine:
                open_.append(p)
            else:
                todo += [(bits + 1, 2 * p), (bits + 1, 2 * p + 1)]
        depth = fine
    return sorted(leaves, key=lambda x: x[1] << (BITS - x[0]))


def shard(docs: DataFrame, keys: list[str], size: F.Column, limit: int = LIMIT) -> DataFrame:
    """The rows with shard (b and the bits of the prefix), shard_bits, shard_bytes and shard_rows.

    Every shard is within the limit but for one that holds a single larger row. Buckets that held no row are left out.
    Nulls in keys or size, repeated rows and ties are allowed; an empty table gives no rows. Columns that docs has under
    the names of the new ones are replaced.
    """
    docs = docs.withColumn("__given", size).drop(*NEW)
    placed = place(docs, [k for k in keys if k in docs.columns], F.col("__given"), limit).drop("__given")
    leaves = directory(placed, limit)
    spark = docs.sparkSession
    names = spark.createDataFrame(
        [(b, p if p < 1 << 63 else p - (1 << BITS), "b" + (format(p, f"0{b}b") if b else "")) for b, p in leaves],
        "shard_bits int, __prefix long, shard string",
    )
    depths = sorted({b for b, _ in leaves})
    # a row's leaf is the only one of its prefixes that the directory holds
    prefix = F.array(*[
        F.struct(F.lit(b).alias("shard_bits"), (
            F.lit(0).cast("long") if b == 0 else F.shiftrightunsigned("__place", BITS - b) if b < BITS else F.col("__place")
        ).alias("__prefix")) for b in sorted({b for b, _ in leaves})
    ])

    def at(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__at", F.explode(prefix)).select("*", "__at.shard_bits", "__at.__prefix").drop("__at", "__place")

    totals = at(placed.select("__size", "__place")).groupBy("shard_bits", "__prefix").agg(
        F.sum("__size").alias("shard_bytes"), F.count("*").alias("shard_rows")
    )
    # written, so that its size is known and the rows need not move to meet it
    held = cut(names.join(totals, ["shard_bits", "__prefix"]))
    return at(placed).join(held, ["shard_bits", "__prefix"]).drop("__prefix", "__size")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; each is written by one task, whose rows the limit bounds."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
