"""Sort, limit, top, distinct, facets, field names and values, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.model import EXTRA, attach, col, expand, field_name, group_key, is_text, ordering, out, quoted, tie_break, unique_name, val
from skeinlog.operators.slices import Key, in_order, positioned

SortBy = "str | tuple[str, bool]"

# ---- fixed values: default limits ------------------------------------------
TOP_LIMIT = 10
FACET_LIMIT = 10
FACET_MAX_VALUES = 1000
FACET_MAX_LENGTH = 128
# ----------------------------------------------------------------------------

# Up to this many rows per group Spark cuts groups before the shuffle.
GROUP_LIMIT = 1000


def sort_keys(df: DataFrame, by: Sequence[SortBy], desc: bool = False, tie: Sequence[str] = ()) -> list[Key]:
    """Sort keys of the fields, flipped as a whole by ``desc``, then tie-break columns."""
    named = [(b, False) if isinstance(b, str) else b for b in by]
    keys = [Key(ordering(df, name), one != desc) for name, one in named]
    used = {field_name(name) for name, _ in named}
    # A tie only has to be settled, so raw values do; mixed order is for the fields asked for.
    return keys + [Key(col(name), desc) for name in tie_break(df, tie) if name not in used]


def sort(
    df: DataFrame,
    by: Sequence[SortBy],
    desc: bool = False,
    offset: int = 0,
    limit: int = 0,
    rank: str | None = None,
    partition_by: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Sort by several fields, with offset, limit and rank, over all rows or per partition.

    With a limit only the first rows of every task travel. Positions over
    unlimited input go through slices, so no task ever sorts the whole table.
    """
    keys = sort_keys(df, by, desc, tie)
    columns = [k.column for k in keys]
    upto = offset + limit
    if partition_by:
        if not limit:
            raise ValueError("partition_by needs a limit")
        pos = "__pos"
        if upto <= GROUP_LIMIT:
            w = Window.partitionBy(*[group_key(df, p) for p in partition_by]).orderBy(*columns)
            ranked = df.withColumn(pos, F.row_number().over(w))
        else:
            ranked = positioned(df, partition_by, keys, pos)
        ranked = ranked.where((F.col(pos) > offset) & (F.col(pos) <= upto))
        return ranked.withColumnRenamed(pos, rank) if rank else ranked.drop(pos)
    if limit and upto <= GROUP_LIMIT:
        first = df.orderBy(*columns).limit(upto)
        if not rank and not offset:
            return first
        first = first.withColumn("__pos", F.row_number().over(Window.orderBy(*columns))).where(F.col("__pos") > offset)
        return first.withColumnRenamed("__pos", rank) if rank else first.drop("__pos")
    if limit or offset or rank:
        ranked = in_order(df, keys, "__pos")
        if offset:
            ranked = ranked.where(F.col("__pos") > offset)
        if limit:
            ranked = ranked.where(F.col("__pos") <= upto)
        return ranked.withColumnRenamed("__pos", rank) if rank else ranked.drop("__pos")
    return df.orderBy(*columns)


def first(df: DataFrame, n: int = 1, by: Sequence[SortBy] = (), partition_by: Sequence[str] = (), rank: str | None = None, tie=()) -> DataFrame:
    return sort(df, by, limit=n, partition_by=partition_by, rank=rank, tie=tie)


def last(df: DataFrame, n: int = 1, by: Sequence[SortBy] = (), partition_by: Sequence[str] = (), rank: str | None = None, tie=()) -> DataFrame:
    return sort(df, by, desc=True, limit=n, partition_by=partition_by, rank=rank, tie=tie)


def limit(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def offset(df: DataFrame, n: int, by: Sequence[SortBy] = (), tie: Sequence[str] = ()) -> DataFrame:
    """Drop the first n rows in order."""
    return sort(df, by, offset=n, tie=tie)


def _group_counts(df: DataFrame, by: Sequence[str], hits: str) -> DataFrame:
    keys = [group_key(df, b).alias(field_name(b)) for b in by]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(hits))


def top(df: DataFrame, by: Sequence[str], n: int = TOP_LIMIT, hits_as: str = "hits", rank: str | None = None) -> DataFrame:
    """Most frequent value tuples; equal counts are settled by the values."""
    hits = unique_name(hits_as, [field_name(b) for b in by])
    counted = _group_counts(df, by, hits)
    keys = [Key(col(hits), True), *[Key(ordering(counted, field_name(b))) for b in by]]
    columns = [k.column for k in keys]
    if n > GROUP_LIMIT:
        ranked = positioned(counted, [], keys, "__pos").where(F.col("__pos") <= n)
        return ranked.withColumnRenamed("__pos", rank) if rank else ranked.drop("__pos")
    best = counted.orderBy(*columns).limit(n)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*columns))) if rank else best


def uniq(
    df: DataFrame, by: Sequence[str], filter: str = "", with_hits: bool = False, limit: int = 0, hits_as: str = "hits"
) -> DataFrame:
    """Distinct value tuples. If a limit cuts the answer, all hits are 0."""
    names = [field_name(b) for b in by]
    if filter:
        if len(names) != 1:
            raise ValueError("a substring filter needs exactly one field")
        df = df.where(val(names[0]).contains(filter))
    hits = unique_name(hits_as, names)
    counted = _group_counts(df.where(_any(df, names)), names, hits)
    if limit:
        keys = [Key(ordering(counted, n)) for n in names]
        columns = [k.column for k in keys]
        if limit < GROUP_LIMIT:
            kept = counted.orderBy(*columns).limit(limit + 1)
            pos = kept.withColumn("__pos", F.row_number().over(Window.orderBy(*columns)))
            total = F.count(F.lit(1)).over(Window.partitionBy())
            cut = pos.withColumn("__all", total).where(F.col("__pos") <= limit)
        else:
            pos = positioned(counted, [], keys, "__pos").where(F.col("__pos") <= limit + 1)
            size = pos.agg(F.count(F.lit(1)).alias("__all"))
            cut = attach(pos, size, []).where(F.col("__pos") <= limit)
        counted = cut.withColumn(hits, F.when(F.col("__all") > limit, F.lit(0).cast("bigint")).otherwise(col(hits)))
    return counted.select(*[col(n) for n in names], *([col(hits)] if with_hits else []))


def _any(df: DataFrame, names: Sequence[str]) -> Column:
    test = F.lit(False)
    for n in names:
        test = test | (val(n) != "" if is_text(df, n) or n not in df.columns else col(n).isNotNull())
    return test


def field_values(df: DataFrame, field: str, filter: str = "", limit: int = 0) -> DataFrame:
    """Values of a field with their hits; with a limit the most frequent ones."""
    rows = df.where(val(field).contains(filter)) if filter else df
    counted = rows.groupBy(out(val(field)).alias("value")).agg(F.count(F.lit(1)).alias("hits"))
    counted = counted.where(F.col("value").isNotNull())
    if limit:
        return sort(counted, [("hits", True), ("value", False)], limit=limit)
    return counted


def field_names(df: DataFrame, filter: str = "") -> DataFrame:
    """Fields with the number of rows that have them: one row of counters, turned to rows."""
    names = [n for n in expand(df, ["*"]) if filter in n]
    counters = [
        F.struct(F.lit(n).alias("name"), F.count_if(val(n) != "" if is_text(df, n) else col(n).isNotNull()).alias("hits")) for n in names
    ]
    parts = []
    if counters:
        parts.append(df.agg(F.array(*counters).alias("__c")).select(F.inline("__c")))
    if EXTRA in df.columns:
        keys = F.map_keys(F.map_filter(col(EXTRA), lambda k, v: (F.coalesce(v, F.lit("")) != "") & k.contains(filter)))
        parts.append(df.select(F.explode(keys).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("hits")))
    done = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).groupBy("name").agg(F.sum("hits").alias("hits"))
    return done.where(F.col("hits") > 0)


def facets(
    df: DataFrame,
    limit: int = FACET_LIMIT,
    max_values: int = FACET_MAX_VALUES,
    max_len: int = FACET_MAX_LENGTH,
    keep_const: bool = False,
) -> DataFrame:
    """Most frequent values per field; fields with too many, too long or constant values are left out.

    A first pass keeps one small sketch and one length per field and drops the
    fields that are far over the bounds, so the counting pass never moves the
    values of high-cardinality fields. What the sketch leaves is decided exactly.
    """
    names = expand(df, ["*"])
    if not names:
        raise ValueError("no fields")
    texts = {n: out(val(n)) for n in names}
    # Typed values are counted as they are; only maps and the like have to become text for it.
    plain = {n: col(n) if isinstance(df.schema[n].dataType, T.AtomicType) else texts[n] for n in names}
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.approx_count_distinct(plain[n], 0.02).alias(f"d{i}") for i, n in enumerate(names)],
        *[F.coalesce(F.max(F.octet_length(texts[n])), F.lit(0)).alias(f"l{i}") if _long(df, n, max_len) else F.lit(0).alias(f"l{i}")
          for i, n in enumerate(names)],
    ).first()
    names = [n for i, n in enumerate(names) if seen[f"d{i}"] <= 2 * max_values and seen[f"l{i}"] <= max_len]
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "field_name string, field_value string, hits bigint")
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), texts[n].alias("field_value")) for n in names])).alias("__p")
    ).select("__p.*")
    counted = (
        pairs.where(F.col("field_value").isNotNull()).groupBy("field_name", "field_value").agg(F.count(F.lit(1)).alias("hits"))
    )
    # At most 2 * max_values rows per field are left, so one task per field is enough here.
    of_field = Window.partitionBy("field_name")
    order = Window.partitionBy("field_name").orderBy(F.desc("hits"), F.col("field_value"))
    ranked = counted.withColumns({"__n": F.count(F.lit(1)).over(of_field), "__rn": F.row_number().over(order)})
    keep = (F.col("__n") <= max_values) & (F.col("__rn") <= limit)
    if not keep_const:
        # A constant field has one value, held by every row.
        keep = keep & ~((F.col("__n") == 1) & (F.col("hits") == seen["rows"]))
    return ranked.where(keep).select("field_name", "field_value", "hits")


def _long(df: DataFrame, name: str, max_len: int) -> bool:
    """Whether text of this column may exceed the length; numbers and times have at most 40 characters."""
    bounded = isinstance(df.schema[name].dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
    return not bounded or max_len < 40


def sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """One row in n on average."""
    return df.sample(fraction=1.0 / n, seed=seed)


def sample_by_key(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """One key in n, the same keys in every run."""
    return df.where(F.pmod(F.xxhash64(*[val(k) for k in keys]), F.lit(n)) == 0)
