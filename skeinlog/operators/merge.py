"""Merging of partial results that clusters have computed on their own.

Input is the union of the partial tables: one row per cluster and key. Values
may be text, as they arrive, or typed columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.functions.aggs import STRATEGIES, Stat
from skeinlog.functions.coerce import float_text
from skeinlog.model import CLUSTER, attach, col, field_name, group_key, is_text, ordering, quoted, val
from skeinlog.operators.order import GROUP_LIMIT
from skeinlog.operators.slices import Key, positioned


def _number(c: Column) -> Column:
    return c.try_cast("double")


def merge_sum(c: Column) -> Column:
    """Sum of what can be read as a number, 0 if nothing can."""
    return F.coalesce(F.sum(_number(c)), F.lit(0.0))


def merge_min(c: Column) -> Column:
    return F.min(_number(c))


def merge_max(c: Column) -> Column:
    return F.max(_number(c))


def merge_avg(c: Column) -> Column:
    """Plain mean of the partial values, 0 if nothing can be read."""
    return F.coalesce(F.avg(_number(c)), F.lit(0.0))


def merge_any(c: Column, by: Column | None = None) -> Column:
    """One of the values: the one of the first cluster by name."""
    key = F.lit(0) if by is None else by
    return F.min_by(c, F.when(c.isNotNull(), F.struct(key.alias("k"), c.cast("string").alias("v"))))


MERGERS = {"sum": merge_sum, "min": merge_min, "max": merge_max, "avg": merge_avg}


def strategy(func: str | Stat) -> str:
    """How partial results of a function are merged."""
    return func.strategy if isinstance(func, Stat) else STRATEGIES.get(func.lower(), "any")


def _merged(parts: DataFrame, result: str, func: str | Stat) -> Column:
    how = strategy(func)
    if how == "any":
        return merge_any(col(result), col(CLUSTER) if CLUSTER in parts.columns else None)
    return MERGERS[how](col(result))


def merge_stats(parts: DataFrame, by: Sequence[str], funcs: dict[str, str | Stat]) -> DataFrame:
    """Group by the by-fields and reduce every result with the strategy of its function.

    An absent by-field is null and forms its own group; empty text counts as absent.
    """
    keys = [group_key(parts, b).alias(field_name(b)) for b in by]
    known = {r: f for r, f in funcs.items() if r in parts.columns}
    if not keys:
        grouped = parts.agg(*[_merged(parts, r, f).alias(r) for r, f in known.items()], F.count(F.lit(1)).alias("__n"))
        return grouped.where(F.col("__n") > 0).drop("__n")
    return parts.groupBy(*keys).agg(*[_merged(parts, r, f).alias(r) for r, f in known.items()])


# ---- series ----------------------------------------------------------------

METRIC, NAME, TS, VALUE = "metric", "name", "ts", "value"


def canonical(metric: Column) -> Column:
    """Label map as JSON with sorted keys, so that it can be a key anywhere."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(metric))))


def result_name(metric: Column, funcs: Sequence[str]) -> Column:
    """Result a series belongs to: its ``__name__`` label if that is a known result, else the only result."""
    label = F.element_at(metric, "__name__")
    default = F.lit(funcs[0]) if len(funcs) == 1 else F.lit(None).cast("string")
    return F.when(label.isin(list(funcs)), label).otherwise(default)


def _labels(metric: Column) -> Column:
    return F.map_filter(metric, lambda k, _: k != "__name__")


def _merge_series(points: DataFrame, funcs: dict[str, str | Stat]) -> DataFrame:
    """Merge points by (labels, name, ts); the strategy follows the result name.

    Values are doubles. If a function keeps one of its values as it is and values come as text, all are text.
    """
    number = _number(F.col(VALUE))
    rows = points.select(
        canonical(_labels(F.col(METRIC))).alias(METRIC),
        result_name(F.col(METRIC), list(funcs)).alias(NAME),
        F.col(TS),
        F.col(VALUE),
        number.alias("__x"),
        *([F.col(CLUSTER)] if CLUSTER in points.columns else []),
    )
    grouped = rows.groupBy(METRIC, NAME, TS).agg(
        F.coalesce(F.sum("__x"), F.lit(0.0)).alias("sum"),
        F.min("__x").alias("min"),
        F.max("__x").alias("max"),
        F.coalesce(F.avg("__x"), F.lit(0.0)).alias("avg"),
        merge_any(F.col(VALUE), F.col(CLUSTER) if CLUSTER in points.columns else None).alias("any"),
    )
    hows = {name: strategy(func) for name, func in funcs.items()}
    # one value of a text function is text: then every value is, numbers in their log form
    text = "any" in hows.values() and is_text(points, VALUE)
    picked = F.col("any") if text else F.col("any").try_cast("double")
    for name, how in hows.items():
        one = F.col(how) if how != "any" else F.col("any") if text else F.col("any").try_cast("double")
        picked = F.when(F.col(NAME) == name, float_text(one) if text and how != "any" else one).otherwise(picked)
    return grouped.select(METRIC, NAME, TS, picked.alias(VALUE))


def merge_stats_range(points: DataFrame, funcs: dict[str, str | Stat]) -> DataFrame:
    """Merge series point by point: values of equal labels and equal time are reduced."""
    return _merge_series(points, funcs)


def merge_stats_instant(points: DataFrame, funcs: dict[str, str | Stat]) -> DataFrame:
    """Merge instant vectors; all series get the first query time."""
    first = points.agg(F.min(TS).alias("__ts"))
    merged = _merge_series(points.withColumn(TS, F.lit(0.0)), funcs)
    return attach(merged, first, []).withColumn(TS, F.col("__ts")).drop("__ts")


# ---- hits, values, facets --------------------------------------------------


def merge_hits(series: DataFrame) -> DataFrame:
    """Sum hits per field set and time, and totals per field set.

    Input rows are series: ``fields`` map, ``timestamps`` and ``values`` arrays, ``total``.
    A missing value counts 0. A field set without points is a row without time and value.
    """
    rows = series.withColumn("fields", canonical(F.coalesce(F.col("fields"), F.map_from_entries(F.array().cast("array<struct<k:string,v:string>>")))))
    totals = rows.groupBy("fields").agg(F.sum(F.col("total").cast("bigint")).alias("total"))
    points = rows.select("fields", F.explode(F.arrays_zip("timestamps", "values")).alias("p"))
    sums = points.where(F.col("p.timestamps").isNotNull()).groupBy("fields", F.col("p.timestamps").alias("ts")).agg(
        F.coalesce(F.sum(F.col("p.values").cast("bigint")), F.lit(0)).alias("value")
    )
    return attach(totals, sums, ["fields"]).select("fields", "ts", "value", F.coalesce("total", F.lit(0)).alias("total"))


def merge_value_hits(parts: DataFrame) -> DataFrame:
    """Sum hits per value; serves field values, field names, streams, stream ids and label names and values."""
    return parts.groupBy("value").agg(F.coalesce(F.sum(F.col("hits").try_cast("bigint")), F.lit(0)).alias("hits"))


def merge_facets(parts: DataFrame) -> DataFrame:
    """Sum hits per field and value; rows whose hits are no whole number are skipped."""
    hits = F.col("hits").try_cast("bigint")
    rows = parts.select("field_name", "field_value", hits.alias("hits")).where(F.col("hits").isNotNull())
    return rows.groupBy("field_name", "field_value").agg(F.sum("hits").alias("hits"))


# ---- sort ------------------------------------------------------------------


def merge_sort(
    parts: DataFrame, by: Sequence[str | tuple[str, bool]] = (), desc: bool = False, limit: int = 0
) -> DataFrame:
    """Sort merged rows; a field is descending if it or the whole sort is. No fields: all, by name."""
    named = [(b, False) if isinstance(b, str) else b for b in (by or sorted(parts.columns))]
    keys = [Key(ordering(parts, n), one or desc) for n, one in named]
    rest = [Key(ordering(parts, n), False) for n in sorted(parts.columns) if by and n not in {n for n, _ in named}]
    keys += [k for k in rest]
    if limit > GROUP_LIMIT:
        return positioned(parts, [], keys, "__pos").where(F.col("__pos") <= limit).orderBy("__pos").drop("__pos")
    ordered = parts.orderBy(*[k.column for k in keys])
    return ordered.limit(limit) if limit else ordered


@dataclass(frozen=True)
class MergeSpec:
    """What a combined query asks of the merge: statistics, facets and sorting."""

    stats_by: Sequence[str] = ()
    stats: dict[str, str | Stat] = field(default_factory=dict)
    facets: bool = False
    sort: bool = False
    sort_by: Sequence[str | tuple[str, bool]] = ()
    desc: bool = False
    limit: int = 0


def merge_partials(parts: DataFrame, spec: MergeSpec) -> DataFrame:
    """Merge in fixed order: statistics, facets, sort. Facets replace statistics but keep the sort."""
    done = parts
    if spec.stats and not spec.facets:
        done = merge_stats(done, spec.stats_by, spec.stats)
    if spec.facets:
        done = merge_facets(done)
    if spec.sort:
        done = merge_sort(done, spec.sort_by, spec.desc, spec.limit)
    return done


def merge_log_streams(sources: dict[str, DataFrame], limit: int, at: str = "_time", tie: Sequence[str] = ()) -> DataFrame:
    """Newest lines over all clusters, cut at the limit."""
    from skeinlog.operators.order import sort
    from skeinlog.sources.federation import federate

    return sort(federate(sources), [at], desc=True, limit=limit, tie=tie)
