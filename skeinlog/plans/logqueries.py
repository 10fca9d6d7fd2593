"""User-level queries over log tables: one function per kind of question."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.functions import timespan
from skeinlog.functions.aggs import Stat, count
from skeinlog.functions.coerce import float_text
from skeinlog.functions.timespan import micros_of
from skeinlog.model import STREAM, STREAM_ID, TIME, attach, col, field_name, is_numeric, out, stream_text, val
from skeinlog.operators.order import facets, field_names, field_values
from skeinlog.operators.stats import NAMED_STEPS, Bucket, stats
from skeinlog.sources.federation import cap

Pipe = Callable[[DataFrame], DataFrame]

__all__ = [
    "query", "stats_query", "stats_query_range", "hits", "facets_query", "field_names", "field_values",
    "streams", "stream_ids", "stream_field_names", "stream_field_values",
]


def query(df: DataFrame, *pipes: Pipe, limit: int | None = None, max_limit: int = 1000, tie: Sequence[str] = ()) -> DataFrame:
    """Newest raw rows up to the limit, or the rows the pipes make of the table."""
    if not pipes:
        return cap(df, limit, max_limit, tie=tie)
    for pipe in pipes:
        df = df.transform(pipe)
    return df


def labels_json(names: Sequence[str]) -> Column:
    """By-fields as a JSON label set; absent labels are left out."""
    ordered = sorted(names)
    return F.to_json(F.struct(*[out(val(n)).alias(n) for n in ordered])) if ordered else F.lit("{}")


def _long(df: DataFrame, names: Sequence[str], results: Sequence[str], ts: Column) -> DataFrame:
    """One row per result: (metric, name, ts, value as text)."""
    text = lambda r: float_text(col(r)) if is_numeric(df, r) else val(r)
    points = F.array(*[F.struct(F.lit(r).alias("name"), text(r).alias("value")) for r in results])
    return df.select(labels_json(names).alias("metric"), ts.alias("ts"), F.explode(points).alias("p")).select(
        "metric", "p.name", "ts", "p.value"
    )


def _by_names(by: Sequence[str | Bucket]) -> list[str]:
    return [b.alias if isinstance(b, Bucket) else field_name(b) for b in by]


def stats_query(df: DataFrame, by: Sequence[str | Bucket], aggs: dict[str, Stat], at: datetime) -> DataFrame:
    """One point per series at one moment; a statistic is required."""
    if not aggs:
        raise ValueError("stats_query needs at least one statistic")
    return _long(stats(df, by, **aggs), _by_names(by), list(aggs), F.lit(micros_of(at) / 1e6))


def stats_query_range(
    df: DataFrame, by: Sequence[str | Bucket], aggs: dict[str, Stat], step: str, offset: str | int = 0, at: str = TIME
) -> DataFrame:
    """One point per series and time step; a statistic is required. Rates are per second of the step."""
    if not aggs:
        raise ValueError("stats_query_range needs at least one statistic")
    aggs = {n: s.at_step(timespan.duration(NAMED_STEPS.get(step, step)) / 1e9) for n, s in aggs.items()} if step not in ("month", "year") else aggs
    grouped = stats(df, [*by, Bucket(at, step, offset, "__ts")], **aggs)
    return _long(grouped, _by_names(by), list(aggs), F.unix_micros("__ts") / F.lit(1e6))


def hits(df: DataFrame, step: str, fields: Sequence[str] = (), offset: str | int = 0, at: str = TIME) -> DataFrame:
    """Rows per time bucket and field set, and the total per field set.

    Totals are summed over the counted buckets, so the log rows are shuffled once
    and only as counts.
    """
    counted = stats(df, [*fields, Bucket(at, step, offset, "__ts")], value=count())
    names = _by_names(fields)
    keyed = counted.select(labels_json(names).alias("fields"), F.date_format("__ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), "value")
    by = ["fields"] if names else []
    return attach(keyed, keyed.groupBy(*by).agg(F.sum("value").alias("total")), by)


def facets_query(df: DataFrame, **options) -> DataFrame:
    return facets(df, **options)


def streams(df: DataFrame) -> DataFrame:
    """Label sets with their hits."""
    return df.groupBy(stream_text(STREAM).alias("value")).agg(F.count(F.lit(1)).alias("hits"))


def stream_ids(df: DataFrame) -> DataFrame:
    return df.groupBy(out(val(STREAM_ID)).alias("value")).agg(F.count(F.lit(1)).alias("hits")).where(F.col("value").isNotNull())


def stream_field_names(df: DataFrame) -> DataFrame:
    """Label names with their hits."""
    return df.select(F.explode(F.map_keys(col(STREAM))).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("hits"))


def stream_field_values(df: DataFrame, field: str) -> DataFrame:
    """Values of one label with their hits."""
    label = out(F.coalesce(F.element_at(col(STREAM), field), F.lit("")))
    return df.groupBy(label.alias("value")).agg(F.count(F.lit(1)).alias("hits")).where(F.col("value").isNotNull())
