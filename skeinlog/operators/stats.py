"""Grouped statistics, partial statistics per cluster, and mergeable state."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.functions import timespan
from skeinlog.functions.aggs import Stat, ranked_frame
from skeinlog.functions.coerce import ipv4_num, num
from skeinlog.model import CLUSTER, TIME, attach, col, field_name, group_key, quoted, val


@dataclass(frozen=True)
class Bucket:
    """A by-field rounded down to buckets.

    ``size`` is a number, a duration, a byte size, ``/bits`` of an IPv4 mask,
    or ``month`` / ``year`` / ``week`` / ``day`` / ``hour`` / ``minute`` / ``second`` and smaller.
    """

    field: str
    size: str | float
    offset: str | float = 0
    name: str | None = None

    @property
    def alias(self) -> str:
        return self.name or field_name(self.field)


NAMED_STEPS = {
    "nanosecond": "1ns",
    "microsecond": "1µs",
    "millisecond": "1ms",
    "second": "1s",
    "minute": "1m",
    "hour": "1h",
    "day": "1d",
    "week": "1w",
}


def is_time(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[field_name(name)].dataType, (T.TimestampType, T.TimestampNTZType))


def time_bucket(c: Column, size, offset=0) -> Column:
    """Start of the bucket that holds a time, counted from 1970-01-01 plus the offset."""
    step = timespan.duration(NAMED_STEPS.get(size, size)) // 1000
    shift = timespan.duration(offset) // 1000
    if step <= 1:
        return c.cast("timestamp")
    micros = F.unix_micros(c.cast("timestamp")) - F.lit(shift)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)) + F.lit(shift))


def bucket_value(df: DataFrame, b: Bucket) -> Column:
    if b.size in ("month", "year"):
        shift = timespan.duration(b.offset) // 1000
        if not shift:
            return F.date_trunc(b.size, col(b.field))
        moved = F.timestamp_micros(F.unix_micros(col(b.field).cast("timestamp")) - F.lit(shift))
        return F.timestamp_micros(F.unix_micros(F.date_trunc(b.size, moved)) + F.lit(shift))
    if field_name(b.field) in df.columns and is_time(df, b.field):
        return time_bucket(col(b.field), b.size, b.offset)
    if isinstance(b.size, str) and b.size.startswith("/"):
        step, shift, value = float(1 << (32 - int(b.size[1:]))), timespan.number(b.offset), ipv4_num(b.field)
        return (F.floor((value - F.lit(shift)) / F.lit(step)) * F.lit(int(step)) + F.lit(int(shift))).cast("bigint")
    step = timespan.number(NAMED_STEPS.get(b.size, b.size))
    shift = timespan.number(b.offset)
    return F.floor((num(b.field, df) - F.lit(shift)) / F.lit(step)) * F.lit(step) + F.lit(shift)


def keyed(df: DataFrame, by: Sequence[str | Bucket]) -> tuple[DataFrame, list[str]]:
    """Rows with their grouping values as columns ``__g<i>``, and the output names."""
    names = [b.alias if isinstance(b, Bucket) else field_name(b) for b in by]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate by-fields: {names}")
    keys = {f"__g{i}": bucket_value(df, b) if isinstance(b, Bucket) else group_key(df, b) for i, b in enumerate(by)}
    return (df.withColumns(keys) if keys else df), names


def stats(df: DataFrame, by: Sequence[str | Bucket] = (), **aggs: Stat) -> DataFrame:
    """Group and aggregate. Result names must differ from each other and from the by-fields."""
    if not aggs:
        raise ValueError("at least one statistic is needed")
    rows, names = keyed(df, by)
    clash = set(names) & set(aggs)
    if clash:
        raise ValueError(f"results named like by-fields: {sorted(clash)}")
    keys = [f"__g{i}" for i in range(len(names))]

    direct = {n: s for n, s in aggs.items() if s.direct is not None}
    planned = {n: s for n, s in aggs.items() if s.direct is None}
    # The groups come from one hash aggregate even if every function has a plan of its own:
    # a group without a usable value still is a row of the answer.
    columns = [s.column(df).alias(n) for n, s in direct.items()] or [F.count(F.lit(1)).alias("__rows")]
    done = rows.groupBy(*keys).agg(*columns)
    ranked = {n: s for n, s in planned.items() if s.ranked}
    if ranked:
        done = attach(done, ranked_frame(rows, keys, ranked), keys)
    for name, stat in planned.items():
        if name in ranked:
            continue
        done = attach(done, stat.frame(rows, keys, name), keys)
        if stat.empty is not None:
            done = done.withColumn(name, F.coalesce(F.col(quoted(name)), F.lit(stat.empty)))
    return done.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], *[F.col(quoted(n)) for n in aggs]
    )


def partial_stats(df: DataFrame, by: Sequence[str | Bucket] = (), **aggs: Stat) -> DataFrame:
    """One partial row per cluster and group, the input of the merge operators."""
    return stats(df, [CLUSTER, *by], **aggs)


def partial_state(df: DataFrame, by: Sequence[str], value: str, sketch_size: int = 200) -> DataFrame:
    """Mergeable state per cluster: sum, count, a distinct sketch and a quantile sketch of one field."""
    rows, names = keyed(df, [CLUSTER, *by])
    keys = [f"__g{i}" for i in range(len(names))]
    state = rows.withColumn("__v", num(value, df)).groupBy(*keys).agg(
        F.sum("__v").alias("sum_state"),
        F.count("__v").alias("count_state"),
        F.hll_sketch_agg(val(value)).alias("distinct_state"),
        F.kll_sketch_agg_double(F.col("__v"), F.lit(sketch_size)).alias("quantile_state"),
    )
    return state.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *state.columns[len(keys):])


def mergeable_merge(parts: DataFrame, by: Sequence[str], phi: float = 0.5) -> DataFrame:
    """Merge partial state: the mean is exact, distinct count and quantile have bounded error."""
    merged = parts.groupBy(*[col(b) for b in by]).agg(
        F.sum("sum_state").alias("__s"),
        F.sum("count_state").alias("count"),
        F.hll_union_agg("distinct_state").alias("__d"),
        F.kll_merge_agg_double("quantile_state").alias("__q"),
    )
    return merged.select(
        *[col(b) for b in by],
        "count",
        F.try_divide(F.col("__s"), F.col("count")).alias("avg"),
        F.hll_sketch_estimate("__d").alias("distinct"),
        F.kll_sketch_get_quantile_double("__q", F.lit(float(phi))).alias("quantile"),
    )
