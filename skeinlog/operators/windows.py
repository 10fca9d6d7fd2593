"""Running statistics, group totals and stream context."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinlog.functions import aggs, timespan
from skeinlog.functions.coerce import num
from skeinlog.model import STREAM_ID, TIME, attach, col, quoted
from skeinlog.operators.order import GROUP_LIMIT, sort_keys
from skeinlog.operators.slices import Key, Running, Slices, is_hot, positioned, running
from skeinlog.operators.stats import keyed


@dataclass(frozen=True)
class RunningStat:
    """One of count, sum, min, max, first, last over the rows of a group so far."""

    func: str
    fields: tuple = ()
    offset: int = 0


def run_count(*fields) -> RunningStat:
    return RunningStat("count", fields)


def run_sum(*fields) -> RunningStat:
    return RunningStat("sum", fields)


def run_min(*fields) -> RunningStat:
    return RunningStat("min", fields)


def run_max(*fields) -> RunningStat:
    return RunningStat("max", fields)


def run_first(f, offset: int = 0) -> RunningStat:
    """Value of the row ``offset`` rows after the first one."""
    return RunningStat("first", (f,), offset)


def run_last(f, offset: int = 0) -> RunningStat:
    """Value ``offset`` rows back; 0 is the current row."""
    return RunningStat("last", (f,), offset)


def _scalar(df: DataFrame, s: RunningStat) -> Running:
    if s.func == "count":
        return Running("count", F.when(aggs._any_present(df, s.fields), 1) if s.fields else F.lit(1))
    numbers = [num(f, df) for f in s.fields]
    if s.func == "sum":
        return Running("sum", aggs._add(numbers))
    pick = F.least if s.func == "min" else F.greatest
    return Running(s.func, numbers[0] if len(numbers) == 1 else pick(*numbers))


def running_stats(
    df: DataFrame, by: Sequence[str] = (), tie: Sequence[str] = (), order: Sequence[str] = (TIME,), **funcs: RunningStat
) -> DataFrame:
    """Running values per group in time order; equal times are settled by the tie-break columns."""
    rows, names = keyed(df, by)
    groups = [f"__g{i}" for i in range(len(names))]
    keys = sort_keys(df, order, tie=tie)
    hot = is_hot(rows, groups)
    scalar = {n: _scalar(df, f) for n, f in funcs.items() if f.func not in ("first", "last")}
    placed = {n: f for n, f in funcs.items() if f.func in ("first", "last")}
    if not hot:
        w = Window.partitionBy(*groups).orderBy(*[k.column for k in keys])
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        columns = {n: r.over_rows().over(so_far) for n, r in scalar.items()}
        for n, f in placed.items():
            c = col(f.fields[0])
            if f.func == "first":
                columns[n] = F.nth_value(c, f.offset + 1).over(so_far)
            else:
                columns[n] = F.lag(c, f.offset).over(w) if f.offset else c
        return rows.withColumns(columns).drop(*groups)
    pos = {"__pos": Running("count", F.lit(1))}
    done = running(rows, groups, keys, {**scalar, **pos}, hot)
    for n, f in placed.items():
        if f.func == "last" and not f.offset:
            done = done.withColumn(n, col(f.fields[0]))
            continue
        # A row is found by its position: an equality join that no hot group can overload.
        source = done.select(*groups, F.col("__pos"), col(f.fields[0]).alias(n))
        if f.func == "first":
            at = source.where(F.col("__pos") == f.offset + 1).drop("__pos")
            done = attach(done, at, groups).withColumn(n, F.when(F.col("__pos") > f.offset, F.col(quoted(n))))
        else:
            at = source.withColumn("__pos", F.col("__pos") + F.lit(f.offset))
            done = attach(done, at, [*groups, "__pos"])
    return done.drop("__pos", *groups)


def total_stats(
    df: DataFrame, by: Sequence[str] = (), tie: Sequence[str] = (), order: Sequence[str] = (TIME,), **funcs: RunningStat
) -> DataFrame:
    """Group totals on every row: aggregated once per group, then joined back.

    The wide rows are not sorted; a small table of totals is broadcast by its
    measured size, and a hot group is split by adaptive execution.
    """
    rows, names = keyed(df, by)
    groups = [f"__g{i}" for i in range(len(names))]
    keys = sort_keys(df, order, tie=tie)
    plain, placed = [], {}
    for n, f in funcs.items():
        if f.func in ("first", "last"):
            if f.offset:
                placed[n] = f
                continue
            rank = F.struct(*[k.expr.alias(f"k{i}") for i, k in enumerate(keys)])
            pick = F.min_by if f.func == "first" else F.max_by
            plain.append(pick(col(f.fields[0]), rank).alias(n))
        else:
            plain.append(_scalar(df, f).over_rows().alias(n))
    done = rows
    if plain:
        done = attach(done, rows.groupBy(*groups).agg(*plain), groups)
    for n, f in placed.items():
        down = f.func == "last"
        flipped = [Key(k.expr, k.desc != down) for k in keys]
        if f.offset < GROUP_LIMIT:
            # Spark keeps only the first rows of each group before the shuffle.
            w = Window.partitionBy(*groups).orderBy(*[k.column for k in flipped])
            ranked = rows.withColumn("__pos", F.row_number().over(w)).where(F.col("__pos") <= f.offset + 1)
        else:
            ranked = positioned(rows, groups, flipped, "__pos")
        nth = ranked.where(F.col("__pos") == f.offset + 1).select(*groups, col(f.fields[0]).alias(n))
        done = attach(done, nth, groups)
    return done.drop(*groups)


def stream_context(
    df: DataFrame,
    match: Column,
    before: int = 0,
    after: int = 0,
    time_window="1h",
    stream: Sequence[str] = (STREAM_ID,),
    at: str = TIME,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Rows that match, with their neighbours in the same stream inside the time window.

    Every row learns the nearest match behind and ahead of it by running values in
    both directions, so matches are never joined with their neighbourhood. On a
    hot stream both come from one cut of the rows.
    """
    window = timespan.duration(time_window) // 1000
    if window <= 0 or before < 0 or after < 0:
        raise ValueError("time_window must be positive, before and after not negative")
    flagged = df.withColumns({"__hit": F.coalesce(match, F.lit(False)), "__us": F.unix_micros(col(at).cast("timestamp"))})
    keys = sort_keys(df, [at], tie=tie)
    hot = is_hot(flagged, stream)
    position = {"__pos": Running("count", F.lit(1))}
    mark = F.when(F.col("__hit"), F.struct(F.col("__pos").alias("pos"), F.col("__us").alias("us")))
    nearest = {"__back": Running("max", mark), "__ahead": Running("min", mark, ahead=True)}
    if hot:
        cut = Slices(flagged, stream, keys, hot)
        both = cut.then(cut.add(position), nearest, ["__hit", "__pos", "__us"]).drop(*cut.helpers)
    else:
        placed = running(flagged, stream, keys, position, None)
        both = running(placed, stream, [Key(F.col("__pos"))], nearest, None)
    follows = (F.col("__pos") - F.col("__back.pos") <= after) & (F.col("__us") - F.col("__back.us") <= window)
    leads = (F.col("__ahead.pos") - F.col("__pos") <= before) & (F.col("__ahead.us") - F.col("__us") <= window)
    kept = both.where(F.col("__hit") | F.coalesce(follows, F.lit(False)) | F.coalesce(leads, F.lit(False)))
    return kept.drop("__hit", "__us", "__pos", "__back", "__ahead")
