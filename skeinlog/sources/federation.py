"""Union of clusters, with failed clusters left out and replicas folded."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.functions import timespan
from skeinlog.functions.filters import time_range
from skeinlog.model import CLUSTER, TIME, col, field_name, quoted

Source = "DataFrame | Callable[[], DataFrame]"


def _union(named: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.withColumn(CLUSTER, F.lit(name)) for name, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def federate(sources: dict[str, Source], on_error: str = "fail") -> DataFrame:
    """All rows of all clusters, tagged with the cluster name."""
    return federate_reporting(sources, on_error)[0]


def federate_reporting(sources: dict[str, Source], on_error: str = "skip") -> tuple[DataFrame, list[str]]:
    """Union and the names of the clusters that could not be read when the plan was made.

    A source may be a DataFrame or a function that opens one.
    """
    if on_error not in ("skip", "fail"):
        raise ValueError("on_error is skip or fail")
    opened, skipped = {}, []
    for name, source in sources.items():
        try:
            df = source() if callable(source) else source
            df.schema  # analyses the plan
            opened[name] = df
        except PySparkException:
            if on_error == "fail":
                raise
            skipped.append(name)
    if not opened:
        raise ValueError(f"no cluster could be read: {skipped}")
    return _union(opened), skipped


def row_content(df: DataFrame, without: Sequence[str] = ()) -> dict[str, Column]:
    """Every column by a name of its own as something that rows can be grouped by; maps by their sorted entries."""
    held = {}
    for i, f in enumerate(df.schema.fields):
        if f.name not in without:
            c = F.col(quoted(f.name))
            kind = f.dataType
            held[f"__c{i}"] = F.array_sort(F.map_entries(c)) if isinstance(kind, T.MapType) else F.to_json(F.struct(c)) if "map<" in kind.simpleString() or "variant" in kind.simpleString() else c
    return held


def dedup_replicas(df: DataFrame, keys: Sequence[str] | None = None, replica: str | None = None) -> DataFrame:
    """Rows that several replicas of a cluster hold, folded.

    Rows are the same if they agree in all columns. With ``replica``, the column that names the replica, a row stays as
    often as the replica that holds it most often has it, so copies that were logged stay; the column goes. Without it copies
    cannot be told from replicas, and one of them stays. ``keys`` asks for one row of those that agree in them.

    Copies are counted before the shuffle, so a row copied very often cannot overload one task.
    """
    if keys:
        return df.dropDuplicates([k for k in keys if k in df.columns])
    content = row_content(df, [replica] if replica else [])
    names = [c for c in df.columns if c != replica]
    by = [*content, *(["__replica"] if replica else [])]
    rows = df.withColumns({**content, **({"__replica": F.col(quoted(replica))} if replica else {})})
    held = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *[F.first(F.col(quoted(n))).alias(f"__v{i}") for i, n in enumerate(names)])
    values = [F.col(f"__v{i}").alias(n) for i, n in enumerate(names)]
    if not replica:
        return held.select(*values)
    richest = held.groupBy(*content).agg(F.max("__n").alias("__n"), *[F.first(f"__v{i}").alias(f"__v{i}") for i in range(len(names))])
    return richest.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n"))).select(*values)


def cap(df: DataFrame, limit: int | str | None = None, max_limit: int = 1000, at: str = TIME, tie: Sequence[str] = ()) -> DataFrame:
    """Newest rows up to the asked limit, never above the maximum; a maximum of 0 means all rows."""
    from skeinlog.operators.order import sort

    wanted = effective_limit(limit, max_limit)
    return sort(df, [at], desc=True, limit=wanted, tie=tie) if wanted else df


def effective_limit(limit: int | str | None, max_limit: int) -> int:
    try:
        asked = int(limit)
    except (TypeError, ValueError):
        return max_limit
    return asked if 0 < asked <= max_limit else max_limit


@dataclass
class Session:
    """Options of a query: a filter for it and all its subqueries, a time range, a time offset, a fixed now."""

    filters: list[Column] = field(default_factory=list)
    time_lo: str | datetime | None = None
    time_hi: str | datetime | None = None
    time_ends: str = "[]"
    offset: str | int = 0
    now: datetime | None = None

    def __post_init__(self):
        self.now = self.now or datetime.now(timezone.utc)

    def base(self, df: DataFrame, at: str = TIME, ignore_global_time_filter: bool = False) -> DataFrame:
        """A base table as the query sees it. A subquery may opt out of the time range."""
        for pred in self.filters:
            df = df.where(pred)
        if not ignore_global_time_filter and (self.time_lo is not None or self.time_hi is not None):
            df = df.where(time_range(self.time_lo, self.time_hi, self.time_ends, self.offset, at, self.now))
        if timespan.duration(self.offset):
            df = df.withColumn(field_name(at), col(at) + timespan.interval(timespan.duration(self.offset)))
        return df


def with_time_offset(df: DataFrame, d, lo=None, hi=None, ends: str = "[]", at: str = TIME) -> DataFrame:
    """Time bounds move back by d, the selected times forward by d."""
    return Session(time_lo=lo, time_hi=hi, time_ends=ends, offset=d).base(df, at)


def with_global_filter(pred: Column, *dfs: DataFrame) -> list[DataFrame]:
    """The same filter on the query's table and on those of its subqueries."""
    session = Session(filters=[pred])
    return [session.base(df) for df in dfs]
