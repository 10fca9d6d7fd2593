"""Aggregate functions of the ``stats`` operator.

A :class:`Stat` describes one function. ``direct`` builds a plain aggregate
Column, which Catalyst splits into a partial and a final aggregate with small
state. Functions whose state would grow with the group (quantiles, collected
lists) give ``table`` instead: a plan of its own that counts or cuts the rows
before anything is brought together, joined back by key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.functions.coerce import num
from skeinlog.functions.selection import quantiles
from skeinlog.model import col, dtype, expand, field_name, is_numeric, is_text, ordering, out, quoted, sort_key, val
from skeinlog.operators.slices import Key, positioned

# The strategy by which partial results of clusters are merged.
STRATEGIES = {
    "count": "sum",
    "count_uniq": "sum",
    "count_empty": "sum",
    "sum": "sum",
    "sum_len": "sum",
    "rate": "sum",
    "rate_sum": "sum",
    "min": "min",
    "first": "min",
    "max": "max",
    "last": "max",
    "avg": "avg",
    "median": "avg",
    "quantile": "avg",
}

LIST_BOUND = 1_000_000

Wrap = Callable[[Column], Column]


@dataclass(frozen=True)
class Stat:
    """One aggregate function with its fields and an optional condition."""

    func: str
    direct: Callable[[DataFrame, Wrap], Column] | None = None
    table: Callable[[DataFrame, Sequence[str], str], DataFrame] | None = None
    cond: Column | None = None
    empty: object = None
    ranked: tuple[float, tuple] | None = None
    per_step: Callable[[float], Stat] | None = None

    def if_(self, cond: Column) -> Stat:
        both = cond if self.cond is None else self.cond & cond
        return replace(self, cond=both)

    def at_step(self, seconds: float) -> Stat:
        """The function for steps of so many seconds, where it depends on them and none was given."""
        return self if self.per_step is None else replace(self.per_step(seconds), cond=self.cond)

    @property
    def strategy(self) -> str:
        return STRATEGIES.get(self.func, "any")

    def column(self, df: DataFrame) -> Column:
        wrap = (lambda c: c) if self.cond is None else (lambda c: F.when(self.cond, c))
        return self.direct(df, wrap)

    def frame(self, df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
        if self.ranked:
            return ranked_frame(df, by, {name: self})
        return self.table(df if self.cond is None else df.where(self.cond), by, name)


def switch(stat: Stat, cases: dict[str, Column], default: str | None = None) -> dict[str, Stat]:
    """One function over several conditions; ``default`` takes the rows of no case."""
    stats = {name: stat.if_(cond) for name, cond in cases.items()}
    if default:
        stats[default] = stat.if_(~reduce(lambda a, b: a | b, cases.values()))
    return stats


def _names(df: DataFrame, fields: Sequence) -> list:
    if not fields:
        return expand(df, ["*"])
    picked: list = []
    for f in fields:
        picked += expand(df, [f]) if isinstance(f, str) and f.endswith("*") else [f]
    return picked


def _numbers(df: DataFrame, fields: Sequence) -> list[Column]:
    return [num(f, df) for f in _names(df, fields)]


def _any_present(df: DataFrame, fields: Sequence) -> Column:
    return reduce(lambda a, b: a | b, [_has(df, f) for f in _names(df, fields)], F.lit(False))


def _has(df: DataFrame, f) -> Column:
    """Presence test; a typed column is tested for null so that the scan can use it."""
    return val(f) != "" if not isinstance(f, str) or is_text(df, f) else col(f).isNotNull()


def _add(terms: Sequence[Column]) -> Column:
    """Sum of the terms that are present, null if none is."""
    if len(terms) == 1:
        return terms[0]
    total = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms])
    return F.when(F.coalesce(*terms).isNotNull(), total)


# ---- counts ----------------------------------------------------------------


def count(*fields) -> Stat:
    """Rows, or rows where at least one of the fields has a value."""

    def build(df, w):
        return F.count(w(F.lit(1))) if not fields else F.count(w(F.when(_any_present(df, fields), 1)))

    return Stat("count", build)


def count_empty(*fields) -> Stat:
    return Stat("count_empty", lambda df, w: F.count(w(F.when(~_any_present(df, fields), 1))))


def _tuple(df: DataFrame, fields: Sequence) -> Column:
    names = _names(df, fields)
    parts = [(out(val(f)) if not isinstance(f, str) or is_text(df, f) else col(f)).alias(f"f{i}") for i, f in enumerate(names)]
    return F.when(_any_present(df, names), parts[0] if len(parts) == 1 else F.struct(*parts))


def _capped(c: Column, limit: int) -> Column:
    return F.least(c, F.lit(limit).cast("bigint")) if limit else c


def count_uniq(*fields, limit: int = 0) -> Stat:
    """Exact number of distinct tuples; tuples without any value do not count."""
    return Stat("count_uniq", lambda df, w: _capped(F.count_distinct(w(_tuple(df, fields))), limit))


def count_uniq_hash(*fields, limit: int = 0) -> Stat:
    """Distinct tuples told apart by a 64-bit hash: eight bytes per tuple are shuffled."""

    def build(df, w):
        names = _names(df, fields)
        hashed = F.when(_any_present(df, names), F.xxhash64(*[val(f) for f in names]))
        return _capped(F.count_distinct(w(hashed)), limit)

    return Stat("count_uniq_hash", build)


# ---- sums ------------------------------------------------------------------


def sum_(*fields) -> Stat:
    return Stat("sum", lambda df, w: F.sum(w(_add(_numbers(df, fields)))))


def sum_len(*fields) -> Stat:
    def build(df, w):
        sizes = reduce(lambda a, b: a + b, [F.octet_length(val(f)).cast("bigint") for f in _names(df, fields)])
        return F.coalesce(F.sum(w(sizes)), F.lit(0).cast("bigint"))

    return Stat("sum_len", build)


def avg(*fields) -> Stat:
    """Mean over all numbers of the fields."""

    def build(df, w):
        numbers = _numbers(df, fields)
        seen = reduce(lambda a, b: a + b, [n.isNotNull().cast("bigint") for n in numbers])
        return F.try_divide(F.sum(w(_add(numbers))), F.sum(w(seen)))

    return Stat("avg", build)


def stddev(*fields) -> Stat:
    """Population standard deviation over all numbers of the fields."""

    def build(df, w):
        numbers = _numbers(df, fields)
        if len(numbers) == 1:
            return F.stddev_pop(w(numbers[0]))
        # one count, mean and variance for each field, put together without squares of the values themselves
        parts = [(F.count(w(x)), F.coalesce(F.avg(w(x)), F.lit(0.0)), F.coalesce(F.var_pop(w(x)), F.lit(0.0))) for x in numbers]
        n = reduce(lambda a, b: a + b, [k for k, _, _ in parts])
        mean = F.try_divide(reduce(lambda a, b: a + b, [k * m for k, m, _ in parts]), n)
        spread = reduce(lambda a, b: a + b, [k * (v + (m - mean) * (m - mean)) for k, m, v in parts])
        return F.sqrt(F.try_divide(spread, n))

    return Stat("stddev", build)


def rate(step_seconds: float | None = None) -> Stat:
    """Rows per second of the time range; the plain count without a range."""
    return Stat(
        "rate", lambda df, w: F.count(w(F.lit(1))) / F.lit(float(step_seconds or 1)), per_step=None if step_seconds else rate
    )


def rate_sum(*fields, step_seconds: float | None = None) -> Stat:
    return Stat(
        "rate_sum", lambda df, w: F.sum(w(_add(_numbers(df, fields)))) / F.lit(float(step_seconds or 1)),
        per_step=None if step_seconds else lambda s: rate_sum(*fields, step_seconds=s),
    )


# ---- extremes --------------------------------------------------------------


def _is_float(df: DataFrame, f) -> bool:
    """Whether a column can hold not-a-number."""
    return isinstance(f, str) and field_name(f) in df.columns and isinstance(dtype(df, f), (T.FloatType, T.DoubleType))


def _extreme(func: str, fields: Sequence) -> Stat:
    best, pick = (F.min, F.least) if func == "min" else (F.max, F.greatest)

    def build(df, w):
        names = _names(df, fields)
        if all(is_numeric(df, f) for f in names):
            values = [num(f, df) if len(names) > 1 or _is_float(df, f) else col(f) for f in names]
            return best(w(values[0] if len(values) == 1 else pick(*values)))
        if all(isinstance(f, str) and not is_text(df, f) for f in names) and len(names) == 1:
            return best(w(col(names[0])))
        keys = [F.when(_has(df, f), sort_key(f)) for f in names]
        return best(w(keys[0] if len(keys) == 1 else pick(*keys)))["text"]

    return Stat(func, build)


def min_(*fields) -> Stat:
    """Smallest value: numbers before text."""
    return _extreme("min", fields)


def max_(*fields) -> Stat:
    return _extreme("max", fields)


def any_(f) -> Stat:
    """Some value; the smallest text, so that repeated runs agree."""
    return Stat("any", lambda df, w: F.min(w(out(val(f)))))


def _row_json(df: DataFrame, fields: Sequence) -> Column:
    names = _names(df, fields)
    return F.to_json(F.struct(*[out(val(f)).alias(f) for f in names]))


def row_any(*fields) -> Stat:
    return Stat("row_any", lambda df, w: F.min(w(_row_json(df, fields))))


def _by_extreme(func: str, src, value: Callable[[DataFrame], Column]) -> Stat:
    pick = F.min_by if func.endswith("min") else F.max_by

    def build(df, w):
        v = value(df)
        rank = F.struct(ordering(df, src).alias("a"), v.alias("b"))
        has = _has(df, src) & ~F.isnan(col(src)) if _is_float(df, src) else _has(df, src)
        return pick(v, w(F.when(has, rank)))

    return Stat(func, build)


def row_min(src, *fields) -> Stat:
    """Row with the smallest ``src`` as JSON; equal values are settled by the JSON text."""
    return _by_extreme("row_min", src, lambda df: _row_json(df, fields))


def row_max(src, *fields) -> Stat:
    return _by_extreme("row_max", src, lambda df: _row_json(df, fields))


def field_min(src, f) -> Stat:
    """Value of ``f`` where ``src`` is smallest; equal values are settled by the value itself."""
    return _by_extreme("field_min", src, lambda df: col(f))


def field_max(src, f) -> Stat:
    return _by_extreme("field_max", src, lambda df: col(f))


# ---- functions with a plan of their own ------------------------------------


def _long(df: DataFrame, by: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """One row per (group, value): the listed columns under each other."""
    keys = [F.col(quoted(b)) for b in by]
    if len(columns) == 1:
        return df.select(*keys, columns[0].alias("__v")).where(F.col("__v").isNotNull())
    return df.select(*keys, F.explode(F.array(*columns)).alias("__v")).where(F.col("__v").isNotNull())


def quantile(phi: float, *fields) -> Stat:
    """Exact quantile, always a value that occurs.

    Ranges of values are counted and narrowed, together for all quantiles of a
    query, so the state of a task never holds the values of a group.
    """
    if not 0 <= phi <= 1:
        raise ValueError("phi must lie between 0 and 1")
    return Stat("quantile", ranked=(phi, fields))


def ranked_frame(df: DataFrame, by: Sequence[str], stats: dict[str, Stat]) -> DataFrame:
    """The quantiles among the functions of a query, in one table."""
    asked = {}
    for name, s in stats.items():
        columns = _numbers(df, s.ranked[1])
        asked[name] = (s.ranked[0], columns if s.cond is None else [F.when(s.cond, c) for c in columns])
    return quantiles(df, by, asked)


def median(*fields) -> Stat:
    return replace(quantile(0.5, *fields), func="median")


def quantile_approx(phi: float, *fields, accuracy: int = 10_000) -> Stat:
    """Quantile with bounded rank error and bounded state: one pass, also on streams."""
    return Stat("quantile", lambda df, w: F.percentile_approx(w(_numbers(df, fields)[0]), phi, accuracy))


# Up to this many rows per group Spark cuts groups before the shuffle.
GROUP_LIMIT = 1000


def _collected(rows: DataFrame, by: Sequence[str], order: Sequence[Key], value: Column, name: str, limit: int) -> DataFrame:
    """JSON array per group of the first rows in order.

    Rows are cut before they are brought together. Without a limit the list must
    fit one cell: a group that is longer than that fails the job, it is never cut short.
    """
    keep = limit or LIST_BOUND + 1
    sorting = [k.column for k in order]
    if keep > GROUP_LIMIT:
        first = positioned(rows, by, order, "__rn").where(F.col("__rn") <= keep)
    elif by:
        w = Window.partitionBy(*[F.col(quoted(b)) for b in by]).orderBy(*sorting)
        first = rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= keep)
    else:
        first = rows.orderBy(*sorting).limit(keep).withColumn("__rn", F.row_number().over(Window.orderBy(*sorting)))
    listed = F.array_sort(F.collect_list(F.struct(F.col("__rn"), value.alias("v"))))
    items = F.transform(listed, lambda x: x["v"])
    grouped = first.groupBy(*[F.col(quoted(b)) for b in by]).agg(items.alias("__items"))
    text = F.concat(F.lit("["), F.array_join(F.col("__items"), ","), F.lit("]"))
    if not limit:
        too_long = F.raise_error(F.lit(f"{name}: more than {LIST_BOUND} values in one group; set a limit"))
        text = F.when(F.size("__items") > LIST_BOUND, too_long.cast("string")).otherwise(text)
    return grouped.select(*[F.col(quoted(b)) for b in by], text.alias(name))


def _json_text(c: Column) -> Column:
    one = F.to_json(F.array(c))
    return one.substr(F.lit(2), F.length(one) - 2)


def values(*fields, limit: int = 0) -> Stat:
    """All values as a JSON array, sorted."""

    def build(df, by, name):
        rows = _long(df, by, [out(val(f)) for f in _names(df, fields)])
        return _collected(rows, by, [Key(F.col("__v"))], _json_text(F.col("__v")), name, limit)

    return Stat("values", table=build, empty="[]")


def uniq_values(*fields, limit: int = 0) -> Stat:
    """Distinct values as a sorted JSON array."""

    def build(df, by, name):
        rows = _long(df, by, [out(val(f)) for f in _names(df, fields)]).distinct()
        return _collected(rows, by, [Key(F.col("__v"))], _json_text(F.col("__v")), name, limit)

    return Stat("uniq_values", table=build, empty="[]")


def value_rows(df: DataFrame, by: Sequence[str], *fields, distinct: bool = False) -> DataFrame:
    """What values and uniq_values list, as rows: the group, position (from 1, in order of text) and value.

    No list is built, so a group may be of any length. Missing values are left out, and groups without any.
    """
    taken = {"position", "value"} & set(by)
    if taken:
        raise ValueError(f"rename the grouping fields {sorted(taken)}")
    rows = _long(df, by, [out(val(f)) for f in _names(df, fields)])
    placed = positioned(rows.distinct() if distinct else rows, by, [Key(F.col("__v"))], "__rn")
    return placed.select(
        *[F.col(quoted(b)) for b in by], F.col("__rn").cast("long").alias("position"), F.col("__v").alias("value")
    )


def json_values(*fields, sort: Sequence[tuple[str, bool] | str] = (), limit: int = 0) -> Stat:
    """Rows as JSON objects in a JSON array, ordered by the sort fields (name or (name, desc)), then by text."""

    def build(df, by, name):
        order = [(s, False) if isinstance(s, str) else s for s in sort]
        rows = df.select(
            *[F.col(quoted(b)) for b in by],
            _row_json(df, fields).alias("__v"),
            *[ordering(df, s).alias(f"__s{i}") for i, (s, _) in enumerate(order)],
        )
        keys = [Key(F.col(f"__s{i}"), desc) for i, (_, desc) in enumerate(order)]
        return _collected(rows, by, [*keys, Key(F.col("__v"))], F.col("__v"), name, limit)

    return Stat("json_values", table=build, empty="[]")


BUCKETS_PER_DECADE = 18


def histogram_bucket(v: Column) -> Column:
    """Bucket number on a log scale with 18 buckets per decade."""
    return F.floor(F.log10(v) * BUCKETS_PER_DECADE)


def histogram(f) -> Stat:
    """Hits per value range as a JSON array; ranges are ``low...high`` on a log scale."""

    def build(df, by, name):
        keys = [F.col(quoted(b)) for b in by]
        rows = df.select(*keys, num(f, df).alias("__v")).where(F.col("__v").isNotNull())
        bucket = F.when(F.col("__v") > 0, histogram_bucket(F.col("__v")))
        hits = rows.groupBy(*keys, bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__h"))
        edge = lambda b: F.format_string("%.3e", F.pow(F.lit(10.0), b / F.lit(float(BUCKETS_PER_DECADE))))
        span = F.when(F.col("__b").isNull(), "-Inf...0").otherwise(F.concat(edge(F.col("__b")), F.lit("..."), edge(F.col("__b") + 1)))
        item = F.struct(F.col("__b").alias("b"), F.to_json(F.struct(span.alias("vmrange"), F.col("__h").alias("hits"))).alias("t"))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), ",")
        return hits.groupBy(*keys).agg(F.concat(F.lit("["), text, F.lit("]")).alias(name))

    return Stat("histogram", table=build, empty="[]")
