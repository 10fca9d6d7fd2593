"""Data model shared by every operator.

A log row may lack any field, and a missing field equals an empty one. Text
columns hold field values, ``_extra`` holds fields that have no column of their
own, and typed columns keep their type until text is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MSG = "_msg"
TIME = "_time"
STREAM = "_stream"
STREAM_ID = "_stream_id"
CLUSTER = "_cluster"
EXTRA = "_extra"

Field = "str | Column"


def use_utc(spark: SparkSession) -> SparkSession:
    """Time filters, buckets and text all assume a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def field_name(name: str) -> str:
    """An empty field name stands for the message."""
    return name or MSG


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(f: Field) -> Column:
    """Column for a field name (dots are part of the name) or a ready expression."""
    if isinstance(f, Column):
        return f
    return F.col(quoted(field_name(f)))


def val(f: Field) -> Column:
    """Field as text, never null."""
    return F.coalesce(col(f).cast("string"), F.lit(""))


def out(c: Column) -> Column:
    """Empty text back to null."""
    return F.nullif(c, F.lit(""))


def present(f: Field) -> Column:
    return val(f) != ""


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[field_name(name)].dataType


def is_numeric(df: DataFrame, f: Field) -> bool:
    return isinstance(f, str) and field_name(f) in df.columns and isinstance(dtype(df, f), T.NumericType)


def is_text(df: DataFrame, f: Field) -> bool:
    return isinstance(f, str) and field_name(f) in df.columns and isinstance(dtype(df, f), T.StringType)


def expand(df: DataFrame, patterns: Iterable[str]) -> list[str]:
    """Resolve field patterns (``name``, ``prefix*``, ``*``) against the columns of ``df``."""
    picked: dict[str, None] = {}
    for pattern in patterns:
        if pattern.endswith("*"):
            for name in df.columns:
                if name.startswith(pattern[:-1]) and name != EXTRA:
                    picked[name] = None
        elif field_name(pattern) in df.columns:
            picked[field_name(pattern)] = None
    return list(picked)


def group_key(df: DataFrame, name: str) -> Column:
    """Grouping value of a by-field: empty text is the same group as a missing field."""
    if field_name(name) not in df.columns:
        return F.lit(None).cast("string")
    c = col(name)
    return out(c) if is_text(df, name) else c


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality over keys where null equals null; planned as a hash or merge join."""
    cond = None
    for k in keys:
        one = left[quoted(k)].eqNullSafe(right[quoted(k)])
        cond = one if cond is None else cond & one
    return cond


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join per-key columns of ``right`` onto ``left``; null keys match null keys.

    The join is left to the planner: a small ``right`` is broadcast when its
    measured size allows it, a big one is shuffled, and skewed keys of ``left``
    are split by adaptive execution.
    """
    if not keys:
        # Without keys the right side is one row: its values become scalar subqueries, not a join.
        return left.withColumns({c: right.select(F.col(quoted(c))).scalar() for c in right.columns})
    renamed = right.select(
        *[F.col(quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(quoted(c)) for c in right.columns if c not in keys],
    )
    cond = None
    for i, k in enumerate(keys):
        one = F.col(quoted(k)).eqNullSafe(F.col(f"__k{i}"))
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"__k{i}" for i in range(len(keys))])


def tie_break(df: DataFrame, given: Sequence[str] = ()) -> list[str]:
    """Columns that settle equal sort keys, so that ordered results are repeatable.

    Columns named by the caller are enough; without them time, stream and message decide.
    """
    return [n for n in (given or (TIME, STREAM_ID, MSG)) if n in df.columns]


def unique_name(name: str, taken: Iterable[str]) -> str:
    """Output name that does not clash: an ``s`` is appended until it is free."""
    taken = set(taken)
    while name in taken:
        name += "s"
    return name


def sort_key(f: Field) -> Column:
    """Order for values of mixed kind: numbers first, then text in natural order.

    The 64-bit integer settles numbers above 2^53, and the raw text settles the rest.
    """
    text = val(f)
    number = text.try_cast("double")
    number = F.when(F.isnan(number), F.lit(None).cast("double")).otherwise(number)
    digits = F.regexp_replace
    natural = F.when(
        number.isNull(),
        F.transform(
            F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1)),
            lambda x: F.when(
                x.rlike(r"^\d"),
                F.concat(
                    F.lpad(F.length(digits(x, r"^0+(?=\d)", "")).cast("string"), 6, "0"),
                    digits(x, r"^0+(?=\d)", ""),
                ),
            ).otherwise(x),
        ),
    )
    return F.struct(
        F.when(number.isNull(), 1).otherwise(0).alias("kind"),
        number.alias("number"),
        text.try_cast("bigint").alias("whole"),
        natural.alias("natural"),
        text.alias("text"),
    )


def ordering(df: DataFrame, f: Field) -> Column:
    """Sort expression of a field: typed columns sort natively, text by ``sort_key``."""
    if isinstance(f, str) and field_name(f) in df.columns and not is_text(df, f):
        return col(f)
    return sort_key(f)


def stream_text(f: Field = STREAM) -> Column:
    """Label map as ``{k="v",...}`` with sorted labels."""
    entries = F.array_sort(F.map_entries(col(f)))
    return F.concat(
        F.lit("{"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.to_json(F.array(e["value"])).substr(
            F.lit(2), F.length(F.to_json(F.array(e["value"]))) - 2))), ","),
        F.lit("}"),
    )


def make_stream(labels: dict[str, Field]) -> Column:
    """Label map from columns; empty labels are left out."""
    pairs = F.create_map(*[x for k, f in labels.items() for x in (F.lit(k), val(f))])
    return F.map_filter(pairs, lambda _, v: v != "")


def make_stream_id(f: Field = STREAM) -> Column:
    """Stable id of a label set: hash of its canonical text."""
    return F.md5(stream_text(f))
