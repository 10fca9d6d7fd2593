"""Sinks: log lines and nested series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.functions.coerce import RFC3339, float_text
from skeinlog.model import col, dtype, is_text, out, quoted, val


def without_empty(df: DataFrame) -> DataFrame:
    """Empty text becomes null, which the JSON writer leaves out."""
    return df.select(*[out(val(n)).alias(n) if is_text(df, n) else col(n) for n in df.columns])


def _as_numbers(df: DataFrame) -> DataFrame:
    """Doubles in their log form, still as JSON numbers; those that JSON has no number for are left out."""
    def number(n: str):
        finite = F.when(~F.isnan(col(n)) & (F.abs(col(n)) != float("inf")), col(n))
        return F.parse_json(float_text(finite)).alias(n)

    return df.select(*[number(n) if dtype(df, n) == T.DoubleType() else col(n) for n in df.columns])


def write_ndjson(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per row, empty fields left out; every task writes its own file."""
    _as_numbers(without_empty(df)).write.mode(mode).options(
        ignoreNullFields="true", timestampFormat=RFC3339, timestampNTZFormat=RFC3339
    ).json(path)


def _points(series: DataFrame, keys: list[str]) -> DataFrame:
    return series.select(*[F.col(quoted(k)) for k in keys], F.struct(F.col("ts").alias("ts"), _text(series).alias("value")).alias("p"))


def _text(df: DataFrame):
    return F.col("value") if is_text(df, "value") else float_text(F.col("value"))


def to_matrix(points: DataFrame, keys: tuple[str, ...] = ("metric", "name")) -> DataFrame:
    """Nested series for a sink, points sorted by time. A series has one point per time step of the query."""
    present = [k for k in keys if k in points.columns]
    return _points(points, present).groupBy(*present).agg(F.array_sort(F.collect_list("p")).alias("values"))


def to_vector(points: DataFrame, keys: tuple[str, ...] = ("metric", "name")) -> DataFrame:
    """One point per series as ``[ts, value]``."""
    present = [k for k in keys if k in points.columns]
    return _points(points, present).select(*present, F.array(F.col("p.ts").cast("string"), F.col("p.value")).alias("value"))
