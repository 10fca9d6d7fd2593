"""The given tables as log tables, and the registry of checked queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinlog.model import make_stream, make_stream_id, use_utc
from skeinlog.operators.slices import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def logs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as log rows."""
    e = table(spark, sf, "events")
    text = F.concat(F.col("event_type"), F.lit(" user="), F.col("user_id"), F.lit(" value="), F.col("value"))
    rows = e.select(
        "event_id", "user_id", "event_type", "value", "props",
        F.col("ts").cast("timestamp").alias("_time"),
        text.alias("_msg"),
        make_stream({"type": "event_type", "user": "user_id"}).alias("_stream"),
    )
    return rows.withColumn("_stream_id", make_stream_id())


LOGS = """logs AS (SELECT event_id, user_id, event_type, value, props, ts AS _time,
 event_type || ' user=' || user_id || ' value=' || value AS _msg,
 '{type="' || event_type || '",user="' || user_id || '"}' AS stream FROM events)"""


def clusters(spark: SparkSession, sf: str, n: int = 3) -> dict[str, DataFrame]:
    """The log rows, spread over n clusters."""
    rows = logs(spark, sf)
    return {f"c{i}": rows.where(F.pmod(F.col("event_id"), F.lit(n)) == i) for i in range(n)}


CLUSTERS = LOGS + ", cl AS (SELECT *, 'c' || (event_id % 3) AS _cluster FROM logs)"


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder in the shared folder of the cluster."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})
