"""Checked queries: live streams, run over all the data there is and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinlog.functions import aggs as a
from skeinlog.functions import filters as f
from skeinlog.model import CLUSTER
from skeinlog.operators import shape, windows
from skeinlog.operators.stats import Bucket, partial_stats
from skeinlog.plans.tables import LOGS, clusters, logs, register, rounded, scratch
from skeinlog.sources.federation import federate
from skeinlog.streaming import live

NOW = {"availableNow": True}
ALL = "400d"  # the slices come in any order, and no row counts as late
#: Micro-batches of a live source, and rows of a file, about.
BATCHES, FILE_ROWS = 3, 250_000


def slices(spark, rows: DataFrame, by: str, count: int | None = None) -> DataFrame:
    """The rows as a live source: files that arrive over three micro-batches. A file is what one task writes and reads, so
    there are as many as the rows (``count``, if known) need."""
    path = scratch(spark, "live")
    count = rows.count() if count is None else count
    per_batch = max(2, -(-count // (BATCHES * FILE_ROWS)))
    rows.repartition(BATCHES * per_batch, by).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def live_logs(spark, sf) -> DataFrame:
    return slices(spark, logs(spark, sf), "user_id")


def finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def appended(spark, sdf: DataFrame) -> DataFrame:
    path = scratch(spark, "appended")
    finished(live.append(sdf, path, scratch(spark, "checkpoint"), NOW))
    return spark.read.parquet(path)


def upserted(spark, sdf: DataFrame, keys: list[str]) -> DataFrame:
    path = scratch(spark, "upserted")
    finished(live.upsert(sdf, path, scratch(spark, "checkpoint"), keys, NOW))
    return live.latest(spark, path, keys)


TAIL = f"WITH {LOGS} SELECT event_id, upper(event_type) AS kind FROM logs WHERE event_type = 'error' AND value > 20"


def _pipes():
    return [
        lambda df: df.where(f.and_(f.phrase("_msg", "error"), f.gt("value", 20))),
        lambda df: shape.format(df, "<uc:event_type>", "kind"),
        lambda df: df.select("event_id", "kind"),
    ]


@register("C12_tail", TAIL)
def _c12(spark, sf):
    return appended(spark, live.tail(live_logs(spark, sf), *_pipes()))


@register("L1_tail", TAIL)
def _l1(spark, sf):
    """The same pipes work on a stream and on a table."""
    return appended(spark, live.tail(live_logs(spark, sf), *_pipes())).select("event_id", "kind")


@register("L2_tail_sorted_batches", f"WITH {LOGS} SELECT event_id, _msg FROM logs")
def _l2(spark, sf):
    path = scratch(spark, "tail")
    rows = live_logs(spark, sf)
    finished(live.tail_sorted_batches(rows, path, scratch(spark, "checkpoint"), tie=["event_id"], trigger=NOW))
    return live.current(spark, path).select("event_id", "_msg")


@register("L3_stream_union", "SELECT event_id, 'c' || (event_id % 3) AS _cluster FROM events")
def _l3(spark, sf):
    named = {n: slices(spark, c, "user_id") for n, c in clusters(spark, sf).items()}
    return appended(spark, live.stream_union(named).select("event_id", CLUSTER))


@register("L4_stream_hits", "SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H') AS at, event_type, count(*) AS value FROM events GROUP BY 1, 2")
def _l4(spark, sf):
    done = upserted(spark, live.stream_hits(live_logs(spark, sf), "6h", ["event_type"], late=ALL), ["ts", "event_type"])
    return done.select(F.date_format("ts", "yyyy-MM-dd HH").alias("at"), "event_type", "value")


@register("L5_stream_stats", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS at, event_type, count(*) AS n, round(sum(value), 4) AS s, max(value) AS hi, round(avg(value), 6) AS av FROM events GROUP BY 1, 2")
def _l5(spark, sf):
    aggs = {"n": a.count(), "s": a.sum_("value"), "hi": a.max_("value"), "av": a.avg("value")}
    done = upserted(spark, live.stream_stats(live_logs(spark, sf), ["event_type"], "1d", aggs, late=ALL), ["ts", "event_type"])
    done = done.select(F.date_format("ts", "yyyy-MM-dd").alias("at"), "event_type", "n", "s", "hi", "av")
    return rounded(rounded(done, 4, "s"), 6, "av")


@register("L5_stream_stats_sliding", """SELECT strftime(w, '%Y-%m-%d %H') AS at, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'),
 time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') - INTERVAL 6 HOUR]) AS w FROM events) GROUP BY 1""")
def _l5_sliding(spark, sf):
    done = upserted(spark, live.stream_stats(live_logs(spark, sf), [], "12h", {"n": a.count()}, late=ALL, slide="6h"), ["ts"])
    return done.select(F.date_format("ts", "yyyy-MM-dd HH").alias("at"), "n")


@register("L6_stream_merge_partials", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS at, event_type, count(*)::DOUBLE AS n, max(value) AS hi FROM events GROUP BY 1, 2")
def _l6(spark, sf):
    parts = partial_stats(federate(clusters(spark, sf)), ["event_type", Bucket("_time", "1d", name="ts")], n=a.count(), hi=a.max_("value"))
    few = 0  # a row for each cluster, type and day: not worth a second run to count them
    merged = live.stream_merge_partials(slices(spark, parts, CLUSTER, few), ["event_type"], {"n": "count", "hi": "max"}, late=ALL)
    done = upserted(spark, merged, ["ts", "event_type"])
    return done.select(F.date_format("ts", "yyyy-MM-dd").alias("at"), "event_type", "n", "hi")


@register("L7_stream_running_stats", "SELECT user_id, row_number() OVER (PARTITION BY user_id) AS n, round(max(value) OVER (PARTITION BY user_id), 4) AS top FROM events")
def _l7(spark, sf):
    """Running counts per user pass every number once, whatever the order of the slices."""
    path = scratch(spark, "running")
    funcs = {"n": windows.run_count(), "hi": windows.run_max("value")}
    source = slices(spark, logs(spark, sf), "event_id")
    finished(live.stream_running_stats(source, ["user_id"], funcs, path, scratch(spark, "state"), scratch(spark, "checkpoint"), tie=["event_id"], trigger=NOW))
    rows = live.current(spark, path)
    top = windows.total_stats(rows, ["user_id"], top=windows.run_max("hi"))
    return rounded(top.select("user_id", "n", "top"), 4, "top")


@register("L8_stream_dedup_replicas", "SELECT event_id, 'main' AS _cluster FROM events")
def _l8(spark, sf):
    twice = live_logs(spark, sf).withColumn(CLUSTER, F.lit("main")).unionByName(live_logs(spark, sf).withColumn(CLUSTER, F.lit("main")))
    return appended(spark, live.stream_dedup_replicas(twice, late=ALL).select("event_id", CLUSTER))
