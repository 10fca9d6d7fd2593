"""Checked queries: user-level questions, sources and sinks, query options."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skeinlog.functions import aggs as a
from skeinlog.functions import filters as f
from skeinlog.functions.coerce import float_text
from skeinlog.model import CLUSTER
from skeinlog.operators import combine, order
from skeinlog.operators.stats import Bucket, stats
from skeinlog.plans import logqueries as q
from skeinlog.plans.catalog_stats import points, series
from skeinlog.plans.tables import LOGS, clusters, logs, register, scratch, table
from skeinlog.sources import federation, readers, writers


@register("C1_query", f"WITH {LOGS} SELECT event_id, _msg FROM logs ORDER BY _time DESC, event_id DESC LIMIT 1000")
def _query(spark, sf):
    return q.query(logs(spark, sf), tie=["event_id"], limit=5000).select("event_id", "_msg")


@register("C1_query_pipes", "SELECT user_id, count(*) AS hits FROM events WHERE event_type = 'error' AND value > 50 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _pipes(spark, sf):
    return q.query(
        logs(spark, sf),
        lambda df: df.where(f.and_(f.phrase("_msg", "error"), f.gt("value", 50))),
        lambda df: order.top(df, ["user_id"], 5),
    )


@register("C2_stats_query", """SELECT '{"event_type":"' || event_type || '"}' AS metric, 'n' AS name, 1706659200.0::DOUBLE AS ts, count(*)::VARCHAR AS value FROM events GROUP BY event_type
 UNION ALL SELECT '{"event_type":"' || event_type || '"}', 'hi', 1706659200.0, regexp_replace(max(value)::VARCHAR, '\\.0$', '') FROM events GROUP BY event_type""")
def _stats_query(spark, sf):
    return q.stats_query(logs(spark, sf), ["event_type"], {"n": a.count(), "hi": a.max_("value")}, datetime(2024, 1, 31))


@register("C3_stats_query_range", """SELECT '{"event_type":"' || event_type || '"}' AS metric, 'n' AS name, epoch(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'))::DOUBLE AS ts, count(*)::VARCHAR AS value
 FROM events GROUP BY event_type, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')""")
def _range(spark, sf):
    return q.stats_query_range(logs(spark, sf), ["event_type"], {"n": a.count()}, "6h")


@register("C3_rate", """SELECT '{"event_type":"' || event_type || '"}' AS metric, 'r' AS name, epoch(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'))::DOUBLE AS ts, round(count(*) / 21600.0, 9) AS value
 FROM events GROUP BY event_type, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')""")
def _rate(spark, sf):
    done = q.stats_query_range(logs(spark, sf), ["event_type"], {"r": a.rate()}, "6h")
    return done.withColumn("value", F.round(F.col("value").cast("double"), 9))


@register("C4_hits", """SELECT '{"event_type":"' || event_type || '"}' AS fields, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts, count(*) AS value,
 CAST(sum(count(*)) OVER (PARTITION BY event_type) AS BIGINT) AS total FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def _hits(spark, sf):
    return q.hits(logs(spark, sf), "1h", ["event_type"])


@register("C4_hits_no_fields", "SELECT '{}' AS fields, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts, count(*) AS value, (SELECT count(*) FROM events) AS total FROM events GROUP BY date_trunc('day', ts)")
def _hits_plain(spark, sf):
    return q.hits(logs(spark, sf), "1d")


LINE_FIELDS = ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_suppkey", "l_orderkey")
LINE_PAIRS = " UNION ALL ".join(f"SELECT '{n}' AS field_name, {n}::VARCHAR AS field_value FROM lineitem" for n in LINE_FIELDS)


@register("C5_facets_query", f"""WITH p AS ({LINE_PAIRS}), c AS (SELECT field_name, field_value, count(*) AS hits FROM p GROUP BY 1, 2),
 n AS (SELECT *, count(*) OVER (PARTITION BY field_name) AS n, row_number() OVER (PARTITION BY field_name ORDER BY hits DESC, field_value) AS rn FROM c)
 SELECT field_name, field_value, hits FROM n WHERE n BETWEEN 2 AND 60 AND rn <= 4""")
def _facets(spark, sf):
    return q.facets_query(table(spark, sf, "lineitem").select(*LINE_FIELDS), limit=4, max_values=60)


@register("C6_field_names", "SELECT 'kind' AS name, count(*) FILTER (event_id % 3 <> 0) AS hits FROM events UNION ALL SELECT 'event_id', count(*) FROM events UNION ALL SELECT 'even', count(*) FILTER (event_id % 2 = 0) FROM events UNION ALL SELECT 'type_click', count(*) FILTER (event_type = 'click') FROM events")
def _field_names(spark, sf):
    rows = logs(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).otherwise("").alias("kind"),
        F.map_filter(F.create_map(F.lit("even"), F.when(F.col("event_id") % 2 == 0, "1").otherwise(""), F.lit("type_click"), F.when(F.col("event_type") == "click", "1")),
                     lambda k, v: v.isNotNull()).alias("_extra"))
    return q.field_names(rows)


@register("C7_field_values", "SELECT user_id::VARCHAR AS value, count(*) AS hits FROM events WHERE contains(user_id::VARCHAR, '1') GROUP BY user_id ORDER BY 2 DESC, user_id LIMIT 15")
def _field_values(spark, sf):
    return q.field_values(logs(spark, sf), "user_id", filter="1", limit=15)


@register("C8_streams", f"WITH {LOGS} SELECT stream AS value, count(*) AS hits FROM logs GROUP BY 1")
def _streams(spark, sf):
    return q.streams(logs(spark, sf))


@register("C9_stream_ids", f"WITH {LOGS} SELECT md5(stream) AS value, count(*) AS hits FROM logs GROUP BY 1")
def _stream_ids(spark, sf):
    return q.stream_ids(logs(spark, sf))


@register("C10_stream_field_names", "SELECT unnest(['type', 'user']) AS value, (SELECT count(*) FROM events) AS hits")
def _label_names(spark, sf):
    return q.stream_field_names(logs(spark, sf))


@register("C11_stream_field_values", "SELECT event_type AS value, count(*) AS hits FROM events GROUP BY 1")
def _label_values(spark, sf):
    return q.stream_field_values(logs(spark, sf), "type")


# ---- sources and sinks ------------------------------------------------------


@register("A2_federate_skip", "SELECT 'c' || (event_id % 3) AS _cluster, count(*) AS n FROM events WHERE event_id % 3 <> 1 GROUP BY 1")
def _skip(spark, sf):
    named = dict(clusters(spark, sf))
    named["c1"] = lambda: spark.read.parquet(f"{sf}/no_such_table.parquet")
    df, skipped = federation.federate_reporting(named, "skip")
    assert skipped == ["c1"]
    return stats(df, [CLUSTER], n=a.count())


@register("A3_dedup_replicas", f"WITH {LOGS} SELECT event_id, _msg, 'c' || (event_id % 3) AS _cluster FROM logs")
def _dedup(spark, sf):
    copies = federation.federate(clusters(spark, sf))
    return federation.dedup_replicas(copies.unionByName(copies)).select("event_id", "_msg", CLUSTER)


@register("A3_dedup_true_copies", """SELECT event_id, event_type, NULL AS trace FROM events UNION ALL SELECT event_id, event_type, NULL FROM events WHERE event_id % 5 = 0
 UNION ALL SELECT event_id, event_type, 'b' FROM events WHERE event_id % 7 = 0""")
def _true_copies(spark, sf):
    """A row that one replica holds twice stays twice, rows that differ in one field stay apart."""
    rows = logs(spark, sf).withColumn("trace", F.lit(None).cast("string"))
    often, other = rows.where("event_id % 5 = 0"), rows.where("event_id % 7 = 0").withColumn("trace", F.lit("b"))
    held = {"r0": [rows, often], "r1": [rows, other], "r2": [often, other, rows.where("event_id % 2 = 0")]}
    tagged = [df.withColumn("_replica", F.lit(name)) for name, dfs in held.items() for df in dfs]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df)
    return federation.dedup_replicas(whole, replica="_replica").select("event_id", "event_type", "trace")


@register("A4_read_ndjson", "SELECT event_id, event_type, CASE WHEN event_id % 4 <> 0 THEN value END AS value FROM events")
def _ndjson(spark, sf):
    """Log lines written as JSON, with broken lines among them, read back."""
    path = scratch(spark, "ndjson")
    rows = logs(spark, sf).select("event_id", "event_type", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    lines.unionByName(lines.where(F.length("value") % 5 == 0).select(F.concat(F.lit("{broken "), F.col("value")).alias("value"))).write.text(path)
    return readers.read_ndjson(spark, path, "event_id long, event_type string, value double").drop(readers.EXTRA)


@register("A5_write_ndjson", """SELECT CASE WHEN event_id % 2 = 0 THEN '{"event_id":' || event_id || ',"kind":"' || event_type || '"}' ELSE '{"event_id":' || event_id || '}' END AS value FROM events""")
def _write(spark, sf):
    path = scratch(spark, "out")
    rows = logs(spark, sf).select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("").alias("kind"))
    writers.write_ndjson(rows, path)
    return spark.read.text(path)


@register("A5_write_ndjson_times", r"""SELECT '{"event_id":' || event_id || ',"value":' || regexp_replace(value::VARCHAR, '\.0$', '') || ',"whole":' || (event_id % 9) || ',"_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value FROM events""")
def _write_times(spark, sf):
    path = scratch(spark, "out")
    rows = logs(spark, sf).select("event_id", "value", (F.col("event_id") % 9).cast("double").alias("whole"), "_time")
    writers.write_ndjson(rows, path)
    return spark.read.text(path)


def _written(spark, df, what):
    """One JSON answer per line in a fresh folder."""
    path = scratch(spark, what)
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    return path


@register("A6_read_vector", """SELECT event_type AS type, 'c' || (event_id % 3) AS cluster, 1704067200.5::DOUBLE AS ts, count(*)::VARCHAR AS value FROM events GROUP BY 1, 2""")
def _vector(spark, sf):
    counted = stats(federation.federate(clusters(spark, sf)), [CLUSTER, "event_type"], n=a.count())
    one = F.struct(
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("cluster"), F.col(CLUSTER)).alias("metric"),
        F.array(F.lit("1704067200.5"), F.col("n").cast("string")).alias("value"))
    answers = counted.select(F.lit("success").alias("status"), F.struct(F.lit("vector").alias("resultType"), F.array(one).alias("result")).alias("data"))
    done = readers.read_vector(spark, _written(spark, answers, "vector"))
    return done.select(F.col("metric.type").alias("type"), F.col("metric.cluster").alias("cluster"), "ts", "value")


@register("A7_read_matrix", """SELECT event_type AS type, 'c' || (event_id % 3) AS cluster, epoch(date_trunc('day', ts))::DOUBLE AS ts, count(*)::VARCHAR AS value FROM events GROUP BY event_type, event_id % 3, date_trunc('day', ts)""")
def _matrix(spark, sf):
    days = stats(federation.federate(clusters(spark, sf)), [CLUSTER, "event_type", Bucket("_time", "1d", name="at")], n=a.count())
    good = F.array(F.unix_seconds("at").cast("string"), F.col("n").cast("string"))
    one = F.struct(
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("cluster"), F.col(CLUSTER)).alias("metric"),
        F.array(good, F.array(F.lit("never"), F.lit("1"))).alias("values"))
    answers = days.select(F.lit("success").alias("status"), F.struct(F.lit("matrix").alias("resultType"), F.array(one).alias("result")).alias("data"))
    done = readers.read_matrix(spark, _written(spark, answers, "matrix"))
    return done.select(F.col("metric.type").alias("type"), F.col("metric.cluster").alias("cluster"), "ts", "value")


@register("A8_to_matrix", r"""WITH days AS (SELECT event_type, date_trunc('day', ts) AS d, count(*)::VARCHAR AS n, regexp_replace(max(value)::VARCHAR, '\.0$', '') AS hi FROM events GROUP BY 1, 2)
SELECT '{"type":"' || event_type || '"}' AS metric, 'n' AS name, string_agg(epoch(d)::BIGINT || '=' || n, ' ' ORDER BY d) AS series FROM days GROUP BY event_type
UNION ALL SELECT '{"type":"' || event_type || '"}', 'hi', string_agg(epoch(d)::BIGINT || '=' || hi, ' ' ORDER BY d) FROM days GROUP BY event_type""")
def _to_matrix(spark, sf):
    from skeinlog.operators import merge

    merged = merge.merge_stats_range(points(spark, sf), {"n": "count", "hi": "max"})
    nested = writers.to_matrix(merged)
    text = F.transform("values", lambda p: F.concat(float_text(p["ts"]), F.lit("="), p["value"]))
    return nested.select("metric", "name", F.array_join(text, " ").alias("series"))


@register("A8_to_vector", """SELECT '{"event_type":"' || event_type || '"}' AS metric, count(*)::VARCHAR AS value FROM events GROUP BY event_type""")
def _to_vector(spark, sf):
    nested = writers.to_vector(q.stats_query(logs(spark, sf), ["event_type"], {"n": a.count()}, datetime(2024, 1, 31)))
    return nested.select("metric", F.get("value", F.lit(1)).alias("value"))


@register("A9_read_hits", "SELECT event_type AS type, 'c' || (event_id % 3) AS cluster, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts, count(*) AS value FROM events GROUP BY event_type, event_id % 3, date_trunc('day', ts)")
def _read_hits(spark, sf):
    one = F.struct(F.map_concat("fields", F.create_map(F.lit("cluster"), F.col(CLUSTER))).alias("fields"), "timestamps", "values", "total")
    path = _written(spark, series(spark, sf).select(F.array(one).alias("hits")), "hits")
    done = readers.hit_points(readers.read_hits(spark, path))
    return done.select(F.col("fields.type").alias("type"), F.col("fields.cluster").alias("cluster"), "ts", "value")


@register("A9_read_values", "SELECT user_id::VARCHAR AS value, count(*) AS hits FROM events GROUP BY 1")
def _read_values(spark, sf):
    counted = order.field_values(logs(spark, sf), "user_id")
    return readers.read_values(spark, _written(spark, counted.select(F.array(F.struct("value", "hits")).alias("values")), "values"))


@register("A9_read_facets", "SELECT 'event_type' AS field_name, event_type AS field_value, count(*) AS hits FROM events GROUP BY event_type")
def _read_facets(spark, sf):
    top = order.facets(logs(spark, sf).select("event_type"))
    one = F.struct("field_name", F.array(F.struct("field_value", "hits")).alias("values"))
    return readers.read_facets(spark, _written(spark, top.select(F.array(one).alias("facets")), "facets"))


@register("A10_inline_rows", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'error') GROUP BY 1")
def _inline(spark, sf):
    rows = combine.inline_rows(spark, [{"event_type": "click"}, {"event_type": "error", "note": "x"}])
    return stats(combine.in_query(logs(spark, sf), "event_type", rows, "event_type"), ["event_type"], n=a.count())


@register("A11_generate_sequence", "SELECT i::VARCHAR AS _msg FROM range((SELECT count(*) FROM orders)) t(i)")
def _sequence(spark, sf):
    return combine.generate_sequence(spark, table(spark, sf, "orders").count())


@register("A12_cap", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def _cap(spark, sf):
    return federation.cap(logs(spark, sf), "many", tie=["event_id"]).select("event_id")


# ---- options ----------------------------------------------------------------


@register("M1_with_time_offset", "SELECT event_id, strftime(ts + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events WHERE ts >= TIMESTAMP '2024-01-04 12:00:00' AND ts < TIMESTAMP '2024-01-06 12:00:00'")
def _offset(spark, sf):
    done = federation.with_time_offset(logs(spark, sf), "12h", "2024-01-05", "2024-01-06")
    return done.select("event_id", F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))


@register("M2_with_global_filter", "SELECT event_id FROM events WHERE event_type <> 'view' AND user_id IN (SELECT user_id FROM events WHERE event_type <> 'view' AND value > 300)")
def _global(spark, sf):
    rows = logs(spark, sf)
    outer, sub = federation.with_global_filter(f.not_(f.exact("event_type", "view")), rows, rows)
    return combine.in_query(outer, "user_id", sub.where(f.gt("value", 300)), "user_id").select("event_id")


@register("M3_ignore_global_time_filter", """SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
 AND user_id IN (SELECT user_id FROM events WHERE value > 300)""")
def _ignore(spark, sf):
    session = federation.Session(time_lo="2024-01-10", time_hi="2024-01-10")
    sub = session.base(logs(spark, sf), ignore_global_time_filter=True).where(f.gt("value", 300))
    return combine.in_query(session.base(logs(spark, sf)), "user_id", sub, "user_id").select("event_id")
