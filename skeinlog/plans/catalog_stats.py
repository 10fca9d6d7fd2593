"""Checked queries: statistics and partial-result merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from skeinlog.functions import aggs as a
from skeinlog.functions import filters as f
from skeinlog.model import CLUSTER
from skeinlog.operators import merge
from skeinlog.operators.stats import Bucket, mergeable_merge, partial_state, partial_stats, stats
from skeinlog.plans.tables import CLUSTERS, LOGS, clusters, logs, register, rounded, table
from skeinlog.sources.federation import federate

BY = "FROM events GROUP BY event_type"


@register("flagship", "SELECT event_type, count(*) AS total, round(sum(value), 4) AS bytes, min(value) AS lowest, max(value) AS highest FROM events GROUP BY event_type")
def flagship(spark, sf):
    """Federate, partial statistics per cluster, merge."""
    funcs = {"total": a.count(), "bytes": a.sum_("value"), "lowest": a.min_("value"), "highest": a.max_("value")}
    merged = merge.merge_stats(partial_stats(federate(clusters(spark, sf)), ["event_type"], **funcs), ["event_type"], funcs)
    return rounded(merged, 4, "bytes").withColumn("total", F.col("total").cast("bigint"))


@register("F1_stats", """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS qty,
 round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, round(avg(l_discount), 8) AS disc FROM lineitem
 WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2""")
def _stats(spark, sf):
    rows = table(spark, sf, "lineitem").where(f.time_range(None, "2000-09-02T00:00:00.000000", at="l_shipdate"))
    rows = rows.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    done = stats(rows, ["l_returnflag", "l_linestatus"], n=a.count(), qty=a.sum_("l_quantity"), revenue=a.sum_("net"), disc=a.avg("l_discount"))
    return rounded(rounded(done, 4, "qty", "revenue"), 8, "disc")


@register("F1_stats_missing_group", "SELECT CASE WHEN event_id % 10 < 2 THEN NULL ELSE event_type END AS kind, count(*) AS n FROM events GROUP BY 1")
def _missing(spark, sf):
    kind = F.when(F.col("event_id") % 10 == 0, "").when(F.col("event_id") % 10 > 1, F.col("event_type"))
    return stats(logs(spark, sf).withColumn("kind", kind), ["kind"], n=a.count())


@register("F2_bucket_number", "SELECT floor((value - 5) / 50) * 50 + 5 AS value, count(*) AS n FROM events GROUP BY 1")
def _bucket(spark, sf):
    return stats(logs(spark, sf), [Bucket("value", 50, 5)], n=a.count())


@register("F2_bucket_time", """SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01 01:00:00'), '%Y-%m-%d %H:%M:%S') AS at, event_type, count(*) AS n
 FROM events GROUP BY 1, 2""")
def _bucket_time(spark, sf):
    done = stats(logs(spark, sf), [Bucket("_time", "6h", "1h"), "event_type"], n=a.count())
    return done.select(F.date_format("_time", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type", "n")


@register("F2_bucket_week", "SELECT strftime(time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS at, count(*) AS n FROM events GROUP BY 1")
def _bucket_week(spark, sf):
    done = stats(logs(spark, sf), [Bucket("_time", "week")], n=a.count())
    return done.select(F.date_format("_time", "yyyy-MM-dd").alias("at"), "n")


@register("F2_bucket_duration", "SELECT floor(user_id / 30)::DOUBLE * 30000000 AS took, count(*) AS n FROM events GROUP BY 1")
def _bucket_duration(spark, sf):
    rows = logs(spark, sf).withColumn("took", F.concat(F.col("user_id"), F.lit("ms")))
    return stats(rows, [Bucket("took", "30ms")], n=a.count())


@register("F2_bucket_ipv4", "SELECT 167772160 + user_id * 65536 AS ip, count(*) AS n FROM events GROUP BY 1")
def _bucket_ip(spark, sf):
    rows = logs(spark, sf).withColumn("ip", F.concat_ws(".", F.lit(10), F.col("user_id"), F.col("event_id") % 256, F.lit(1)))
    return stats(rows, [Bucket("ip", "/16")], n=a.count())


@register("F3_bucket_month", "SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS month, strftime(date_trunc('year', l_shipdate), '%Y') AS year, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _bucket_month(spark, sf):
    done = stats(table(spark, sf, "lineitem"), [Bucket("l_shipdate", "month", name="month"), Bucket("l_shipdate", "year", name="year")], n=a.count())
    return done.select(F.date_format("month", "yyyy-MM").alias("month"), F.date_format("year", "yyyy").alias("year"), "n")


@register("F4_if", f"SELECT event_type, count(*) FILTER (value > 100) AS big, round(sum(value) FILTER (user_id < 50), 4) AS low_users {BY}")
def _if(spark, sf):
    done = stats(logs(spark, sf), ["event_type"], big=a.count().if_(f.gt("value", 100)), low_users=a.sum_("value").if_(f.lt("user_id", 50)))
    return rounded(done, 4, "low_users")


@register("F5_switch", f"SELECT event_type, count(*) FILTER (value > 100) AS big, count(*) FILTER (value < 10) AS small, count(*) FILTER (value BETWEEN 10 AND 100) AS rest {BY}")
def _switch(spark, sf):
    cases = {"big": f.gt("value", 100), "small": f.lt("value", 10)}
    return stats(logs(spark, sf), ["event_type"], **a.switch(a.count(), cases, "rest"))


HOLES = {"x": "if(event_id % 3 = 0, null, value)", "y": "if(event_id % 5 = 0, '', cast(user_id as string))"}
HOLES_SQL = "(SELECT *, CASE WHEN event_id % 3 <> 0 THEN value END AS x, CASE WHEN event_id % 5 <> 0 THEN user_id END AS y FROM events)"


def holes(spark, sf):
    return logs(spark, sf).withColumns({n: F.expr(e) for n, e in HOLES.items()})


@register("F21_values_rows", f"""SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY y::VARCHAR) AS position,
 y::VARCHAR AS value FROM {HOLES_SQL} WHERE y IS NOT NULL""")
def _value_rows(spark, sf):
    return a.value_rows(holes(spark, sf), ["event_type"], "y")


@register("F22_uniq_values_rows", f"""SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY v) AS position, v AS value
 FROM (SELECT DISTINCT event_type, y::VARCHAR AS v FROM {HOLES_SQL} WHERE y IS NOT NULL)""")
def _uniq_value_rows(spark, sf):
    return a.value_rows(holes(spark, sf), ["event_type"], "y", distinct=True)


# Aggregates over fields with holes: function and SQL.
AGGS = {
    "F6_count": (lambda: a.count("x", "y"), "count(*) FILTER (x IS NOT NULL OR y IS NOT NULL)"),
    "F7_count_empty": (lambda: a.count_empty("x", "y"), "count(*) FILTER (x IS NULL AND y IS NULL)"),
    "F8_count_uniq": (lambda: a.count_uniq("x", "y"), "count(DISTINCT (x, y)) FILTER (x IS NOT NULL OR y IS NOT NULL)"),
    "F8_count_uniq_limit": (lambda: a.count_uniq("y", limit=100), "least(count(DISTINCT y), 100)"),
    "F9_count_uniq_hash": (lambda: a.count_uniq_hash("x"), "count(DISTINCT x)"),
    "F10_sum": (lambda: a.sum_("x", "y"), "round(sum(coalesce(x, 0) + coalesce(y, 0)) FILTER (x IS NOT NULL OR y IS NOT NULL), 4)"),
    "F11_sum_len": (lambda: a.sum_len("y", "props"), "CAST(sum(coalesce(strlen(y::VARCHAR), 0) + strlen(props)) AS BIGINT)"),
    "F12_avg": (lambda: a.avg("x", "y"), "round((sum(coalesce(x, 0)) + sum(coalesce(y, 0))) / (count(x) + count(y)), 6)"),
    "F13_min": (lambda: a.min_("x"), "min(x)"),
    "F13_min_text": (lambda: a.min_("y"), "min(y)::VARCHAR"),
    "F14_max": (lambda: a.max_("x"), "max(x)"),
    "F14_max_text": (lambda: a.max_("y", "event_type"), "max(event_type)"),
    "F15_median": (lambda: a.median("x"), "quantile_disc(x, 0.5)"),
    "F16_quantile": (lambda: a.quantile(0.9, "x"), "quantile_disc(x, 0.9)"),
    "F17_stddev": (lambda: a.stddev("x"), "round(stddev_pop(x), 6)"),
    "F18_rate": (lambda: a.rate(3600), "round(count(*) / 3600.0, 6)"),
    "F19_rate_sum": (lambda: a.rate_sum("y", step_seconds=60), "round(sum(y) / 60.0, 6)"),
    "F20_any": (lambda: a.any_("y"), "min(y::VARCHAR)"),
    "F21_values": (lambda: a.values("event_type", limit=3), """'["' || min(event_type) || '","' || min(event_type) || '","' || min(event_type) || '"]'"""),
    "F22_uniq_values": (lambda: a.uniq_values("y"), """'["' || string_agg(DISTINCT y::VARCHAR, '","' ORDER BY y::VARCHAR) || '"]'"""),
    "F25_row_min": (lambda: a.row_min("value", "event_id", "value"), """'{"event_id":"' || arg_min(event_id, (value, '{"event_id":"' || event_id)) || '","value":"' || min(value) || '"}'"""),
    "F26_row_max": (lambda: a.row_max("value", "event_id", "value"), """'{"event_id":"' || arg_max(event_id, (value, '{"event_id":"' || event_id)) || '","value":"' || max(value) || '"}'"""),
    "F27_field_min": (lambda: a.field_min("value", "event_id"), "arg_min(event_id, (value, event_id))"),
    "F28_field_max": (lambda: a.field_max("value", "event_id"), "arg_max(event_id, (value, event_id))"),
    "F24_row_any": (lambda: a.row_any("event_type"), """'{"event_type":"' || event_type || '"}'"""),
}
DIGITS = {"F10_sum": 4, "F12_avg": 6, "F17_stddev": 6, "F18_rate": 6, "F19_rate_sum": 6}

for _name, (_agg, _sql) in AGGS.items():

    def _run(spark, sf, name=_name, agg=_agg):
        done = stats(holes(spark, sf), ["event_type"], r=agg())
        return rounded(done, DIGITS[name], "r") if name in DIGITS else done

    register(_name, f"SELECT event_type, {_sql} AS r FROM {HOLES_SQL} GROUP BY event_type")(_run)


@register("F16_quantile_fields", "SELECT event_type, quantile_disc(v, 0.75) AS q FROM (SELECT event_type, value AS v FROM events UNION ALL SELECT event_type, user_id FROM events) GROUP BY 1")
def _quantile_fields(spark, sf):
    return stats(logs(spark, sf), ["event_type"], q=a.quantile(0.75, "value", "user_id"))


@register("F16_quantile_all", "SELECT quantile_disc(l_extendedprice, 0.99) AS p99, quantile_disc(l_extendedprice, 0.5) AS p50 FROM lineitem")
def _quantile_all(spark, sf):
    return stats(table(spark, sf, "lineitem"), [], p99=a.quantile(0.99, "l_extendedprice"), p50=a.median("l_extendedprice"))


@register("F17_stddev_fields", """SELECT event_type, round(stddev_pop(x), 4) AS r
 FROM (SELECT event_type, value AS x FROM events UNION ALL SELECT event_type, user_id + 1e6 FROM events) GROUP BY 1""")
def _stddev_fields(spark, sf):
    rows = logs(spark, sf).withColumn("far", F.col("user_id") + F.lit(1e6))
    return rounded(stats(rows, ["event_type"], r=a.stddev("value", "far")), 4, "r")


@register("F3_bucket_month_offset", """SELECT strftime(date_trunc('month', l_shipdate - INTERVAL '5 days') + INTERVAL '5 days', '%Y-%m-%d') AS month, count(*) AS n FROM lineitem GROUP BY 1""")
def _bucket_month_offset(spark, sf):
    done = stats(table(spark, sf, "lineitem"), [Bucket("l_shipdate", "month", "5d", "month")], n=a.count())
    return done.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "n")


@register("F16_quantile_approx", "SELECT event_type, true AS close FROM events GROUP BY 1")
def _quantile_approx(spark, sf):
    """Whether a share of the rows within 0.02 of the asked one is at most the answer."""
    rows = logs(spark, sf)
    found = stats(rows, ["event_type"], q=a.quantile_approx(0.9, "value"))
    share = F.avg((F.col("value") <= F.col("q")).cast("int"))
    return rows.join(found, "event_type").groupBy("event_type").agg(share.between(0.88, 0.92).alias("close"))


@register("F23_json_values", """SELECT event_type, '[' || string_agg('{"event_id":"' || event_id || '"}', ',' ORDER BY value DESC, '{"event_id":"' || event_id || '"}') || ']' AS r
 FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, '{"event_id":"' || event_id || '"}') AS rn FROM events) WHERE rn <= 5 GROUP BY 1""")
def _json_values(spark, sf):
    return stats(logs(spark, sf), ["event_type"], r=a.json_values("event_id", sort=[("value", True)], limit=5))


@register("F29_histogram", """SELECT event_type, b AS bucket, count(*) AS hits FROM (SELECT event_type, CAST(floor(log10(value) * 18) AS BIGINT) AS b FROM events WHERE value > 0) GROUP BY 1, 2""")
def _histogram(spark, sf):
    done = stats(logs(spark, sf), ["event_type"], h=a.histogram("value"))
    items = F.from_json("h", "array<struct<vmrange:string,hits:bigint>>")
    low = F.split("i.vmrange", r"\.\.\.")[0].cast("double")
    return done.select("event_type", F.explode(items).alias("i")).select(
        "event_type", F.round(F.log10(low) * 18).cast("bigint").alias("bucket"), F.col("i.hits").alias("hits"))


@register("F30_partial_stats", f"WITH {CLUSTERS} SELECT _cluster, event_type, count(*) AS n, round(sum(value), 4) AS s FROM cl GROUP BY 1, 2")
def _partial(spark, sf):
    return rounded(partial_stats(federate(clusters(spark, sf)), ["event_type"], n=a.count(), s=a.sum_("value")), 4, "s")


@register("F31_mergeable_merge", "SELECT event_type, count(*) AS count, true AS close FROM events GROUP BY 1")
def _mergeable(spark, sf):
    """Whether quantile and distinct count of the merged sketches are within their errors."""
    rows = logs(spark, sf)
    found = mergeable_merge(partial_state(federate(clusters(spark, sf)), ["event_type"], "value"), ["event_type"], 0.9)
    share, exact = F.avg((F.col("value") <= F.col("quantile")).cast("int")), F.count_distinct("value")
    near = share.between(0.87, 0.93) & (F.abs(F.first("distinct") - exact) <= 0.1 * exact)
    return rows.join(found, "event_type").groupBy("event_type", "count").agg(near.alias("close"))


@register("F31_mergeable_mean", "SELECT event_type, count(*) AS count, round(avg(value), 6) AS avg FROM events GROUP BY 1")
def _mergeable_mean(spark, sf):
    merged = mergeable_merge(partial_state(federate(clusters(spark, sf)), ["event_type"], "value"), ["event_type"])
    return rounded(merged.select("event_type", "count", "avg"), 6, "avg")


# ---- merges of partial results ---------------------------------------------

PARTS = f"WITH {CLUSTERS}, parts AS (SELECT _cluster, event_type, count(*) AS n, count(DISTINCT user_id) AS u, sum(value) AS s, min(value) AS lo, max(value) AS hi, avg(value) AS av FROM cl GROUP BY 1, 2)"


def parts(spark, sf):
    return partial_stats(federate(clusters(spark, sf)), ["event_type"], n=a.count(), u=a.count_uniq("user_id"), s=a.sum_("value"),
                         lo=a.min_("value"), hi=a.max_("value"), av=a.avg("value"))


# Result column, function name, SQL over the partial table.
MERGES = {
    "B2_sum": ("u", "count_uniq", "sum(u)::DOUBLE"),
    "B3_min": ("lo", "min", "min(lo)"),
    "B3_first": ("lo", "first", "min(lo)"),
    "B4_max": ("hi", "max", "max(hi)"),
    "B4_last": ("hi", "last", "max(hi)"),
    "B5_avg": ("av", "median", "round(avg(av), 6)"),
    "B6_any": ("n", "stddev", "min_by(n, _cluster)"),
}
for _name, (_col, _func, _sql) in MERGES.items():
    register(_name, f"{PARTS} SELECT event_type, {_sql} AS {_col} FROM parts GROUP BY 1")(
        lambda spark, sf, name=_name, c=_col, fn=_func: rounded(merge.merge_stats(parts(spark, sf), ["event_type"], {c: fn}), 6, c)
    )


@register("B1_merge_stats", f"""{PARTS} SELECT CASE WHEN event_type <> 'view' THEN event_type END AS event_type, sum(n)::DOUBLE AS n, round(sum(s), 4) AS s,
 min(lo) AS lo, max(hi) AS hi, round(avg(av), 6) AS av FROM parts GROUP BY 1""")
def _merge_stats(spark, sf):
    p = parts(spark, sf)
    text = [c for c in p.columns if c not in (CLUSTER, "event_type")]
    p = p.withColumns({c: F.col(c).cast("string") for c in text})
    p = p.withColumn("event_type", F.when(F.col("event_type") == "view", F.when(F.col(CLUSTER) == "c0", "")).otherwise(F.col("event_type")))
    done = merge.merge_stats(p, ["event_type"], {"n": "count", "s": "sum", "lo": "min", "hi": "max", "av": "avg"})
    return rounded(rounded(done, 4, "s"), 6, "av")


@register("B1_merge_stats_global", "SELECT count(*)::DOUBLE AS n FROM events")
def _merge_global(spark, sf):
    return merge.merge_stats(partial_stats(federate(clusters(spark, sf)), [], n=a.count()), [], {"n": a.count()})


def points(spark, sf, step="1d"):
    """Series points per cluster: count and largest value per type and step."""
    grouped = partial_stats(federate(clusters(spark, sf)), ["event_type", Bucket("_time", step, name="at")], n=a.count(), hi=a.max_("value"))
    pair = F.array(F.struct(F.lit("n").alias("k"), F.col("n").cast("string").alias("v")), F.struct(F.lit("hi").alias("k"), F.col("hi").cast("string").alias("v")))
    return grouped.select(CLUSTER, "event_type", "at", F.explode(pair).alias("p")).select(
        CLUSTER,
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("__name__"), F.col("p.k")).alias("metric"),
        (F.unix_micros("at") / F.lit(1e6)).alias("ts"),
        F.col("p.v").alias("value"),
    )


POINTS = """SELECT '{"type":"' || event_type || '"}' AS metric, 'n' AS name, epoch(date_trunc('day', ts)) AS ts, count(*)::DOUBLE AS value FROM events GROUP BY event_type, date_trunc('day', ts)
 UNION ALL SELECT '{"type":"' || event_type || '"}', 'hi', epoch(date_trunc('day', ts)), max(value) FROM events GROUP BY event_type, date_trunc('day', ts)"""


@register("B8_merge_stats_range", POINTS)
def _range(spark, sf):
    return merge.merge_stats_range(points(spark, sf), {"n": "count", "hi": "max"})


@register("B8_merge_any_text", """SELECT '{"type":"' || event_type || '"}' AS metric, 'n' AS name, epoch(date_trunc('day', ts)) AS ts, count(*)::VARCHAR AS value FROM events GROUP BY event_type, date_trunc('day', ts)
 UNION ALL SELECT '{"type":"' || event_type || '"}', 'tag', epoch(date_trunc('day', ts)), min('x' || event_id % 3) FROM events GROUP BY event_type, date_trunc('day', ts)""")
def _any_text(spark, sf):
    """The text result of the first cluster stays text; sums beside it are text in log form."""
    counts = points(spark, sf).where(F.element_at("metric", "__name__") == "n")
    tagged = counts.withColumns({
        "metric": F.create_map(F.lit("type"), F.element_at("metric", "type"), F.lit("__name__"), F.lit("tag")),
        "value": F.concat(F.lit("x"), F.substring(CLUSTER, 2, 9)),
    })
    return merge.merge_stats_range(counts.unionByName(tagged), {"n": "count", "tag": "row_any"})


@register("B7_merge_stats_instant", """SELECT '{"type":"' || event_type || '"}' AS metric, 'n' AS name, 1704067200.0::DOUBLE AS ts, count(*)::DOUBLE AS value FROM events GROUP BY event_type
 UNION ALL SELECT '{"type":"' || event_type || '"}', 'hi', 1704067200.0, max(value) FROM events GROUP BY event_type""")
def _instant(spark, sf):
    grouped = points(spark, sf, "36500d").withColumn("ts", F.when(F.col(CLUSTER) == "c0", 1704067200.0).otherwise(1704067260.0))
    return merge.merge_stats_instant(grouped, {"n": "count", "hi": "max"})


@register("B9_result_name", """SELECT '{"type":"' || event_type || '"}' AS metric, 'total' AS name, epoch(d) AS ts, round(sum(v), 4) AS value
 FROM (SELECT event_type, date_trunc('day', ts) AS d, (count(*) + max(value))::DOUBLE AS v FROM events GROUP BY event_id % 3, 1, 2) GROUP BY event_type, d""")
def _result_name(spark, sf):
    return rounded(merge.merge_stats_range(points(spark, sf), {"total": "sum"}), 4, "value")


def series(spark, sf):
    """Hits series per cluster and type; a series has one point per day."""
    days = partial_stats(federate(clusters(spark, sf)), ["event_type", Bucket("_time", "1d", name="at")], n=a.count())
    points = F.array_sort(F.collect_list(F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), F.col("n").alias("v"))))
    grouped = days.groupBy(CLUSTER, "event_type").agg(points.alias("p"), F.sum("n").alias("total"))
    return grouped.select(
        CLUSTER, F.create_map(F.lit("type"), F.col("event_type")).alias("fields"),
        F.transform("p", lambda x: x["t"]).alias("timestamps"), F.transform("p", lambda x: x["v"]).alias("values"), "total")


@register("B10_merge_hits", """SELECT '{"type":"' || event_type || '"}' AS fields, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS ts, count(*) AS value,
 CAST(sum(count(*)) OVER (PARTITION BY event_type) AS BIGINT) AS total FROM events GROUP BY event_type, date_trunc('day', ts)""")
def _merge_hits(spark, sf):
    return merge.merge_hits(series(spark, sf))


@register("B10_merge_hits_no_points", """SELECT '{"type":"' || event_type || '"}' AS fields, NULL::VARCHAR AS ts, NULL::BIGINT AS value, count(*) AS total FROM events GROUP BY event_type""")
def _merge_hits_no_points(spark, sf):
    bare = series(spark, sf).withColumns({c: F.slice(c, 1, 0) for c in ("timestamps", "values")})
    return merge.merge_hits(bare)


@register("B11_merge_value_hits", "SELECT user_id::VARCHAR AS value, count(*) AS hits FROM events GROUP BY 1")
def _value_hits(spark, sf):
    from skeinlog.operators.order import field_values

    return merge.merge_value_hits(federate({n: field_values(c, "user_id") for n, c in clusters(spark, sf).items()}))


@register("B12_merge_facets", """SELECT 'event_type' AS field_name, event_type AS field_value, count(*) AS hits FROM events GROUP BY event_type
 UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY props""")
def _merge_facets(spark, sf):
    from skeinlog.operators.order import facets

    each = {n: facets(c.select("event_type", "props"), limit=1000) for n, c in clusters(spark, sf).items()}
    noise = federate(each).withColumn("hits", F.col("hits").cast("string"))
    return merge.merge_facets(noise.unionByName(noise.withColumn("hits", F.lit("n/a"))))


@register("B13_merge_sort", f"""{PARTS} SELECT _cluster, event_type, n, row_number() OVER (ORDER BY n DESC, event_type DESC, _cluster) AS pos FROM parts
 ORDER BY n DESC, event_type DESC, _cluster LIMIT 7""")
def _merge_sort(spark, sf):
    from pyspark.sql import Window

    p = parts(spark, sf).select(CLUSTER, "event_type", "n")
    best = merge.merge_sort(p, [("n", True), "event_type"], desc=True, limit=7)
    w = Window.orderBy(F.desc("n"), F.desc("event_type"), CLUSTER)
    return best.withColumn("pos", F.row_number().over(w).cast("bigint"))


@register("B15_merge_partials", f"{PARTS} SELECT event_type, sum(n)::DOUBLE AS n FROM parts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def _merge_partials(spark, sf):
    spec = merge.MergeSpec(stats_by=["event_type"], stats={"n": "count"}, sort=True, sort_by=[("n", True)], limit=3)
    return merge.merge_partials(parts(spark, sf), spec)


@register("B15_merge_partials_facets", "SELECT 'event_type' AS field_name, event_type AS field_value, count(*) AS hits FROM events GROUP BY event_type ORDER BY 3 DESC, 2 LIMIT 2")
def _merge_partials_facets(spark, sf):
    from skeinlog.operators.order import facets

    each = federate({n: facets(c.select("event_type")) for n, c in clusters(spark, sf).items()})
    spec = merge.MergeSpec(stats_by=["field_name"], stats={"hits": "count"}, facets=True, sort=True, sort_by=[("hits", True), "field_value"], limit=2)
    return merge.merge_partials(each, spec)


@register("B16_merge_log_streams", f"WITH {LOGS} SELECT event_id, _msg, 'c' || (event_id % 3) AS _cluster FROM logs ORDER BY _time DESC, event_id DESC LIMIT 50")
def _log_streams(spark, sf):
    return merge.merge_log_streams(clusters(spark, sf), 50, tie=["event_id"]).select("event_id", "_msg", CLUSTER)
