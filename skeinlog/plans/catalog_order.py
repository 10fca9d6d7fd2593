"""Checked queries: windows, ordering, joins, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from skeinlog.functions import filters as f
from skeinlog.operators import combine, order, windows
from skeinlog.plans.tables import LOGS, clusters, logs, register, rounded, table
from skeinlog.sources.federation import federate

OVER = "OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("G1_running_stats", f"""SELECT event_id, event_type, count(*) {OVER} AS n, round(sum(value) {OVER}, 4) AS s, min(value) {OVER} AS lo, max(value) {OVER} AS hi FROM events""")
def _running(spark, sf):
    done = windows.running_stats(logs(spark, sf), ["event_type"], tie=["event_id"], n=windows.run_count(), s=windows.run_sum("value"),
                                 lo=windows.run_min("value"), hi=windows.run_max("value"))
    return rounded(done.select("event_id", "event_type", "n", "s", "lo", "hi"), 4, "s")


@register("G1_running_stats_global", "SELECT event_id, count(*) OVER w AS n, max(value) OVER w AS hi FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def _running_global(spark, sf):
    done = windows.running_stats(logs(spark, sf), [], tie=["event_id"], n=windows.run_count(), hi=windows.run_max("value"))
    return done.select("event_id", "n", "hi")


@register("G2_running_first", f"SELECT event_id, nth_value(event_id, 3) {OVER} AS third FROM events")
def _first(spark, sf):
    return windows.running_stats(logs(spark, sf), ["event_type"], tie=["event_id"], third=windows.run_first("event_id", 2)).select("event_id", "third")


@register("G3_running_last", "SELECT event_id, lag(event_id, 2) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS back, event_id AS here FROM events")
def _last(spark, sf):
    done = windows.running_stats(logs(spark, sf), ["event_type"], tie=["event_id"], back=windows.run_last("event_id", 2), here=windows.run_last("event_id"))
    return done.select("event_id", "back", "here")


@register("G3_running_conversation", "SELECT conv_id, turn, count(*) OVER w AS n, CAST(sum(strlen(text)) OVER w AS BIGINT) AS size FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def _conversation(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("bytes", F.octet_length("text"))
    done = windows.running_stats(rows, ["conv_id"], order=["turn"], n=windows.run_count(), size=windows.run_sum("bytes"))
    return done.select("conv_id", "turn", "n", F.col("size").cast("bigint").alias("size"))


@register("G4_total_stats", """SELECT event_id, count(*) OVER p AS n, round(sum(value) OVER p, 4) AS s, min(value) OVER p AS lo, max(value) OVER p AS hi,
 first_value(event_id) OVER a AS f, last_value(event_id) OVER a AS l, nth_value(event_id, 3) OVER a AS third FROM events
 WINDOW p AS (PARTITION BY event_type), a AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _total(spark, sf):
    w = windows
    done = w.total_stats(logs(spark, sf), ["event_type"], tie=["event_id"], n=w.run_count(), s=w.run_sum("value"), lo=w.run_min("value"),
                         hi=w.run_max("value"), f=w.run_first("event_id"), l=w.run_last("event_id"), third=w.run_first("event_id", 2))
    return rounded(done.select("event_id", "n", "s", "lo", "hi", "f", "l", "third"), 4, "s")


@register("G5_sort_partition", "SELECT event_id, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts DESC, event_id DESC) <= 3")
def _partition(spark, sf):
    done = order.sort(logs(spark, sf), [("value", False), ("_time", False), "event_id"], desc=True, limit=3, partition_by=["user_id"])
    return done.select("event_id", "user_id", "value")


@register("G6_rank", "SELECT event_id, rank FROM (SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank BETWEEN 4 AND 23")
def _rank(spark, sf):
    done = order.sort(logs(spark, sf), [("value", True), ("event_id", False)], offset=3, limit=20, rank="rank")
    return done.select("event_id", F.col("rank").cast("bigint").alias("rank"))


@register("G6_rank_partition", "SELECT event_id, rank FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rank FROM events) WHERE rank <= 4")
def _rank_partition(spark, sf):
    done = order.sort(logs(spark, sf), ["value", "event_id"], limit=4, rank="rank", partition_by=["event_type"])
    return done.select("event_id", F.col("rank").cast("bigint").alias("rank"))


@register("G7_stream_context", """WITH p AS (SELECT event_id, user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)
 SELECT DISTINCT x.event_id, x.user_id FROM p x JOIN p m ON x.user_id = m.user_id AND m.value > 250
 WHERE x.event_id = m.event_id OR (x.pos - m.pos BETWEEN 1 AND 2 AND x.ts - m.ts <= INTERVAL 12 HOUR) OR (m.pos - x.pos BETWEEN 1 AND 3 AND m.ts - x.ts <= INTERVAL 12 HOUR)""")
def _context(spark, sf):
    rows = logs(spark, sf)
    done = windows.stream_context(rows, f.gt("value", 250), before=3, after=2, time_window="12h", stream=["user_id"], tie=["event_id"])
    return done.select("event_id", "user_id")


@register("H1_sort", "SELECT event_id, value FROM events ORDER BY event_type DESC, value, event_id LIMIT 100 OFFSET 50")
def _sort(spark, sf):
    return order.sort(logs(spark, sf), [("event_type", True), "value", "event_id"], offset=50, limit=100).select("event_id", "value")


@register("H1_sort_deep", "SELECT l_orderkey, l_linenumber, l_partkey, pos FROM (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem) WHERE pos > 5000")
def _sort_deep(spark, sf):
    by = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return order.sort(table(spark, sf, "lineitem"), by, offset=5000, rank="pos").select("l_orderkey", "l_linenumber", "l_partkey", "pos")


@register("H2_first", "SELECT event_id FROM events ORDER BY value, event_id LIMIT 5")
def _h_first(spark, sf):
    return order.first(logs(spark, sf), 5, ["value", "event_id"]).select("event_id")


@register("H3_last", "SELECT event_id FROM events ORDER BY value DESC, event_id DESC LIMIT 5")
def _h_last(spark, sf):
    return order.last(logs(spark, sf), 5, ["value", "event_id"]).select("event_id")


@register("H4_limit", "SELECT 25::BIGINT AS n, 25::BIGINT AS different, 25::BIGINT AS known")
def _limit(spark, sf):
    """So many rows, all different, all from the table."""
    rows, all_ = order.limit(logs(spark, sf).select("event_id"), 25), logs(spark, sf).select("event_id", F.lit(1).alias("known"))
    return rows.join(all_, "event_id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("different"), F.count("known").alias("known")
    )


@register("H5_offset", "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events) WHERE pos > 9000")
def _offset(spark, sf):
    return order.offset(logs(spark, sf), 9000, ["_time"], tie=["event_id"]).select("event_id")


@register("H6_top", "SELECT user_id, event_type, count(*) AS hits, row_number() OVER (ORDER BY count(*) DESC, user_id, event_type) AS rank FROM events GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 12")
def _top(spark, sf):
    done = order.top(logs(spark, sf), ["user_id", "event_type"], 12, rank="rank")
    return done.withColumn("rank", F.col("rank").cast("bigint"))


@register("H6_top_customers", """SELECT c_name, count(*) AS hits FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _top_customers(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    rows = rows.join(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey")
    return order.top(rows.join(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey"), ["c_name"])


@register("H7_uniq", "SELECT user_id, event_type, count(*) AS hits FROM events GROUP BY 1, 2")
def _uniq(spark, sf):
    return order.uniq(logs(spark, sf), ["user_id", "event_type"], with_hits=True)


@register("H7_uniq_limit", "SELECT user_id, CASE WHEN (SELECT count(DISTINCT user_id) FROM events) > 20 THEN 0 ELSE count(*) END AS hits FROM events GROUP BY 1 ORDER BY 1 LIMIT 20")
def _uniq_limit(spark, sf):
    return order.uniq(logs(spark, sf), ["user_id"], with_hits=True, limit=20)


@register("H7_uniq_filter", "SELECT event_type, count(*) AS hits FROM events WHERE contains(event_type, 'r') GROUP BY 1")
def _uniq_filter(spark, sf):
    return order.uniq(logs(spark, sf), ["event_type"], filter="r", with_hits=True, limit=20)


@register("H8_field_values", "SELECT source AS value, count(*) AS hits FROM documents WHERE contains(source, '1') GROUP BY 1")
def _field_values(spark, sf):
    return order.field_values(table(spark, sf, "documents"), "source", filter="1")


@register("H8_field_names", "SELECT 'l_' || n AS name, (SELECT count(*) FROM lineitem) AS hits FROM (VALUES ('linenumber'), ('linestatus')) t(n)")
def _field_names(spark, sf):
    return order.field_names(table(spark, sf, "lineitem"), filter="_line")


@register("H9_facets", """WITH p AS (SELECT 'event_type' AS field_name, event_type AS field_value FROM events UNION ALL SELECT 'user_id', user_id::VARCHAR FROM events
  UNION ALL SELECT 'props', props FROM events UNION ALL SELECT 'event_id', event_id::VARCHAR FROM events UNION ALL SELECT 'fixed', 'same' FROM events),
 c AS (SELECT field_name, field_value, count(*) AS hits FROM p GROUP BY 1, 2),
 n AS (SELECT *, count(*) OVER (PARTITION BY field_name) AS n, row_number() OVER (PARTITION BY field_name ORDER BY hits DESC, field_value) AS rn FROM c)
 SELECT field_name, field_value, hits FROM n WHERE n BETWEEN 2 AND 1000 AND rn <= 10""")
def _facets(spark, sf):
    rows = logs(spark, sf).select("event_type", "user_id", "props", "event_id", F.lit("same").alias("fixed"))
    return order.facets(rows)


@register("H10_sample", "SELECT count(*) AS of, true AS fair, true AS different FROM events")
def _sample(spark, sf):
    """About one row in ten, none twice."""
    rows = logs(spark, sf).select("event_id")
    drawn = order.sample(rows, 10, seed=7).withColumn("drawn", F.lit(1))
    return rows.join(drawn, "event_id", "left").agg(
        F.count_distinct("event_id").alias("of"), F.avg(F.coalesce("drawn", F.lit(0))).between(0.05, 0.15).alias("fair"),
        (F.count(F.lit(1)) == F.count_distinct("event_id")).alias("different"),
    )


@register("H10_sample_by_key", "SELECT count(DISTINCT user_id) AS of, true AS fair, true AS whole FROM events")
def _sample_key(spark, sf):
    """Some of the keys, each with all its rows or none."""
    rows = logs(spark, sf).select("event_id", "user_id")
    drawn = order.sample_by_key(rows, 10, ["user_id"]).select("event_id", F.lit(1).alias("drawn"))
    share = rows.join(drawn, "event_id", "left").groupBy("user_id").agg(F.avg(F.coalesce("drawn", F.lit(0))).alias("share"))
    return share.agg(
        F.count(F.lit(1)).alias("of"), F.avg("share").between(0.01, 0.3).alias("fair"), F.bool_and(F.col("share").isin(0.0, 1.0)).alias("whole"),
    )


@register("H11_unique_name", "SELECT event_type AS hits, count(*) AS hitss FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def _unique(spark, sf):
    return order.top(logs(spark, sf).select(F.col("event_type").alias("hits")), ["hits"], 3)


JOINED = "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def _customers(spark, sf):
    return table(spark, sf, "customer").withColumn("n_nationkey", F.col("c_nationkey"))


@register("I1_join_left", "SELECT o_orderkey, n.n_name FROM orders LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1) n ON o_custkey = c_custkey")
def _join_left(spark, sf):
    asia = combine.join(_customers(spark, sf), ["n_nationkey"], table(spark, sf, "nation").where(f.exact("n_regionkey", "1")), inner=True)
    right = asia.select(F.col("c_custkey").alias("o_custkey"), "n_name")
    return combine.join(table(spark, sf, "orders"), ["o_custkey"], right).select("o_orderkey", "n_name")


@register("I1_join_text_to_double", "SELECT l_orderkey, l_linenumber, n_name FROM lineitem LEFT JOIN nation ON l_quantity = n_nationkey")
def _join_text_to_double(spark, sf):
    left = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("k"))
    right = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("k"), "n_name")
    return combine.join(left, ["k"], right).drop("k")


@register("I2_join_inner", "SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate::DATE::VARCHAR AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def _join_inner(spark, sf):
    right = table(spark, sf, "orders").where(f.exact("o_orderstatus", "F")).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    done = combine.join(table(spark, sf, "lineitem"), ["l_orderkey"], right, inner=True)
    return done.select("l_orderkey", "l_linenumber", "l_partkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@register("I3_join_prefix", "SELECT c_custkey, c_name AS name, n_name AS right_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _join_prefix(spark, sf):
    left = _customers(spark, sf).select("c_custkey", "n_nationkey", F.col("c_name").alias("name"))
    right = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    return combine.join(left, ["n_nationkey"], right, prefix="right_").select("c_custkey", "name", "right_name")


@register("I3_join_clash", "SELECT c_custkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE c_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _join_clash(spark, sf):
    left = _customers(spark, sf).select("c_custkey", "n_nationkey", F.col("c_name").alias("name"))
    right = table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("").alias("name"))
    return combine.join(left, ["n_nationkey"], right).select("c_custkey", "name")


@register("I4_join_rows", "SELECT event_id, CASE event_type WHEN 'error' THEN '3' WHEN 'view' THEN '6' END AS level FROM events")
def _join_rows(spark, sf):
    rows = [{"event_type": "error", "level": "3"}, {"event_type": "view", "level": "6"}]
    return combine.join(logs(spark, sf), ["event_type"], rows=rows).select("event_id", "level")


@register("I5_semi_anti", "SELECT p_partkey, 'sold' AS how FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) UNION ALL SELECT p_partkey, 'not' FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def _semi(spark, sf):
    part, sub = table(spark, sf, "part"), table(spark, sf, "lineitem").where(f.gt("l_quantity", 49))
    yes = combine.in_query(part, "p_partkey", sub, "l_partkey").select("p_partkey", F.lit("sold").alias("how"))
    no = combine.in_query(part, "p_partkey", sub, "l_partkey", negate=True).select("p_partkey", F.lit("not").alias("how"))
    return combine.union(yes, no)


@register("I6_union", "SELECT c_name AS name, c_acctbal AS bal, NULL::VARCHAR AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier")
def _union(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    right = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"), F.lit("supplier").alias("segment"))
    return combine.union(left, right)


@register("I7_union_rows", "SELECT r_name FROM region UNION ALL SELECT 'NOWHERE' UNION ALL SELECT 'ELSEWHERE'")
def _union_rows(spark, sf):
    return combine.union(table(spark, sf, "region").select("r_name"), rows=[{"r_name": "NOWHERE"}, {"r_name": "ELSEWHERE"}])


@register("A1_federate", "SELECT 'c' || (event_id % 3) AS _cluster, count(*) AS n, round(sum(value), 4) AS s FROM events GROUP BY 1")
def _federate(spark, sf):
    from skeinlog.functions import aggs as a
    from skeinlog.operators.stats import stats

    return rounded(stats(federate(clusters(spark, sf)), ["_cluster"], n=a.count(), s=a.sum_("value")), 4, "s")


@register("A1_federate_uneven", f"WITH {LOGS} SELECT event_id, CASE WHEN event_id % 3 <> 1 THEN props END AS props FROM logs")
def _uneven(spark, sf):
    named = clusters(spark, sf)
    named["c1"] = named["c1"].drop("props")
    return federate(named).select("event_id", "props")
