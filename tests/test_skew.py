"""Sliced computation of groups that are too large for one task gives the same rows as plain windows."""

import pytest
from pyspark.sql import functions as F

from rows import rows_of
from skeinlog.functions import aggs as a
from skeinlog.functions import filters as f
from skeinlog.operators import combine, order, windows
from skeinlog.operators.stats import stats
from skeinlog.plans.tables import logs, table

w = windows
CASES = {
    "running": lambda rows: w.running_stats(rows, ["event_type"], tie=["event_id"], n=w.run_count(), lo=w.run_min("value"), hi=w.run_max("value"),
                                            third=w.run_first("event_id", 2), back=w.run_last("event_id", 3), here=w.run_last("event_id")),
    "running_global": lambda rows: w.running_stats(rows, [], tie=["event_id"], n=w.run_count("value"), hi=w.run_max("value"), back=w.run_last("event_id", 1)),
    "total": lambda rows: w.total_stats(rows, ["event_type"], tie=["event_id"], n=w.run_count(), f=w.run_first("event_id"), l=w.run_last("event_id", 2)),
    "context": lambda rows: w.stream_context(rows, f.gt("value", 200), 2, 1, "60h", stream=["event_type"], tie=["event_id"]),
    "sort": lambda rows: order.sort(rows, [("value", True)], offset=300, rank="r", tie=["event_id"]),
    "uniq": lambda rows: order.uniq(rows, ["user_id"], with_hits=True, limit=2000),
    "quantile": lambda rows: stats(rows, ["event_type"], q=a.quantile(0.9, "value"), m=a.median("value", "user_id")),
    "quantile_global": lambda rows: stats(rows, [], q=a.quantile(0.01, "value"), top=a.quantile(1, "value"), low=a.quantile(0, "value")),
    "value_rows": lambda rows: a.value_rows(rows, ["event_type"], "user_id"),
    "value_rows_global": lambda rows: a.value_rows(rows, [], "user_id", "event_id", distinct=True),
    "values": lambda rows: stats(rows, ["event_type"], v=a.values("user_id"), u=a.uniq_values("user_id"), j=a.json_values("event_id", sort=["value"])),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows(spark, sf, tiny_groups, name):
    rows = logs(spark, sf).drop("_stream")
    plain = rows_of(CASES[name](rows))
    tiny_groups(True)
    sliced = rows_of(CASES[name](rows))
    assert plain and sliced == plain


def test_copies_of_one_row_are_spread(spark, tiny_groups):
    rows = spark.range(500).select(F.lit("k").alias("k"), F.lit(1).alias("v"), F.lit("2024-01-01").cast("timestamp").alias("_time"))
    tiny_groups(True)
    done = w.running_stats(rows, ["k"], n=w.run_count(), s=w.run_sum("v"))
    assert rows_of(done.select("n", "s")) == sorted([(i, float(i)) for i in range(1, 501)], key=str)


@pytest.mark.parametrize("every", [False, True])
def test_phrases_by_join(spark, sf, every):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    phrases = ["the", "of the", "in", "er", "é", ".", "", "that the", "(the", "un la le"]
    fn = combine.contains_all_query if every else combine.contains_any_query
    for chosen in (phrases, phrases[:2], ["the", "in", "."], [""], ["zzz qqq"], ["."]):
        sub = spark.createDataFrame([(p,) for p in chosen], "p string")
        assert rows_of(fn(docs, "text", sub, inline_limit=0)) == rows_of(fn(docs, "text", sub))


def test_too_long_lists_fail_instead_of_being_cut(spark, monkeypatch):
    monkeypatch.setattr(a, "LIST_BOUND", 3)
    rows = spark.range(5).select(F.lit("g").alias("g"), F.col("id").alias("v"))
    with pytest.raises(Exception, match="set a limit"):
        stats(rows, ["g"], v=a.values("v")).collect()
    assert stats(rows, ["g"], v=a.values("v", limit=3)).first()["v"] == '["0","1","2"]'


def test_lists_as_rows_have_no_bound(spark, monkeypatch):
    monkeypatch.setattr(a, "LIST_BOUND", 3)
    rows = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "a"), ("g", None), ("g", ""), (None, "c"), ("h", None), ("g", "é")], "g string, v string")
    got = rows_of(a.value_rows(rows, ["g"], "v"))
    assert got == sorted([("g", 1, "a"), ("g", 2, "a"), ("g", 3, "b"), ("g", 4, "é"), (None, 1, "c")], key=str)
    assert rows_of(a.value_rows(rows, [], "v", distinct=True)) == sorted([(1, "a"), (2, "b"), (3, "c"), (4, "é")], key=str)
    assert a.value_rows(rows.limit(0), ["g"], "v").count() == 0
    with pytest.raises(ValueError, match="rename"):
        a.value_rows(rows.withColumnRenamed("g", "value"), ["value"], "v")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("desc", [False, True])
def test_sliced_rows_lie_in_order_without_another_sort(spark, tiny_groups, desc):
    rows = spark.range(1000).select("id", (F.col("id") * 7919 % 1000).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("k"))
    rows = rows.repartition(5)
    by = [("k", not desc), ("v", desc)]
    plain = order.sort(rows, by, offset=100, rank="r", tie=["id"]).collect()
    tiny_groups(True)
    done = order.sort(rows, by, offset=100, rank="r", tie=["id"])
    assert done.collect() == plain and [r["r"] for r in plain] == list(range(101, 1001))
    # one shuffle brings the wide rows to their slices; the carried table is narrow
    assert _plan(done).count("Exchange rangepartitioning") == 0


def test_slices_read_no_column_that_nobody_asks_for(spark, tiny_groups, tmp_path):
    spark.range(600).select("id", F.col("id").cast("string").alias("wide")).write.parquet(str(tmp_path / "t"))
    tiny_groups(True)
    done = order.sort(spark.read.parquet(str(tmp_path / "t")), ["id"], offset=10, rank="r").select("id", "r")
    assert "wide" not in _plan(done)
    assert sorted(r["r"] for r in done.collect()) == list(range(11, 601))


def test_equal_order_values_are_cut_by_content(spark, tiny_groups):
    rows = spark.range(600).select(F.lit(1).alias("v"), "id")
    tiny_groups(True)
    done = order.sort(rows, ["v"], offset=100, rank="r", tie=["v"]).collect()
    assert [r["r"] for r in done] == list(range(101, 601)) and len({r["id"] for r in done}) == 500
