"""Typed values in their log text, and replicas that are folded without losing rows."""

import math

import pytest
from pyspark.sql import functions as F

from rows import rows_of
from skeinlog.functions import filters as f
from skeinlog.functions.coerce import float_text, logged_number, text_of
from skeinlog.sources.federation import dedup_replicas
from skeinlog.streaming import live

NUMBERS = [5.0, -5.0, 0.0, -0.0, 0.1, 1.5, 100.0, 9999999.0, 1e7, 12345678.5, 1e20, 1e21, 1.25e22, 1e-3, 0.00123, 1e-4, 9.9e-5, -3.2e-7, 5e-324,
           1.7976931348623157e308, math.pi, math.inf, -math.inf, math.nan, 2.0**53 + 2]


def test_every_double_is_found_by_its_log_text(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(NUMBERS)], "i int, v double")
    texts = {r["i"]: r["t"] for r in df.select("i", float_text(F.col("v")).alias("t")).collect()}
    for i, text in texts.items():
        want = {j for j, t in texts.items() if t == text}
        assert {r["i"] for r in df.where(f.exact("v", text)).collect()} == want, text
        assert {r["i"] for r in df.where(f.in_("v", text, "nowhere")).collect()} == want
    assert df.where(f.in_("v", "5.0", "1e3", "05", "+5", "five", "1E21", "-0", "")).count() == 0
    assert logged_number("5") == 5 and logged_number("1e+21") == 1e21 and logged_number("1e21") is None


def test_text_columns_and_missing_values_are_as_before(spark):
    df = spark.createDataFrame([("5", None), ("5.0", 5.0), (None, 0.5)], "s string, v double")
    assert [r["s"] for r in df.where(f.exact("s", "5")).collect()] == ["5"]
    assert [r["s"] for r in df.where(f.in_("s", "5", "5.0")).collect()] == ["5", "5.0"]
    assert df.where(f.exact("v", "")).count() == df.where(f.in_("v", "", "7")).count() == df.where(f.exact("s", "")).count() == 1
    assert df.where(f.not_(f.exact("v", "5"))).count() == 2
    got = df.withColumn("at", F.lit("2024-01-02 03:04:05.6").cast("timestamp")).select(*[text_of(df.withColumn("at", F.current_timestamp()), c) for c in ("s", "v", "at")])
    assert rows_of(got)[0] == ("", "0.5", "2024-01-02T03:04:05.600000Z")


def test_replicas(spark):
    rows = [("a", 1, "r1"), ("a", 1, "r1"), ("a", 1, "r2"), ("a", 2, "r2"), (None, 1, "r1"), (None, 1, "r2"), ("b", None, "r3")]
    df = spark.createDataFrame(rows, "x string, y int, rep string").withColumn("m", F.create_map(F.lit("k"), F.col("x")))
    got = dedup_replicas(df, replica="rep").select("x", "y", F.col("m")["k"])
    assert rows_of(got) == sorted([("a", 1, "a"), ("a", 1, "a"), ("a", 2, "a"), (None, 1, None), ("b", None, "b")], key=str)
    assert dedup_replicas(df).count() == 6 and dedup_replicas(df.drop("rep")).count() == 4
    assert dedup_replicas(df, ["x"]).count() == 3 and dedup_replicas(df.where("false"), replica="rep").count() == 0


@pytest.mark.parametrize("replica, want", [("rep", {1: 2, 2: 1, 3: 1}), (None, {1: 2, 2: 1, 3: 1})])
def test_replicas_on_a_stream(spark, tmp_path, replica, want):
    """With a replica column copies of one replica stay; without it rows that differ in it are other rows."""
    kind = "id int, _time timestamp, note map<string,string>, rep string"
    rows = [(1, "r1"), (1, "r1"), (1, "r2"), (2, "r1"), (2, "r1") if not replica else (2, "r2"), (3, "r2")]
    for k, part in enumerate((rows[:3], rows[3:], [(9, "r1")])):
        at = "2024-01-01 00:00:00" if k < 2 else "2030-01-01 00:00:00"
        spark.createDataFrame([(i, r) for i, r in part], "id int, rep string").select(
            "id", F.lit(at).cast("timestamp").alias("_time"), F.create_map(F.lit("k"), F.lit("v")).alias("note"), "rep"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sdf = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    done = live.stream_dedup_replicas(sdf, late="1h", replica=replica)
    live.append(done, str(tmp_path / "out"), str(tmp_path / "checkpoint"), {"availableNow": True}).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where("id < 9").groupBy("id").count().collect()
    assert dict(map(tuple, got)) == want
