"""Quantiles by selection, and ordered work on slices that nothing wide is stored for."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import rows_of
from skeinlog.functions import aggs as a
from skeinlog.functions import filters as f
from skeinlog.functions import selection
from skeinlog.operators import order, slices, windows
from skeinlog.operators.stats import stats
from skeinlog.plans.tables import logs

DRAW = np.random.default_rng(17)
VALUES = {
    "even": DRAW.integers(0, 10_000, 3000).astype(float).tolist(),
    "copies": [7.0] * 2500 + [1.0, 9.0] * 20,
    "wide": (10.0 ** DRAW.uniform(-300, 300, 3000) * DRAW.choice([-1, 1], 3000)).tolist(),
    "ends": [-math.inf] * 5 + [math.inf] * 5 + [-1.7e308, 1.7e308, 5e-324, 0.0, -5e-324] * 3,
    "close": [1.0 + k * 2.0**-52 for k in range(2000)],
    "one": [3.5],
}


@pytest.mark.parametrize("listed", [1 << 16, 3])
def test_quantiles(spark, listed, monkeypatch):
    """Every rank that is asked for is found, whether ranges are listed at once or narrowed to a few values."""
    monkeypatch.setattr(selection, "LISTED", listed)
    monkeypatch.setattr(selection, "PARTS", 64)
    rows = [(g, v) for g, vs in VALUES.items() for v in vs] + [(None, 1.0), (None, 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    phis = [0, 0.01, 0.5, 0.9, 0.999, 1]
    got = {r["g"]: r for r in stats(df, ["g"], **{f"q{i}": a.quantile(p, "v") for i, p in enumerate(phis)}).collect()}
    assert set(got) == {*VALUES, None, "none"}
    for g, vs in [*VALUES.items(), (None, [1.0, 2.0])]:
        s = sorted(vs)
        assert [got[g][f"q{i}"] for i in range(len(phis))] == [s[max(math.ceil(p * len(s)), 1) - 1] for p in phis], g
    assert all(got["none"][f"q{i}"] is None for i in range(len(phis)))


def test_quantiles_of_several_fields_and_conditions(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"), (-F.col("id")).alias("y"))
    got = stats(df, ["g"], a=a.quantile(0.5, "x"), b=a.quantile(0.5, "x", "y"), c=a.quantile(0.5, "x").if_(F.col("x") < 10), d=a.median("x"))
    for r in got.collect():
        x = list(range(r["g"], 1000, 3))
        both, few = sorted([*x, *[-v for v in x]]), [v for v in x if v < 10]
        rank = lambda s: s[max(math.ceil(len(s) / 2), 1) - 1]
        assert (r["a"], r["b"], r["c"], r["d"]) == (rank(x), rank(both), rank(few), rank(x))
    assert stats(df.where("false"), [], q=a.quantile(0.5, "x")).collect() == [(None,)]


WORK = {
    "running": lambda rows: windows.running_stats(rows, ["event_type"], tie=["event_id"], n=windows.run_count(), hi=windows.run_max("value")),
    "sort": lambda rows: order.sort(rows, [("value", True), "_msg"], offset=300, rank="r", tie=["event_id"]),
    "context": lambda rows: windows.stream_context(rows, f.gt("value", 200), 2, 1, "60h", stream=["event_type"], tie=["event_id"]),
}


@pytest.mark.parametrize("name", WORK)
def test_nothing_wide_is_stored_and_nothing_whole_is_in_one_task(spark, sf, tiny_groups, name, monkeypatch):
    rows = logs(spark, sf).drop("_stream")
    plain = rows_of(WORK[name](rows))
    stored, durable = [], slices.durable
    monkeypatch.setattr(slices, "durable", lambda df: stored.append(df.columns) or durable(df))
    tiny_groups(True)
    done = WORK[name](rows)
    assert rows_of(done) == plain
    assert stored and not any({"props", "_msg", "event_id"} & set(c) for c in stored)
    plan = done._jdf.queryExecution().executedPlan().toString()
    wide = [p for p in plan.split("\n") if "SinglePartition" in p and "props" in p]
    assert not wide


def test_groups_are_measured_in_bytes(spark):
    rows = spark.range(3000).select(F.lit(1).alias("g"), F.col("id"), F.repeat(F.lit("x"), 5000).alias("text"))
    assert slices.is_hot(rows, ["g"]) is None
    spark.conf.set(slices.MAX_GROUP_BYTES, "1000000")
    try:
        sizes = slices.is_hot(rows, ["g"])
        assert sizes.width > 5000 and slices.Slices(rows, ["g"], [slices.Key(F.col("id"))], sizes).count >= 15
        done = slices.positioned(rows, ["g"], [slices.Key(F.col("id"), True)], "pos")
        assert done.where("pos + id != 3000").count() == 0 and done.count() == 3000
    finally:
        spark.conf.unset(slices.MAX_GROUP_BYTES)


@pytest.mark.parametrize("desc", [False, True])
def test_slices_keep_the_order_of_nulls_text_and_groups(spark, tiny_groups, desc):
    rows = spark.range(900).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") * 37 % 101).alias("v"), "id"
    )
    keys = [slices.Key(F.col("v"), desc), slices.Key(F.col("id"))]
    plain = rows_of(slices.positioned(rows, ["g"], keys, "pos"))
    tiny_groups(True)
    assert rows_of(slices.positioned(rows, ["g"], keys, "pos")) == plain
