"""Edge values of coercion, filters, time arguments, text and JSON handling."""

import json
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from skeinlog.functions import coerce as k
from skeinlog.functions import filters as f
from skeinlog.functions import mathx as m
from skeinlog.functions import timespan
from skeinlog.functions.textpat import extract_regex, parse_pattern
from skeinlog.model import sort_key
from skeinlog.operators import combine, order, shape
from skeinlog.operators.stats import Bucket, stats
from skeinlog.functions import aggs as a
from skeinlog.plans import catalog_shape  # noqa: F401
from skeinlog.plans.tables import QUERIES, SQL
from skeinlog.sources.federation import effective_limit, federate_reporting


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


NUMBERS = [("", None), ("5", 5.0), ("-1.5", -1.5), ("1_000", 1000.0), ("1h5m3.2s", 3903.2e9), ("1.5KiB", 1536.0), ("0x1F", 31.0), ("-0b101", -5.0), ("0o17", 15.0),
           ("1e3", 1000.0), ("1.2.3.4", None), ("-2s", -2e9), ("007", 7.0), ("10KB5", 10005.0), ("abc", None), ("1y", 365 * 86400e9), ("2w", 14 * 86400e9), ("1.5µs", 1500.0), ("3TiB", 3 * 2.0**40)]


@pytest.mark.parametrize("text,want", NUMBERS)
def test_num(spark, text, want):
    assert one(spark, text, k.num("v")) == want


@pytest.mark.parametrize("text,want", [("1.5", None), ("15", 15), ("1.5K", 1500), ("1GiB", 1 << 30), ("5B", 5), ("KB", None), ("-1Ki", -1024)])
def test_bytes(spark, text, want):
    assert one(spark, text, k.bytes_("v")) == want


@pytest.mark.parametrize("text,want", [("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("1.2.3", None), ("1.2.3.4.5", None)])
def test_ipv4(spark, text, want):
    assert one(spark, text, k.ipv4_num("v")) == want


@pytest.mark.parametrize("text,want", [("2024-01-01T00:00:00.123456789Z", 1704067200123456789), ("2024-01-01T00:00:00+02:00", 1704060000000000000), ("2024-01-01 00:00:00", 1704067200000000000), ("2024-01-01", None)])
def test_timestamps(spark, text, want):
    assert one(spark, text, k.ts_ns("v")) == want


@pytest.mark.parametrize("ns,want", [(0, "0"), (5, "5ns"), (1500, "1µs500ns"), (3_600_500_000_000, "1h500ms"), (788_645_600_000_000, "1w2d3h4m5.6s"), (-1_500_000_000, "-1.5s")])
def test_duration_text(spark, ns, want):
    assert one(spark, ns, k.duration_text(F.col("v")), "bigint") == want


WEEK = 604_800_000_000_000


@pytest.mark.parametrize("ns,kind,want", [
    (15_251 * WEEK + 93_784_500_000_000, "decimal(37,0)", "15251w1d2h3m4.5s"),
    (-(1 << 63) * WEEK - 1500, "decimal(38,0)", "-9223372036854775808w1µs500ns"),
    (10**38 - 1, "decimal(38,0)", f"{(10**38 - 1) // WEEK}w6d9h46m39.999999999s"),
    (WEEK - 1, "decimal(38,0)", "6d23h59m59.999999999s"),
    ((1 << 63) - 1, "bigint", "15250w1d23h47m16.854775807s"),
    (-(1 << 63), "bigint", "-15250w1d23h47m16.854775808s"),
    (604_800_000_000_001.75, "double", "1w1ns"),
    (None, "decimal(38,0)", ""),
])
def test_duration_text_beyond_64_bits(spark, ns, kind, want):
    value = Decimal(ns) if ns is not None and kind.startswith("decimal") else ns
    assert one(spark, value, k.duration_text(F.col("v")), kind) == want


def test_duration_text_query_takes_any_user(spark, tmp_path):
    users = [0, 7, 999, 15_250, 15_251, 89_999, 539_999, (1 << 63) - 1]
    events = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    rows = [(i, datetime(2024, 1, 1), user, "view", 1.0, "{}") for i, user in enumerate(users)]
    spark.createDataFrame(rows, events).write.parquet(f"{tmp_path}/events.parquet")
    got = {r["event_id"]: r for r in QUERIES["K6_duration_text"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = {i: (a, b) for i, a, b in con.execute(f"SELECT event_id, a, b FROM ({SQL['K6_duration_text']})").fetchall()}
    assert {i: r["a"] for i, r in got.items()} == {i: a for i, (a, _) in want.items()}
    assert [got[i]["b"] for i in (0, 1, 2)] == [want[i][1] for i in (0, 1, 2)]
    assert [got[i]["b"] for i in (3, 6)] == ["15.250007s", "8m59.999007s"]  # seconds have a fraction, also where the SQL writes ms
    assert got[7]["b"].startswith(f"{((1 << 63) - 1) * 1_000_000 // WEEK}w")


@pytest.mark.parametrize("x,want", [(5.0, "5"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (1.5e-7, "1.5e-07"), (0.1, "0.1"), (123456789.25, "123456789.25"), (0.0, "0"), (float("nan"), "NaN")])
def test_float_text(spark, x, want):
    assert one(spark, x, k.float_text(F.col("v")), "double") == want


def test_coerce_counts_failures(spark):
    seen = Observation("coerce")
    df = spark.createDataFrame([("1s", "x"), ("oops", ""), (None, "5")], "a string, b string")
    rows = [tuple(r) for r in k.coerce(df, {"a": "duration", "b": "num"}, seen).collect()]
    assert rows == [(1_000_000_000, None), (None, None), (None, 5.0)]
    assert seen.get == {"bad_a": 1, "bad_b": 1}


US = 1_000_000
DAY = 86400 * US
JAN1 = timespan.micros_of(datetime(2025, 1, 1))


@pytest.mark.parametrize("text,start,end", [
    ("2025", JAN1, JAN1 + 365 * DAY),
    ("2025-02", JAN1 + 31 * DAY, JAN1 + 59 * DAY),
    ("2025-12", JAN1 + 334 * DAY, JAN1 + 365 * DAY),
    ("2025-01-01", JAN1, JAN1 + DAY),
    ("2025-01-01T05", JAN1 + 5 * 3600 * US, JAN1 + 6 * 3600 * US),
    ("2025-01-01T00:00:01", JAN1 + US, JAN1 + 2 * US),
    ("2025-01-01T00:00:00.123", JAN1 + 123_000, JAN1 + 124_000),
    ("2025-01-01T00:00:00.123456Z", JAN1 + 123_456, JAN1 + 123_457),
    ("2025-01-01+02:00", JAN1 - 7200 * US, JAN1 + DAY - 7200 * US),
    ("1735689600", JAN1, JAN1 + US),
    ("1735689600123", JAN1 + 123_000, JAN1 + 124_000),
    ("1735689600.123456", JAN1 + 123_456, JAN1 + 123_457),
])
def test_spans(text, start, end):
    assert timespan.span(text) == (start, end)


def test_time_filters_reach_the_scan(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    e = spark.read.parquet(f"{sf}/events.parquet")
    plan = e.where(f.time_range("2024-01-05", "2024-01-06", at="ts") & f.gt("value", 10))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "GreaterThan(value,10.0)" in plan


@pytest.mark.parametrize("value,pred,want", [
    ("foo_bar", lambda: f.phrase("v", "foo"), False), ("foo-bar", lambda: f.phrase("v", "foo"), True), ("été", lambda: f.phrase("v", "t"), False),
    (None, lambda: f.phrase("v", ""), True), (None, lambda: f.not_(f.phrase("v", "x")), True), ("ab.c", lambda: f.phrase("v", "b.c"), False),
    ("x (a) y", lambda: f.phrase("v", "(a)"), True), ("foobar", lambda: f.prefix("v", "foo"), True), ("a foobar", lambda: f.prefix("v", "bar"), False),
    ("one\ntwo", lambda: f.seq("v", "one", "two"), True), ("two one", lambda: f.seq("v", "one", "two"), False), ("x", lambda: f.regexp("v", ".+"), True),
    (None, lambda: f.regexp("v", ".+"), False), (None, lambda: f.regexp("v", ".*"), True), ("q", lambda: f.in_("v", "*"), True),
    ("10", lambda: f.range_("v", 5, 10, "[)"), False), ("abc", lambda: f.range_("v", 5, 10), False), ("NaN", lambda: f.gt("v", 5), False),
    ("b", lambda: f.gt("v", "a"), True), ("10", lambda: f.lt("v", "9"), False), ("1MB", lambda: f.ge("v", "1000KB"), True),
    ('["a","b"]', lambda: f.json_array_contains_any("v", "b", "z"), True), ("[broken", lambda: f.json_array_contains_any("v", "b"), False),
    ("héé", lambda: f.len_range("v", 3, 3), True), ("took 15ms", lambda: f.pattern_match("v", "took <N>ms"), True),
    ("x at 10:20:30, ok", lambda: f.pattern_match("v", "at <TIME>, <W>", "suffix"), True), ("a b\n", lambda: f.pattern_match("v", "a b", "full"), False),
])
def test_predicates(spark, value, pred, want):
    assert one(spark, value, pred()) is want


def test_common_case():
    assert f.common_case_phrases(["Error"]) == ["ERROR", "Error", "error"]
    assert len(f.common_case_phrases(["fooBarBaz"])) == 5
    with pytest.raises(ValueError):
        f.common_case_phrases(["ABCDEFGHIJK"])


def test_user_regex_limits():
    for bad in (r"(?=a)", r"(?<!a)b", r"(a)\1"):
        with pytest.raises(ValueError):
            f.user_re(bad)


@pytest.mark.parametrize("start,end,hour,want", [("08:00", "18:00", 8, True), ("08:00", "18:00", 19, False), ("22:00", "06:00", 23, True), ("22:00", "06:00", 12, False)])
def test_day_range(spark, start, end, hour, want):
    assert one(spark, datetime(2024, 1, 3, hour), f.day_range(start, end, at="v"), "timestamp") is want


@pytest.mark.parametrize("addr,want", [("2001:db8::1", True), ("2001:DB8:0:0:0:0:0:1", True), ("2001:db9::1", False), ("2001:db8:::1", False), ("1.2.3.4", False), ("", False), ("2001:db8::2:3:4:5:6", True), ("2001:db8::1:2:3:4:5:6", False), ("2001:db8:1:2:3:4:5:6:7", False)])
def test_ipv6(spark, addr, want):
    assert one(spark, addr, f.ipv6_range("v", "2001:db8::/32")) is want


def test_natural_order(spark):
    words = ["file10", "file9", "10", "9.5", "-3", "", "file010a", "1e2"]
    df = spark.createDataFrame([(x,) for x in words], "v string").orderBy(sort_key("v"))
    assert [r["v"] for r in df.collect()] == ["-3", "9.5", "10", "1e2", "", "file9", "file10", "file010a"]


@pytest.mark.parametrize("x,nearest,want", [(2.5, None, 3.0), (-2.5, None, -3.0), (1.249, 0.1, 1.2), (-1.25, 0.5, -1.5), (127.0, 10.0, 130.0)])
def test_round(spark, x, nearest, want):
    assert one(spark, x, m.round_(F.col("v"), nearest), "double") == want


@pytest.mark.parametrize("expr,want", [(lambda: m.div(1, 0), None), (lambda: m.mod(-7, 3), -1.0), (lambda: m.mod(7.5, 2), 1.5), (lambda: m.ln(-1), None), (lambda: m.max_(F.lit(None), 3, 1), 3.0),
                                       (lambda: m.default(F.lit(float("nan")), 4), 4.0), (lambda: m.bit_and(6, 3), 2.0), (lambda: m.bit_xor(6, 3), 5.0), (lambda: m.pow_(-8, 0.5), None)])
def test_math(spark, expr, want):
    assert spark.range(1).select(expr().alias("r")).first()["r"] == want


def test_patterns():
    assert [(p.text, p.name, p.option) for p in parse_pattern("a&lt;<x>b<q:y><_>")] == [("a<", "x", ""), ("b", "y", "q"), ("", "", "")]
    with pytest.raises(ValueError):
        extract_regex("<a><b>")
    with pytest.raises(ValueError):
        extract_regex("<_> only")
    with pytest.raises(ValueError):
        parse_pattern("<a")


def test_extract_and_options(spark):
    df = spark.createDataFrame([("ip=1.1.1.1 q=\"a \\\"b\" end", "old"), ("nothing", "old"), (None, "old")], "_msg string, ip string")
    assert [r["ip"] for r in shape.extract(df, "ip=<ip> ").collect()] == ["1.1.1.1", "", ""]
    assert [r["ip"] for r in shape.extract(df, "ip=<ip> ", skip_empty=True).collect()] == ["1.1.1.1", "old", "old"]
    assert [r["ip"] for r in shape.extract(df, "ip=<ip> ", keep_original=True).collect()] == ["old"] * 3
    assert shape.extract(df, "q=<q> end").first()["q"] == 'a "b'


def test_replace_regexp_limit(spark):
    df = spark.createDataFrame([("a1b22c333",)], "_msg string")
    assert shape.replace_regexp(df, "([a-z])([0-9]+)", "$2$1-", limit=2).first()["_msg"] == "1a-22b-c333"
    assert shape.replace_regexp(df, "[0-9]+", "N", limit=2).first()["_msg"] == "aNbNc333"
    assert shape.replace(df, "b", "x.y").first()["_msg"] == "a1x.y22c333"


def test_json_unpacking(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":"x","d":[1,2]},"a":2,"b.c":"late"}',), ("no json",), (None,)], "_msg string")
    rows = shape.unpack_json(df).select("a", "`b.c`", "`b.d`").collect()
    assert [tuple(r) for r in rows] == [("1", "x", "[1,2]"), ("", "", ""), ("", "", "")]
    kept = shape.unpack_json(df, fields=["b"], preserve_keys=["b"]).first()["b"]
    assert kept == '{"c":"x","d":[1,2]}'


def test_json_numbers_and_depth(spark):
    deep = '{"v":1.50}'
    for _ in range(8):
        deep = '{"o":' + deep + "}"
    long_text = '"' + "\\\\" * 20000 + ' 1.5 {{{{"'
    docs = [deep, '{"t":' + long_text + ',"v":-0.10}', '{"v":1.5.2}', '{"v": 1E+2 , "w":[ 1.0,{"z":2.50}]}', "{}", "", None]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, _msg string")
    rows = [r.asDict() for r in shape.unpack_json(df, preserve_keys=["w"]).orderBy("id").collect()]
    name = ".".join("o" * 8) + ".v"
    assert rows[0][name] == "1.50" and rows[1]["v"] == "-0.10" and rows[1]["t"] == json.loads(long_text)
    assert [r["v"] for r in rows[2:]] == ["", "1E+2", "", "", ""] and rows[3]["w"] == '[1.0,{"z":2.50}]'
    named = [tuple(r) for r in shape.unpack_json(df, fields=["v", "w"]).select("v", "w").orderBy("id").collect()]
    assert named == [("", ""), ("-0.10", ""), ("", ""), ("1E+2", '[1.0,{"z":2.50}]'), ("", ""), ("", ""), ("", "")]
    assert [r[0] for r in df.select(shape.json_depth(F.col("_msg"))).orderBy("id").collect()][:5] == [9, 1, 1, 2, 1]


def test_keys_beyond_the_bound_stay_in_the_map(spark):
    df = spark.createDataFrame([("a=1 b=2 c=3",), ("a=4 b=5",)], "_msg string")
    rows = shape.unpack_logfmt(df, bound=2).collect()
    assert [(r["a"], r["b"], r["_extra"]) for r in rows] == [("1", "2", {"c": "3"}), ("4", "5", {})]


def test_unroll_pads(spark):
    df = spark.createDataFrame([('["a","b"]', "[1]"), ("x", None)], "p string, q string")
    assert [tuple(r) for r in shape.unroll(df, "p", "q").collect()] == [("a", "1"), ("b", ""), ("", "")]


def test_joins(spark):
    left = spark.createDataFrame([("1", "l", "x"), (None, "l", "y"), ("3", "l", "z")], "k string, v string, w string")
    rows = [{"k": "1", "v": "r"}, {"k": "", "v": ""}]
    got = {r["w"]: r["v"] for r in combine.join(left, ["k"], rows=rows).collect()}
    assert got == {"x": "r", "y": "l", "z": "l"}
    assert combine.join(left, ["k"], rows=rows, inner=True).count() == 2
    assert {(r["v"], r["p_v"]) for r in combine.join(left, ["k"], rows=rows, prefix="p_").collect()} == {("l", "r"), ("l", ""), ("l", None)}


def test_facet_rules(spark):
    rows = spark.range(100).selectExpr("cast(id as string) as many", "cast(id % 2 as string) as two", "'c' as const", "repeat('x', 200) as long", "if(id % 50 = 0, 'c', '') as rare")
    got = {r["field_name"] for r in order.facets(rows, max_values=50).collect()}
    assert got == {"two", "rare"}
    assert {r["field_name"] for r in order.facets(rows, max_values=50, keep_const=True).collect()} == {"two", "rare", "const"}


def test_stats_rules(spark):
    df = spark.range(3).selectExpr("id as a", "cast(null as string) as b")
    with pytest.raises(ValueError):
        stats(df, ["a"], a=a.count())
    with pytest.raises(ValueError):
        stats(df, ["a"])
    row = stats(df, [], n=a.count(), m=a.median("b"), v=a.values("b"), u=a.count_uniq("b"), s=a.sum_("b")).first()
    assert tuple(row) == (3, None, "[]", 0, None)


def test_groups_without_numbers_stay(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("b", None)], "g string, v string")
    assert sorted(tuple(r) for r in stats(df, ["g"], q=a.quantile(0.5, "v")).collect()) == [("a", 1.0), ("b", None)]
    none = stats(df, ["g"], v=a.values("v").if_(f.exact("g", "a")))
    assert sorted(tuple(r) for r in none.collect()) == [("a", '["1"]'), ("b", "[]")]


@pytest.mark.parametrize("asked,top,want", [(None, 1000, 1000), ("x", 1000, 1000), (0, 1000, 1000), (5, 1000, 5), (5000, 1000, 1000), ("7", 1000, 7), (5, 0, 0)])
def test_effective_limit(asked, top, want):
    assert effective_limit(asked, top) == want


def test_failed_clusters_are_named(spark):
    good = spark.range(2).toDF("x")
    df, skipped = federate_reporting({"a": good, "b": lambda: spark.read.parquet("/tmp/absent-table")}, "skip")
    assert (df.count(), skipped) == (2, ["b"])
    with pytest.raises(Exception):
        federate_reporting({"b": lambda: spark.read.parquet("/tmp/absent-table")}, "fail")


def test_wildcards_keep_fields_that_a_row_lacks(spark):
    df = spark.createDataFrame([('{"a":"1"}', "keep"), ('{"level":"new"}', "old"), ('{"it\'s":"x"}', "keep")], "_msg string, level string")
    assert [r["level"] for r in shape.unpack_json(df).collect()] == ["keep", "new", "keep"]
    assert [r["level"] for r in shape.unpack_json(df, fields=["level"]).collect()] == ["", "new", ""]
    assert [r["it's"] for r in shape.unpack_json(df, fields=["it's"]).collect()] == ["", "", "x"]
    lines = spark.createDataFrame([("a=1", "keep"), ("level=new", "old")], "_msg string, level string")
    assert [r["level"] for r in shape.unpack_logfmt(lines).collect()] == ["keep", "new"]


@pytest.mark.parametrize("text, pattern, repl, limit, want", [
    ("aaa", "^(a)", "[$1]", 2, "[a]aa"),
    ("ab cd ef", r"\b(\w)(\w)", "$2${1}", 50, "ba dc fe"),
    ("ab cd ef", r"\b(\w)(\w)", "$2$1", 2, "ba dc ef"),
    ("abc", "(x*)", "-$1", 2, "-a-bc"),
    ("none", "(x)", "$1$1", 3, "none"),
    ("k=v", "(?<n>[a-z])=", "${n}:", 1, "k:v"),
])
def test_first_replacements_see_the_whole_text(spark, text, pattern, repl, limit, want):
    df = spark.createDataFrame([(text,)], "_msg string")
    assert shape.replace_regexp(df, pattern, repl, limit=limit).first()["_msg"] == want


def test_not_a_number_never_wins(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (3.0, "c")], "x double, y string")
    r = stats(df, lo=a.min_("x"), hi=a.max_("x"), y=a.field_max("x", "y")).first()
    assert tuple(r) == (1.0, 3.0, "c")
    r = df.where("y = 'b'").select(m.max_(F.col("x"), 1), m.add(F.col("x"), 1), m.mul(F.lit("5ms"), 2)).first()
    assert tuple(r) == (1.0, None, 1e7)


def test_deviation_of_several_fields_is_stable(spark):
    df = spark.createDataFrame([(1e9 + 1, 1e9 + 2), (1e9 + 3, 1e9 + 4)], "a double, b double")
    assert abs(stats(df, s=a.stddev("a", "b")).first()["s"] - 1.25**0.5) < 1e-9


def test_numbers_of_64_bits(spark):
    one = spark.range(1)
    r = one.select(m.bit_and(1e19, 1e19), m.bit_or(6, 1), m.round_(7.3, F.lit(0.5)), m.round_(7.3e-18, 1e-18)).first()
    assert r[0] == 1e19 and r[1] == 7 and r[2] == 7.5 and abs(r[3] - 7e-18) < 1e-30
    kinds = spark.createDataFrame([("18446744073709551615",), ("18446744073709551616",), ("-9999999999999999999",)], "v string")
    assert [r[0] for r in kinds.select(f.value_kind("v")).collect()] == ["uint64", "string", "string"]


def test_month_buckets_take_an_offset(spark):
    df = spark.sql("SELECT timestamp'2024-03-03 00:00:00' AS t UNION ALL SELECT timestamp'2024-03-07 00:00:00'")
    got = stats(df, [Bucket("t", "month", "5d", "m")], n=a.count()).orderBy("m").collect()
    assert [str(r["m"]) for r in got] == ["2024-02-06 00:00:00", "2024-03-06 00:00:00"]


def test_rates_take_the_step_of_the_query(spark):
    from skeinlog.plans.logqueries import stats_query_range

    df = spark.sql("SELECT timestamp'2024-03-03 00:10:00' AS _time, 4.0D AS v UNION ALL SELECT timestamp'2024-03-03 00:20:00', 5.0D")
    got = stats_query_range(df, [], {"r": a.rate(), "s": a.rate_sum("v")}, "1h").collect()
    assert {r["name"]: round(float(r["value"]), 9) for r in got} == {"r": round(2 / 3600, 9), "s": 0.0025}


def test_hits_without_points_keep_their_total(spark):
    from skeinlog.operators.merge import merge_hits

    df = spark.sql("SELECT map('a','b') AS fields, array() AS timestamps, array() AS values, 7 AS total").selectExpr(
        "fields", "cast(timestamps AS array<string>) timestamps", "cast(values AS array<int>) values", "total")
    assert [tuple(r) for r in merge_hits(df).collect()] == [('{"a":"b"}', None, None, 7)]


def test_written_lines_keep_microseconds(spark, tmp_path):
    from skeinlog.sources.writers import write_ndjson

    write_ndjson(spark.sql("SELECT timestamp'2024-01-02 03:04:05.123456' AS _time"), f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").first()[0] == '{"_time":"2024-01-02T03:04:05.123456Z"}'


def test_end_of_text_is_the_very_end(spark):
    df = spark.createDataFrame([("foo",), ("foo\n",), ("a$b",)], "v string")
    assert [r[0] for r in df.select(f.regexp("v", "foo$")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(f.regexp("v", r"[$]b|a\$")).collect()] == [False, False, True]


def test_phrases_that_begin_alike_are_no_hot_key(spark):
    texts = spark.createDataFrame([(i, f"the case of the w{i} and of the rest") for i in range(200)], "id long, t string")
    phrases = spark.createDataFrame([(f"of the w{i}",) for i in range(300)], "p string")
    found = combine.contains_any_query(texts, "t", phrases, inline_limit=1)
    assert found.count() == 200
    offered = texts.select("id", F.explode(combine._runs(F.split("t", " "), 3, " ")).alias("k"))
    keys = phrases.select(F.get(combine._runs(F.split("p", " "), 3, " "), F.lit(0)).alias("k"))
    assert offered.join(keys, "k").count() == 200


def test_keys_of_json_are_found_without_reading_values(spark, monkeypatch):
    plans, found = [], shape.discover

    def seen(keys, df, bound):
        plans.append(df.select(F.explode(keys))._jdf.queryExecution().optimizedPlan().toString())
        return found(keys, df, bound)

    monkeypatch.setattr(shape, "discover", seen)
    docs = ['{"a":1.50,"b":{"c":[1e3,"1.0"],"a.b":-0},"a":2}', '{"b":7}', "no json", None]
    done = shape.unpack_json(spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string"), "doc").drop("doc")
    assert "map_from_entries" not in plans[0] and shape.MARK not in plans[0].split("array_distinct")[1].split("\n")[0]
    assert done.columns == ["i", "a", "b", "b.a.b", "b.c"]
    assert [tuple(r) for r in done.orderBy("i").collect()] == [
        (0, "1.50", "", "-0", '[1e3,"1.0"]'), (1, "", "7", "", ""), (2, "", "", "", ""), (3, "", "", "", "")]
    few = shape.unpack_json(spark.createDataFrame([('{"a":1.0,"b":[2.50],"c":3e1}',), ('{"a":1}',)], "doc string"), "doc", bound=1)
    assert few.select(shape.EXTRA).first()[0] == {"b": "[2.50]", "c": "3e1"}
