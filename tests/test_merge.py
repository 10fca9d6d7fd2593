"""Merge cases with fixed numbers."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rows import rows_of
from skeinlog.functions import aggs as a
from skeinlog.operators import merge, order
from skeinlog.operators.stats import partial_stats, stats
from skeinlog.plans.tables import clusters, logs
from skeinlog.sources import readers, writers
from skeinlog.sources.federation import federate

# by-fields, functions, partial rows of several clusters (all text), merged rows
STATS = [
    (["depot"], {"boxes": "count"}, [{"depot": "north", "boxes": "3"}, {"depot": "south", "boxes": "11"}, {"depot": "north", "boxes": "9"}, {"depot": "east", "boxes": "1"}],
     {("north", 12.0), ("south", 11.0), ("east", 1.0)}),
    (["depot", "lane"], {"boxes": "count_uniq"}, [{"depot": "north", "lane": "1", "boxes": "4"}, {"depot": "north", "lane": "2", "boxes": "6"}, {"depot": "north", "lane": "1", "boxes": "5"}],
     {("north", "1", 9.0), ("north", "2", 6.0)}),
    (["depot"], {"kg": "sum"}, [{"depot": "north", "kg": k} for k in ("-2.5", "0.75", "1e2")], {("north", 98.25)}),
    (["depot"], {"kg": "sum_len"}, [{"depot": "north", "kg": k} for k in ("8", "oops", "")], {("north", 8.0)}),
    (["depot"], {"kg": "max"}, [{"depot": "north", "kg": k} for k in ("-7", "-7.5", "-60")], {("north", -7.0)}),
    (["depot"], {"kg": "last"}, [{"depot": "north", "kg": k} for k in ("0.1", "oops", "0.09")], {("north", 0.1)}),
    (["depot"], {"kg": "min"}, [{"depot": "north", "kg": k} for k in ("4", "-0.5", "oops")], {("north", -0.5)}),
    (["depot"], {"kg": "median"}, [{"depot": "north", "kg": k} for k in ("-3", "1.5", "6")], {("north", 1.5)}),
    (["depot"], {"n": "rate", "lo": "first", "hi": "max", "mid": "avg"},
     [{"depot": "west", "n": "0.25", "lo": "6", "hi": "-1", "mid": "2"}, {"depot": "west", "n": "0.5", "lo": "-6", "hi": "-2", "mid": "-4"}], {("west", 0.75, -6.0, -1.0, -1.0)}),
    ([], {"boxes": "count_empty"}, [{"boxes": "13"}, {"boxes": "0"}, {"boxes": "28"}], {(41.0,)}),
    (["depot"], {"boxes": "count"}, [{"boxes": "5"}, {"depot": "south", "boxes": "2"}, {"boxes": "6"}], {(None, 11.0), ("south", 2.0)}),
    (["depot"], {"kg": "max"}, [{"depot": "north", "kg": "oops"}], {("north", None)}),
    (["depot"], {"kg": "quantile"}, [{"depot": "north", "kg": "oops"}], {("north", 0.0)}),
]


@pytest.mark.parametrize("by,funcs,parts,want", STATS)
def test_merge_stats(spark, by, funcs, parts, want):
    names = [*by, *funcs]
    df = spark.createDataFrame([tuple(p.get(n) for n in names) for p in parts], ", ".join(f"{n} string" for n in names))
    assert {tuple(r) for r in merge.merge_stats(df, by, funcs).collect()} == want


def test_merge_stats_without_input(spark):
    empty = spark.createDataFrame([], "depot string, boxes string")
    assert merge.merge_stats(empty, ["depot"], {"boxes": "count"}).count() == 0
    assert merge.merge_stats(empty, [], {"boxes": "count"}).count() == 0


def test_any_keeps_the_first_cluster(spark):
    df = spark.createDataFrame([("b", "2"), ("a", None), ("a", "1")], "_cluster string, v string")
    assert merge.merge_stats(df, [], {"v": "values"}).first()[0] == "1"


NOON = 1_700_000_000.0


def test_range_points_are_summed_and_sorted(spark):
    rows = [({"lane": lane, "__name__": "boxes"}, NOON + at, text) for lane, at, text in [
        ("7", 60, "2.5"), ("8", 0, "-4"), ("7", 0, "1"), ("7", 60, "-0.5"), ("7", 0, "oops"), ("8", 0, "4"),
    ]]
    df = spark.createDataFrame(rows, "metric map<string,string>, ts double, value string")
    nested = {r["metric"]: [(p["ts"], p["value"]) for p in r["values"]] for r in writers.to_matrix(merge.merge_stats_range(df, {"boxes": "count"})).collect()}
    assert nested == {'{"lane":"7"}': [(NOON, "1"), (NOON + 60, "2")], '{"lane":"8"}': [(NOON, "0")]}


def test_range_disjoint_times(spark):
    rows = [({"lane": "7"}, NOON + d, str(d)) for d in (90, 15, 45)]
    df = spark.createDataFrame(rows, "metric map<string,string>, ts double, value string")
    [row] = writers.to_matrix(merge.merge_stats_range(df, {"boxes": "sum"})).collect()
    assert [(p["ts"] - NOON, p["value"]) for p in row["values"]] == [(15, "15"), (45, "45"), (90, "90")]


def test_instant(spark):
    rows = [({"lane": "7", "__name__": "kg"}, NOON + 3, "0.5"), ({"lane": "8", "__name__": "kg"}, NOON + 1, "-2"), ({"lane": "7", "__name__": "kg"}, NOON + 2, "0.25")]
    df = spark.createDataFrame(rows, "metric map<string,string>, ts double, value string")
    got = {(r["metric"], r["ts"], r["value"]) for r in merge.merge_stats_instant(df, {"kg": "sum"}).collect()}
    assert got == {('{"lane":"7"}', NOON + 1, 0.75), ('{"lane":"8"}', NOON + 1, -2.0)}


def test_hits(spark):
    early, late = "2031-07-05T06:00:00Z", "2031-07-05T07:00:00Z"
    rows = [({"lane": "7"}, [late], [4], 4), ({"lane": "7"}, [early, late], [2], 9), ({}, [early, early], [3, 5], 8), ({"lane": "9"}, [], [], 6)]
    df = spark.createDataFrame(rows, "fields map<string,string>, timestamps array<string>, values array<bigint>, total bigint")
    got = {(r["fields"], r["ts"], r["value"], r["total"]) for r in merge.merge_hits(df).collect()}
    assert got == {('{"lane":"7"}', early, 2, 13), ('{"lane":"7"}', late, 4, 13), ("{}", early, 8, 8), ('{"lane":"9"}', None, None, 6)}


def test_value_hits_and_facets(spark):
    values = spark.createDataFrame([("crate", 6), ("drum", 1), ("crate", 30), ("sack", 0), (None, 2)], "value string, hits bigint")
    assert rows_of(merge.merge_value_hits(values)) == sorted([("crate", 36), ("drum", 1), ("sack", 0), (None, 2)], key=str)
    facets = spark.createDataFrame([("kind", "crate", "6"), ("lane", "7", "oops"), ("kind", "crate", "8"), ("lane", "7", "12"), ("lane", "8", "1")], "field_name string, field_value string, hits string")
    assert rows_of(merge.merge_facets(facets)) == [("kind", "crate", 14), ("lane", "7", 12), ("lane", "8", 1)]


def test_sort_rules(spark):
    df = spark.createDataFrame([("b", "10"), ("a", "9"), ("c", "x"), ("d", "9.5")], "k string, v string")
    up = [r["v"] for r in merge.merge_sort(df, ["v"]).collect()]
    assert up == ["9", "9.5", "10", "x"]
    assert [r["v"] for r in merge.merge_sort(df, ["v"], desc=True, limit=2).collect()] == ["x", "10"]
    assert [r["v"] for r in merge.merge_sort(df, [("v", True)], desc=True, limit=2).collect()] == ["x", "10"]
    assert [r["k"] for r in merge.merge_sort(df).collect()] == ["a", "b", "c", "d"]


def test_order_of_merges(spark):
    df = spark.createDataFrame([("f", "v1", 2), ("f", "v1", 3), ("f", "v2", 9)], "field_name string, field_value string, hits bigint")
    spec = merge.MergeSpec(stats_by=["field_name"], stats={"hits": "max"}, facets=True, sort=True, sort_by=[("hits", True)], limit=1)
    assert [tuple(r) for r in merge.merge_partials(df, spec).collect()] == [("f", "v2", 9)]


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_splitting_into_clusters_changes_nothing(spark, sf, n):
    funcs = {"n": a.count(), "lo": a.min_("value"), "hi": a.max_("value"), "u": a.sum_("user_id")}
    whole = stats(logs(spark, sf), ["event_type"], **funcs)
    parts = partial_stats(federate(clusters(spark, sf, n)), ["event_type"], **funcs)
    assert rows_of(merge.merge_stats(parts, ["event_type"], funcs)) == rows_of(whole)
    hits = federate({k: order.field_values(c, "user_id") for k, c in clusters(spark, sf, n).items()})
    assert rows_of(merge.merge_value_hits(hits)) == rows_of(order.field_values(logs(spark, sf), "user_id"))


def test_matrix_reader_skips_bad_points(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"a":"b"},"values":[[1,"2"],["x","3"],[4]]}]}}')
    got = [tuple(r) for r in readers.read_matrix(spark, str(tmp_path)).collect()]
    assert got == [({"a": "b"}, 1.0, "2")]


def test_broken_lines_are_dropped(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"_msg":"a"}\n{broken\n{"_msg":"b","n":1}\n')
    assert sorted(r["_msg"] for r in readers.read_ndjson(spark, str(tmp_path), "_msg string, n long").collect()) == ["a", "b"]


def test_lines_lose_no_field_of_another_type_or_name(spark, tmp_path):
    lines = ['{"_msg":"a","value":1.5}', '{"_msg":"b","value":"n/a"}', '{"_msg":"c","value":"2","app":"x","o":{"p":[1,2]}}', '{"_msg":null,"tags":["t"]}', "", "  ",
             '{"_msg":"d","tags":"none","value":null,"z":null}', "{broken", "[1]", '"text"', "null", '{"_msg":"e"', "{}"]
    (tmp_path / "l.json").write_text("\n".join(lines))
    seen = Observation()
    got = readers.read_ndjson(spark, str(tmp_path), "_msg string, value double, tags array<string>", seen).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([
        ("a", 1.5, None, None), ("b", None, None, {"value": "n/a"}), ("c", 2.0, None, {"app": "x", "o": '{"p":[1,2]}'}),
        (None, None, ["t"], None), ("d", None, None, {"tags": "none", "z": None}), (None, None, None, None),
    ], key=str)
    assert seen.get == {"lines": 11, "dropped": 5}


def test_vector_is_text_at_the_edge(spark):
    df = spark.createDataFrame([("m", "n", 5.0, 5.0)], "metric string, name string, ts double, value double")
    assert writers.to_vector(df).select(F.get("value", F.lit(1))).first()[0] == "5"
