"""Checked queries: filters."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from skeinlog.functions import filters as f
from skeinlog.operators.combine import contains_all_query, contains_any_query, in_query, stream_id_in_query
from skeinlog.model import sort_key
from skeinlog.plans.tables import LOGS, logs, register, table

NW = r"[^\p{L}\p{Nd}_]"


def word(text: str) -> str:
    return f"(^|{NW}){text}($|{NW})"


def starts(text: str) -> str:
    return f"(^|{NW}){text}"


# Filters over documents: predicate and the same condition in SQL.
DOCUMENTS = {
    "D1_and": (lambda: f.and_(f.exact("lang", "en"), f.substring("text", "that")), "lang = 'en' AND contains(text, 'that')"),
    "D2_or": (lambda: f.or_(f.exact("lang", "de"), f.exact("source", "src3")), "lang = 'de' OR source = 'src3'"),
    "D3_not": (lambda: f.not_(f.not_(f.not_(f.substring("text", "the")))), "NOT contains(text, 'the')"),
    "D4_all_rows": (lambda: f.all_rows(), "true"),
    "D5_phrase": (lambda: f.phrase("text", "of the"), f"regexp_matches(text, '{word('of the')}')"),
    "D6_prefix": (lambda: f.prefix("text", "tha"), f"regexp_matches(text, '{starts('tha')}')"),
    "D7_substring": (lambda: f.substring("text", "tion"), "contains(text, 'tion')"),
    "D8_exact": (lambda: f.exact("source", "src7"), "source = 'src7'"),
    "D8_not_exact": (lambda: f.not_(f.exact("source", "src7")), "source <> 'src7'"),
    "D9_exact_prefix": (lambda: f.exact_prefix("text", "Th"), "starts_with(text, 'Th')"),
    "D10_any_case_phrase": (lambda: f.any_case_phrase("text", "The"), f"regexp_matches(lower(text), '{word('the')}')"),
    "D11_any_case_prefix": (lambda: f.any_case_prefix("text", "WHE"), f"regexp_matches(lower(text), '{starts('whe')}')"),
    "D12_regexp": (lambda: f.regexp("text", r"[0-9]{3}-[0-9]{4}"), "regexp_matches(text, '[0-9]{3}-[0-9]{4}')"),
    "D12_not_regexp": (lambda: f.not_(f.regexp("text", "th(is|at)")), "NOT regexp_matches(text, 'th(is|at)')"),
    "D13_seq": (lambda: f.seq("text", "that", "the"), f"regexp_matches(text, '(?s){word('that')}(.*{NW})?the($|{NW})')"),
    "D14_in": (lambda: f.in_("source", "src1", "src2", "nowhere"), "source IN ('src1', 'src2', 'nowhere')"),
    "D16_contains_any": (lambda: f.contains_any("text", "und", "les", "that the"), f"regexp_matches(text, '(^|{NW})(und|les|that the)($|{NW})')"),
    "D17_contains_all": (lambda: f.contains_all("text", "in", "that"), f"regexp_matches(text, '{word('in')}') AND regexp_matches(text, '{word('that')}')"),
    "D19_contains_common_case": (lambda: f.contains_common_case("text", "The", "Und"), f"regexp_matches(text, '(^|{NW})(The|the|THE|Und|und|UND)($|{NW})')"),
    "D20_equals_common_case": (lambda: f.equals_common_case("lang", "En", "DE"), "lang IN ('En', 'en', 'EN', 'DE', 'De', 'dE', 'de')"),
    "D23_string_range": (lambda: f.string_range("source", "src1", "src3"), "source >= 'src1' AND source < 'src3'"),
    "D24_len_range": (lambda: f.len_range("text", 100, "1KB"), "length(text) BETWEEN 100 AND 1000"),
    "D24_len_range_inf": (lambda: f.len_range("text", "1KiB", "inf"), "length(text) >= 1024"),
    "D31_pattern_match": (lambda: f.pattern_match("text", "<IP4>"), r"regexp_matches(text, '\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}')"),
}

for _name, (_pred, _sql) in DOCUMENTS.items():
    register(_name, f"SELECT doc_id, lang, n_chars FROM documents WHERE {_sql}")(
        lambda spark, sf, pred=_pred: table(spark, sf, "documents").where(pred()).select("doc_id", "lang", "n_chars")
    )


@register("D14_in_double", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity IN (5, 17, 50)")
def _in_double(spark, sf):
    """Numbers in their log text find doubles; other spellings of a number are other text."""
    rows = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("double"))
    return rows.where(f.in_("l_quantity", "5", "17", "50", "6.0", "7e0", "nine")).select("l_orderkey", "l_linenumber")


IP = "concat_ws('.', 10, user_id, event_id % 256, (event_id * 7) % 256)"
IP_SQL = "'10.' || user_id || '.' || (event_id % 256) || '.' || ((event_id * 7) % 256)"
NUMBER = "(10 * 16777216 + user_id * 65536 + (event_id % 256) * 256 + (event_id * 7) % 256)"

STREAM_IDS = [hashlib.md5(f'{{type="click",user="{u}"}}'.encode()).hexdigest() for u in range(10, 20)]

# Filters over log rows: extra fields, predicate, condition in SQL.
EVENTS = {
    "D5_phrase_empty": ({"kind": "if(event_id % 10 = 0, '', event_type)"}, lambda: f.phrase("kind", ""), "event_id % 10 = 0"),
    "D6_prefix_empty": ({"kind": "if(event_id % 10 = 0, null, event_type)"}, lambda: f.prefix("kind", ""), "event_id % 10 <> 0"),
    "D3_not_missing": ({"kind": "if(event_id % 10 = 0, null, event_type)"}, lambda: f.not_(f.exact("kind", "click")), "event_id % 10 = 0 OR event_type <> 'click'"),
    "D21_range": ({}, lambda: f.range_("value", 10, "20.5", "(]"), "value > 10 AND value <= 20.5"),
    "D21_range_text": ({"took": "concat(user_id, 'ms')"}, lambda: f.range_("took", "20ms", "0.1s", "[)"), "user_id >= 20 AND user_id < 100"),
    "D22_gt": ({}, lambda: f.gt("value", 99.5), "value > 99.5"),
    "D22_ge": ({}, lambda: f.ge("user_id", "100"), "user_id >= 100"),
    "D22_lt": ({"size": "concat(user_id, 'KB')"}, lambda: f.lt("size", "20KB"), "user_id < 20"),
    "D22_le_text": ({}, lambda: f.le("event_type", "error"), "event_type <= 'error'"),
    "D25_ipv4_range": ({"ip": IP}, lambda: f.ipv4_range("ip", "10.20.0.0", "10.40.255.255"), f"{NUMBER} BETWEEN 10 * 16777216 + 20 * 65536 AND 10 * 16777216 + 40 * 65536 + 65535"),
    "D25_ipv4_cidr": ({"ip": IP}, lambda: f.ipv4_range("ip", "10.64.0.0/12"), "user_id BETWEEN 64 AND 79"),
    "D26_ipv6_range": ({"ip": "concat('2001:db8::', lower(hex(user_id)), ':', lower(hex(event_id % 65536)))"}, lambda: f.ipv6_range("ip", "2001:db8::10:0/108"), "user_id BETWEEN 16 AND 31"),
    "D27_eq_field": ({"a": "event_id % 7", "b": "user_id % 7"}, lambda: f.eq_field("a", "b"), "event_id % 7 = user_id % 7"),
    "D28_le_field": ({"a": "cast(event_id % 17 as string)", "b": "cast(user_id as string)"}, lambda: f.le_field("a", "b"), "event_id % 17 <= user_id"),
    "D29_lt_field": ({"a": "cast(event_id % 17 as string)", "b": "cast(user_id as string)"}, lambda: f.lt_field("a", "b"), "event_id % 17 < user_id"),
    "D30_json_array_contains_any": ({"arr": "to_json(array(event_type, cast(user_id as string)))"}, lambda: f.json_array_contains_any("arr", "click", "42"), "event_type = 'click' OR user_id = 42"),
    "D31_pattern_match_full": ({}, lambda: f.pattern_match("_msg", "<W> user=<N> value=<N>.5", "full"), r"regexp_matches(_msg, '^[\p{L}\p{Nd}_]+ user=[0-9]+ value=[0-9]+\.5$')"),
    "D31_pattern_match_prefix": ({}, lambda: f.pattern_match("_msg", "<W> user=7", "prefix"), "regexp_matches(_msg, '^[a-z]+ user=7')"),
    "D31_pattern_match_suffix": ({}, lambda: f.pattern_match("_msg", "=<N>.25", "suffix"), r"regexp_matches(_msg, '=[0-9]+\.25$')"),
    "D32_value_type": ({"v": "if(event_id % 3 = 0, cast(value as string), if(event_id % 3 = 1, cast(user_id as string), event_type))"}, lambda: f.value_type("v", "uint64"), "event_id % 3 = 1"),
    "D33_time_range": ({}, lambda: f.time_range("2024-01-05", "2024-01-07T12"), "_time >= TIMESTAMP '2024-01-05' AND _time < TIMESTAMP '2024-01-07 13:00:00'"),
    "D33_time_range_open": ({}, lambda: f.time_range("2024-01-05", "2024-01-07T12", "()"), "_time > TIMESTAMP '2024-01-05' AND _time < TIMESTAMP '2024-01-07 12:00:00'"),
    "D33_time_at": ({}, lambda: f.time_at("2024-01-20"), "_time >= TIMESTAMP '2024-01-20' AND _time < TIMESTAMP '2024-01-21'"),
    "D33_time_zone": ({}, lambda: f.time_range("2024-01-05T00:00:00+02:00", "2024-01-06", "[)"), "_time >= TIMESTAMP '2024-01-04 22:00:00' AND _time < TIMESTAMP '2024-01-06'"),
    "D34_time_last": ({}, lambda: f.time_last("36h", now=datetime(2024, 1, 20)), "_time >= TIMESTAMP '2024-01-18 12:00:00' AND _time < TIMESTAMP '2024-01-20'"),
    "D34_time_older": ({}, lambda: f.time_last("36h", ">", now=datetime(2024, 1, 20)), "_time < TIMESTAMP '2024-01-18 12:00:00'"),
    "D35_time_offset": ({}, lambda: f.time_range("2024-01-05", "2024-01-07", offset="1d12h"), "_time >= TIMESTAMP '2024-01-03 12:00:00' AND _time < TIMESTAMP '2024-01-06 12:00:00'"),
    "D36_day_range": ({}, lambda: f.day_range("08:00", "18:00", ends="[)"), "CAST(_time AS TIME) >= TIME '08:00:00' AND CAST(_time AS TIME) < TIME '18:00:00'"),
    "D36_day_range_offset": ({}, lambda: f.day_range("08:00", "18:00", "2h", ends="[)"), "CAST(_time + INTERVAL 2 HOUR AS TIME) >= TIME '08:00:00' AND CAST(_time + INTERVAL 2 HOUR AS TIME) < TIME '18:00:00'"),
    "D37_week_range": ({}, lambda: f.week_range("Mon", "Fri"), "dayofweek(_time) BETWEEN 1 AND 5"),
    "D37_week_range_wrap": ({}, lambda: f.week_range("Sat", "Mon", "3h"), "dayofweek(_time + INTERVAL 3 HOUR) IN (6, 0, 1)"),
    "D38_stream": ({}, lambda: f.stream([("type", "=", "click"), ("user", "=~", "1[0-4].?")], [("type", "in", ["error"]), ("user", "!=", "3")]),
                   "(event_type = 'click' AND regexp_full_match(user_id::VARCHAR, '1[0-4].?')) OR (event_type = 'error' AND user_id <> 3)"),
    "D38_stream_not": ({}, lambda: f.stream([("type", "not_in", ["click", "view"]), ("user", "!~", "[0-9]{2}")]),
                       "event_type NOT IN ('click', 'view') AND NOT regexp_full_match(user_id::VARCHAR, '[0-9]{2}')"),
    "D39_stream_id": ({}, lambda: f.stream_id(*STREAM_IDS), "event_type = 'click' AND user_id BETWEEN 10 AND 19"),
}

for _name, (_extra, _pred, _sql) in EVENTS.items():
    register(_name, f"WITH {LOGS} SELECT event_id, event_type FROM logs WHERE {_sql}")(
        lambda spark, sf, extra=_extra, pred=_pred: logs(spark, sf)
        .withColumns({n: F.expr(e) for n, e in extra.items()})
        .where(pred())
        .select("event_id", "event_type")
    )


@register("D15_in_query", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _in_query(spark, sf):
    sub = table(spark, sf, "customer").where(f.exact("c_mktsegment", "BUILDING"))
    return in_query(table(spark, sf, "orders"), "o_custkey", sub, "c_custkey").select("o_orderkey", "o_custkey")


@register("D15_not_in_query", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _not_in_query(spark, sf):
    sub = table(spark, sf, "orders").where(f.exact("o_orderstatus", "F"))
    return in_query(table(spark, sf, "customer"), "c_custkey", sub, "o_custkey", negate=True).select("c_custkey")


SUB = "sub AS (SELECT DISTINCT regexp_extract(text, '[a-z]{4,}') AS w FROM benchmark)"
MATCH = r"(length(d.text) > 0 AND regexp_matches(d.text, '(^|[^\p{L}\p{Nd}_])' || w || '($|[^\p{L}\p{Nd}_])'))"


def _words(spark, sf):
    return table(spark, sf, "benchmark").select(F.regexp_extract("text", "[a-z]{4,}", 0).alias("w"))


@register("D18_contains_any_query", f"WITH {SUB} SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM sub WHERE {MATCH})")
def _any_query(spark, sf):
    return contains_any_query(table(spark, sf, "documents"), "text", _words(spark, sf), "w").select("doc_id")


@register("D18_contains_any_query_join", f"WITH {SUB} SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM sub WHERE {MATCH})")
def _any_query_join(spark, sf):
    return contains_any_query(table(spark, sf, "documents"), "text", _words(spark, sf), "w", inline_limit=0).select("doc_id")


@register("D18_contains_all_query", r"""SELECT doc_id FROM documents d
 WHERE NOT EXISTS (SELECT 1 FROM region WHERE NOT regexp_matches(d.text, '(^|[^\p{L}\p{Nd}_])' || (CASE WHEN r_regionkey % 2 = 0 THEN 'the' ELSE 'and' END) || '($|[^\p{L}\p{Nd}_])'))""")
def _all_query(spark, sf):
    sub = table(spark, sf, "region").select(F.when(F.col("r_regionkey") % 2 == 0, "the").otherwise("and").alias("w"))
    return contains_all_query(table(spark, sf, "documents"), "text", sub, "w").select("doc_id")


@register("D40_stream_id_in_query", f"WITH {LOGS} SELECT event_id FROM logs WHERE stream IN (SELECT stream FROM logs WHERE value > 300)")
def _stream_ids(spark, sf):
    rows = logs(spark, sf)
    return stream_id_in_query(rows, rows.where(f.gt("value", 300)), "_stream_id").select("event_id")


@register("D41_any_field", f"WITH {LOGS} SELECT event_id FROM logs WHERE contains(event_type, '9') OR contains(event_id::VARCHAR, '9') OR event_id % 11 = 0")
def _any_field(spark, sf):
    rows = logs(spark, sf).withColumn("_extra", F.create_map(F.lit("event_tag"), F.when(F.col("event_id") % 11 == 0, "x9").otherwise("")))
    return rows.where(f.any_field(rows, "event_*", lambda c: f.substring(c, "9"))).select("event_id")


@register("B14_sort_key", "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_size, length(p_partkey::VARCHAR), p_partkey) AS pos FROM part")
def _sort_key(spark, sf):
    from skeinlog.operators.slices import Key, positioned

    rows = table(spark, sf, "part").withColumns({
        "size": F.concat(F.lit("size"), F.col("p_size")), "code": F.concat(F.lit("p-"), F.col("p_partkey"), F.lit("z"))})
    return positioned(rows, [], [Key(sort_key("size")), Key(sort_key("code"))], "pos").select("p_partkey", "p_name", F.col("pos").cast("bigint").alias("pos"))
