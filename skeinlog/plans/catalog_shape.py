"""Checked queries: row shape, math, coercion."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skeinlog.functions import coerce as k
from skeinlog.functions import filters as f
from skeinlog.functions import mathx as m
from skeinlog.model import stream_text
from skeinlog.operators import shape
from skeinlog.plans.tables import LOGS, logs, register, rounded, table


def _texts(spark, sf, **exprs):
    """Log rows with extra text fields."""
    return logs(spark, sf).withColumns({n: F.expr(e) for n, e in exprs.items()})


@register("E1_fields", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _fields(spark, sf):
    return shape.fields(table(spark, sf, "customer"), "c_cust*", "c_na*")


@register("E2_delete", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _delete(spark, sf):
    return shape.delete(table(spark, sf, "orders"), "o_orders*", "o_orderd*", "o_orderpriority")


@register("E3_rename", "SELECT s_suppkey AS id, s_name AS sup_name, s_nationkey AS sup_nationkey, s_acctbal AS bal FROM supplier")
def _rename(spark, sf):
    return shape.rename(table(spark, sf, "supplier"), {"s_suppkey": "id", "s_acctbal": "bal", "s_*": "sup_*"})


@register("E4_drop_empty_fields", "SELECT CASE WHEN event_id % 2 = 0 THEN event_type END AS a, CASE WHEN event_id % 3 = 0 THEN user_id::VARCHAR END AS b FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0")
def _drop_empty(spark, sf):
    rows = _texts(spark, sf, a="if(event_id % 2 = 0, event_type, '')", b="if(event_id % 3 = 0, cast(user_id as string), '')")
    return shape.drop_empty_fields(rows.select("a", "b"))


@register("E5_filter", "SELECT event_id FROM events WHERE value > 100 AND event_type = 'view'")
def _filter(spark, sf):
    return shape.filter(logs(spark, sf), f.and_(f.gt("value", 100), f.exact("event_type", "view"))).select("event_id")


@register("E6_format", """SELECT event_id, 'user <' || user_id || '> ' || upper(event_type) || ' "' || event_type || '" ' || to_hex(event_type::BLOB) AS out,
 CASE WHEN event_type = 'click' THEN 'c' || user_id ELSE event_type END AS event_type FROM events""")
def _format(spark, sf):
    rows = shape.format(logs(spark, sf), "user &lt;<user_id>&gt; <uc:event_type> <q:event_type> <hexencode:event_type>", "out")
    return shape.format(rows, "c<user_id>", "event_type", iff=f.exact("event_type", "click")).select("event_id", "out", "event_type")


@register("E6_format_numbers", """SELECT event_id, '10.' || user_id || '.0.1' AS ip, CASE WHEN user_id = 0 THEN '0' WHEN user_id < 60 THEN user_id || 's' WHEN user_id % 60 = 0 THEN (user_id // 60) || 'm'
 ELSE (user_id // 60) || 'm' || (user_id % 60) || 's' END AS took FROM events""")
def _format_numbers(spark, sf):
    rows = _texts(spark, sf, n="cast(167772161 + user_id * 65536 as string)", d="cast(user_id * 1000000000 as string)")
    return shape.format(shape.format(rows, "<ipv4:n>", "ip"), "<duration:d>", "took").select("event_id", "ip", "took")


@register("E7_extract", "SELECT event_id, event_type AS kind, user_id::VARCHAR AS u, value::VARCHAR AS v FROM events")
def _extract(spark, sf):
    return shape.extract(logs(spark, sf), "<kind> user=<u> value=<v>").select("event_id", "kind", "u", "v")


@register("E7_extract_quoted", """SELECT event_id, 'a "' || event_type || '"' AS name FROM events""")
def _extract_quoted(spark, sf):
    rows = _texts(spark, sf, line="""concat('id=', event_id, ' name="a \\\\"', event_type, '\\\\"" rest')""")
    return shape.extract(rows, "name=<name> <_>", "line").select("event_id", "name")


@register("E8_extract_regexp", r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, 'lang=.([a-z]+)', 1) AS lang FROM pages")
def _extract_regexp(spark, sf):
    rows = shape.extract_regexp(table(spark, sf, "pages"), "<title>(?P<title>[^<]*)</title>", "html")
    return shape.extract_regexp(rows, "lang=.(?P<lang>[a-z]+)", "html").select("page_id", "title", "lang")


@register("E9_replace", "SELECT doc_id, replace(text, 'the', 'THE') AS text FROM documents")
def _replace(spark, sf):
    return shape.replace(table(spark, sf, "documents"), "the", "THE", "text").select("doc_id", "text")


@register("E9_replace_limit", "SELECT event_id, regexp_replace(regexp_replace(event_type || ' ' || event_type || ' ' || event_type, 'c', 'K'), 'c', 'K') AS x FROM events")
def _replace_limit(spark, sf):
    rows = _texts(spark, sf, x="concat_ws(' ', event_type, event_type, event_type)")
    return shape.replace(rows, "c", "K", "x", limit=2).select("event_id", "x")


@register("E10_replace_regexp", r"SELECT doc_id, regexp_replace(text, '([a-z])([0-9]+)', '\2\1', 'g') AS text FROM documents")
def _replace_regexp(spark, sf):
    return shape.replace_regexp(table(spark, sf, "documents"), "([a-z])([0-9]+)", "$2$1", "text").select("doc_id", "text")


@register("E10_replace_regexp_many", r"SELECT event_id, regexp_replace(event_type || ' user=' || user_id || ' value=' || value, '\b([a-z])([a-z]*)', '\2<\1>', 'g') AS a FROM events")
def _replace_regexp_many(spark, sf):
    return shape.replace_regexp(_texts(spark, sf, a="_msg"), r"\b([a-z])([a-z]*)", "$2<$1>", "a", limit=50).select("event_id", "a")


@register("E10_replace_regexp_limit", r"SELECT event_id, regexp_replace(_msg, '([a-z]+)=', '[\1]') AS a, CASE WHEN event_type = 'click' THEN regexp_replace(_msg, '[aeiou]', '_') ELSE _msg END AS b FROM (SELECT *, event_type || ' user=' || user_id || ' value=' || value AS _msg FROM events)")
def _replace_regexp_limit(spark, sf):
    rows = _texts(spark, sf, a="_msg", b="_msg")
    rows = shape.replace_regexp(rows, "([a-z]+)=", "[$1]", "a", limit=1)
    return shape.replace_regexp(rows, "[aeiou]", "_", "b", limit=1, iff=f.exact("event_type", "click")).select("event_id", "a", "b")


@register("E11_collapse_nums", "SELECT event_id, event_type || ' user=<N> value=<N>.<N>' AS a, '<UUID> at <DATETIME> from <IP4>' AS b FROM events")
def _collapse(spark, sf):
    rows = _texts(spark, sf, b="""concat('2edfed59-3e98-4073-bbb2-28d321ca71a7 at ', date_format(_time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), ' from 10.1.2.', user_id)""", a="_msg")
    return shape.collapse_nums(shape.collapse_nums(rows, "a"), "b", prettify=True).select("event_id", "a", "b")


@register("E12_decolorize", "SELECT event_id, event_type || ' done' AS x FROM events")
def _decolorize(spark, sf):
    rows = _texts(spark, sf, x="concat(char(27), '[1;31m', event_type, char(27), '[0m done')")
    return shape.decolorize(rows, "x").select("event_id", "x")


@register("E13_len", "SELECT doc_id, strlen(text) AS n FROM documents")
def _len(spark, sf):
    return shape.len_(table(spark, sf, "documents"), "text", "n").select("doc_id", "n")


@register("E14_hash", "SELECT count(*) AS n, count(DISTINCT text) AS different FROM documents")
def _hash(spark, sf):
    """As many hashes as texts."""
    hashed = shape.hash_(table(spark, sf, "documents"), "text", "h")
    return hashed.agg(F.count("h").alias("n"), F.count_distinct("h").alias("different"))


@register("E15_json_array_len", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 4 END AS n FROM events")
def _array_len(spark, sf):
    rows = _texts(spark, sf, arr="if(event_id % 4 = 0, 'none', to_json(array_repeat(event_type, cast(event_id % 4 as int))))")
    return shape.json_array_len(rows, "arr", "n").select("event_id", "n")


@register("E16_pack_json", """SELECT event_id, '{' || CASE WHEN event_id % 2 = 0 THEN '"kind":"' || event_type || '",' ELSE '' END || '"user_id":"' || user_id || '"}' AS packed FROM events""")
def _pack_json(spark, sf):
    rows = _texts(spark, sf, kind="if(event_id % 2 = 0, event_type, '')").select("event_id", "kind", "user_id")
    return shape.pack_json(rows, ["kind", "user*"], "packed").select("event_id", "packed")


@register("E16_pack_json_typed", r"""SELECT event_id, '{"value":"' || regexp_replace(value::VARCHAR, '\.0$', '') || '","whole":"' || (event_id % 9) || '","_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS packed FROM events""")
def _pack_json_typed(spark, sf):
    rows = logs(spark, sf).withColumn("whole", (F.col("event_id") % 9).cast("double"))
    return shape.pack_json(rows, ["value", "whole", "_time"], "packed").select("event_id", "packed")


@register("E17_pack_logfmt", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'kind=' || event_type || ' ' ELSE '' END || 'note="a ' || event_type || '"' AS packed FROM events""")
def _pack_logfmt(spark, sf):
    rows = _texts(spark, sf, kind="if(event_id % 2 = 0, event_type, '')", note="concat('a ', event_type)").select("event_id", "kind", "note")
    return shape.pack_logfmt(rows, ["kind", "note"], "packed").select("event_id", "packed")


NESTED = """to_json(named_struct('k', get_json_object(props, '$.k'), 'who', named_struct('id', user_id, 'kind', event_type), 'tags', array(event_type, 'x')))"""


@register("E18_unpack_json", "SELECT event_id, props->>'k' AS k, user_id::VARCHAR AS \"who.id\" FROM events")
def _unpack_json(spark, sf):
    rows = _texts(spark, sf, doc=NESTED).select("event_id", "doc")
    return shape.unpack_json(rows, "doc", ["k", "who.id"]).drop("doc")


@register("E18_unpack_json_all", """SELECT event_id, props->>'k' AS j_k, user_id::VARCHAR AS "j_who.id", event_type AS "j_who.kind", '["' || event_type || '","x"]' AS j_tags FROM events""")
def _unpack_json_all(spark, sf):
    rows = _texts(spark, sf, doc=NESTED).select("event_id", "doc")
    return shape.unpack_json(rows, "doc", result_prefix="j_").drop("doc")


@register("E18_unpack_json_existing", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'keep' END AS level, CASE WHEN event_id % 2 = 1 THEN user_id::VARCHAR ELSE '' END AS other FROM events""")
def _unpack_json_existing(spark, sf):
    doc = "if(event_id % 2 = 0, concat('{\"level\":\"', event_type, '\"}'), concat('{\"other\":', user_id, '}'))"
    rows = _texts(spark, sf, level="'keep'", doc=doc).select("event_id", "level", "doc")
    return shape.unpack_json(rows, "doc").drop("doc")


@register("E18_unpack_json_deep", """SELECT event_id, user_id::VARCHAR AS "a.b.c.d.e.f.g", event_type AS "a.b.k", '{h' AS "a.b.c.t" FROM events""")
def _unpack_json_deep(spark, sf):
    """Seven levels, found in the data."""
    inner = "named_struct('t', '{h', 'd', named_struct('e', named_struct('f', named_struct('g', user_id))))"
    doc = f"to_json(named_struct('a', named_struct('b', named_struct('k', event_type, 'c', {inner}))))"
    return shape.unpack_json(_texts(spark, sf, doc=doc).select("event_id", "doc"), "doc").drop("doc")


def _numbers(spark, sf):
    doc = """concat('{"p":', event_id, '.50,"e":{"x":', event_id, 'e3},"t":"say \\\\"1.50\\\\" 2e5","l":[1.0,-0,"7.0"],"n":12345678901234567890123}')"""
    return _texts(spark, sf, doc=doc).select("event_id", "doc")


NUMBERS = """SELECT event_id, event_id || '.50' AS p, event_id || 'e3' AS "e.x", 'say "1.50" 2e5' AS t, '[1.0,-0,"7.0"]' AS l, '12345678901234567890123' AS n FROM events"""


@register("E18_unpack_json_numbers", NUMBERS)
def _unpack_json_numbers(spark, sf):
    """Numbers as they are written, alone and in lists."""
    return shape.unpack_json(_numbers(spark, sf), "doc").drop("doc")


@register("E18_unpack_json_numbers_named", NUMBERS)
def _unpack_json_numbers_named(spark, sf):
    return shape.unpack_json(_numbers(spark, sf), "doc", ["p", "e.x", "t", "l", "n"]).drop("doc")


@register("E19_unpack_logfmt_existing", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'keep' END AS level, CASE WHEN event_id % 2 = 1 THEN user_id::VARCHAR ELSE '' END AS other FROM events""")
def _unpack_logfmt_existing(spark, sf):
    line = "if(event_id % 2 = 0, concat('level=', event_type), concat('other=', user_id))"
    rows = _texts(spark, sf, level="'keep'", line=line).select("event_id", "level", "line")
    return shape.unpack_logfmt(rows, "line").drop("line")


@register("E18_unpack_json_preserve", """SELECT event_id, '{"id":' || user_id || ',"kind":"' || event_type || '"}' AS who FROM events""")
def _unpack_json_preserve(spark, sf):
    rows = _texts(spark, sf, doc=NESTED).select("event_id", "doc")
    return shape.unpack_json(rows, "doc", ["who"], preserve_keys=["who"]).drop("doc")


@register("E19_unpack_logfmt", "SELECT event_id, event_type AS kind, 'user ' || user_id AS who, CASE WHEN event_id % 2 = 0 THEN value::VARCHAR ELSE '' END AS v FROM events")
def _unpack_logfmt(spark, sf):
    rows = _texts(spark, sf, line="""concat('kind=', event_type, ' who="user ', user_id, '"', if(event_id % 2 = 0, concat(' v=', value), ''))""").select("event_id", "line")
    return shape.unpack_logfmt(rows, "line").drop("line")


@register("E20_unpack_syslog", """SELECT event_id, (event_id % 192)::VARCHAR AS priority, (event_id % 192 // 8)::VARCHAR AS facility, (event_id % 8)::VARCHAR AS severity,
 CASE WHEN event_id % 2 = 0 THEN 'rfc5424' ELSE 'rfc3164' END AS format, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS timestamp, 'host' || user_id AS hostname, event_type AS app_name,
 user_id::VARCHAR AS proc_id, CASE WHEN event_id % 2 = 0 THEN 'ID7' ELSE '' END AS msg_id, 'it is ' || event_type AS message FROM events""")
def _unpack_syslog(spark, sf):
    rows = _texts(spark, sf, line="""if(event_id % 2 = 0,
      concat('<', event_id % 192, '>1 ', date_format(_time, "yyyy-MM-dd'T'HH:mm:ss'.000Z'"), ' host', user_id, ' ', event_type, ' ', user_id, ' ID7 [ex@1 a="b c]"] it is ', event_type),
      concat('<', event_id % 192, '>', date_format(_time, 'MMM dd HH:mm:ss'), ' host', user_id, ' ', event_type, '[', user_id, ']: it is ', event_type))""")
    done = shape.unpack_syslog(rows, 2024, "line")
    return done.select("event_id", "priority", "facility", "severity", "format", "timestamp", "hostname", "app_name", "proc_id", "msg_id", "message")


@register("E21_unpack_words", r"""SELECT doc_id, CASE WHEN regexp_matches(text, '[\p{L}\p{Nd}_]') THEN '["' || array_to_string(regexp_extract_all(text, '[\p{L}\p{Nd}_]+'), '","') || '"]' ELSE '[]' END AS words, len(list_distinct(regexp_extract_all(text, '[\p{L}\p{Nd}_]+')))::BIGINT AS n FROM documents""")
def _unpack_words(spark, sf):
    rows = shape.unpack_words(table(spark, sf, "documents"), "text", "words")
    rows = shape.json_array_len(shape.unpack_words(rows, "text", "uniq", drop_duplicates=True), "uniq", "n")
    return rows.select("doc_id", "words", "n")


@register("E22_split", """SELECT o_orderkey, '["' || replace(o_orderpriority, '-', '","') || '"]' AS parts FROM orders""")
def _split(spark, sf):
    return shape.split(table(spark, sf, "orders"), "-", "o_orderpriority", "parts").select("o_orderkey", "parts")


@register("E23_unroll", """SELECT event_id, event_type AS a, 'x' AS b FROM events UNION ALL SELECT event_id, user_id::VARCHAR, '' FROM events""")
def _unroll(spark, sf):
    rows = _texts(spark, sf, a="to_json(array(event_type, cast(user_id as string)))", b="""'["x"]'""")
    return shape.unroll(rows, "a", "b").select("event_id", "a", "b")


@register("E24_time_add", "SELECT event_id, strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events")
def _time_add(spark, sf):
    rows = shape.time_add(logs(spark, sf), "1h30m")
    return rows.select("event_id", F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"))


@register("E25_set_stream_fields", """SELECT event_id, CASE WHEN event_type = 'click' THEN '{type="click",user="' || user_id || '"}' ELSE '{event_type="' || event_type || '"}' END AS s FROM events""")
def _set_stream(spark, sf):
    rows = shape.set_stream_fields(logs(spark, sf), "event_type", iff=f.not_(f.exact("event_type", "click")))
    return rows.select("event_id", stream_text().alias("s"))


@register("E26_math", "SELECT event_id, round(value * 2 + user_id, 6) AS a, round((value * 2 + user_id) / 4, 6) AS b FROM events")
def _math(spark, sf):
    rows = shape.math_(logs(spark, sf), a=m.add(m.mul(F.col("value"), 2), F.col("user_id")), b=m.div(F.col("a"), 4))
    return rounded(rows.select("event_id", "a", "b"), 6, "a", "b")


@register("E27_value_type_profile", """SELECT 'v' AS field_name, CASE event_id % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'uint64' WHEN 2 THEN 'int64' WHEN 3 THEN 'ipv4' ELSE 'string' END AS kind, count(*) AS hits FROM events GROUP BY 2
 UNION ALL SELECT 'w', 'float64', count(*) FROM events""")
def _profile(spark, sf):
    rows = _texts(spark, sf, w="cast(value as string)", v="""case event_id % 5 when 0 then '' when 1 then cast(user_id as string) when 2 then concat('-', user_id + 1)
      when 3 then concat('10.0.0.', user_id) else event_type end""")
    return shape.value_type_profile(rows.select("v", "w"))


# ---- math: name, expression, SQL over value (double), user_id and event_id (bigint) -------

V, U, N = (lambda: F.col("value")), (lambda: F.col("user_id")), (lambda: F.col("event_id"))
MATH = {
    "J1_pow": (lambda: m.pow_(V(), 1.5), "pow(value, 1.5)"),
    "J2_mul": (lambda: m.mul(V(), U()), "value * user_id"),
    "J3_div": (lambda: m.div(V(), U()), "CASE WHEN user_id <> 0 THEN value / user_id END"),
    "J4_mod": (lambda: m.mod(m.sub(U(), 75), 7), "(user_id - 75) % 7"),
    "J4_mod_zero": (lambda: m.mod(V(), U()), "CASE WHEN user_id <> 0 THEN fmod(value, user_id) END"),
    "J5_add": (lambda: m.add(V(), U()), "value + user_id"),
    "J6_sub": (lambda: m.sub(V(), U()), "value - user_id"),
    "J7_bit_and": (lambda: m.bit_and(U(), N()), "(user_id & event_id)::DOUBLE"),
    "J8_bit_xor": (lambda: m.bit_xor(U(), N()), "xor(user_id, event_id)::DOUBLE"),
    "J9_bit_or": (lambda: m.bit_or(V(), N()), "(trunc(value)::BIGINT | event_id)::DOUBLE"),
    "J10_default": (lambda: m.default(m.div(V(), m.mod(U(), 2)), -1), "CASE WHEN user_id % 2 <> 0 THEN value ELSE -1 END"),
    "J11_abs": (lambda: m.abs_(m.sub(V(), 50)), "abs(value - 50)"),
    "J12_exp": (lambda: m.exp(m.div(U(), 100)), "exp(user_id / 100)"),
    "J13_ln": (lambda: m.ln(m.sub(V(), 10)), "CASE WHEN value - 10 > 0 THEN ln(value - 10) END"),
    "J14_max": (lambda: m.max_(V(), U(), m.div(N(), m.mod(N(), 3))), "greatest(value, user_id, CASE WHEN event_id % 3 <> 0 THEN event_id / (event_id % 3) END)"),
    "J15_min": (lambda: m.min_(V(), U(), m.div(N(), m.mod(N(), 3))), "least(value, user_id, CASE WHEN event_id % 3 <> 0 THEN event_id / (event_id % 3) END)"),
    "J16_round": (lambda: m.round_(m.sub(V(), 100)), "round(value - 100)"),
    "J16_round_nearest": (lambda: m.round_(V(), 0.25), "round(value / 0.25) * 0.25"),
    "J17_ceil": (lambda: m.ceil(m.sub(V(), 100)), "ceil(value - 100)"),
    "J18_floor": (lambda: m.floor(m.sub(V(), 100)), "floor(value - 100)"),
    "J19_neg": (lambda: m.neg(V()), "-value"),
}
for _name, (_expr, _sql) in MATH.items():
    _digits = 10 if _name == "J3_div" else 6  # ten digits hold these quotients without a tie
    register(_name, f"SELECT event_id, round(({_sql})::DOUBLE, {_digits}) AS r FROM events")(
        lambda spark, sf, e=_expr, d=_digits: rounded(shape.math_(logs(spark, sf), r=e).select("event_id", "r"), d, "r")
    )


@register("J20_rand", "SELECT count(*) AS n, count(*) AS different, true AS inside FROM events")
def _rand(spark, sf):
    """A number of its own in [0, 1) for every row."""
    drawn = shape.math_(logs(spark, sf), r=m.rand(5)).select("r")
    inside = F.bool_and((F.col("r") >= 0) & (F.col("r") < 1))
    return drawn.agg(F.count("r").alias("n"), F.count_distinct("r").alias("different"), inside.alias("inside"))


@register("J21_now", "SELECT event_id, 1705708800000000000::DOUBLE AS r FROM events")
def _now(spark, sf):
    return shape.math_(logs(spark, sf), r=m.now(datetime(2024, 1, 20))).select("event_id", "r")


# ---- coercion: text expression, function, SQL -------------------------------

KINDS = {
    "K1_num": ("case event_id % 5 when 0 then cast(value as string) when 1 then concat(user_id, 'ms') when 2 then concat(user_id, 'KiB') when 3 then concat('0x', hex(user_id)) else event_type end",
               lambda: k.num("t"), "CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN user_id * 1000000 WHEN 2 THEN user_id * 1024 WHEN 3 THEN user_id END"),
    "K2_duration_ns": ("if(event_id % 7 = 0, event_type, concat(if(event_id % 2 = 0, '-', ''), user_id, 'h', event_id % 60, 'm1.5s', user_id, 'µs'))",
                       lambda: k.duration_ns("t"), "CASE WHEN event_id % 7 <> 0 THEN (CASE WHEN event_id % 2 = 0 THEN -1 ELSE 1 END) * (user_id * 3600000000000 + (event_id % 60) * 60000000000 + 1500000000 + user_id * 1000) END"),
    "K3_bytes": ("case event_id % 4 when 0 then concat(user_id, '.5KiB') when 1 then concat(user_id, 'MB') when 2 then concat(user_id, '.5') else cast(user_id as string) end",
                 lambda: k.bytes_("t"), "CASE event_id % 4 WHEN 0 THEN user_id * 1024 + 512 WHEN 1 THEN user_id * 1000000 WHEN 3 THEN user_id END"),
    "K4_ipv4_num": ("concat_ws('.', 10, user_id * 2, event_id % 256, 7)", lambda: k.ipv4_num("t"), "CASE WHEN user_id * 2 <= 255 THEN 167772160 + user_id * 2 * 65536 + (event_id % 256) * 256 + 7 END"),
    "K5_ts_ns": ("""concat(date_format(_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '789', if(event_id % 2 = 0, 'Z', '+01:00'))""",
                 lambda: k.ts_ns("t"), "epoch_us(ts) * 1000 + 789 - CASE WHEN event_id % 2 = 0 THEN 0 ELSE 3600000000000 END"),
}
for _name, (_text, _expr, _sql) in KINDS.items():
    _type = "DOUBLE" if _name == "K1_num" else "BIGINT"
    register(_name, f"SELECT event_id, ({_sql})::{_type} AS r FROM events")(
        lambda spark, sf, t=_text, e=_expr: _texts(spark, sf, t=t).select("event_id", e().alias("r"))
    )


@register("K_coerce", "SELECT event_id, user_id * 1000000 AS took, CASE WHEN event_id % 3 <> 0 THEN user_id * 1000 END AS size FROM events")
def _coerce(spark, sf):
    rows = _texts(spark, sf, took="concat(user_id, 'ms')", size="if(event_id % 3 = 0, 'unknown', concat(user_id, 'KB'))")
    return k.coerce(rows.select("event_id", "took", "size"), {"took": "duration", "size": "bytes"})


@register("K6_duration_text", """SELECT event_id, CASE WHEN user_id = 0 THEN '' ELSE user_id || 'w' END || '1d2h3m4.5s' AS a, CASE WHEN user_id = 0 THEN '7µs' ELSE user_id || 'ms7µs' END AS b FROM events""")
def _duration_text(spark, sf):
    user = F.col("user_id").cast("decimal(20,0)")  # 15,251 weeks are more nanoseconds than 64 bits hold
    long = user * 604800000000000 + 93784500000000
    return logs(spark, sf).select("event_id", k.duration_text(long).alias("a"), k.duration_text(user * 1000000 + 7000).alias("b"))


@register("K7_float_text", "SELECT event_id, regexp_replace(value::VARCHAR, '\\.0$', '') AS a, user_id || CASE WHEN user_id = 0 THEN '' ELSE '0000000' END AS b FROM events")
def _float_text(spark, sf):
    return logs(spark, sf).select("event_id", k.float_text(F.col("value")).alias("a"), k.float_text(F.col("user_id") * 1e7).alias("b"))
