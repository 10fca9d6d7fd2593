"""One query for each operator, over its whole table, with the SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinlog.llm import (
    decontaminate,
    lexical,
    line_dedup,
    lm,
    near_dedup,
    ngram_join,
    packing,
    pii,
    quality,
    sharding,
    substring_dedup,
    urls,
    whitening,
)
from skeinlog.llm.common import QUERIES, SQL, cut, register, shared_folder, table

__all__ = ["QUERIES", "SQL"]


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op1_packing")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents", "doc_id", "text"), *tokenizer_paths())


@register("op2_pii")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf, "documents", "doc_id", "text"))

    def text(spans: str) -> F.Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))

    kinds = F.transform("base", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


@register("op3_line_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_OP4 = """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
firsts AS (SELECT g, min({'d': doc_id, 's': s}) AS f FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p
 FROM win JOIN firsts USING (g) WHERE {'d': doc_id, 's': s} > f)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@register("op4_substring_dedup", _OP4)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_quality_rules")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    judged = quality.judge(cut(quality.quality_stats(docs).drop("text")))
    return judged.select(
        "doc_id", *[F.col(f"stats.{c}").alias(c) for c in quality.STATS[:5]], "base_failed", "kept", "p_good",
    )


@register("op6_lm_scoring")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_documents(table(spark, sf, "documents", "doc_id", "text"))


@register("op7_minhash_dedup")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents", "doc_id", "text"), 85).drop("version")


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_OP8 = """WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{U}', '{L}'), '{W}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{U}', '{L}'), '{W}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, w[s:s + least(10, len(w)) - 1] AS g
 FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, s, w[s:s + n - 1] AS g
 FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw))),
hit AS (SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN iw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
 sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""".format(U=urls.UPPER, L=urls.LOWER, W=_ALNUM)


@register("op8_decontamination", _OP8)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    out = decontaminate.contamination(docs, items)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_OP9 = """WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
 FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{U}', '{L}') AS host,
 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules (rhost, rpath, told) AS (VALUES {R}),
best AS (SELECT s.page_id, s.host, s.path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
 arg_max(told, length(rhost || rpath)) AS told
 FROM split s LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
 GROUP BY ALL)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(told, 'allow') AS verdict FROM best""".format(
    U=urls.UPPER, L=urls.LOWER, R=", ".join(str(r) for r in URL_RULES)
)


@register("op9_url_filter", _OP9)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = urls.filter_urls(table(spark, sf, "pages", "page_id", "url"), rules)
    return out.select("page_id", "host", "path", "rule", "verdict")


@register("op10_sharding")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    docs = docs.withColumn("n_bytes", sharding.row_bytes(docs))
    path = f"{shared_folder(spark)}/skeinlog-shards-{uuid.uuid4().hex}"
    sharding.write_shards(sharding.shard(docs, ["doc_id"], F.col("n_bytes")).select(*docs.columns, "shard"), path)
    # what was written, not what was planned
    schema = docs.schema.add("shard", "string")
    rows = spark.read.schema(schema).parquet(path).select("doc_id", "n_bytes", "shard")
    totals = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return rows.join(totals, "shard").select(
        "doc_id", "n_bytes", "shard", (F.length("shard") - 1).alias("shard_bits"), "shard_bytes", "shard_rows"
    )


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_OP11 = """WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{U}', '{L}'), '{W}') AS t FROM documents),
tf AS (SELECT doc_id, len(t)::BIGINT AS n, x, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS x FROM d) GROUP BY ALL),
al AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
df AS (SELECT x, count(*) AS df FROM tf GROUP BY x),
w AS (SELECT x, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, al),
q AS (SELECT item_id, x, count(*) AS r FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{U}', '{L}'), '{W}')) AS x
 FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
 FROM q JOIN w USING (x) JOIN tf USING (x), al GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""".format(U=urls.UPPER, L=urls.LOWER, W=_TERM)


@register("op11_lexical_search", _OP11)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text")
    return lexical.search(docs, items)


@register("op12_whitening")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf, "embeddings", "vec_id", "embedding"))
    return out.select(
        F.col("row.vec_id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened",
        "explained", "identity_error",
    )


_LINKED = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{U}', '{L}'), '[^\\x20\\x09-\\x0D]+') AS t
 FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < {K} THEN [array_to_string(t, ' ')]
 ELSE [array_to_string(t[i:i + {K} - 1], ' ') for i in range(1, len(t) - {K} + 2)] END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {P} * (x.n + y.n - c)),
r (d, k) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.d, l.b FROM r JOIN l ON r.k = l.a)
SELECT d AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(k) AS component_id{MORE}
FROM r LEFT JOIN n ON n.doc_id = d GROUP BY d"""


@register("op13_ngram_join", _LINKED.format(U=urls.UPPER, L=urls.LOWER, K=3, P=90, MORE=""))
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf, "documents", "doc_id", "text"), 90)
