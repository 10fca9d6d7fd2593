"""Joins, unions and subquery filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinlog.functions.coerce import text_of
from skeinlog.functions.filters import WORD, and_, any_phrase, phrase
from skeinlog.model import STREAM_ID, col, field_name, out, quoted, val
from skeinlog.operators.slices import durable

INLINE_LIMIT = 1000


def inline_rows(spark: SparkSession, rows: Sequence[dict[str, str]]) -> DataFrame:
    """Literal rows; a field that a row lacks is null."""
    names = list(dict.fromkeys(n for r in rows for n in r))
    schema = ", ".join(f"{quoted(n)} string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def generate_sequence(spark: SparkSession, n: int) -> DataFrame:
    """Rows 0 to n-1 in the message field, made by the executors."""
    return spark.range(n).select(F.col("id").cast("string").alias("_msg"))


def join(
    df: DataFrame,
    by: Sequence[str],
    right: DataFrame | None = None,
    rows: Sequence[dict[str, str]] | None = None,
    inner: bool = False,
    prefix: str = "",
) -> DataFrame:
    """Add the fields of matching right rows; without a prefix a right value wins over a left one.

    Keys are compared as log text, so a missing key equals an empty one, and the
    double 5.0 meets the text 5. The join strategy is left to the optimizer and
    adaptive execution, which know the size of either side.
    """
    if (right is None) == (rows is None):
        raise ValueError("give either a right table or inline rows")
    keys = [field_name(b) for b in by]
    if rows is not None:
        right = inline_rows(df.sparkSession, rows)
    fields = [c for c in right.columns if c not in keys]
    side = right.select(*[text_of(right, k).alias(f"__k{i}") for i, k in enumerate(keys)], *[col(c).alias(f"__r_{c}") for c in fields])
    cond = None
    for i, k in enumerate(keys):
        one = text_of(df, k) == F.col(f"__k{i}")
        cond = one if cond is None else cond & one
    joined = df.join(side, cond, "inner" if inner else "left")
    target = {c: prefix + c for c in fields}
    columns = []
    for c in df.columns:
        source = next((f for f, t in target.items() if t == c), None)
        columns.append(_prefer(_filled(right, source), col(c), right.schema[source].dataType, df.schema[c].dataType).alias(c) if source else col(c))
    columns += [F.col(quoted(f"__r_{f}")).alias(t) for f, t in target.items() if t not in df.columns]
    return joined.select(*columns)


def _prefer(right: Column, left: Column, right_type, left_type) -> Column:
    """Right value if there is one; columns of different types meet as text."""
    if right_type != left_type:
        right, left = right.cast("string"), left.cast("string")
    return F.coalesce(right, left)


def _filled(right: DataFrame, name: str) -> Column:
    c = F.col(quoted(f"__r_{name}"))
    return out(c) if right.schema[name].dataType.simpleString() == "string" else c


def union(df: DataFrame, other: DataFrame | None = None, rows: Sequence[dict[str, str]] | None = None) -> DataFrame:
    """Append the rows of a second query, or inline rows; duplicates stay."""
    other = inline_rows(df.sparkSession, rows) if rows is not None else other
    return df.unionByName(other, allowMissingColumns=True)


def _sub_values(sub: DataFrame, field: str | None) -> DataFrame:
    """Distinct values of the subquery's field; the last column if none is named."""
    return sub.select(text_of(sub, field or sub.columns[-1]).alias("__v")).distinct()


def in_query(df: DataFrame, f: str, sub: DataFrame, sub_field: str | None = None, negate: bool = False) -> DataFrame:
    """Keep the rows whose value appears (or does not appear) in a subquery."""
    return df.join(_sub_values(sub, sub_field), text_of(df, f) == F.col("__v"), "left_anti" if negate else "left_semi")


def stream_id_in_query(df: DataFrame, sub: DataFrame, sub_field: str | None = None, negate: bool = False) -> DataFrame:
    return in_query(df, STREAM_ID, sub, sub_field, negate)


def _phrase_query(df: DataFrame, f: str, sub: DataFrame, sub_field: str | None, every: bool, inline_limit: int) -> DataFrame:
    values = _sub_values(sub, sub_field)
    few = [r[0] for r in values.limit(inline_limit + 1).collect()]
    if len(few) > inline_limit:
        return _word_join(df, f, values, every)
    if every:
        return df.where(and_(*[phrase(f, p) for p in few]))
    return df.where(any_phrase(f, few))


# Phrases are joined on all their words (or characters, if they hold no word); longer ones on so many first ones.
_WORD_RUN, _CHAR_RUN = 64, 16


def _runs(tokens: Column, n: int, sep: str) -> Column:
    """Runs of n tokens by place: doubled by pairing the array with itself, shifted; two that overlap make up the rest."""
    runs, have = tokens, 1
    while have < n:
        step = min(have, n - have)
        runs = F.zip_with(runs, F.slice(runs, step + 1, F.size(runs)), lambda a, b: F.concat(a, F.lit(sep), b))
        have += step
    return F.array_compact(runs)


def _word_join(df: DataFrame, f: str, phrases: DataFrame, every: bool) -> DataFrame:
    """Match against any number of phrases by equality joins, never all pairs.

    A phrase is keyed by the run of its words; a text offers every run of that
    length once. So phrases that only begin alike have different keys, and what
    the join puts out is hits but for punctuation, confirmed on the whole text.
    There is one pass for each length that phrases have.
    """
    words = lambda c: F.regexp_extract_all(c, F.lit(f"{WORD}+"), F.lit(0))
    tokens = {"w": (words, " ", _WORD_RUN), "c": (lambda c: F.split(c, ""), "", _CHAR_RUN)}
    listed = phrases.withColumn("__kind", F.when(F.col("__v") == "", "e").when(F.size(words(F.col("__v"))) > 0, "w").otherwise("c"))
    rows = durable(df.withColumns({"__row": F.monotonically_increasing_id(), "__text": val(f)}))
    texts = rows.select("__row", "__text")
    empty = listed.where(F.col("__kind") == "e").select("__v")
    found = texts.where(F.col("__text") == "").join(empty, F.col("__text") == F.col("__v")).select("__row", "__v")
    for kind, (split, sep, most) in tokens.items():
        some = listed.where(F.col("__kind") == kind).withColumn("__t", split(F.col("__v")))
        some = some.withColumn("__n", F.least(F.size("__t"), F.lit(most)))
        used = [r[0] for r in some.select("__n").distinct().collect()]  # at most one entry per run length
        for n in sorted(used):
            # Only row numbers and keys are multiplied; the text is joined back for candidates alone.
            offered = texts.select("__row", F.explode(F.array_distinct(_runs(split(F.col("__text")), n, sep))).alias("__key"))
            keyed = some.where(F.col("__n") == n).select("__v", F.get(_runs(F.col("__t"), n, sep), F.lit(0)).alias("__key"))
            pairs = offered.join(keyed, "__key")
            if kind == "w" and n == 1:
                found = found.unionByName(pairs.where(F.col("__v") == F.col("__key")).select("__row", "__v"))
                pairs = pairs.where(F.col("__v") != F.col("__key"))
            checked = pairs.select("__row", "__v").join(texts, "__row").where(_holds(F.col("__text"), F.col("__v")))
            found = found.unionByName(checked.select("__row", "__v"))
    if every:
        need = phrases.agg(F.count(F.lit(1)).alias("__have"))
        full = found.distinct().groupBy("__row").agg(F.count(F.lit(1)).alias("__have"))
        matched = full.join(need, "__have", "left_semi").select("__row")
    else:
        matched = found.select("__row").distinct()
    return rows.join(matched, "__row", "left_semi").drop("__row", "__text")


def _holds(text: Column, phrase: Column) -> Column:
    """Bounded containment where the phrase is a column: the pattern is built per row."""
    escaped = F.regexp_replace(phrase, r"([\\.\[\]{}()*+?^$|/-])", r"\\$1")
    head = F.when(phrase.rlike(f"^{WORD}"), F.lit(f"(?<!{WORD})")).otherwise("")
    tail = F.when(phrase.rlike(rf"{WORD}\z"), F.lit(f"(?!{WORD})")).otherwise("")
    return text.contains(phrase) & F.regexp_like(text, F.concat(head, escaped, tail))


def contains_any_query(df: DataFrame, f: str, sub: DataFrame, sub_field: str | None = None, inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """Rows that contain some phrase of a subquery.

    Up to ``inline_limit`` phrases become one regex; more are matched by a join on words.
    """
    return _phrase_query(df, f, sub, sub_field, False, inline_limit)


def contains_all_query(df: DataFrame, f: str, sub: DataFrame, sub_field: str | None = None, inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """Rows that contain every phrase of a subquery."""
    return _phrase_query(df, f, sub, sub_field, True, inline_limit)
