"""Readers of log lines and of the answer shapes of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType


# ---- fixed values: answer shapes -------------------------------------------
VECTOR = "status string, data struct<resultType: string, result: array<struct<metric: map<string,string>, value: array<string>>>>"
MATRIX = "status string, data struct<resultType: string, result: array<struct<metric: map<string,string>, values: array<array<string>>>>>"
HITS = "hits array<struct<fields: map<string,string>, timestamps: array<string>, values: array<bigint>, total: bigint>>"
VALUES = "values array<struct<value: string, hits: bigint>>"
FACETS = "facets array<struct<field_name: string, values: array<struct<field_value: string, hits: bigint>>>>"
#: Column of the fields of a line that its schema does not name.
EXTRA = "_extra"
# ----------------------------------------------------------------------------


def read_ndjson(
    spark: SparkSession, path: str | list[str], schema: str | None = None, seen: Observation | None = None
) -> DataFrame:
    """One JSON object per line. Give a schema to spare a pass over the data.

    With a schema, a value that does not fit its field's type is null, and only lines that hold no JSON object are
    dropped. The map _extra keeps, as text, the fields that the schema does not name and the values that did not fit
    (null where there are none; parts of an array or object that do not fit are null in it). An action on the result fills seen with lines and dropped, the counts of lines that are
    not blank and of those dropped. Without a schema broken lines are dropped uncounted, and no field is lost.
    """
    if not schema:
        if seen is not None:
            raise ValueError("lines are only counted with a schema")
        return spark.read.json(path, mode="DROPMALFORMED")
    types = StructType.fromDDL(schema)
    if EXTRA in types.names:
        raise ValueError(f"{EXTRA} is the name of the map of other fields")
    held = [F.from_json("value", "map<string,string>").alias("held"), F.from_json("value", types).alias("fit")]
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S")).select(held)
    counts = [F.count(F.lit(1)).alias("lines"), F.count_if(F.col("held").isNull()).alias("dropped")]
    if seen is not None:
        lines = lines.observe(seen, *counts)

    def typed(field: StructField) -> Column:
        fit = F.col("fit").getField(field.name)
        if isinstance(field.dataType, ArrayType | MapType | StructType):
            return fit
        text = F.get(F.map_values(F.map_filter("held", lambda k, _: k == field.name)), F.lit(0))
        return F.coalesce(fit, text.try_cast(field.dataType))

    known = lines.where("held IS NOT NULL").select("held", F.struct(*[typed(f).alias(f.name) for f in types]).alias("row"))
    unfit = F.array_compact(F.array(*[F.when(F.col("row").getField(f.name).isNull(), F.lit(f.name)) for f in types]))
    named = F.array(*[F.lit(f.name) for f in types])
    extra = F.map_filter("held", lambda k, v: ~F.array_contains(named, k) | (F.array_contains(unfit, k) & v.isNotNull()))
    return known.select("row.*", F.when(F.size(extra) > 0, extra).alias(EXTRA))


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)


def _answers(spark: SparkSession, path, schema: str, multi_line: bool = False) -> DataFrame:
    """One answer per line, or one per file with ``multi_line``; broken answers are dropped."""
    return spark.read.schema(schema).json(path, multiLine=multi_line, mode="DROPMALFORMED")


def vector_points(answers: DataFrame) -> DataFrame:
    rows = answers.select(F.explode("data.result").alias("s"))
    return rows.select(
        F.col("s.metric").alias("metric"), F.get("s.value", F.lit(0)).try_cast("double").alias("ts"), F.get("s.value", F.lit(1)).alias("value")
    )


def matrix_points(answers: DataFrame) -> DataFrame:
    """One row per series and time; pairs that are no (number, text) are skipped."""
    series = answers.select(F.explode("data.result").alias("s")).select("s.metric", F.explode("s.values").alias("p"))
    points = series.select("metric", F.get("p", F.lit(0)).try_cast("double").alias("ts"), F.get("p", F.lit(1)).alias("value"))
    return points.where(F.col("ts").isNotNull() & F.col("value").isNotNull())


def read_vector(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    return vector_points(_answers(spark, path, VECTOR, multi_line))


def read_matrix(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    return matrix_points(_answers(spark, path, MATRIX, multi_line))


def read_hits(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Series rows: fields, timestamps, values, total."""
    return _answers(spark, path, HITS, multi_line).select(F.explode("hits").alias("h")).select("h.*")


def hit_points(series: DataFrame) -> DataFrame:
    """One row per series and time; a missing value is null."""
    rows = series.select("fields", F.explode(F.arrays_zip("timestamps", "values")).alias("p"))
    return rows.select("fields", F.col("p.timestamps").alias("ts"), F.col("p.values").alias("value"))


def read_values(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    return _answers(spark, path, VALUES, multi_line).select(F.explode("values").alias("v")).select("v.*")


def read_facets(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    rows = _answers(spark, path, FACETS, multi_line).select(F.explode("facets").alias("f"))
    return rows.select("f.field_name", F.explode("f.values").alias("v")).select("field_name", "v.*")


def parse_lines(df: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """Decode a column of answer texts with one of the shapes above; text that does not parse gives no row."""
    parsed = F.from_json(F.col(text), schema)
    return df.select(parsed.alias("a")).where(F.col("a").isNotNull()).select("a.*")


