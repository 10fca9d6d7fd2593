"""Reading tables, cutting lineage, and the registry of this package's queries."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def reachable(spark: SparkSession) -> None:
    """Lets Python workers find this package wherever the session was started; a cluster has it installed or shipped."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    reachable(spark)
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, as in tests, a temporary one of a local session."""
    reachable(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="skeinlog-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read again: lost executors cannot change them, nothing runs twice."""
    path = f"{shared_folder(df.sparkSession)}/skeinlog-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doc_key(text: str = "text") -> Column:
    """Tells the texts of one id apart; null and empty differ from each other no more than their results do."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def with_versions(docs: DataFrame, doc: str = "doc", version: str = "version") -> DataFrame:
    """docs (doc_id, text) with doc, the id as a long not null, and version, which tells the texts of one doc apart.

    A doc with one text has version 0. Each text of the others has a number of its own, dealt in order of doc_key over a
    written table of distinct texts' digests, so that no two share one, however many texts an id (or null) has.
    """
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    texts = cut(keyed.select(F.col(doc).alias("__id"), doc_key().alias("__key"), digest.alias("__digest")).distinct())
    several = cut(texts.groupBy("__id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__id"))
    alone = keyed.withColumn(version, F.lit(0).cast("long"))
    if not several.take(1):
        return alone
    numbers = cut(
        texts.join(several, "__id", "left_semi").orderBy("__id", "__key", "__digest").withColumn("__number", F.monotonically_increasing_id())
    )
    shared = keyed.withColumn("__sha", digest).join(numbers, (F.col(doc) == F.col("__id")) & (F.col("__sha") == F.col("__digest")))
    # with numbers that are too many to broadcast the texts are moved: once, whoever reads them
    shared = cut(shared.withColumn(version, F.col("__number")).select(alone.columns))
    return alone.join(several, F.col(doc) == F.col("__id"), "left_anti").union(shared)


def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Equality of keys that may be null."""
    on = [left[k].eqNullSafe(right[k]) for k in keys]
    out = on[0]
    for x in on[1:]:
        out = out & x
    return out
