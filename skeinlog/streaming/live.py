"""Live queries on Structured Streaming.

Aggregates that change are written as upserts: every micro-batch writes the
rows it changed as a run of its own number (``runs.py``). A batch that is repeated
after a failure writes it again, and a reader takes the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skeinlog.functions.aggs import Stat, count
from skeinlog.functions.timespan import duration
from skeinlog.model import CLUSTER, TIME, attach, col, field_name, group_key, quoted
from skeinlog.operators.merge import _merged
from skeinlog.operators.order import sort_keys
from skeinlog.operators.slices import is_hot, running
from skeinlog.operators.stats import keyed
from skeinlog.operators.windows import RunningStat, _scalar
from skeinlog.sources.federation import row_content
from skeinlog.streaming.runs import EVERY, Runs

Pipe = Callable[[DataFrame], DataFrame]
BATCH = "_batch"


def _spark_interval(value) -> str:
    return f"{duration(value) // 1000} microseconds"


def tail(sdf: DataFrame, *row_pipes: Pipe) -> DataFrame:
    """Row-wise pipes on a live stream; no cap."""
    for pipe in row_pipes:
        sdf = sdf.transform(pipe)
    return sdf


def stream_union(sources: dict[str, DataFrame]) -> DataFrame:
    """Several live sources as one, tagged with their names."""
    tagged = [s.withColumn(CLUSTER, F.lit(name)) for name, s in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stream_stats(
    sdf: DataFrame, by: Sequence[str], step, aggs: dict[str, Stat], late="1h", slide=None, at: str = TIME
) -> DataFrame:
    """Statistics per time window, kept up to date; rows later than ``late`` are left out.

    Only functions with state of fixed size fit a stream.
    """
    bad = [n for n, a in aggs.items() if a.direct is None]
    if bad:
        raise ValueError(f"no bounded state on a stream: {bad}")
    window = F.window(col(at), _spark_interval(step), _spark_interval(slide) if slide else None)
    marked = sdf.withWatermark(field_name(at), _spark_interval(late))
    keys = [group_key(sdf, b).alias(field_name(b)) for b in by]
    grouped = marked.groupBy(window.alias("__w"), *keys).agg(*[a.column(sdf).alias(n) for n, a in aggs.items()])
    return grouped.select(F.col("__w.start").alias("ts"), *[col(field_name(b)) for b in by], *[col(n) for n in aggs])


def stream_hits(sdf: DataFrame, step, fields: Sequence[str] = (), late="1h", at: str = TIME) -> DataFrame:
    """Rows per time bucket and field set, kept up to date."""
    return stream_stats(sdf, fields, step, {"value": count()}, late, at=at)


def stream_merge_partials(sdf: DataFrame, by: Sequence[str], funcs: dict[str, str | Stat], ts: str = "ts", late="1h") -> DataFrame:
    """Partial results of clusters merged by (by, ts) as they arrive."""
    marked = sdf.withWatermark(ts, _spark_interval(late))
    keys = [group_key(sdf, b).alias(field_name(b)) for b in by]
    return marked.groupBy(*keys, col(ts)).agg(*[_merged(sdf, r, f).alias(r) for r, f in funcs.items()])


def stream_dedup_replicas(
    sdf: DataFrame, late="1h", keys: Sequence[str] | None = None, at: str = TIME, replica: str | None = None
) -> DataFrame:
    """Rows that replicas deliver within ``late`` of each other, folded as ``dedup_replicas`` does.

    Without ``replica`` the first of equal rows (all columns, or ``keys``) passes at once. With it, rows are counted by
    (row, replica) until the watermark has passed their time; then each goes out as often as its richest replica has it.
    """
    marked = sdf.withWatermark(field_name(at), _spark_interval(late))
    if keys:
        return marked.dropDuplicatesWithinWatermark([k for k in keys if k in sdf.columns])
    content = row_content(sdf, [c for c in (replica, field_name(at)) if c])
    rows = marked.withColumns(content)
    if not replica:
        return rows.dropDuplicatesWithinWatermark([*content, field_name(at)]).drop(*content)
    names = [c for c in sdf.columns if c not in (replica, field_name(at))]
    by = [*content, col(at)]
    first = lambda source: [F.first(F.col(quoted(source(i, n)))).alias(f"__v{i}") for i, n in enumerate(names)]
    held = rows.groupBy(*by, col(replica)).agg(F.count(F.lit(1)).alias("__n"), *first(lambda i, n: n))
    richest = held.groupBy(*by).agg(F.max("__n").alias("__n"), *first(lambda i, n: f"__v{i}"))
    copies = richest.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")))
    return copies.select(col(at), *[F.col(f"__v{i}").alias(n) for i, n in enumerate(names)])


# ---- sinks -----------------------------------------------------------------


def _start(sdf: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str, trigger: dict) -> StreamingQuery:
    writer = sdf.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def tail_sorted_batches(
    sdf: DataFrame, path: str, checkpoint: str, at: str = TIME, tie: Sequence[str] = (), trigger: dict | None = None
) -> StreamingQuery:
    """Write the rows of every flush newest first, one folder per flush; a flush each second by default."""

    def write(batch: DataFrame, number: int) -> None:
        keys = sort_keys(batch, [at], desc=True, tie=tie)
        batch.orderBy(*[k.column for k in keys]).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return _start(sdf, write, checkpoint, "append", trigger or {"processingTime": "1 second"})


def append(sdf: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the rows of a stream once each, as they come."""
    writer = sdf.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start(path)


def _newest(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Rows with a batch number, cut to the newest per key."""

    def fold(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in keys]
        newest = F.max_by(F.struct(*[col(c) for c in others]), col(BATCH)).alias("__r")
        return rows.groupBy(*[col(k) for k in keys]).agg(newest).select(*[col(k) for k in keys], "__r.*")

    return fold


def upsert(
    sdf: DataFrame, path: str, checkpoint: str, keys: Sequence[str], trigger: dict | None = None, every: int = EVERY
) -> StreamingQuery:
    """Write changed rows of an aggregate, newest per key; ``every`` micro-batches are folded into one run, and so on up.

    A path belongs to one query and its checkpoint.
    """
    runs = Runs(path, _newest(keys), every)

    def write(batch: DataFrame, number: int) -> None:
        runs.write(batch.withColumn(BATCH, F.lit(number).cast("bigint")), number)

    return _start(sdf, write, checkpoint, "update", trigger or {"processingTime": "1 second"})


def latest(spark: SparkSession, path: str, keys: Sequence[str], every: int = EVERY) -> DataFrame:
    """Newest row per key of what ``upsert`` wrote, out of a number of folders that grows with the log of the batches."""
    runs = Runs(path, _newest(keys), every)
    head = runs.head(spark)
    if head is None:
        raise ValueError(f"no finished batch in {path}")
    return runs.fold(runs.rows(spark, head)).drop(BATCH)


def stream_running_stats(
    sdf: DataFrame,
    by: Sequence[str],
    funcs: dict[str, RunningStat],
    path: str,
    state: str,
    checkpoint: str,
    tie: Sequence[str] = (),
    order: Sequence[str] = (TIME,),
    trigger: dict | None = None,
    every: int = EVERY,
) -> StreamingQuery:
    """Running count, sum, min and max per group on a live stream.

    Rows are ordered inside a micro-batch and batches follow each other. The totals so far lie below ``state`` as
    runs: a batch reads the totals of its own groups and writes what it adds to them, so groups that it does not
    touch are not written, and a repeated batch gives the same answer. A hot group is spread over tasks like in the
    batch operator.
    """
    bad = [n for n, f in funcs.items() if f.func in ("first", "last")]
    if bad:
        raise ValueError(f"no running position on a stream: {bad}")
    groups = [f"__g{i}" for i in range(len(by))]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = batch.persist()
        rows, _ = keyed(held, by)
        scalars = {n: _scalar(held, f) for n, f in funcs.items()}
        merge = [s.merge(col(n)).alias(n) for n, s in scalars.items()]
        totals = Runs(state, lambda many: many.groupBy(*groups).agg(*merge), every)
        here = running(rows, groups, sort_keys(held, order, tie=tie), scalars, is_hot(rows, groups))
        sums = rows.groupBy(*groups).agg(*[s.over_rows().alias(n) for n, s in scalars.items()])
        if number > 0:
            before = totals.rows(spark, number - 1)
            if groups:
                touched = rows.select(*[F.col(g).alias(f"__t{i}") for i, g in enumerate(groups)]).distinct()
                same = [F.col(g).eqNullSafe(F.col(f"__t{i}")) for i, g in enumerate(groups)]
                before = before.join(touched, same, "left_semi")
            old = totals.fold(before).withColumnsRenamed({n: f"__s_{n}" for n in funcs})
            here = attach(here, old, groups)
            here = here.withColumns({n: s.combine(F.col(quoted(f"__s_{n}")), col(n)) for n, s in scalars.items()})
        drop = [*groups, *[f"__s_{n}" for n in funcs]]
        here.drop(*drop).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")
        totals.write(sums, number)
        held.unpersist()

    return _start(sdf, write, checkpoint, "append", trigger or {"processingTime": "1 second"})


def current(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a batch-numbered folder."""
    return spark.read.parquet(path).drop(BATCH)
