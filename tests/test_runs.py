"""Tables that grow by micro-batches: few folders to read, nothing lost in a crash, nothing written for other groups."""

import os

import pytest
from pyspark.sql import functions as F
from rows import rows_of

from skeinlog.functions import aggs as a
from skeinlog.operators import windows
from skeinlog.plans import catalog_live
from skeinlog.streaming import live
from skeinlog.streaming.runs import Runs

ONCE = {"availableNow": True}


def files(spark, path, parts):
    """One file a micro-batch, the oldest first."""
    for i, rows in parts:
        at = f"{path}/{i:03d}"
        df = spark.createDataFrame(rows, "g string, v bigint, id bigint").withColumn("_time", F.timestamp_seconds("id"))
        df.coalesce(1).write.parquet(at)
    schema = "g string, v bigint, id bigint, _time timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(path))


def folders(path):
    return sorted(os.listdir(f"{path}/run"))


def test_live_runs_are_digits():
    runs = Runs("p", lambda df: df, 3)
    for n in range(300):
        spans = [tuple(map(int, r.rsplit("/", 1)[1].split("-"))) for r in runs.live(n)]
        assert [s[0] for s in spans] == [0] + [s[1] + 1 for s in spans[:-1]] and spans[-1][1] == n
        assert len(spans) <= 2 * 6
        assert all((hi - lo + 1) in (1, 3, 9, 27, 81, 243) for lo, hi in spans)


def test_upsert_reads_few_folders_and_survives_a_crash(spark, tmp_path, monkeypatch):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    parts = [(i, [(f"g{i % 4}", i, i), (None, 1, i)]) for i in range(14)]
    sdf = files(spark, tmp_path / "in", parts)

    def start():
        counted = live.stream_stats(sdf, ["g"], "30d", {"n": a.count(), "hi": a.max_("v")}, late="400d")
        return live.upsert(counted, out, checkpoint, ["ts", "g"], ONCE, every=3)

    with pytest.raises(ValueError):
        live.latest(spark, out, ["ts", "g"], every=3)
    whole, broken = Runs._finish, []

    def fails(self, session, number):
        """The run of batch 8 and its folds are written, its mark is not."""
        if number == 8 and not broken:
            broken.append(live.latest(session, out, ["ts", "g"], every=3).agg(F.sum("n")).first()[0])
            raise RuntimeError("lost")
        whole(self, session, number)

    monkeypatch.setattr(Runs, "_finish", fails)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    assert broken == [16]  # a reader sees the eight finished batches
    start().awaitTermination()
    got = live.latest(spark, out, ["ts", "g"], every=3)
    want = [(None, 14, 1.0), ("g0", 4, 12.0), ("g1", 4, 13.0), ("g2", 3, 10.0), ("g3", 3, 11.0)]
    assert rows_of(got.select("g", "n", F.col("hi").cast("double"))) == sorted(want, key=str)
    head = Runs(out, None, 3).head(spark)
    assert head >= 13 and len(Runs(out, None, 3).live(head)) <= 6
    assert len(os.listdir(f"{out}/mark")) <= 2 * 3 + 1 and len(folders(out)) <= 16
    assert "0-0" not in folders(out) and "0-8" in folders(out)


def test_running_stats_write_their_own_groups_only(spark, tmp_path):
    path, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "check"))
    many = [(0, [(f"k{i}", i, i) for i in range(2000)])]
    few = [(i, [("k7", i, 5000 + i), (None, i, 6000 + i)]) for i in range(1, 6)]
    funcs = {"n": windows.run_count(), "s": windows.run_sum("v")}

    def run(sdf):
        query = live.stream_running_stats(sdf, ["g"], funcs, path, state, checkpoint, tie=["id"], trigger=ONCE, every=4)
        query.awaitTermination()
        assert query.exception() is None

    run(files(spark, tmp_path / "in", many + few[:2]))
    run(files(spark, tmp_path / "in", few[2:]))  # a restart goes on where the first query ended
    got = live.current(spark, path).where("g IS NULL OR g = 'k7'").orderBy("id").select("g", "n", F.col("s").cast("long"))
    k7, none = [7, 8, 10, 13, 17, 22], [1, 3, 6, 10, 15]
    assert rows_of(got.where("g = 'k7'")) == sorted([("k7", i + 1, s) for i, s in enumerate(k7)], key=str)
    assert rows_of(got.where("g IS NULL")) == sorted([(None, i + 1, s) for i, s in enumerate(none)], key=str)
    assert spark.read.parquet(f"{state}/run/0-0").count() == 2000
    assert {spark.read.parquet(f"{state}/run/{i}-{i}").count() for i in range(1, 6)} == {2}
    assert "0-3" in folders(state)


def test_files_of_a_live_source_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog_live, "FILE_ROWS", 50)
    rows = spark.range(3_000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    read = catalog_live.slices(spark, rows, "id")
    sizes, batches = [], []

    def seen(batch, number):
        batches.append(batch.count())
        sizes.extend(r["n"] for r in batch.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect())

    read.writeStream.foreachBatch(seen).option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start().awaitTermination()
    assert sum(sizes) == sum(batches) == 3_000 and len(batches) == 3
    assert len(sizes) == 60 and max(sizes) < 100
