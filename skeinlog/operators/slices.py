"""Ordered computation over groups of any size.

A window over a group runs in one task. That is right for ordinary groups and
impossible for a group that holds a large share of all rows (or for no grouping
at all). The helpers here measure the groups first, which is one scan of the
key columns. Ordinary groups take a plain window. If a group is larger than
``spark.skeinlog.maxGroupRows`` or ``maxGroupBytes`` allow, one sample of narrow
rows (group, order) gives splitters, and each row finds its slice by a search
among them. Slices depend on the row alone, so nothing wide is stored: a window
runs inside every slice after one shuffle, and what a slice must add from the
others comes from narrow sums. A slice continues at most one group of an earlier
slice, so the carried table has at most one row per slice and direction.

Equal order values cannot be split this way. Where many rows share one, rows go by
their content too; where that is equal, they are stored with a number that tells
them apart.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinlog.model import attach, col, quoted

MAX_GROUP_ROWS = "spark.skeinlog.maxGroupRows"
SLICE_ROWS = "spark.skeinlog.sliceRows"
MAX_GROUP_BYTES = "spark.skeinlog.maxGroupBytes"
_DEFAULTS = {MAX_GROUP_ROWS: 5_000_000, SLICE_ROWS: 5_000_000, MAX_GROUP_BYTES: 2 << 30}
_MAX_SLICES = 20_000
# Sampled rows for each slice, and how much larger than planned a slice may come out.
SAMPLED, MOST_TIMES = 40, 4
# Rows from which on a core has a slice of its own, and the most slices that a compiled tree of comparisons finds.
LEAST_ROWS, TREE = 100_000, 128
# Rows that tell the width of a row, and the width that no row is taken to exceed without a look.
WIDTH_ROWS, WIDEST = 1000, 4096

_LOCAL_FOLDERS: dict[str, str] = {}

_SLICE, _ROW = "__slice", "__row"


def shared_folder(spark) -> str:
    """Folder for checkpoints: the one the cluster names, a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="skeinlog-")
    return _LOCAL_FOLDERS[app]


def durable(df: DataFrame) -> DataFrame:
    """Write the rows once to shared storage, so that lost executors cannot change them."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@dataclass(frozen=True)
class Sizes:
    rows: int
    largest: int
    width: int = 0


def group_sizes(df: DataFrame, by: Sequence[str]) -> Sizes:
    """Number of rows and size of the largest group: two numbers reach the driver."""
    counts = df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("n"))
    total, largest = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return Sizes(total, largest)


def row_width(df: DataFrame) -> int:
    """Bytes of a row as text, by the first rows: an estimate for the number of rows that a task may hold."""
    text = F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]))
    return int(df.limit(WIDTH_ROWS).agg(F.coalesce(F.avg(F.octet_length(text)), F.lit(0.0))).first()[0]) + 16


def _content(df: DataFrame) -> Column:
    """Hash of what a row holds in columns that can be hashed."""
    known = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*[F.col(quoted(c)) for c in known]) if known else F.lit(0).cast("bigint")


def _setting(df: DataFrame, name: str) -> int:
    return int(df.sparkSession.conf.get(name, str(_DEFAULTS[name])))


def is_hot(df: DataFrame, by: Sequence[str]) -> Sizes | None:
    """Sizes if some group is too large for one task, by rows or by bytes, else None."""
    sizes = group_sizes(df, by)
    most = _setting(df, MAX_GROUP_BYTES)
    if sizes.largest > _setting(df, MAX_GROUP_ROWS) or sizes.largest * WIDEST > most:
        sizes = Sizes(sizes.rows, sizes.largest, row_width(df))
    return sizes if sizes.largest > _setting(df, MAX_GROUP_ROWS) or sizes.largest * sizes.width > most else None


@dataclass(frozen=True)
class Key:
    """One sort expression with its direction."""

    expr: Column
    desc: bool = False

    @property
    def column(self) -> Column:
        return self.expr.desc_nulls_last() if self.desc else self.expr.asc_nulls_first()

    def before(self, a: Column, b: Column) -> Column:
        """Whether value a comes before value b; never null."""
        if self.desc:
            return F.coalesce(a > b, a.isNotNull() & b.isNull())
        return F.coalesce(a < b, a.isNull() & b.isNotNull())


@dataclass(frozen=True)
class Running:
    """A running value: ``kind`` is sum, count, min or max of ``expr`` from the start to the current row, or with
    ``ahead`` from the current row to the end."""

    kind: str
    expr: Column
    ahead: bool = False

    def over_rows(self) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](self.expr)

    def merge(self, c: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](c)

    def combine(self, carried: Column, here: Column) -> Column:
        if self.kind == "min":
            return F.least(carried, here)
        if self.kind == "max":
            return F.greatest(carried, here)
        return F.when(carried.isNull(), here).when(here.isNull(), carried).otherwise(carried + here)

    def window(self, keys: Sequence, ordered: Sequence[Column]):
        w = Window.partitionBy(*keys).orderBy(*ordered)
        return w.rowsBetween(0, Window.unboundedFollowing) if self.ahead else w.rowsBetween(Window.unboundedPreceding, 0)


class Slices:
    """The rows of a table with their slice, cut along (group, order)."""

    def __init__(self, df: DataFrame, by: Sequence[str], order: Sequence[Key], sizes: Sizes) -> None:
        self.by, self.keys = list(by), [quoted(b) for b in by]
        rows = _setting(df, SLICE_ROWS)
        if sizes.width:
            rows = min(rows, max(1, _setting(df, MAX_GROUP_BYTES) // sizes.width))
        # no core without a slice; fewer rows than a slice may hold are not cut for that
        cores = df.sparkSession.sparkContext.defaultParallelism
        self.count = max(2, min(_MAX_SLICES, max(-(-sizes.rows // rows), min(cores, sizes.rows // LEAST_ROWS))))
        # The order alone cuts rows where it can: what it leaves equal lies in one slice. Where too much is equal, rows
        # go by their content too, which reads all columns, and by a stored number where that is equal as well.
        for most in (list(order), [*order, Key(_content(df))]):
            exprs = {f"__o{i}": k.expr for i, k in enumerate(most)}
            self.order = [Key(F.col(f"__o{i}"), k.desc) for i, k in enumerate(most)]
            self.helpers = [_SLICE, *exprs]
            self.rows = self._searched(df, exprs, sizes)
            if self.largest() <= MOST_TIMES * -(-sizes.rows // self.count):
                break
        else:
            self.rows = self._numbered(df.withColumns(exprs))
        self.within = [k.column for k in self.order]
        # a slice is a task
        self.dealt = self.rows.repartitionById(self.count, _SLICE)

    def _searched(self, df: DataFrame, exprs: dict[str, Column], sizes: Sizes) -> DataFrame:
        """Slices by splitters: the sample goes to one row of at most SAMPLED times as many narrow values as slices."""
        # keys of one direction that follow each other are compared as one struct
        runs: list[list[Key]] = []
        for key in [Key(F.col(k)) for k in self.keys] + self.order:
            if not runs or runs[-1][0].desc != key.desc:
                runs.append([])
            runs[-1].append(key)
        names = [f"r{i}" for i in range(len(runs))]
        here = F.struct(*[F.struct(*[k.expr.alias(f"k{i}") for i, k in enumerate(r)]).alias(n) for r, n in zip(runs, names)])

        def before(a: Column, b: Column) -> Column:
            out = F.lit(False)
            for r, n in reversed(list(zip(runs, names))):
                out = (a[n] > b[n] if r[0].desc else a[n] < b[n]) | ((a[n] == b[n]) & out)
            return out

        share = min(1.0, SAMPLED * self.count / max(sizes.rows, 1))
        some = (df.sample(False, share, seed=7) if share < 1 else df).withColumns(exprs).select(here.alias("at"))
        line = F.array_sort(F.collect_list("at"), lambda a, b: F.when(before(a, b), -1).when(before(b, a), 1).otherwise(0))
        step = F.greatest(F.ceil(F.size("all") / self.count), F.lit(1)).cast("int")
        picks = F.filter("all", lambda _, i: (i > 0) & (i % step == 0))
        splitters = durable(some.agg(line.alias("all")).select(F.array_distinct(picks).alias("splitters")))
        held = F.col("__held")

        def goes_before(at) -> Column:
            return F.coalesce(before(F.col("__here"), F.get(held, at)), F.lit(True))

        def tree(lo: int, hi: int) -> Column:
            if lo >= hi:
                return F.lit(lo)
            middle = (lo + hi) // 2
            return F.when(goes_before(F.lit(middle)), tree(lo, middle)).otherwise(tree(middle + 1, hi))

        def halved(state: Column, _: Column) -> Column:
            middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
            after = goes_before(middle)
            return F.when(state["lo"] >= state["hi"], state).otherwise(F.struct(
                F.when(after, state["lo"]).otherwise(middle + 1).alias("lo"), F.when(after, middle).otherwise(state["hi"]).alias("hi")
            ))

        steps = F.sequence(F.lit(0), F.lit(self.count.bit_length()))
        start = F.struct(F.lit(0).alias("lo"), F.size(held).alias("hi"))
        # a tree of comparisons is compiled, a loop over an array is not
        found = tree(0, self.count - 1) if self.count <= TREE else F.aggregate(steps, start, halved)["lo"]
        looked = df.withColumns(exprs).withColumns({"__here": here, "__held": splitters.scalar()})
        return looked.withColumn(_SLICE, found).drop("__here", "__held")

    def _numbered(self, placed: DataFrame) -> DataFrame:
        base = durable(placed.withColumn(_ROW, F.monotonically_increasing_id()))
        self.order, self.helpers = [*self.order, Key(F.col(_ROW))], [*self.helpers, _ROW]
        ordered = [k.column for k in self.order]
        return durable(
            base.repartitionByRange(self.count, *[F.col(k) for k in self.keys], *ordered).withColumn(_SLICE, F.spark_partition_id())
        )

    def largest(self) -> int:
        """Rows of the largest slice. Their numbers are kept: at most one narrow row a slice."""
        self.counts = durable(self.rows.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n")))
        return self.counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]

    def add(self, cols: dict[str, Running]) -> DataFrame:
        """The rows with the running values: those of the slice, and what narrow sums carry into it."""
        local = self.dealt.withColumns({n: r.over_rows().over(r.window([_SLICE, *self.keys], self.within)) for n, r in cols.items()})
        return self._carried(local, cols)

    def place(self, name: str) -> DataFrame:
        """The rows of all slices, without groups, in their order, with their 1-based position."""
        number = Running("count", F.lit(1))
        local = self.dealt.withColumn(name, number.over_rows().over(number.window([_SLICE], self.within)))
        return self._carried(local, {name: number}, parts=self.counts.withColumnRenamed("n", f"__p_{name}"))

    def _carried(
        self, local: DataFrame, cols: dict[str, Running], source: DataFrame | None = None, parts: DataFrame | None = None
    ) -> DataFrame:
        parts = parts or (source or self.rows).groupBy(_SLICE, *self.keys).agg(*[r.over_rows().alias(f"__p_{n}") for n, r in cols.items()])
        line = Window.partitionBy(*self.keys).orderBy(_SLICE)
        others = {False: line.rowsBetween(Window.unboundedPreceding, -1), True: line.rowsBetween(1, Window.unboundedFollowing)}
        carry = parts.withColumns({f"__c_{n}": r.merge(F.col(quoted(f"__p_{n}"))).over(others[r.ahead]) for n, r in cols.items()})
        carry = carry.withColumn("__of", F.count(F.lit(1)).over(Window.partitionBy(*self.keys))).where(F.col("__of") > 1)
        carry = durable(carry.select(_SLICE, *self.keys, *[F.col(quoted(f"__c_{n}")) for n in cols]))
        joined = attach(local, F.broadcast(carry), [_SLICE, *self.by])
        merged = {n: r.combine(F.col(quoted(f"__c_{n}")), F.col(quoted(n))) for n, r in cols.items()}
        return joined.withColumns(merged).drop(*[f"__c_{n}" for n in cols])

    def then(self, done: DataFrame, cols: dict[str, Running], narrow: Sequence[str]) -> DataFrame:
        """More running values over rows that ``add`` has made, from their columns ``narrow``; no further shuffle."""
        local = done.withColumns({n: r.over_rows().over(r.window([_SLICE, *self.keys], self.within)) for n, r in cols.items()})
        return self._carried(local, cols, done.select(_SLICE, *self.keys, *narrow))


def running(
    df: DataFrame, by: Sequence[str], order: Sequence[Key], cols: dict[str, Running], hot: Sizes | None | bool = True
) -> DataFrame:
    """Add running values per group in the given order. ``hot`` may carry sizes measured before."""
    sizes = is_hot(df, by) if hot is True else hot
    if not sizes:
        keys, ordered = [col(b) for b in by], [k.column for k in order]
        return df.withColumns({name: r.over_rows().over(r.window(keys, ordered)) for name, r in cols.items()})
    cut = Slices(df, by, order, sizes)
    return cut.add(cols).drop(*cut.helpers)


def positioned(
    df: DataFrame, by: Sequence[str], order: Sequence[Key], name: str, hot: Sizes | None | bool = True
) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    if not by:
        sizes = is_hot(df, by) if hot is True else hot
        if sizes:
            cut = Slices(df, by, order, sizes)
            return cut.place(name).drop(*cut.helpers)
        hot = sizes
    return running(df, by, order, {name: Running("count", F.lit(1))}, hot)


def in_order(df: DataFrame, order: Sequence[Key], name: str) -> DataFrame:
    """The rows in order, with their 1-based position. Slices lie in order already, one after the other: no more sort."""
    sizes = is_hot(df, [])
    placed = positioned(df, [], order, name, sizes)
    return placed if sizes else placed.orderBy(name)
