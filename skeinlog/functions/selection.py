"""Exact quantiles by selection: ranges of values are counted and narrowed, values are never sorted.

All quantiles of a query share their passes. The first gives count, least and greatest value of each (group, value set).
Each further one splits the range that still holds a wanted rank into equal parts, counts them with map-side combining, and
keeps the part that holds the rank, with the least and greatest value that occur in it. A range with few values is listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.model import quoted
from skeinlog.operators.slices import durable

#: Parts of a range in a round; values of a range that are listed in one cell; rounds until values are counted one by one.
PARTS, LISTED, ROUNDS = 4096, 1 << 16, 40
#: Ranges that are sent to all tasks; with more of them the planner chooses the join.
BROADCAST = 10_000
_MOST = 1.7976931348623157e308


def _part(v: Column, lo: Column, hi: Column) -> Column:
    """Number of the equal part of lo to hi that holds v. Infinite ends count as the greatest numbers."""
    least, most = F.greatest(lo, F.lit(-_MOST)), F.least(hi, F.lit(_MOST))
    share = F.try_divide(v / 2 - least / 2, most / 2 - least / 2)
    inside = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * PARTS), F.lit(0)), F.lit(PARTS - 1))
    return F.when(v < least, -1).when(v > most, PARTS).otherwise(inside).cast("int")


def _at_rank(parts: Column, rank: Column, field: str) -> Column:
    """Of sorted parts with counts n: the first that reaches the rank, and how many values lie before it."""
    start = F.struct(F.lit(0).cast("bigint").alias("before"), F.get(parts, F.lit(0)).alias("part"), F.lit(False).alias("found"))

    def step(s: Column, p: Column) -> Column:
        reached = s["before"] + p["n"] >= rank
        return F.when(s["found"], s).when(reached, F.struct(s["before"].alias("before"), p.alias("part"), F.lit(True).alias("found"))).otherwise(
            F.struct((s["before"] + p["n"]).alias("before"), p.alias("part"), F.lit(False).alias("found"))
        )

    return F.aggregate(parts, start, step).alias(field)


def quantiles(df: DataFrame, by: Sequence[str], asked: dict[str, tuple[float, list[Column]]]) -> DataFrame:
    """One row for each group that holds a value, with the quantiles asked for: name to (phi, columns of numbers).

    A quantile is the value at rank ceil(phi n), at least 1, of all values of its columns; null without values.
    """
    sets: list[list[Column]] = []
    members: list[tuple[str, float, int]] = []
    for name, (phi, columns) in asked.items():
        known = next((i for i, s in enumerate(sets) if [str(c) for c in s] == [str(c) for c in columns]), None)
        if known is None:
            sets.append(columns)
        members.append((name, phi, len(sets) - 1 if known is None else known))
    keys = [quoted(b) for b in by]
    flat = [(i, c.cast("double")) for i, s in enumerate(sets) for c in s]
    if len(flat) == 1:
        rows = df.select(*keys, F.lit(0).alias("__f"), flat[0][1].alias("__v"))
    else:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), c.alias("v")) for i, c in flat])).alias("__e")
        rows = df.select(*keys, each).select(*keys, F.col("__e.f").alias("__f"), F.col("__e.v").alias("__v"))
    rows = rows.where(F.col("__v").isNotNull())
    facts = rows.groupBy(*keys, "__f").agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    wanted = F.explode(F.filter(
        F.array(*[F.struct(F.lit(q).alias("q"), F.lit(f).alias("f"), F.lit(float(phi)).alias("phi")) for q, (_, phi, f) in enumerate(members)]),
        lambda a: a["f"] == F.col("__f"),
    )).alias("__a")
    state = facts.select(*keys, "__f", wanted, "__n", "__lo", "__hi").select(
        *keys, "__f", F.col("__a.q").alias("__q"), F.greatest(F.ceil(F.col("__a.phi") * F.col("__n")), F.lit(1)).cast("bigint").alias("__rank"),
        "__n", "__lo", "__hi",
    )
    state = durable(state)
    for _ in range(ROUNDS):
        open_ = F.col("__lo") < F.col("__hi")
        seen = state.agg(F.coalesce(F.max(F.when(open_, F.col("__n"))), F.lit(0)).alias("most"), F.count(F.when(open_, 1)).alias("open")).first()
        if not seen["most"] or seen["most"] <= LISTED:
            break
        state = durable(_narrowed(rows, keys, state, seen["open"]))
    told = _listed(rows, keys, state, seen["open"]) if seen["open"] else state.select(*keys, "__q", F.col("__lo").alias("__value"))
    return told.groupBy(*keys).agg(*[F.max(F.when(F.col("__q") == q, F.col("__value"))).alias(name) for q, (name, _, _) in enumerate(members)])


def _within(rows: DataFrame, keys: Sequence[str], state: DataFrame, ranges: int) -> DataFrame:
    """The values that lie in an open range of their group, with it."""
    held = state.where("__lo < __hi").select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__f").alias("__g"), "__q", "__lo", "__hi", "__rank")
    if not keys:
        # one range a quantile of the query: they are part of each row's test, not of a join
        fields = ("__g", "__q", "__lo", "__hi", "__rank")
        told = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in fields]) for r in held.collect()])
        mine = F.filter(told, lambda r: (r["__g"] == F.col("__f")) & (F.col("__v") >= r["__lo"]) & (F.col("__v") <= r["__hi"]))
        return rows.withColumn("__r", F.explode(mine)).select("__f", "__v", *[F.col("__r")[c].alias(c) for c in fields[1:]])
    on = F.col("__f") == F.col("__g")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    held = F.broadcast(held) if ranges <= BROADCAST else held
    return rows.join(held, on).where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))


def _narrowed(rows: DataFrame, keys: Sequence[str], state: DataFrame, ranges: int) -> DataFrame:
    parts = _within(rows, keys, state, ranges).groupBy(*keys, "__f", "__q", "__rank", _part(F.col("__v"), F.col("__lo"), F.col("__hi")).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")
    )
    line = parts.groupBy(*keys, "__f", "__q", "__rank").agg(F.sort_array(F.collect_list(F.struct("part", "n", "lo", "hi"))).alias("__parts"))
    picked = line.withColumn("__at", _at_rank(F.col("__parts"), F.col("__rank"), "__at"))
    closed = state.where("__lo >= __hi")
    return closed.unionByName(picked.select(
        *keys, "__f", "__q", (F.col("__rank") - F.col("__at.before")).alias("__rank"), F.col("__at.part.n").alias("__n"),
        F.col("__at.part.lo").alias("__lo"), F.col("__at.part.hi").alias("__hi"),
    ))


def _listed(rows: DataFrame, keys: Sequence[str], state: DataFrame, ranges: int) -> DataFrame:
    counts = _within(rows, keys, state, ranges).groupBy(*keys, "__f", "__q", "__rank", F.col("__v").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    line = counts.groupBy(*keys, "__f", "__q", "__rank").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("__parts"))
    found = line.withColumn("__at", _at_rank(F.col("__parts"), F.col("__rank"), "__at"))
    closed = state.where("__lo >= __hi").select(*keys, "__q", F.col("__lo").alias("__value"))
    return closed.unionByName(found.select(*keys, "__q", F.col("__at.part.v").alias("__value")))
