"""Exact order statistics of a distributed column: no sort of it, and no task that holds more than LIMIT values of a rank.

A wanted rank is kept as an interval of values that it lies in. A pass over the column counts the values of each interval in BINS bins, with
the least and greatest value of each; the bin that holds the rank is the next interval. An interval on both sides of zero is cut there, one whose ends differ
16 times or more into bins of equal ratio, others into bins of equal width, so that some ten passes settle any doubles; the largest value has a bin
of its own, so each pass leaves something out. Once an interval has LIMIT values at most, they are read and sorted, and one of equal values needs no
reading. All ranks of all groups take the same passes; between these there is a row for each group and rank, cut from its lineage by a
checkpoint. Values are counted in their tasks before anything is shuffled, so a group may hold a third of them.

Nulls are left out; NaN is above all numbers. Groups may be null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.streaming.topic_log import ensure_checkpoint_dir

BINS, LIMIT = 1024, 1 << 14
MOST = 1.7976931348623157e308


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """The number of the bin of lo <= v <= hi: a value that isn't less never has a lesser one."""
    low, high, x = (F.greatest(F.least(c, F.lit(MOST)), F.lit(-MOST)) for c in (lo, hi, v))
    part = lambda a, b, c: F.try_divide(c * 0.5 - a * 0.5, b * 0.5 - a * 0.5)  # noqa: E731  halves can't overflow
    at = F.when((low > 0) & (high * 0.0625 > low), part(F.log(low), F.log(high), F.log(x))).when((high < 0) & (low * 0.0625 < high), part(-F.log(-low), -F.log(-high), -F.log(-x))).otherwise(part(low, high, x))
    number = F.greatest(F.least(F.floor(F.coalesce(at, F.lit(0.0)) * BINS), F.lit(BINS - 1)), F.lit(0)).cast("int")
    number = F.when((low <= 0) & (high >= 0), F.signum(x).cast("int") + 1).otherwise(number)
    return F.when(v == hi, BINS + 2).when(v == F.lit(float("inf")), BINS + 1).when(v == F.lit(float("-inf")), -1).otherwise(number)


def _same(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Joined on the groups, a null group with a null one."""
    named = b.withColumnsRenamed({c: f"__b_{c}" for c in by})
    on = reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__b_{c}`")) for c in by])
    return a.join(named, on, how).drop(*[f"__b_{c}" for c in by])


def _within(x: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Each value with each interval of its group that it is in."""
    lists = state.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.collect_set(F.struct("lo", "hi")).alias("__ivs"))
    if by:
        joined = _same(x, lists, by)
    else:  # as many intervals as ranks are wanted
        ivs = lists.first()["__ivs"]
        joined = x.withColumn("__ivs", F.array(*[F.struct(F.lit(i["lo"]).alias("lo"), F.lit(i["hi"]).alias("hi")) for i in ivs]))
    return joined.withColumn("iv", F.explode(F.filter("__ivs", lambda i: (i["lo"] <= F.col("__v")) & (F.col("__v") <= i["hi"])))).drop("__ivs")


def order_statistics(df: DataFrame, column: str, ranks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by..., rank, value: the values at the wanted ranks (from 0, in order of size) of each group. ranks: by..., rank (long); ranks that a group doesn't
    have give no row."""
    by = list(by or [])
    keys = [F.col(f"`{c}`") for c in by]
    ensure_checkpoint_dir(df.sparkSession)
    x = df.select(*keys, F.col(f"`{column}`").cast("double").alias("__v")).where("__v is not null")
    ends = x.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    wanted = ranks.select(*keys, "rank").distinct()
    state = _same(wanted, ends, by) if by else wanted.join(F.broadcast(ends))
    state = state.where("rank >= 0 and rank < n").select(*keys, "rank", F.col("rank").alias("left"), "n", "lo", "hi").checkpoint()
    many = (F.col("n") > LIMIT) & (F.col("lo") != F.col("hi"))
    while not (open_ := state.where(many)).isEmpty():
        bins = _within(x, open_, by).withColumn("bin", _bin(F.col("__v"), F.col("iv.lo"), F.col("iv.hi"))).groupBy(*keys, "iv", "bin").agg(F.count("*").alias("c"), F.min("__v").alias("a"), F.max("__v").alias("b"))
        upto = F.sum("c").over(Window.partitionBy(*keys, "iv").orderBy("bin"))
        bins = bins.withColumn("before", upto - F.col("c")).select(*keys, F.col("iv.lo").alias("lo"), F.col("iv.hi").alias("hi"), "before", "c", "a", "b")
        on = [*by, "lo", "hi"]
        next_ = _same(open_, bins, on).where("left >= before and left < before + c").select(*keys, "rank", (F.col("left") - F.col("before")).alias("left"), F.col("c").alias("n"), F.col("a").alias("lo"), F.col("b").alias("hi"))
        state = state.where(~many).unionByName(next_).checkpoint()
    done = state.where("lo = hi").select(*keys, "rank", F.col("lo").alias("value"))
    few = state.where("lo <> hi")
    if few.isEmpty():
        return done
    lists = _within(x, few, by).groupBy(*keys, "iv").agg(F.array_sort(F.collect_list("__v")).alias("values")).select(*keys, F.col("iv.lo").alias("lo"), F.col("iv.hi").alias("hi"), "values")
    read = _same(few, lists, [*by, "lo", "hi"]).select(*keys, "rank", F.get("values", F.col("left").cast("int")).alias("value"))
    return done.unionByName(read)


def percentiles(df: DataFrame, column: str, points: tuple[float, ...], by: list[str] | None = None) -> DataFrame:
    """by..., n, values: interpolated percentiles of each group, in the order of points (null each where a group has no value)."""
    by = list(by or [])
    keys = [F.col(f"`{c}`") for c in by]
    # a value between two ranks, as near to the next one as the point says
    rows = df.select(*keys, F.col(f"`{column}`").cast("double").alias("__v"))
    sizes = rows.groupBy(*keys).agg(F.count("__v").alias("n"))
    at = sizes.select("*", F.posexplode(F.array(*[F.lit(float(p)) for p in points])).alias("i", "p")).withColumn("at", F.col("p") * (F.col("n") - 1))
    at = at.where("n > 0").select(*keys, "i", "at", F.floor("at").alias("low"), F.ceil("at").alias("high"))
    ranks = at.select(*keys, F.explode(F.array("low", "high")).alias("rank"))
    found = order_statistics(df, column, ranks, by)
    value = lambda name: found.select(*keys, F.col("rank").alias(name), F.col("value").alias(f"{name}_value"))
    both = _same(_same(at, value("low"), [*by, "low"]), value("high"), [*by, "high"])
    mixed = F.when(F.col("low_value") == F.col("high_value"), F.col("low_value")).otherwise((F.col("high") - F.col("at")) * F.col("low_value") + (F.col("at") - F.col("low")) * F.col("high_value"))
    lists = both.withColumn("x", mixed).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("xs"))
    out = _same(sizes, lists, by, "left") if by else sizes.join(F.broadcast(lists), how="left")
    return out.select(*keys, "n", F.when(F.size("xs") > 0, F.transform("xs", lambda v: v["x"])).otherwise(F.array_repeat(F.lit(None).cast("double"), len(points))).alias("values"))
