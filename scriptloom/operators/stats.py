"""Corpus statistics and build counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SIZE_LIMITS = (50_000, 80_000, 100_000, 150_000, 200_000)
RANGE = 1024


def percentiles(df: DataFrame, value: str, shares: dict[str, float]) -> DataFrame:
    """Discrete percentiles `sorted[int(n * p)]` of a non-negative integer column.

    Values become a histogram (partially counted), the histogram is summed over ranges of values,
    and only these range totals are put in order; the value is then looked up inside the one range
    that holds the rank. No task ever sorts the values themselves.
    """
    hist = df.groupBy(F.col(value).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    hist = hist.withColumn("r", F.floor(F.col("v") / RANGE))
    ranges = hist.groupBy("r").agg(F.sum("c").alias("rc"))
    order = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    placed = ranges.select(
        "r", "rc", F.coalesce(F.sum("rc").over(order), F.lit(0)).alias("before"), F.sum("rc").over(whole).alias("n")
    )
    stats = F.explode(F.array(*[F.struct(F.lit(k).alias("stat"), F.lit(p).alias("p")) for k, p in shares.items()]))
    wanted = placed.select("r", "rc", "before", "n", stats.alias("s")).withColumn(
        "rank", F.floor(F.col("n") * F.col("s.p"))
    )
    wanted = wanted.filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rc")))
    inner = Window.partitionBy("s.stat").orderBy("v")
    found = wanted.join(hist, "r").withColumn(
        "upto", F.col("before") + F.sum("c").over(inner)
    )
    return found.filter(F.col("upto") > F.col("rank")).groupBy(F.col("s.stat").alias("stat")).agg(
        F.min("v").alias("value")
    )


def totals(df: DataFrame, value: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.max(value).cast("bigint").alias("max")]


def above_limits(df: DataFrame, value: str, limits=SIZE_LIMITS) -> DataFrame:
    """How many rows exceed each limit, one pass."""
    counted = df.agg(*[F.count_if(F.col(value) > limit).alias(str(limit)) for limit in limits])
    rows = F.explode(
        F.array(*[F.struct(F.lit(limit).cast("bigint").alias("size_limit"), F.col(f"`{limit}`").alias("n")) for limit in limits])
    )
    return counted.select(rows.alias("x")).select("x.*")


def counters(parts: dict[str, DataFrame]) -> DataFrame:
    """Long table (counter, value) from named one-value frames, computed side by side."""
    out = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("counter"), F.col(df.columns[0]).cast("bigint").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value"))


def of_table(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Long table (counter, value) of several counters of one table, in one scan."""
    row = df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in values.items()])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("counter"), F.col(k).alias("value")) for k in values])).alias("x")
    return row.select(each).select("x.*")
