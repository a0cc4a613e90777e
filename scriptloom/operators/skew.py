"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SHARE = 100_000  # a key is heavy beyond this part of all rows, so there are at most as many heavy keys
ROWS = 10_000  # and beyond this many rows


def heavy_keys(rows: DataFrame, key: str, least: int = ROWS) -> DataFrame:
    """key, parts: keys with more rows than one task should get, and over how many parts to deal them.

    At most SHARE keys, whatever the size of the table: it may be broadcast.
    """
    each = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = each.agg(F.sum("_rows")).first()[0] or 0
    most = max(least, total // SHARE)
    return each.filter(F.col("_rows") > most).select(key, F.ceil(F.col("_rows") / most).cast("int").alias("_parts"))


def lookup(rows: DataFrame, table: DataFrame, key: str, spread: list[str], how: str = "inner", least: int = ROWS) -> DataFrame:
    """rows joined with `table`, which has one row for each key. Rows of a heavy key are dealt over parts by a hash of
    the columns `spread`, and the key's row in the table is copied to each part. `rows` is scanned twice: pass a written table."""
    heavy = F.broadcast(heavy_keys(rows, key, least))
    part = F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1)))
    dealt = rows.join(heavy, key, "left").withColumn("_part", part.cast("int")).drop("_parts")
    upto = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    copies = table.join(heavy, key, "left").withColumn("_part", F.explode(upto)).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")
