"""Contiguous shards of near equal size, by global prefix sums of bytes.

1. Rows are dealt to ranges of the order (doc_id, text hash, place in the scan) and sorted inside them, so rows that
   share a doc_id or are equal throughout are split over ranges like any others. Each task numbers its rows and adds
   up their sizes; the ranges are written once, with all columns.
2. The totals of the ranges, one row each, are summed up in their order: bytes and rows before each range.
3. A row's bytes before it are those before its range plus those inside. The byte axis is cut at equal targets, and
   a row belongs to the shard that its middle lies in: shards are contiguous in the order and each end is less than
   half a row away from its target.

Sizes are `size`, by default the UTF-8 bytes of the text plus 1, so null and empty texts count 1. Null doc_ids come
first; repeated doc_ids are ordered by text hash, equal rows as they lie in the scan. Fewer rows than shards, or a row larger
than a target, leave shards empty. An empty table gives an empty result. Columns of the input keep their names and
values, also if they are called shard or slot: the result holds each row whole in `doc`. All work on one row is
with its sizes only; a table of any size needs two passes over what was written, over narrow columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scriptloom.session import written


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def ranged(documents: DataFrame, size: Column) -> DataFrame:
    """doc, size, part, row, before (bytes of the part before the row); parts are ascending ranges. Written."""
    rows = documents.select(
        F.struct("*").alias("doc"), size.alias("size"), F.col("doc_id").cast("bigint").alias("_id"),
        F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    order = ["_id", "_hash", "_place"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "size")
    schema = StructType([*dealt.schema.fields, *(StructField(c, LongType()) for c in ("part", "row", "before"))])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            upto = np.cumsum(batch.column("size").to_numpy())
            more = [np.full(n, part), np.arange(row, row + n), before + upto - batch.column("size").to_numpy()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in more)],
                                             [*batch.schema.names, "part", "row", "before"])
            row, before = row + n, before + (int(upto[-1]) if n else 0)

    return written(dealt.mapInArrow(number, schema), "ranges")


def offsets(rows: DataFrame) -> DataFrame:
    """part, _bytes, _rows before the part, _total bytes of all: one row for each range."""
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    return totals.select("part", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("_bytes"),
                         F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_rows"),
                         F.sum("bytes").over(Window.partitionBy()).alias("_total"))


def sharded(documents: DataFrame, shards: int = 8, size: Column | None = None) -> DataFrame:
    """doc (the row as it came), size, shard, slot (place in the shard, from 0) of every row."""
    rows = ranged(documents, text_size() if size is None else size)
    placed = rows.join(F.broadcast(offsets(rows)), "part")  # as many rows as tasks wrote
    middle = 2 * (F.col("_bytes") + F.col("before")) + F.col("size")
    placed = placed.select("doc", "size", (F.col("_rows") + F.col("row")).alias("_at"), (middle * shards).alias("_scaled"),
                           F.greatest("_total", F.lit(1)).alias("_total"))
    placed = placed.select("doc", "size", "_at", F.expr("_scaled div (2 * _total)").cast("int").alias("shard"))
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))  # at most `shards` rows
    return placed.join(F.broadcast(first), "shard").select("doc", "size", "shard", (F.col("_at") - F.col("_first")).alias("slot"))


def write_shards(documents: DataFrame, path: str, shards: int = 8) -> DataFrame:
    """Writes each shard's rows to a folder of its own; returns shard, n_rows, n_bytes of what was written.

    A range lies in one shard or a few neighbours, so tasks write few files; rows carry their slot, and files are
    sorted by it. Input columns called shard or slot are left out.
    """
    rows = sharded(documents, shards)
    clear = [F.col("doc")[c].alias(c) for c in documents.columns if c not in ("shard", "slot")]
    rows.select(*clear, "shard", "slot", F.col("size").alias("_size")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    back = documents.sparkSession.read.parquet(path)
    return back.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("_size").alias("n_bytes"))


def digests(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("doc")["text"], F.lit(""))
    return sharded(documents, shards).select(
        F.col("doc")["doc_id"].cast("bigint").alias("doc_id"), "size", F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
