"""Product codes of vectors in exact integers, nearest entries found by LAESA pivots.

Components become floor(1024 * x), in longs. A vector is cut into equal consecutive parts; each part position has a
codebook, which starts as that part of the vectors with the smallest ids and is moved by rounds of assignment and
floored means.

1. The vectors that can be coded are written once, as integers, with the distances of each part to the fixed pivots
   of its position: entries of the first codebook, far from each other.
2. A round takes the distances of pivots and entries. By the triangle inequality |d(part, pivot) - d(entry, pivot)| bounds
   d(part, entry) from below; a part's entries are taken in the order of their largest such bound, and only those
   whose bound does not exceed the best distance so far are evaluated, exactly. Bounds are lowered by more than their
   rounding error, and an entry at the same distance with a lower index wins, so pruning changes no code.
3. Tasks add up their parts by entry; Spark adds those sums. Only codebooks reach the driver: entries x dimension numbers.

Rows whose vector is null or holds null, NaN or infinite components are dropped; so are those with a component of
2^52 or more in magnitude, and vectors of another length than most (ties: the shorter) or whose length the number of parts does not divide.
Lengths of 0 give codes of zeros. Null ids come last and repeated ids are ordered by their vectors; fewer vectors than entries
give a shorter codebook. An empty table gives an empty result. Sums are decimals where components pass 2^28; an
error beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptloom.session import written

SCALE = 1024
NARROW = 2 ** 28  # components below keep squared distances and sums of 2^35 rows within longs
GUARD = 4e-7  # of the two distances: more than what 32-bit floats and the roots lose
LONGEST = 2 ** 63 - 1


@dataclass(frozen=True)
class Params:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    pivots: int = 8
    block: int = 8  # entries evaluated at a time, in the order of their bounds
    rows: int = 4096  # vectors compared at a time


def coded_rows(embeddings: DataFrame, p: Params) -> tuple[DataFrame, int, bool]:
    """vec_id, label, v (array<bigint>) of the rows that can be coded; their length; whether longs hold all sums."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2 ** 52)))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(x.isNotNull() & F.coalesce(fine, F.lit(False)))
    ints = rows.select("vec_id", "label", F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))
    most = F.coalesce(F.aggregate("v", F.lit(0).cast("bigint"), lambda a, c: F.greatest(a, F.abs(c))), F.lit(0))
    lengths = ints.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), F.max(most).alias("most")) \
        .filter(f"n % {p.parts} = 0").orderBy(F.desc("rows"), "n").limit(1).collect()
    n, most = (lengths[0].n, lengths[0].most) if lengths else (0, 0)
    return ints.filter(F.size("v") == n), n, most < NARROW


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(-1)


def distances(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row of a to each pivot, as floats."""
    out = np.empty((len(a), len(pivots)))
    for k, pivot in enumerate(pivots):
        out[:, k] = np.sqrt(squared(a, pivot).astype("float64"))
    return out


def far_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """The first entry, then always the entry farthest from those taken (ties: the lowest)."""
    taken = [0]
    near = squared(entries, entries[0])
    while len(taken) < min(count, len(entries)) and near.max() > 0:
        taken.append(int(np.argmax(near)))
        near = np.minimum(near, squared(entries, entries[taken[-1]]))
    return entries[taken]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray, block: int = 8,
            evaluated: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lowest) and the exact squared distance for each part."""
    bound = np.zeros((len(parts), len(entries)))
    for k in range(to_pivots.shape[1]):
        a, b = to_pivots[:, k, None].astype("float64"), entry_pivots[None, :, k]
        np.maximum(bound, np.abs(a - b) - GUARD * (a + b), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.zeros(len(parts), parts.dtype)
    index = np.full(len(parts), -1)
    rows = np.arange(len(parts))
    for at in range(0, len(entries), block):
        if at:
            reach = np.sqrt(best[rows].astype("float64")) * (1 + 1e-12)
            rows = rows[bound[rows, order[rows, at]] <= reach]
        if not len(rows):
            break
        some = order[rows, at:at + block]
        exact = squared(parts[rows, None, :], entries[some])
        if evaluated is not None:
            evaluated[0] += exact.size
        least = exact.min(1)
        first = np.where(exact == least[:, None], some, len(entries)).min(1)
        better = (index[rows] < 0) | (least < best[rows]) | ((least == best[rows]) & (first < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], first[better]
    return index, best


class Coder:
    """What a task needs: codebooks and pivots of every position."""

    def __init__(self, books: list[np.ndarray], pivots: list[np.ndarray], p: Params):
        self.books, self.pivots, self.p = books, pivots, p
        self.entry_pivots = [distances(b, q) for b, q in zip(books, pivots, strict=True)]

    def batches(self, table: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list]]:
        """Batch, its vectors, and (index, squared distance) by position."""
        kind, width = self.books[0].dtype, self.books[0].shape[1]
        for batch in table:
            for at in range(0, batch.num_rows, self.p.rows):
                rows = batch.slice(at, self.p.rows)
                v = rows.column("v").flatten().to_numpy().reshape(rows.num_rows, self.p.parts, width).astype(kind)
                to = rows.column("to_pivots").flatten().to_numpy().reshape(rows.num_rows, -1)
                found, k = [], 0
                for q in range(self.p.parts):
                    m = len(self.pivots[q])
                    found.append(nearest(v[:, q], to[:, k:k + m], self.books[q], self.entry_pivots[q], self.p.block))
                    k += m
                yield rows, v, found


def with_pivots(rows: DataFrame, pivots: list[np.ndarray], p: Params) -> DataFrame:
    """vec_id, label, v, to_pivots (32-bit floats, position after position). Written."""
    kind, width = pivots[0].dtype, pivots[0].shape[1]

    def measure(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            if not batch.num_rows:
                continue
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, p.parts, width).astype(kind)
            to = np.concatenate([distances(v[:, q], pivots[q]) for q in range(p.parts)], axis=1).astype("float32")
            column = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype="int32") * to.shape[1], pa.array(to.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "to_pivots"])

    return written(rows.mapInArrow(measure, "vec_id bigint, label int, v array<bigint>, to_pivots array<float>"), "vectors")


def moved(table: DataFrame, coder: Coder, narrow: bool) -> list[np.ndarray]:
    """The codebooks after one round."""
    p, width = coder.p, coder.books[0].shape[1]
    number, kind = ("bigint", "int64") if narrow else ("decimal(38,0)", object)
    sums = [f"s{i}" for i in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), width), kind) for b in coder.books]
        count = [np.zeros(len(b), "int64") for b in coder.books]
        for _, v, found in coder.batches(batches):
            for q, (index, _) in enumerate(found):
                np.add.at(total[q], index, v[:, q])
                count[q] += np.bincount(index, minlength=len(count[q]))
        for q in range(p.parts):
            used = np.flatnonzero(count[q])
            kinds = pa.int64() if narrow else pa.decimal128(38, 0)
            columns = [pa.array(np.full(len(used), q), pa.int32()), pa.array(used, pa.int32()), pa.array(count[q][used], pa.int64()),
                       *(pa.array(total[q][used, i].tolist(), kinds) for i in range(width))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *sums])

    each = table.mapInArrow(add, ", ".join(["part int", "entry int", "n bigint", *(f"{s} {number}" for s in sums)]))
    books = [b.copy() for b in coder.books]
    for r in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(s).cast(number).alias(s) for s in sums)).collect():
        books[r.part][r.entry] = [int(r[s]) // r.n for s in sums]  # at most parts x entries rows
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def coded(embeddings: DataFrame, p: Params = Params()) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, codes (one index for each part), error of every row that can be coded (written); the final codebooks."""
    rows, length, narrow = coded_rows(embeddings, p)
    width = length // p.parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(p.entries).collect()
    kind = "int64" if narrow else object
    start = np.array([r.v for r in first] or [[0] * length], kind).reshape(len(first) or 1, p.parts, width)
    books = [start[:, q] for q in range(p.parts)]
    pivots = [far_pivots(b, p.pivots) for b in books]
    table = with_pivots(rows, pivots, p)
    for _ in range(p.rounds if first else 0):
        books = moved(table, Coder(books, pivots, p), narrow)
    coder = Coder(books, pivots, p)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, found in coder.batches(batches):
            index = np.stack([i for i, _ in found], axis=1).astype("int32")
            error = sum(d for _, d in found)
            error = pa.array([int(e) if e <= LONGEST else None for e in error.tolist()], pa.int64())
            column = pa.ListArray.from_arrays(np.arange(len(index) + 1, dtype="int32") * p.parts, pa.array(index.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), column, error], ["vec_id", "label", "codes", "error"])

    out = table.mapInArrow(assign, "vec_id bigint, label int, codes array<int>, error bigint")
    return written(out, "codes"), books


def compressed(embeddings: DataFrame, p: Params = Params()) -> DataFrame:
    """vec_id, code (two hex digits for each part), error, label_error, codebooks_sha256 of every row that can be coded."""
    rows, books = coded(embeddings, p)
    each = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.bool_and(F.col("error").isNotNull()).alias("_all"))
    fits = F.when(F.col("_all") & (F.col("_sum") <= LONGEST), F.col("_sum").cast("bigint"))
    each = each.select(F.col("label").alias("_label"), fits.alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return rows.join(each, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
