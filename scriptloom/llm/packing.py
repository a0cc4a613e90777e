"""Best-fit-decreasing packing of token pieces into sequences of a fixed length.

A document's ids end with one end id. Documents longer than a sequence are cut into full pieces and a rest; no
other document is cut. Pieces are dealt evenly over groups of about `GROUP` pieces by a hash that is never hot,
and every group is packed by itself: longest piece first, each into the open sequence with the least room that
still holds it. The open sequences are kept by their room in a segment tree whose nodes count the sequences
below them, so the tightest one is found in as many steps as the tree is deep. A group's loss against one
packing of everything is less than a sequence; a cluster packs all groups at once.

Edge cases: null text is empty and yields its end id alone. Repeated rows are packed one by one. An empty table
gives an empty result. Ties of length go by doc_id, piece. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptloom.llm.bpe_words import encoder, groups, tokenizer_path
from scriptloom.session import written

LENGTH = 2048
END_ID = 0
GROUP = 50_000
ROWS = 128  # texts of an Arrow batch that are Python strings at a time
TOKENIZER = "word_bpe_49k.json"
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(documents: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with its ids if asked for, and the row's number in its task."""
    path = path or tokenizer_path(TOKENIZER)
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = PIECE + ", _row bigint" + (", ids array<int>" if with_ids else "")

    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][:len(names)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(path), 0
        # a batch may hold thousands of long texts: few of them at a time become Python strings
        for few in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
            texts, ids = few["text"].to_pylist(), few["doc_id"].to_pylist()
            for a, b in groups(texts):
                out = []
                for doc_id, raw in zip(ids[a:b], enc.packed(texts[a:b]), strict=True):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * length)):
                        part = raw[at:at + 4 * length]
                        out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), row)
                                   + ((np.frombuffer(part, "<u4").astype("i4"),) if with_ids else ()))
                        row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)


class Room:
    """Open sequences by the room they have left; a segment tree of counts finds the least that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of the tightest open sequence with room for `need`, which leaves the tree."""
        count, node = self.count, need + self.size
        if not count[node]:
            # up to the first right-hand neighbour that holds something, then down to its least room
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not count[2 * node])
        room = node - self.size
        self._add(room, -1)
        return room, self.open[room].pop()

    def _add(self, room: int, by: int) -> None:
        count, node = self.count, room + self.size
        while node:
            count[node] += by
            node >>= 1


def best_fit(lengths: list[int], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length, given longest first."""
    tree, sequences, offsets, used = Room(length), [], [], 0
    for n in lengths:
        found = tree.take(n)
        room, sequence = found if found else (length, used)
        used += not found
        sequences.append(sequence)
        offsets.append(length - room)
        if room > n:
            tree.put(room - n, sequence)
    return sequences, offsets


def placed(rows: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Written pieces with sequence_id and offset."""
    n_groups = max(1, -(-rows.count() // group))
    keyed = rows.select("doc_id", "piece", "start", "length", "ids_crc32",
                        F.expr(f"pmod(xxhash64(doc_id, piece, ids_crc32, _row), {n_groups}L)").alias("_group"))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequences, offsets = best_fit(frame["length"].tolist(), length)
        frame["sequence_id"] = np.asarray(sequences, dtype="int64") + (int(key[0]) << 32)
        frame["offset"] = np.asarray(offsets, dtype="int64")
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame.drop(columns="_group")

    return keyed.groupBy("_group").applyInPandas(pack, PIECE + ", sequence_id bigint, offset bigint")


def packed(documents: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return placed(written(pieces(documents, path, length), "pieces"), length)


def sequences(documents: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and the pieces in them by offset."""
    rows = written(pieces(documents, path, length, with_ids=True), "pieces-with-ids")
    where = placed(rows, length)
    numbered = lambda df: df.withColumn("_copy", F.expr(
        "row_number() over (partition by doc_id, piece, start, length, ids_crc32 order by 1)"))
    same = ["doc_id", "piece", "start", "length", "ids_crc32", "_copy"]
    joined = numbered(where).join(numbered(rows).drop("_row"), same)
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    return joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"))
