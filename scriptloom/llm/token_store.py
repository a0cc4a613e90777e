"""Token ids in binary shard files, with a minimal perfect hash index from document key to place.

Shard file: the ids of its records one after another (2 or 4 bytes each, little-endian), then a footer with the
first id of every record, the record keys, and a trailer. Shards hold the documents in ascending order of
doc_id (then of a hash of the text), nulls first; shard s ends where shard s + 1 begins.

Index file: for one part of the keys (by hash, about `PART` keys), a minimal perfect hash in levels of bit
arrays: a key that meets no other on its bit of a level is placed there, the others go on to the next level, and
the number of set bits before a key's bit is its slot. The slot holds a fingerprint of the key, the shard and the
record where the key begins, and the number of shards its records reach into. A lookup touches a few bits and one
slot, whatever the number of keys; a fingerprint or a footer key that differs means that the key is not stored.

Files are written by tasks under names of their own attempt; only files named in the manifest of a finished job
are ever read, so tasks that run again or twice do no harm. The folder is reached through pyarrow's file systems
and is shared by all executors; it lies in the folder that the cluster names in spark.checkpoint.dir.

Edge cases: null text is empty and has the end id alone. Rows that repeat a doc_id are records of their own that
follow each other; a lookup gives all of them. A null doc_id is looked up like any other. An empty table gives a
store without shards. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scriptloom.llm.bpe_words import encoder, groups, tokenizer_path
from scriptloom.session import checkpoint_root, written

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
PART = 200_000  # keys of an index file, about
MAGIC = b"IDSHARD1"
GAMMA = 2.0  # bits of a level for each key that reaches it
SLOT = np.dtype([("print", "<u4"), ("shard", "<i4"), ("record", "<i8"), ("shards", "<i4")])


# ---- files ----------------------------------------------------------------------------------------------------

def file_system(root: str):
    """(file system, folder) of a folder name with or without a scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def write_file(root: str, name: str, blocks: list[bytes]) -> None:
    system, folder = file_system(root)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/{name}") as out:
        for block in blocks:
            out.write(block)


class Shard:
    """One open shard file: footer in memory, ids read by range."""

    def __init__(self, root: str, name: str):
        system, folder = file_system(root)
        self.file = system.open_input_file(f"{folder}/{name}")
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        if tail[:8] != MAGIC:
            raise ValueError(f"{name} is no shard file")
        self.width, records = (int(x) for x in np.frombuffer(tail[8:], "<u8"))
        foot = self.file.read_at(8 * (records + 1) + 9 * records, size - 24 - 17 * records - 8)
        self.first = np.frombuffer(foot, "<u8", records + 1).astype("int64")
        self.keys = np.frombuffer(foot, "<i8", records, 8 * (records + 1))
        self.null = np.frombuffer(foot, "u1", records, 16 * records + 8)

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, record: int) -> np.ndarray:
        a, b = int(self.first[record]), int(self.first[record + 1])
        return np.frombuffer(self.file.read_at(self.width * (b - a), self.width * a), f"<u{self.width}").astype("<u4")


# ---- minimal perfect hash -------------------------------------------------------------------------------------

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """One-to-one scrambling of 64-bit keys, another for every seed."""
    x = keys.astype("<i8").view("<u8") + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """levels: bit arrays; starts: set bits before each level's 64-bit words."""

    levels: list[np.ndarray]

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (mixed(left, len(levels)) % np.uint64(size)).astype("int64")
            count = np.bincount(at, minlength=size)
            levels.append(count == 1)
            left = left[count[at] > 1]
            if len(levels) > 200:
                raise ValueError("keys repeat")
        return PerfectHash(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are surely not stored."""
        out, left, before = np.full(len(keys), -1, "int64"), np.arange(len(keys)), 0
        for k, bits in enumerate(self.levels):
            if not len(left):
                break
            rank = np.cumsum(bits) - 1
            at = (mixed(keys[left], k) % np.uint64(len(bits))).astype("int64")
            hit = bits[at]
            out[left[hit]] = before + rank[at[hit]]
            left, before = left[~hit], before + int(bits.sum())
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<u8").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @staticmethod
    def from_bytes(raw: bytes) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(raw, "<u8", 1)[0])
        sizes = np.frombuffer(raw, "<u8", n, 8).astype(int)
        at, levels = 8 * (n + 1), []
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, "u1", width, at))[:size].astype(bool))
            at += width
        return PerfectHash(levels), at


def index_bytes(keys: np.ndarray, shard: np.ndarray, record: np.ndarray, shards: np.ndarray) -> bytes:
    table = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    at = table.slots(keys)
    for name, value in (("print", mixed(keys, 1000) >> np.uint64(32)), ("shard", shard), ("record", record), ("shards", shards)):
        slots[name][at] = value
    return table.to_bytes() + slots.tobytes()


def look_up(raw: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, slot rows) of keys in one index file."""
    table, at = PerfectHash.from_bytes(raw)
    slots = np.frombuffer(raw, SLOT, offset=at)
    where = table.slots(keys)
    found = where >= 0
    rows = slots[np.where(found, where, 0)] if len(slots) else np.zeros(len(keys), SLOT)
    return found & (rows["print"] == (mixed(keys, 1000) >> np.uint64(32)).astype("<u4")), rows


# ---- store ----------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Store:
    """root: folder of the files; manifest: shard, file, n_records, n_ids, start; index: part, index_file; parts: their number."""

    root: str
    manifest: DataFrame
    index: DataFrame
    nulls: DataFrame
    parts: int

    def places(self, keys: DataFrame) -> DataFrame:
        """doc_id, shard, record, shards of each distinct key (column doc_id) that is stored."""
        root, parts = self.root, self.parts
        asked = keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
        known = asked.filter("doc_id is not null").withColumn("part", part_of(parts)).join(self.index, "part")
        dealt = known.repartition("part").sortWithinPartitions("part")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            system, folder = file_system(root)
            name, raw = None, b""
            for batch in batches:
                for file, rows in batch.groupby("index_file", sort=False):
                    if file != name:
                        with system.open_input_file(f"{folder}/{file}") as f:
                            name, raw = file, f.read()
                    found, slots = look_up(raw, rows["doc_id"].to_numpy("int64"))
                    yield pd.DataFrame({"doc_id": rows["doc_id"].to_numpy()[found], "shard": slots["shard"][found],
                                        "record": slots["record"][found], "shards": slots["shards"][found]})

        placed = dealt.select("doc_id", "index_file").mapInPandas(run, "doc_id bigint, shard int, record bigint, shards int")
        return placed.unionByName(self.nulls.join(asked.filter("doc_id is null").limit(1).select(F.lit(1).alias("_one")), F.lit(True))
                                  .drop("_one"))

    def records(self, keys: DataFrame) -> DataFrame:
        """doc_id, start, n_tokens, ids_crc32, shard, record of all records of the keys, read from the files."""
        root = self.root
        # the records of a key go on at the beginning of the next shards
        runs = self.places(keys).select("doc_id", F.posexplode(F.expr("sequence(shard, shard + shards - 1)")).alias("_k", "shard"),
                                        F.col("record").alias("_record"))
        runs = runs.select("doc_id", "shard", F.when(F.col("_k") == 0, F.col("_record")).otherwise(F.lit(0)).cast("bigint").alias("record"))
        dealt = runs.join(self.manifest.select("shard", "file", "start"), "shard") \
            .repartition(F.col("shard")).sortWithinPartitions("shard", "record")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, shard = None, None
            for batch in batches:
                out = []
                for r in batch.itertuples(index=False):
                    if r.file != name:
                        name, shard = r.file, Shard(root, r.file)
                    none, k = pd.isna(r.doc_id), int(r.record)
                    while k < len(shard) and bool(shard.null[k]) == none and (none or shard.keys[k] == r.doc_id):
                        ids = shard.ids(k)
                        out.append((None if none else int(r.doc_id), int(r.start + shard.first[k]), len(ids), zlib.crc32(ids.tobytes()), int(r.shard), k))
                        k += 1
                frame = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "record"])
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

        return dealt.select("doc_id", "shard", "record", "file", "start").mapInPandas(
            run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int, record bigint")


def part_of(parts: int):
    return F.expr(f"cast(pmod(xxhash64(doc_id), {parts}L) as int)")


def write_store(documents: DataFrame, path: str | None = None, end_id: int = END_ID) -> Store:
    """Encode, write the shards in order, then the index."""
    spark: SparkSession = documents.sparkSession
    path = path or tokenizer_path(TOKENIZER)
    root = f"{checkpoint_root(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    n = max(1, rows.rdd.getNumPartitions())
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        enc, shard = encoder(path), TaskContext.get().partitionId()
        width = 2 if max(len(enc.ends), enc.whole.get_vocab_size()) <= 65536 and end_id < 65536 else 4
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        system, folder = file_system(root)
        out, at, first, keys, null = None, 0, [0], [], []
        end = np.array([end_id], "<u4")
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            ids = batch["doc_id"].tolist()
            for a, b in groups(texts):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}")
                for doc_id, raw in zip(ids[a:b], enc.packed(texts[a:b]), strict=True):
                    record = np.concatenate([np.frombuffer(raw, "<u4"), end]).astype(f"<u{width}")
                    out.write(record.tobytes())
                    at += len(record)
                    first.append(at)
                    null.append(bool(pd.isna(doc_id)))
                    keys.append(0 if null[-1] else int(doc_id))
        if out is None:
            return
        for block in (np.array(first, "<u8"), np.array(keys, "<i8"), np.array(null, "u1")):
            out.write(block.tobytes())
        out.write(MAGIC + np.array([width, len(keys)], "<u8").tobytes())
        out.close()
        # one row for each key of the shard: where its records begin
        new = np.flatnonzero(np.r_[True, (np.diff(keys) != 0) | (np.diff(null) != 0)])
        for k in range(0, len(new), 10_000):
            part = new[k:k + 10_000]
            yield pd.DataFrame({
                "doc_id": pd.array([None if null[i] else keys[i] for i in part], "Int64"), "shard": shard, "file": name,
                "record": part.astype("int64"), "n_records": len(keys), "n_ids": at})

    found = written(dealt.mapInPandas(run, "doc_id bigint, shard int, file string, record bigint, n_records bigint, n_ids bigint"),
                    "shard-keys")
    # one row for each shard; the running total passes over their number, not over documents
    shards = found.groupBy("shard", "file").agg(F.first("n_records").alias("n_records"), F.first("n_ids").alias("n_ids"))
    start = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    manifest = written(shards.withColumn("start", F.coalesce(start, F.lit(0))), "shard-manifest")
    places = found.groupBy("doc_id").agg(F.min(F.struct("shard", "record")).alias("at"), F.count("*").cast("int").alias("shards")) \
        .select("doc_id", "at.shard", "at.record", "shards")
    keyed = written(places, "shard-places")
    parts = max(1, -(-keyed.count() // PART))

    def index(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        name = f"index-{int(key[0]):06d}-{uuid.uuid4().hex}.mph"
        write_file(root, name, [index_bytes(*(frame[c].to_numpy("int64") for c in ("doc_id", "shard", "record", "shards")))])
        return pd.DataFrame({"part": [int(key[0])], "index_file": [name]})

    built = keyed.filter("doc_id is not null").withColumn("part", part_of(parts)).groupBy("part") \
        .applyInPandas(index, "part int, index_file string")
    return Store(root, manifest, written(built, "index-manifest"), keyed.filter("doc_id is null"), parts)


def read_back(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard, record of every document, from the files by way of the index."""
    return write_store(documents, path).records(documents)
