"""Trie of conversation prefixes, by adaptive radix trees over fixed-width turn ids.

A turn's id is the 128-bit digest of its role and text, as 16 big-endian bytes; a conversation's key is the
concatenation of its ids. Texts leave the scan as digest and length only.

1. Conversations with the same key are counted before anything else: the trees hold distinct keys.
2. Keys are dealt to ranges of their byte order, cut where a range has `Params.turns` turns, so a first turn that a
   third of all conversations share is split like any other. A range knows how many turns its first key has in
   common with the key before it, and its last key with the key after it.
3. Every range builds one adaptive radix tree: compressed paths, and inner nodes whose layout grows from 4 and 16
   sorted bytes to an index of 48 and a direct table of 256. Paths split at any byte; only byte depths at the end of a turn are
   nodes of the trie.
4. All figures of a node are sums (or the least) over the keys below it: a node counts as a child, and its text is subtracted once, where
   its first key lies; a leaf is where no key goes on. So the few nodes on both sides of a cut are added up
   by Spark, and all others are complete in their range.
5. The ids of the conversations that end at a node are joined in sorted stretches by many tasks, and the stretches
   of a node are hashed one after the other as a stream.

Turns are ordered by turn, null first, then by id. Null roles and texts are empty; rows with a null conv_id are no
conversation. Repeated rows are turns of their own. An empty table has no nodes. A conversation is one row of 24
bytes a turn; its texts are never together. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from scriptloom.session import written

WIDTH = 16  # bytes of a turn id
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Params:
    turns: int = 100_000  # of a range, and one key more at most


# ---- the tree


class Sorted:
    """Up to `most` children by sorted byte: 4, then 16."""

    __slots__ = ("most", "bytes", "nodes")

    def __init__(self, most: int = 4):
        self.most, self.bytes, self.nodes = most, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Layout:
        """The layout that holds the child: this one, or a larger one."""
        if len(self.nodes) == self.most:
            grown = Sorted(16) if self.most == 4 else Indexed()
            for b, child in self:
                grown = grown.put(b, child)
            return grown.put(byte, node)
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes, strict=True)


class Indexed:
    """Up to 48 children behind a table of 256 places."""

    __slots__ = ("place", "nodes")

    def __init__(self):
        self.place, self.nodes = bytearray([255]) * 256, []

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.nodes[at] if at != 255 else None

    def put(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) == 48:
            grown = Direct()
            for b, child in self:
                grown.put(b, child)
            return grown.put(byte, node)
        self.place[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[at]) for b, at in enumerate(self.place) if at != 255)


class Direct:
    """A table of 256 children."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


Layout = Sorted | Indexed | Direct


class Node:
    """A compressed path, the number of the key that ends at its end (or -1), and children by their first byte."""

    __slots__ = ("path", "key", "children")

    def __init__(self, path: bytes, key: int = -1):
        self.path, self.key, self.children = path, key, None


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Bytes that a has in common with b from `at` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at:at + n]:
        return n
    low = 0  # equal up to low, different before n
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[at + low:at + middle]:
            low = middle
        else:
            n = middle
    return low


def insert(root: Node, key: bytes, number: int) -> None:
    node, at = root, 0
    while True:
        same = common(node.path, key, at)
        if same < len(node.path):
            lower = Node(node.path[same + 1:], node.key)
            lower.children = node.children
            node.children = Sorted().put(node.path[same], lower)
            node.path, node.key = node.path[:same], -1
        at += same
        if at == len(key):
            node.key = number
            return
        child = node.children.get(key[at]) if node.children is not None else None
        if child is None:
            node.children = (node.children if node.children is not None else Sorted()).put(key[at], Node(key[at + 1:], number))
            return
        node, at = child, at + 1


def built(keys: list[bytes]) -> Node:
    root = Node(keys[0], 0) if keys else Node(b"")
    for k in range(1, len(keys)):
        insert(root, keys[k], k)
    return root


class Below:
    """What hangs below a place of the tree: sums over its keys, and trie nodes that wait for their parent."""

    __slots__ = ("n", "least", "leaves", "weight", "owned", "tops", "low", "high", "orphans")

    def __init__(self):
        self.n = self.leaves = self.weight = self.owned = self.tops = 0
        self.least = self.low = self.high = None
        self.orphans: list[int] = []

    def add(self, n: int, least: int, low: int, high: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(least, self.least)
        self.low = low if self.low is None else min(low, self.low)
        self.high = high if self.high is None else max(high, self.high)

    def merge(self, x: Below) -> None:
        self.add(x.n, x.least, x.low, x.high)
        self.leaves += x.leaves
        self.weight += x.weight
        self.owned += x.owned
        self.tops += x.tops
        if len(x.orphans) > len(self.orphans):
            self.orphans, x.orphans = x.orphans, self.orphans
        self.orphans += x.orphans


def trie_nodes(keys: list[bytes], counts: list[int], least: list[int], sizes: list, before: int = -1, after: int = -1) -> list[list]:
    """[depth, least id, parent's place in the list (-1: none), n, children, leaves, saved, key that ends here (-1: none),
    whether on the first key, whether on the last key] of every trie node.

    keys: distinct, ascending. before, after: turns that the first key shares with the key before it and the last with the key after
    it, -1 where there is none; nodes up to there are parts of larger ones.
    """
    out: list[list] = []
    last = len(keys) - 1

    def end(node: Node, begin: int, upto: int, below: Below) -> Below:
        """Emits the aligned depths of the path of a node, which lies after `begin` and ends at `upto`."""
        if node.key >= 0:
            below.add(counts[node.key], least[node.key], node.key, node.key)
        for t in range(upto - upto % WIDTH, begin, -WIDTH):
            depth = t // WIDTH
            own = not (below.low == 0 and depth <= before)
            key = node.key if t == upto else -1
            if not below.orphans and not (key == last and depth <= after):
                below.leaves += 1
            size = int(sizes[below.low][depth - 1]) if depth else 0
            below.weight += below.n * size
            below.owned += size if own else 0
            for child in below.orphans:
                out[child][2] = len(out)
            out.append([depth, below.least, -1, below.n, below.tops, below.leaves, below.weight - below.owned, key,
                        below.low == 0, below.high == last])
            below.tops, below.orphans = int(own), [len(out) - 1]
        return below

    root = built(keys)
    # a frame: node, byte depth before its path (-1: the root's), byte depth of its end, children to come, sums
    frame = lambda node, begin, at: (node, begin, at + len(node.path), iter(node.children or ()), Below())
    stack = [frame(root, -1, 0)]
    while stack:
        node, begin, upto, rest, below = stack[-1]
        child = next(rest, None)
        if child is not None:
            stack.append(frame(child[1], upto, upto + 1))
            continue
        stack.pop()
        done = end(node, begin, upto, below)
        if stack:
            stack[-1][4].merge(done)
    return out


def prefix_digests(key: bytes, upto: int) -> list[bytes]:
    """Digest of the first d turns for d = 0 ... upto."""
    import xxhash

    state = xxhash.xxh3_128()
    out = [state.digest()]
    for d in range(upto):
        state.update(key[d * WIDTH:(d + 1) * WIDTH])
        out.append(state.digest())
    return out


# ---- conversations to keys


def gathered(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of turn, id, size in order) of every conversation. Written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
                    F.octet_length(text).cast("bigint").alias("size"))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t")).filter("conv_id is not null")
    return written(rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")), "conversations")


def with_borrowed_starts(rows: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """The same conversations, each starting with the first h turns of conversation c - c % every instead of its own
    first h; h = crc32(decimal c) % (most + 1)."""
    heads = rows.filter(f"conv_id % {every} = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    both = rows.withColumn("_h", h).join(heads, F.expr(f"conv_id - conv_id % {every}") == F.col("_base"), "left")
    none = F.expr("cast(array() as array<struct<turn:bigint,id:string,size:bigint>>)")
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return both.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), own).alias("turns"))


def keyed(rows: DataFrame) -> DataFrame:
    """conv_id, key, digest (of the key), sizes (bytes of the text of each turn). Written."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    out = rows.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    return written(out.select("conv_id", "key", F.unhex(F.md5("key")).alias("digest"), "sizes"), "keys")


def ends(rows: DataFrame) -> DataFrame:
    """digest, ends: SHA-256 of the ascending, comma-joined ids of all conversations with that key."""
    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                new = np.flatnonzero((x["digest"] != x["digest"].shift()).to_numpy())
                ids = x["conv_id"].tolist()
                text = [",".join(map(str, ids[a:b])) for a, b in zip(new, [*new[1:], len(x)], strict=True)]
                yield pd.DataFrame({"digest": x["digest"].to_numpy()[new], "first": [ids[a] for a in new], "ids": text})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last = None, None
        for x in batches:
            done = []
            for digest, ids in zip(x["digest"], x["ids"], strict=True):
                if digest != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    state, last = hashlib.sha256(ids.encode()), digest
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["digest", "ends"])
        if state is not None:
            yield pd.DataFrame({"digest": [last], "ends": [state.hexdigest()]})

    each = rows.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id") \
        .mapInPandas(stretches, "digest binary, first bigint, ids string")
    return each.repartition("digest").sortWithinPartitions("digest", "first").mapInPandas(stream, "digest binary, ends string")


# ---- ranges of keys, their trees, and what spans ranges


def ranged(keys: DataFrame, turns: int) -> DataFrame:
    """The keys with part, seq (a range of at most about `turns` turns of a part), shared (turns in common with the key before
    in the part; null for its first), opens (whether the first of its range). Written."""
    dealt = keys.repartitionByRange("key").sortWithinPartitions("key")
    extra = [StructField("part", IntegerType()), StructField("seq", LongType()), StructField("shared", IntegerType()), StructField("opens", BooleanType())]
    schema = StructType([*dealt.schema.fields, *extra])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            seqs, shared, opens = [], [], []
            for key in batch.column("key").to_pylist():
                n = len(key) // WIDTH + 1
                new = last is None or held + n > turns
                seq += last is not None and new
                held = n if new else held + n
                seqs.append(seq)
                shared.append(None if last is None else common(last, key) // WIDTH)
                opens.append(new)
                last = key
            more = [pa.array([part] * len(seqs), pa.int32()), pa.array(seqs, pa.int64()), pa.array(shared, pa.int32()), pa.array(opens, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [f.name for f in schema.fields])

    return written(dealt.mapInArrow(number, schema), "key-ranges")


def borders(rows: DataFrame) -> DataFrame:
    """part, seq, before, after: turns that the first and the last key of each range share with their neighbours, or -1."""
    @F.pandas_udf("int")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([-1 if x is None or y is None else common(x, y) // WIDTH for x, y in zip(a, b, strict=True)], dtype="int32")

    order = Window.orderBy("part")  # one row for each task that wrote
    parts = rows.groupBy("part").agg(F.min("key").alias("_first"), F.max("key").alias("_last"))
    parts = parts.select("part", "_first", "_last", F.lag("_last").over(order).alias("_ahead"), F.lead("_first").over(order).alias("_next"))
    parts = parts.select("part", shared("_ahead", "_first").alias("_before"), shared("_last", "_next").alias("_after"))
    inside = Window.partitionBy("part").orderBy("seq")
    return rows.filter("opens").join(F.broadcast(parts), "part").select(
        "part", "seq", F.coalesce("shared", "_before").alias("before"),
        F.coalesce(F.lead("shared").over(inside), "_after").alias("after"))


PARTIAL = ("part int, seq bigint, node binary, up binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
           "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string")


def partial_nodes(rows: DataFrame) -> DataFrame:
    """Trie nodes of every range. node: digest of a node that other ranges may share, else null; up: that of a shared parent. Written."""
    def trie(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("key")
        keys = x["key"].tolist()
        before, after = int(x["before"].iloc[0]), int(x["after"].iloc[0])
        nodes = trie_nodes(keys, x["n"].tolist(), x["least"].tolist(), x["sizes"].tolist(), before, after)
        firsts = prefix_digests(keys[0], before) if before >= 0 else []
        lasts = prefix_digests(keys[-1], after) if after >= 0 else []
        names = [firsts[d] if first and d <= before else lasts[d] if last_ and d <= after else None
                 for d, *_, first, last_ in nodes]
        text = x["ends"].tolist()
        out = []
        for (d, least, parent, n, children, leaves, saved, ending, _, _), name in zip(nodes, names, strict=True):
            up = names[parent] if parent >= 0 else None
            out.append((key[0], key[1], name, up, least, d, nodes[parent][1] if parent >= 0 and up is None else None, n, children,
                        leaves, saved, text[ending] if ending >= 0 else None))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in PARTIAL.split(", ")])
        frame["parent_conv_id"] = frame["parent_conv_id"].astype("Int64")
        return frame

    joined = rows.select("part", "seq", "key", "n", "least", "sizes", "ends").join(borders(rows), ["part", "seq"])
    return written(joined.groupBy("part", "seq").applyInPandas(trie, PARTIAL), "trie-parts")


def nodes_of(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """The trie's nodes over keyed conversations (see `keyed`): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    keys = rows.groupBy("digest").agg(F.first("key").alias("key"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    parts = partial_nodes(ranged(keys.join(ends(rows), "digest").drop("digest"), p.turns))
    spans = parts.filter("node is not null")
    whole = written(spans.groupBy("node").agg(
        F.max("up").alias("up"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *(
            F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends").alias("ends")), "trie-spans")
    named = whole.select(F.col("node").alias("_node"), F.col("conv_id").alias("_least"))
    # a parent that spans ranges, as each range knows it: the key of this join holds one range's nodes at most
    known = spans.select("part", "seq", F.col("node").alias("up")).join(named, F.col("up") == F.col("_node")).drop("_node")
    inner = parts.filter("node is null").join(known, ["part", "seq", "up"], "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least"))
    outer = whole.join(named, F.col("up") == F.col("_node"), "left").withColumn("parent_conv_id", F.col("_least"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")]
    return inner.select(*columns).unionByName(outer.select(*columns))


def prefix_nodes(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """Nodes of the conversations as they are."""
    return nodes_of(keyed(gathered(conversations)), p)


def rebuilt_nodes(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """Nodes of the conversations with borrowed starts."""
    return nodes_of(keyed(with_borrowed_starts(gathered(conversations))), p)
