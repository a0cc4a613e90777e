"""Near-duplicate documents by SetSketch registers, verified on full shingle sets.

A document's set holds its distinct windows of `Params.words` words (fewer words: the whole sequence as one),
after lower-casing A-Z. Register i of a sketch is the whole part of 1 - log_b of the least exponential variable
that hash i gives an element: exponentially spaced, truncated minima. Sketches of parts merge by the larger
register, and equal registers tell of a shared least element, so bands of registers are a locality-sensitive key.

1. Documents with the same set form a class with a number; everything below runs on these, so exact copies cost nothing.
2. Classes that agree on a band of registers share a bucket. Buckets are counted first, and only the rows of those with two or
   more members go on. In every bucket each class is compared with the bucket's first class only, so a bucket of any
   size yields one pair for each member.
3. A pair's similarity is estimated from the counts of larger, smaller and equal registers and the two set sizes
   together, by the likeliest value; pairs clearly below the threshold go. The rest is verified on the full sets.
4. Buckets that still span more than one component get all their other pairs across components compared, in
   blocks inside tasks: a pair is met in the first band it agrees on, estimated and verified there, and only links
   that join components leave the task, fewer than it has rows. Of buckets with the same members only that of the first band is compared. So
   no link between different components of a bucket is lost, however large it is, and no pairs are listed within a group.
5. Components of the verified links give each document the smallest doc_id it reaches.

A pair at the threshold shares no bucket with a probability of (1 - 0.8^5)^25 = 5e-5, and is dropped by the
estimate only if that is 0.2 too low (more than five standard deviations).

Edge cases: null, empty and white-space texts have an empty set, link with nothing and are kept. Rows with a null
doc_id link like others but are never the smallest id; where a component has no other its id is null. Rows that
repeat a doc_id with another text keep their own set. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scriptloom.llm.graph import components
from scriptloom.session import dropped, written

BROADCAST_ROWS = 200_000  # keys joined by broadcast; beyond, Spark chooses
BLOCK = 128


@dataclass(frozen=True)
class Params:
    words: int = 4
    percent: int = 80  # least similarity, in hundredths
    registers: int = 125
    band: int = 5
    base: float = 1.02
    likely: float = 0.6  # pairs estimated below this are not verified


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's n-word windows."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.empty(0, "uint64")
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=len(words))], "uint64")
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), "uint64", len(words))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = _mix(out) + h[k: len(h) - n + 1 + k]
    return np.unique(_mix(out))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _factors(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240817)
    return rng.integers(0, 2**63, m, dtype="uint64") * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, m, dtype="uint64")


def sketch(elements: np.ndarray, p: Params) -> np.ndarray:
    """Registers of a non-empty set."""
    a, b = _factors(p.registers)
    least = np.full(p.registers, np.iinfo("uint64").max, "uint64")
    for at in range(0, len(elements), 512):
        part = elements[at:at + 512, None] * a + b
        np.minimum(least, part.min(0), out=least)
    exponential = -np.log1p(-(least.astype("float64") + 0.5) / 2.0**64)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(p.base)), 0, 65535).astype("<u2")


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(one, other)


def likeliest(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, p: Params) -> np.ndarray:
    """Likeliest similarity given how many registers of a are larger and smaller than b's, and both set sizes."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.arange(0.0, 1.0001, 0.02)[None, :]
    chance = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (p.base - 1) / p.base) / np.log(p.base)
    up, down = chance(u - v * grid), chance(v - u * grid)
    same = np.clip(1 - up - down, 1e-9, 1)
    equal = p.registers - more - less
    fit = more[:, None] * np.log(up) + less[:, None] * np.log(down) + equal[:, None] * np.log(same)
    fit[(grid > np.minimum(u / v, v / u) + 1e-9) & (grid > 0)] = -np.inf
    return grid[0][fit.argmax(1)]


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, p: Params) -> np.ndarray:
    """Which rows may reach the threshold; a, b: registers by row."""
    out = 100 * np.minimum(n_a, n_b) >= p.percent * np.maximum(n_a, n_b)
    at = np.flatnonzero(out)
    if len(at):
        more, less = (a[at] > b[at]).sum(1), (a[at] < b[at]).sum(1)
        out[at] = likeliest(more, less, n_a[at].astype(float), n_b[at].astype(float), p) >= p.likely
    return out


def sketched(documents: DataFrame, p: Params) -> DataFrame:
    """doc_id, text_hash, n_shingles, key (of the set; null if empty), registers of every row."""
    import xxhash

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingles(text, p.words)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None,
                             sketch(s, p).tobytes() if len(s) else None))
            frame = pd.DataFrame(rows, columns=["n_shingles", "key", "registers"], index=batch.index)
            yield pd.concat([batch[["doc_id", "text_hash"]], frame], axis=1)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInPandas(run, "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, registers binary")


def buckets(classes: DataFrame, p: Params) -> DataFrame:
    """bucket, band, node: one row for each band of each class."""
    width = 2 * p.band
    return classes.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(p.registers // p.band - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("registers"), k * width + 1, F.lit(width))))).alias("band", "bucket"))


def shared_members(rows: DataFrame) -> DataFrame:
    """bucket, band, node, first (least node of the bucket) of the rows of buckets with two or more members. Written."""
    shared = rows.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    shared = written(shared, "near-buckets")
    out = written(rows.join(shared, "bucket"), "near-members")
    dropped(shared)
    return out


def plausible(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) of nodes whose estimate may reach the threshold. pairs: written."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    held = written(classes.join(nodes, "node", "left_semi").select("node", "n_shingles", "registers"), "near-registers")
    side = lambda x: held.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = rows.filter(100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                regs = lambda c: np.frombuffer(b"".join(c), "<u2").reshape(len(c), -1)
                keep = likely(regs(x["r_a"]), regs(x["r_b"]), x["n_a"].to_numpy(), x["n_b"].to_numpy(), p)
                yield x.loc[keep, ["a", "b"]]

    out = written(rows.mapInPandas(run, "a bigint, b bigint"), "near-pairs")
    dropped(held)
    return out


def texts_of(nodes: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """node, text of the classes with these nodes, each read from its first row. Written."""
    needed = written(classes.join(nodes, "node", "left_semi").select("node", "first"), "near-nodes")
    side = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    found = rows.join(side, rows["doc_id"].eqNullSafe(side["first"]["doc_id"]) & (rows["_hash"] == side["first"]["text_hash"]))
    out = written(found.select("node", "text").dropDuplicates(["node"]), "near-texts")
    dropped(needed)
    return out


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, p: Params) -> DataFrame:
    """The pairs whose full sets reach the threshold. pairs: written."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(nodes, classes, documents)
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, known = None, None
        for x in batches:
            keep = []
            for a, t_a, t_b in zip(x["a"], x["t_a"], x["t_b"], strict=True):
                if a != last:
                    last, known = a, shingles(t_a, p.words)
                other = shingles(t_b, p.words)
                common = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(100 * common >= p.percent * (len(known) + len(other) - common))
            yield x.loc[keep, ["a", "b"]]

    out = written(both.mapInPandas(run, "a bigint, b bigint"), "near-links")
    dropped(texts)
    return out


def first_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each bucket's least node with every other node of the bucket. Written."""
    return written(members.filter("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "near-first")


def mixed_buckets(rows: DataFrame) -> DataFrame:
    """bucket, main (its largest component), blocks of main and of the other members, for each set of members that spans components.

    rows: bucket, band, node, component. The least band stands for all buckets with the same members.
    """
    marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    each = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.min("band").alias("band"), *marks)
    mixed = each.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"), F.min("band").alias("band"),
        F.max_by("component", F.struct("n", "component")).alias("main"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    mixed = mixed.filter("parts > 1 and n > 2").groupBy("n", "x1", "x2").agg(
        F.min(F.struct("band", "bucket", "most", "main")).alias("b")).select("b.*", "n")
    return mixed.select("bucket", "main", F.expr(f"(most + {BLOCK - 1}) div {BLOCK}").alias("main_blocks"),
                        F.expr(f"(n - most + {BLOCK - 1}) div {BLOCK}").alias("other_blocks"))


def rest_links(members: DataFrame, labels: DataFrame, classes: DataFrame, documents: DataFrame, p: Params) -> DataFrame | None:
    """Links (a, b) across components that share a bucket; none where no bucket spans two components. Written.

    The members of a bucket's largest component (left) meet the others block by block, and the others meet among
    themselves.
    """
    rows = members.join(labels, members.node == labels.id, "left").select(
        "bucket", "band", "node", F.coalesce("component", "node").alias("component"))
    mixed = written(mixed_buckets(rows), "near-mixed")
    if mixed.isEmpty():
        dropped(mixed)
        return None
    own = written(rows.join(mixed, "bucket"), "near-mixed-members")
    texts = texts_of(own.select("node").distinct(), classes, documents)
    held = written(classes.join(texts, "node").select("node", "n_shingles", "registers", "text"), "near-held")
    dropped(texts)
    block = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.col(n))
    cell = lambda i, j, left: F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"), F.lit(left).alias("left"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    mine = block("other_blocks")
    # cell (i, j): block i of the left side with block j of the others; blocks of the largest component count from -1 down
    as_main = F.transform(upto("other_blocks"), lambda j: cell(-1 - block("main_blocks"), j, True))
    as_other = F.concat(
        F.transform(upto("main_blocks"), lambda i: cell(-1 - i, mine, False)),
        F.transform(upto("other_blocks"), lambda j: cell(F.least(mine, j), F.greatest(mine, j), False)))
    dealt = own.join(held, "node").withColumn("cell", F.explode(F.when(F.col("component") == F.col("main"), as_main).otherwise(as_other)))

    def compare(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("node")
        regs = np.frombuffer(b"".join(x["registers"]), "<u2").reshape(len(x), -1)
        bands = regs.reshape(len(x), -1, p.band)
        n, parts = x["n_shingles"].to_numpy(), pd.factorize(x["component"])[0]
        nodes, left, texts_, band = x["node"].to_numpy(), x["left"].to_numpy(bool), x["text"].to_numpy(), int(x["band"].iloc[0])
        sets: dict[int, np.ndarray] = {}
        out = []
        for k in np.flatnonzero(left) if int(key[1]) < 0 else range(len(x)):
            others = np.flatnonzero(~left & (parts != parts[k]) if int(key[1]) < 0 else (np.arange(len(x)) > k) & (parts != parts[k]))
            if not len(others):
                continue
            agree = (bands[others] == bands[k]).all(2)
            others = others[agree.argmax(1) == band]  # a bucket's members agree on its band at least
            others = others[likely(np.broadcast_to(regs[k], (len(others), regs.shape[1])), regs[others], np.full(len(others), n[k]), n[others], p)]
            for o in others:
                if parts[o] == parts[k]:
                    continue
                for y in (k, o):
                    if y not in sets:
                        sets[y] = shingles(texts_[y], p.words)
                common = len(np.intersect1d(sets[k], sets[o], assume_unique=True))
                if 100 * common >= p.percent * (len(sets[k]) + len(sets[o]) - common):
                    out.append((nodes[k], nodes[o]))
                    parts[parts == parts[o]] = parts[k]
        return pd.DataFrame(out, columns=["a", "b"])

    found = dealt.select("bucket", "cell.i", "cell.j", "cell.left", "band", "node", "component", "n_shingles", "registers", "text")
    out = written(found.groupBy("bucket", "i", "j").applyInPandas(compare, "a bigint, b bigint"), "near-rest")
    dropped(mixed, own, held)
    return out


def linked(documents: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash, group (its own name of the component; null if empty) of every row of documents."""
    rows = written(sketched(documents, p), "sketches")
    # one row for each set; `first` is where its text is read
    classes = written(rows.filter("key is not null").groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("doc_id").alias("least_id"),
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    members = shared_members(buckets(classes, p))
    first = first_pairs(members)
    pairs = plausible(first, classes, p)
    links = verified(pairs, classes, documents, p)
    dropped(first, pairs)
    labels = components(links)
    rest = rest_links(members, labels, classes, documents, p)
    if rest is not None:
        labels = components(links.unionByName(rest))
        dropped(rest)
    dropped(members, links)
    # classes that link with none are components of their own
    named = classes.select("node", "least_id").join(labels, F.col("node") == F.col("id"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("_least"))
    by_node = labels.join(smallest, "component")
    by_key = classes.join(by_node, classes.node == by_node.id, "left").select(
        "key", F.when(F.col("id").isNull(), F.col("least_id")).otherwise(F.col("_least")).alias("_component"),
        F.coalesce("component", "node").alias("group"))
    # one row for each set, so the hot side can be split
    out = rows.join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("_component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", "group")


def near_duplicates(documents: DataFrame, p: Params = Params()) -> DataFrame:
    return linked(documents, p).drop("text_hash", "group")


def kept_documents(documents: DataFrame, p: Params = Params()) -> DataFrame:
    """One row of each group, with its own columns as it came: the first by doc_id (nulls last) and text hash.

    Of rows equal in both any one stays, so null and repeated doc_ids leave one row too. Rows with an empty set stay.
    """
    each = linked(documents, p).filter("group is not null").groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("_n"))
    each = written(each.withColumn("_order", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")), "near-rows")
    first = each.groupBy("group").agg(F.min("_order").alias("_first"))
    marked = written(each.join(first, "group").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_n", F.col("_order").eqNullSafe(F.col("_first")).alias("_stays"))
        .filter("not _stays or _n > 1"), "near-marked")
    rows = documents.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("bigint").alias("_key"), F.xxhash64("text").alias("_text"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    repeated = marked.filter("_stays")
    out = rows.join(marked.select("_id", "_hash"), same, "left_anti")
    if repeated.limit(1).count():
        out = out.unionByName(rows.join(repeated.select("_id", "_hash"), same, "left_semi").dropDuplicates(["_key", "_text"]))
    return out.select("_doc.*")
