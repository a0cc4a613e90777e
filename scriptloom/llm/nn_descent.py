"""Near-duplicate vectors by NN-descent.

1. Equal vectors form one node with a count; all work below is on nodes.
2. First neighbours come from blocks of nodes that agree on the signs of random projections; a block larger than
   `Params.block` is split by signs about its own mean, and only what is still larger then by a hash.
3. Descent: around every node, its neighbours and those it is a neighbour of are compared with each other, and
   each keeps the best `Params.k`. Lists grow better as neighbours of neighbours meet.
4. A node whose whole list is links is saturated: it may have more, also in another component. All members of the
   components with such a node are compared, within a component and across: the core of a component (within half the
   threshold angle of its mean) links wholly, and two pieces whose centres and radii leave no doubt need no
   comparison; the others are compared block by block. Counts and links that join components leave the tasks.
5. The links of a bounded sample of nodes, as they are then, are audited against all nodes: the mean recall of nodes
   with links, apart for saturated and other nodes. Below `Params.recall`, fresh projections, twice as many,
   and more rounds follow; if the last start does not reach it, all nodes are compared with all, block by block.

Cosines are taken in double precision from the vectors as given. Vectors that are null, zero or hold null or
non-finite components link with nothing; so do vectors of different lengths with each other. Repeated rows are
rows of their own: equal vectors link, whatever their ids. A null vec_id is never the smallest id. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptloom.llm.graph import components
from scriptloom.session import written


@dataclass(frozen=True)
class Params:
    cosine: float = 0.9
    k: int = 10
    tables: int = 6  # projections of a start
    fill: int = 64  # nodes of a block, about
    block: int = 256  # nodes of a block, at most about
    rounds: int = 2  # descent rounds after a start
    starts: int = 4
    recall: float = 0.99
    audit: int = 400  # nodes of the audit


GRAPH = "a bigint, b bigint, sim double"


def units(vectors, kind: str) -> np.ndarray:
    """Vectors of length one; a power of two is taken out first, so that no square is beyond a double."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype("float64")
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Column: the vector can link at all."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(rows: DataFrame, kind: str) -> DataFrame:
    """node, embedding, dim, n, least_id, vec (bytes) of the distinct usable vectors."""
    @F.pandas_udf("binary")
    def raw(v: pd.Series) -> pd.Series:
        return v.map(lambda x: np.asarray(x, kind).tobytes())

    each = rows.filter(usable(F.col("embedding"))).groupBy("embedding").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    return written(each.select(F.monotonically_increasing_id().alias("node"), "embedding", F.size("embedding").alias("dim"),
                               "n", "least_id", raw("embedding").alias("vec")), "vector-nodes")


def start(nodes: DataFrame, count: int, kind: str, seed: int, p: Params) -> DataFrame:
    """Best neighbours inside blocks of equal projection signs; a later start (seed) has twice the tables of the one before."""
    bits = max(0, int(np.ceil(np.log2(max(1, count / p.fill)))))
    tables, deepest = p.tables << seed, 40

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                planes = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * bits))
                signs = (units(part["vec"], kind) @ planes > 0).reshape(len(part), tables, bits)
                codes = (signs * (1 << np.arange(bits, dtype="int64"))).sum(2) if bits else np.zeros((len(part), tables), "int64")
                for t in range(tables):
                    yield pd.DataFrame({"node": part["node"], "dim": dim, "t": t, "code": codes[:, t]})

    cell = ["dim", "t", "code"]
    coded = written(nodes.select("node", "dim", "vec").mapInPandas(code, "node bigint, dim int, t int, code bigint"), "vector-codes")
    full = written(coded.groupBy(*cell).agg(F.count("*").alias("_n")), "vector-codes")
    vecs = nodes.select("node", "vec")
    dealt = coded.join(full.filter(F.col("_n") <= p.block).drop("_n"), cell).withColumns({"sub": F.lit(0).cast("bigint"), "part": F.lit(0).cast("bigint")})
    crowded = full.filter(F.col("_n") > p.block)
    if crowded.limit(1).count():
        hot = coded.join(crowded, cell).join(vecs, "node")

        def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(*key, units(part["vec"], kind).sum(0).tobytes()) for key, part in batch.groupby(cell)]
                yield pd.DataFrame(rows, columns=[*cell, "total"])

        def total(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
            whole_ = np.frombuffer(b"".join(x["total"]), "f8").reshape(len(x), -1).sum(0)
            return pd.DataFrame([(*key, whole_.tobytes())], columns=[*cell, "total"])

        totals = hot.select(*cell, "vec").mapInPandas(add_up, "dim int, t int, code bigint, total binary") \
            .groupBy(*cell).applyInPandas(total, "dim int, t int, code bigint, total binary")

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for (dim, t), x in batch.groupby(["dim", "t"]):
                    planes = np.random.default_rng([seed, int(dim), int(t), 1]).standard_normal((int(dim), deepest))
                    n = x["_n"].to_numpy()
                    mean = np.frombuffer(b"".join(x["total"]), "f8").reshape(len(x), -1) / n[:, None]
                    used = np.arange(deepest) < np.ceil(np.log2(n / p.fill))[:, None]
                    sub = ((((units(x["vec"], kind) - mean) @ planes > 0) & used) * (1 << np.arange(deepest, dtype="int64"))).sum(1)
                    yield x[["node", *cell]].assign(sub=sub)

        fine = written(hot.join(totals, cell).select("node", *cell, "_n", "vec", "total").mapInPandas(
            split, "node bigint, dim int, t int, code bigint, sub bigint"), "vector-hot-codes")
        left = fine.groupBy(*cell, "sub").agg(F.count("*").alias("_m"))
        dealt = dealt.unionByName(fine.join(left, [*cell, "sub"]).withColumn(
            "part", F.expr(f"pmod(xxhash64(node, t), (_m + {p.block - 1}) div {p.block})")).drop("_m"))

    def near(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        u = units(x["vec"], kind)
        return best(x["node"].to_numpy(), u @ u.T, p.k)

    return dealt.join(vecs, "node").select(*cell, "sub", "part", "node", "vec").groupBy(*cell, "sub", "part").applyInPandas(near, GRAPH)


def best(ids: np.ndarray, sims: np.ndarray, k: int, least: np.ndarray | None = None) -> pd.DataFrame:
    """The k best others of each id, above its own least similarity if given."""
    np.fill_diagonal(sims, -2.0)
    k = min(k, len(ids) - 1)
    if k < 1:
        return pd.DataFrame({"a": ids[:0], "b": ids[:0], "sim": sims[:0, 0]})
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(ids)), k)
    a, b, s = ids[rows], ids[at.ravel()], sims[rows, at.ravel()]
    keep = s > (least[rows] if least is not None else -1.5)
    return pd.DataFrame({"a": a[keep], "b": b[keep], "sim": s[keep]})


def lists(graph: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of each node.

    The rank limit is applied before the shuffle as well, so a hub that a third of all rows name is never gathered.
    """
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), F.desc("b")))
    once = graph.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return once.withColumn("_rn", rank).filter(F.col("_rn") <= k).select("a", "b", "sim")


def descend(graph: DataFrame, nodes: DataFrame, kind: str, p: Params) -> DataFrame:
    """One round: the neighbours around each node meet each other."""
    back = lists(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"), p.k)
    around = graph.unionByName(back).select(F.col("a").alias("at"), F.col("b").alias("node")).distinct()
    least = graph.groupBy("a").agg(F.when(F.count("*") >= p.k, F.min("sim")).otherwise(-1.5).alias("least"))
    known = nodes.select("node", "vec").join(least, nodes.node == least.a, "left").select(
        "node", "vec", F.coalesce("least", F.lit(-1.5)).alias("least"))
    met = around.join(known, "node").groupBy("at").agg(F.collect_list(F.struct("node", "least", "vec")).alias("m"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for m in batch["m"]:
                if len(m) < 2:
                    continue
                ids = np.array([r["node"] for r in m], "int64")
                u = units([r["vec"] for r in m], kind)
                out.append(best(ids, u @ u.T, 3, np.array([r["least"] for r in m])))
            if out:
                yield pd.concat(out)

    found = met.select("m").mapInPandas(meet, GRAPH)
    return written(lists(graph.unionByName(found), p.k), "vector-graph")


def audited(found: DataFrame, nodes: DataFrame, kind: str, p: Params) -> float:
    """Mean share of its links (rows) that a node has in found, over a bounded sample against all nodes.

    Nodes with full lists are sampled and averaged apart, nodes without links left out; the lower mean counts.
    """
    each = nodes.join(found, "node").select("node", "dim", "vec", "links", "full")
    sample = [r for full in (False, True)
              for r in each.filter(F.col("full") == full).orderBy(F.xxhash64("node")).limit(p.audit).collect()]
    ids, dims = np.array([r.node for r in sample], "int64"), np.array([r.dim for r in sample])
    vecs = [r.vec for r in sample]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                at = np.flatnonzero(dims == dim)
                if len(at):
                    link = units([vecs[i] for i in at], kind) @ units(part["vec"], kind).T >= p.cosine
                    link &= ids[at][:, None] != part["node"].to_numpy()
                    yield pd.DataFrame({"node": ids[at], "links": link @ part["n"].to_numpy()}).query("links > 0")

    true = nodes.select("node", "dim", "n", "vec").mapInPandas(compare, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))
    true = {r.node: r.links for r in true.collect()}  # a row for each node of the sample
    shares = [[min(1.0, r.links / true[r.node]) for r in sample if r.full == full and r.node in true] for full in (False, True)]
    return float(min([np.mean(x) for x in shares if x], default=1.0))


def both_ways(links: DataFrame) -> DataFrame:
    pairs = links.select("a", "b")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def whole(members: DataFrame, kind: str, p: Params) -> tuple[DataFrame, DataFrame]:
    """Exact links among all members (part, label, node, dim, n, vec).

    node, links (rows that it links with, its own left out) of every member, and joins (a, b) of labels that are linked.
    A part is cut into its core, whose members all link, and the rest. By the triangle inequality two pieces link
    wholly, not at all, or are compared member by member.
    """
    wide = 8 * p.block

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(c, units(part["vec"], kind).sum(0).tobytes()) for c, part in batch.groupby("part")]
            yield pd.DataFrame(rows, columns=["part", "total"])

    def mean(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(b"".join(x["total"]), "f8").reshape(len(x), -1).sum(0)
        return pd.DataFrame({"part": [key[0]], "center": [total.tobytes()]})

    centers = written(members.select("part", "vec").mapInPandas(add_up, "part bigint, total binary")
                      .groupBy("part").applyInPandas(mean, "part bigint, center binary"), "vector-centers")
    half = np.sqrt((1 + p.cosine) / 2) + 1e-9

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, x in batch.groupby("dim"):
                with np.errstate(invalid="ignore"):  # a centre may be zero
                    near = np.nan_to_num((units(x["vec"], kind) * units(x["center"], "f8")).sum(1), nan=-1.0)
                yield x.drop(columns="center").assign(near=near, core=near >= half)

    placed = members.join(centers, "part").select("part", "label", "node", "dim", "n", "vec", "center").mapInPandas(
        place, "part bigint, label bigint, node bigint, dim int, n bigint, vec binary, near double, core boolean")
    placed = written(placed.withColumn("piece", F.col("part") * 2 + F.col("core").cast("bigint")), "vector-members")
    pieces = written(placed.groupBy("piece", "part", "core", "dim").agg(
        F.min("near").alias("near"), F.sum("n").alias("rows"), F.count("*").alias("size"),
        F.min("label").alias("first")).join(centers, "part"), "vector-pieces")

    blocks = (pieces.count() + wide - 1) // wide
    mine = F.pmod(F.xxhash64("piece"), F.lit(blocks))
    cells = F.transform(F.sequence(F.lit(0), F.lit(max(0, blocks - 1))), lambda j: F.struct(
        F.least(mine, j.cast("bigint")).alias("i"), F.greatest(mine, j.cast("bigint")).alias("j")))
    angle = np.arccos(p.cosine)

    def meet(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        at = x["mine"].to_numpy()
        l, r = np.flatnonzero(at == key[1]), np.flatnonzero(at == key[2])
        ids, own, reach = x["piece"].to_numpy(), x["core"].to_numpy(bool), np.arccos(np.clip(x["near"].to_numpy(), -1, 1))
        with np.errstate(invalid="ignore"):
            c = units(x["center"], "f8")
            apart = np.arccos(np.clip(c[l] @ c[r].T, -1, 1))
        both = reach[l][:, None] + reach[r]
        may = ~(apart - both > angle + 1e-7)
        sure = apart + both <= angle - 1e-7
        same = ids[l][:, None] == ids[r]
        sure = np.where(same, own[l][:, None], sure)
        if key[1] == key[2]:
            may &= ids[l][:, None] <= ids[r]
        i, j = np.nonzero(may)
        return pd.DataFrame({"p": ids[l][i], "q": ids[r][j], "sure": sure[i, j]})

    met = written(pieces.select("dim", "piece", "core", "near", "center", mine.alias("mine"), F.explode(cells).alias("cell"))
                  .select("dim", "cell.i", "cell.j", "mine", "piece", "core", "near", "center")
                  .groupBy("dim", "i", "j").applyInPandas(meet, "p bigint, q bigint, sure boolean"), "vector-piece-pairs")
    surely = met.filter("sure").select(F.col("p").alias("piece"), F.col("q").alias("other"))
    surely = surely.unionByName(surely.filter("piece <> other").select(F.col("other").alias("piece"), F.col("piece").alias("other")))
    other = pieces.select(F.col("piece").alias("other"), F.col("rows").alias("_rows"), F.col("first").alias("b"))
    surely = surely.join(other, "other")
    known = surely.groupBy("piece").agg(F.sum("_rows").alias("all")).join(pieces.select("piece", "first"), "piece")
    inside = placed.join(known, "piece").select(
        "node", (F.col("all") - F.when(F.col("core"), F.col("n")).otherwise(0)).alias("links"))
    joins = surely.join(pieces.select("piece", F.col("first").alias("a")), "piece").select("a", "b").unionByName(
        placed.join(known, "piece").select(F.col("first").alias("a"), F.col("label").alias("b")))

    of = lambda n: F.expr(f"({n} + {wide - 1}) div {wide}")
    block = lambda n: F.pmod(F.xxhash64("node"), of(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), of(n) - 1))
    size = lambda x: pieces.select(F.col("piece").alias(x), F.col("size").alias(f"n_{x}"))
    open_ = written(met.filter("not sure").drop("sure").join(size("p"), "p").join(size("q"), "q"), "vector-open-pairs")
    held = ["p", "q", "label", "node", "n", "vec"]
    left = placed.join(open_, F.col("piece") == F.col("p")).select(
        *held, block("n_p").alias("i"), upto("n_q").alias("j"), F.lit(True).alias("left"))
    right = placed.join(open_, F.col("piece") == F.col("q")).select(
        *held, upto("n_p").alias("i"), block("n_q").alias("j"), F.lit(False).alias("left"))

    def compare(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        l, r = x[x["left"]], x[~x["left"]]
        if not len(l) or not len(r):
            return pd.DataFrame({"node": x["node"][:0], "links": x["n"][:0], "a": x["node"][:0], "b": x["node"][:0]})
        link = (units(l["vec"], kind) @ units(r["vec"], kind).T >= p.cosine) & (l["node"].to_numpy()[:, None] != r["node"].to_numpy())
        out = [pd.DataFrame({"node": l["node"], "links": link @ r["n"].to_numpy()})]
        if key[0] != key[1]:  # else each pair comes both ways
            out.append(pd.DataFrame({"node": r["node"], "links": l["n"].to_numpy() @ link}))
        here, there = l["label"].to_numpy(), r["label"].to_numpy()
        i, j = np.nonzero(link & (here[:, None] != there))
        out.append(forest(here[i], there[j]))
        return pd.concat(out).astype({c: "Int64" for c in ("node", "links", "a", "b")})[["node", "links", "a", "b"]]

    compared = written(left.unionByName(right).groupBy("p", "q", "i", "j").applyInPandas(
        compare, "node bigint, links bigint, a bigint, b bigint"), "vector-compared")
    counts = compared.filter("node is not null").select("node", "links").unionByName(inside).groupBy("node").agg(F.sum("links").alias("links"))
    joins = joins.filter("a <> b").unionByName(compared.filter("node is null").select("a", "b"))
    return counts, joins.distinct()


def forest(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Those of the pairs that join what is not joined yet."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := top.get(x, x)) != x:
            top[x] = x = top.get(y, y)
        return x

    out = []
    for x, y in np.unique(np.c_[a, b], axis=0).tolist() if len(a) else []:
        if (s := find(x)) != (t := find(y)):
            top[s] = t
            out.append((x, y))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def relabelled(found: DataFrame, joins: DataFrame) -> DataFrame:
    """found, with the labels in `component` merged along the joins."""
    tops = components(joins).select(F.col("id").alias("component"), F.col("component").alias("_top"))
    return found.join(tops, "component", "left").withColumn("component", F.coalesce("_top", "component")).drop("_top")


def finished(graph: DataFrame, nodes: DataFrame, kind: str, p: Params) -> DataFrame:
    """node, component, links (rows), full (its list was saturated) of every node.

    A link that neither of its two lists holds has two saturated ends, so the components with a saturated node are
    compared with each other, as wholes.
    """
    links = written(both_ways(graph.filter(F.col("sim") >= p.cosine)), "vector-links")
    labels = components(links)
    full = written(graph.filter(F.col("sim") >= p.cosine).groupBy("a").count().filter(F.col("count") >= p.k)
                   .select(F.col("a").alias("node"), F.lit(True).alias("full")), "vector-full")
    wide = full.join(labels, full.node == labels.id).select("component").distinct()
    members = written(labels.join(wide, "component").join(nodes, labels.id == nodes.node).select(
        F.col("component").alias("part"), F.col("component").alias("label"), "node", "dim", "n", "vec"), "vector-saturated")
    by_list = links.join(nodes.select(F.col("node").alias("b"), "n"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("listed"))
    counts, joins = whole(members, kind, p)
    found = (nodes.select("node").join(labels.select(F.col("id").alias("node"), "component"), "node", "left")
             .join(by_list, "node", "left").join(counts, "node", "left").join(full, "node", "left")
             .select("node", F.coalesce("component", "node").alias("component"), F.coalesce("links", "listed", F.lit(0)).alias("links"),
                     F.coalesce("full", F.lit(False)).alias("full")))
    return written(relabelled(found, joins), "vector-found")


def exact(found: DataFrame, nodes: DataFrame, kind: str, p: Params) -> DataFrame:
    """found, from all nodes against all, block by block."""
    members = nodes.join(found, "node").select(
        F.col("dim").cast("bigint").alias("part"), F.col("component").alias("label"), "node", "dim", "n", "vec")
    counts, joins = whole(members, kind, p)
    counted = found.drop("links").join(counts, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    return written(relabelled(counted, joins), "vector-found")


def linked(embeddings: DataFrame, p: Params = Params()) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    kind = "<f4" if "float" in embeddings.schema["embedding"].dataType.simpleString() else "<f8"
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    nodes = nodes_of(rows, kind)
    count = nodes.count()
    graph = None
    for k in range(p.starts):
        fresh = start(nodes, count, kind, k, p)
        graph = written(lists(fresh if graph is None else graph.unionByName(fresh), p.k), "vector-graph")
        for _ in range(p.rounds):
            graph = descend(graph, nodes, kind, p)
        found = finished(graph, nodes, kind, p)
        if audited(found, nodes, kind, p) >= p.recall:
            break
    else:
        found = exact(found, nodes, kind, p)
    least = nodes.join(found, "node").select("embedding", "n", "least_id", "component", "links")
    smallest = least.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = least.join(smallest, "component").select("embedding", "component_id", (F.col("n") - 1 + F.col("links")).alias("n_links"))
    out = rows.join(known, "embedding", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
