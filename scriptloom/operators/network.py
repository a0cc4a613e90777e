"""The relation network: components, and shortest paths between entities.

Nodes are entity ids, or the names of tails that have none; direction and type of a relation do not matter for
reaching a node. Every round is a written table, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scriptloom.operators.skew import ROWS, lookup
from scriptloom.session import written


def links(relations: DataFrame) -> DataFrame:
    """Distinct (a, b, type), one row for each relation between two different named ends."""
    other = F.coalesce("tail", "tail_name")
    rows = relations.select(F.col("head").alias("a"), other.alias("b"), "type")
    return rows.filter("a is not null and b is not null and a <> b and a <> '' and b <> ''").distinct()


def both_ways(rows: DataFrame) -> DataFrame:
    return rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b"), *[c for c in rows.columns if c not in ("a", "b")]))


# ---- components


def _large_star(edges: DataFrame, least: int) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node around it."""
    both = written(both_ways(edges), "stars")
    top = both.groupBy("a").agg(F.min("b").alias("_near")).select("a", F.least("a", "_near").alias("_top"))
    joined = lookup(both, top, "a", ["b"], least=least).filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("_top").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame, least: int) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the smallest of them."""
    down = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    top = down.groupBy("a").agg(F.min("b").alias("_top"))
    moved = lookup(down, top, "a", ["b"], least=least).select(F.col("b").alias("a"), F.col("_top").alias("b"))
    return moved.unionByName(top.select("a", F.col("_top").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, least: int = ROWS) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of the edges (a, b).

    Large-star and small-star steps in turn: each replaces edges by edges of the same components, until every node
    hangs on its component's smallest node. No step holds more edges than there were, and the edges of a node with
    many neighbours are dealt over tasks.
    """
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "star-edges")
    mark = None
    while True:
        now = written(_small_star(_large_star(now, least), least), "star-edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == mark:
            break
        mark = state
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def component_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))


def component_of(rows: DataFrame, node: str) -> DataFrame:
    """All nodes that `node` is connected with, itself included."""
    own = rows.filter(F.col("node") == node).select("component")
    return rows.join(F.broadcast(own), "component", "left_semi")  # one row


# ---- paths


def _grown(front: DataFrame, seen: DataFrame, both: DataFrame, least: int) -> DataFrame:
    """Nodes next to the frontier that their search has not seen: pair, node. Written."""
    # nodes of several searches meet the same links: frontier rows are dealt like the links of a hub
    asked = front.select(F.col("node").alias("a")).distinct()
    near = written(both.join(asked, "a", "left_semi"), "near-links")
    hubs = near.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least)
    if hubs.isEmpty():
        reached = near.join(front.withColumnRenamed("node", "a"), "a")
    else:
        parts = written(hubs.select("a", F.ceil(F.col("_n") / least).cast("int").alias("_parts")), "hubs")
        part = F.pmod(F.xxhash64("b"), F.coalesce("_parts", F.lit(1))).cast("int").alias("_part")
        left = near.join(parts, "a", "left").select("a", "b", part)
        copies = front.withColumnRenamed("node", "a").join(parts, "a", "left")
        copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
        reached = left.join(copies, ["a", "_part"])
    fresh = reached.select("pair", F.col("b").alias("node")).distinct()
    return written(fresh.join(seen.select("pair", "node"), ["pair", "node"], "left_anti"), "frontier")


def paths(edges: DataFrame, pairs: DataFrame, most: int = 6, least: int = ROWS) -> DataFrame:
    """A shortest path for each (source, target) of `pairs` that has one of at most `most` links: source, target, hop (from 1),
    via (the node that the hop leads to), type (the first type of the link).

    Both ends are searched in turn, one level a round; a search that has met its other end stops. Of several shortest
    paths the one with the smallest nodes, first hop first, is returned. A pair of equal ends has no hop.
    """
    both = written(both_ways(edges.select("a", "b")).distinct(), "links")
    pairs = written(pairs.select("source", "target").filter("source <> target").distinct()
                    .select(F.monotonically_increasing_id().alias("pair"), "source", "target"), "pairs")
    sides = [written(pairs.select("pair", F.col(end).alias("node"), F.lit(0).alias("level")), "levels") for end in ("source", "target")]
    met = None  # pair, length, reach (levels searched from the source)
    open_ = pairs.select("pair")
    depth = [0, 0]
    for turn in range(most):
        side = turn % 2
        last = sides[side].filter(F.col("level") == depth[side]).select("pair", "node").join(open_, "pair", "left_semi")
        fresh = _grown(last, sides[side], both, least)
        depth[side] += 1
        sides[side] = written(sides[side].unionByName(fresh.withColumn("level", F.lit(depth[side]))), "levels")
        hit = fresh.join(sides[1 - side].filter(F.col("level") == depth[1 - side]).select("pair", "node"), ["pair", "node"], "left_semi")
        hit = written(hit.select("pair").distinct().select("pair", F.lit(depth[0]).alias("head"), F.lit(sum(depth)).alias("length")), "met")
        met = hit if met is None else met.unionByName(hit)
        open_ = written(open_.join(hit, "pair", "left_anti"), "open")
        if open_.isEmpty():
            break
    if met is None:
        met = pairs.select("pair", F.lit(0).alias("head"), F.lit(0).alias("length")).limit(0)
    met = written(met, "met-pairs")
    return _walked(both, edges, pairs, met, sides, sum(depth))


def _walked(both: DataFrame, edges: DataFrame, pairs: DataFrame, met: DataFrame, sides: list[DataFrame], longest: int) -> DataFrame:
    """The paths, from the levels of both searches."""
    # place of a node on shortest paths: its level from the source, or the path's length less its level from the target
    ahead = sides[0].join(met, "pair").filter("level <= head").select("pair", "node", F.col("level").alias("place"), "length")
    back = sides[1].join(met, "pair").filter("level <= length - head").select("pair", "node", (F.col("length") - F.col("level")).alias("place"), "length")
    middle = ahead.join(met.select("pair", F.col("head").alias("place")), ["pair", "place"]) \
        .join(back.select("pair", "node", "place"), ["pair", "node", "place"], "left_semi")
    # before the meeting level only nodes that lead to a meeting node count; after it every node of the other search leads on
    on = written(middle.select("pair", "node", "place"), "on-path")
    heads = on
    for step in range(1, longest + 1):
        prior = ahead.join(met.select("pair", (F.col("head") - step).alias("place")), ["pair", "place"])
        to = heads.select("pair", F.col("node").alias("b"))
        near = prior.select("pair", F.col("node").alias("a"), "place").join(both, "a").join(to, ["pair", "b"], "left_semi")
        heads = written(near.select("pair", F.col("a").alias("node"), "place").distinct(), "on-path")
        if heads.isEmpty():
            break
        on = on.unionByName(heads)
    after = back.join(met.select("pair", F.col("head")), "pair").filter("place > head").select("pair", "node", "place")
    on = written(on.unionByName(after), "on-path")
    at = pairs.join(met.select("pair", "length"), "pair").select("pair", F.col("source").alias("node"), "length")
    hops = None
    for hop in range(1, longest + 1):
        here = at.filter(F.col("length") >= hop).select("pair", F.col("node").alias("a"), "length")
        onward = on.filter(F.col("place") == hop).select("pair", F.col("node").alias("b"))
        step = onward.join(here, "pair").join(both, ["a", "b"], "left_semi").groupBy("pair", "a", "length").agg(F.min("b").alias("b"))
        step = written(step.withColumn("hop", F.lit(hop)), "hops")
        hops = step if hops is None else hops.unionByName(step)
        at = step.select("pair", F.col("b").alias("node"), "length")
    if hops is None:
        hops = at.select("pair", F.col("node").alias("a"), "length", F.col("node").alias("b"), F.lit(0).alias("hop")).limit(0)
    kinds = both_ways(edges.select("a", "b", "type")).groupBy("a", "b").agg(F.min("type").alias("type"))
    return hops.join(kinds, ["a", "b"]).join(pairs, "pair").select("source", "target", F.col("hop").cast("bigint").alias("hop"), F.col("b").alias("via"), "type")
