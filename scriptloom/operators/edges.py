"""Edge layers: explicit links, key-name edges, their union and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.operators.participants import TIER_RANK, tier_rank

EDGE_SCHEMA = (
    "entity_id string, container_id string, stage_idx bigint, source string, tier string, "
    "spoke_lines bigint, mention_count bigint, matched_aliases array<string>, story_set_name string"
)


def explicit_edges(resolved_links: DataFrame) -> DataFrame:
    """Linked rows of `chunks.resolve_links` as edges."""
    return resolved_links.filter(F.col("status") == "linked").select(
        "entity_id", "container_id", "stage_idx",
        F.lit("deterministic").alias("source"), F.col("link_name").alias("story_set_name"),
    )


def resolved_names(key_names: DataFrame, alias_index: DataFrame) -> DataFrame:
    """Key-name rows (container_id, stage_idx, ord, name) joined with the alias index."""
    side = alias_index.select(F.col("alias").alias("name"), "n_ids", "sole_id")
    return key_names.join(side, "name", "left")


def unresolved(rows: DataFrame) -> DataFrame:
    """Distinct (container_id, name) that no alias knows; ambiguous names are not reported."""
    return rows.filter("n_ids is null").select("container_id", "name").distinct()


def _layer(rows: DataFrame, keys: list[str]) -> DataFrame:
    names = F.array_sort(F.collect_list(F.struct("ord", "name")))
    return rows.groupBy(*keys).agg(F.transform(names, lambda p: p["name"]).alias("matched_aliases"))


def summary_edges(
    stage_names: DataFrame,
    container_names: DataFrame,
    alias_index: DataFrame,
    explicit: DataFrame | None = None,
    skip_ids: DataFrame | None = None,
) -> DataFrame:
    """Edges from key names: per chunk, and per container where no chunk of it already has one.

    Explicit links suppress the same (entity, chunk) and, for container rows, (entity, container).
    `skip_ids` drops entities covered by another layer.
    """

    def usable(rows: DataFrame) -> DataFrame:
        good = rows.filter("n_ids = 1").withColumnRenamed("sole_id", "entity_id")
        return good.join(skip_ids, "entity_id", "left_anti") if skip_ids is not None else good

    chunk = ["entity_id", "container_id", "stage_idx"]
    pair = ["entity_id", "container_id"]
    stage = usable(resolved_names(stage_names, alias_index))
    event = usable(resolved_names(container_names, alias_index))
    if explicit is not None:
        stage = stage.join(explicit.select(*chunk), chunk, "left_anti")
        event = event.join(explicit.select(*pair).distinct(), pair, "left_anti")
    event = event.join(stage.select(*pair).distinct(), pair, "left_anti")
    by_stage = _layer(stage, chunk)
    by_event = _layer(event, pair).withColumn("stage_idx", F.lit(None).cast("bigint"))
    return by_stage.unionByName(by_event).withColumns(
        {"source": F.lit("summary"), "tier": F.lit("named")}
    )


def union_edges(*layers: DataFrame) -> DataFrame:
    """All layers in one shape; a column a layer lacks is null."""
    out = layers[0].sparkSession.createDataFrame([], EDGE_SCHEMA)
    for layer in layers:
        out = out.unionByName(layer, allowMissingColumns=True)
    return out


def passes(min_tier: str = "named", source: str = "all") -> Column:
    """Explicit edges always pass the tier test, as does an edge without a tier."""
    tier = F.col("tier").isNull() | (tier_rank("tier") >= TIER_RANK[min_tier])
    keep = (F.col("source") == "deterministic") | tier
    return keep if source == "all" else keep & (F.col("source") == source)


def of_entity(edges: DataFrame, entity_id: str, source: str = "all", min_tier: str = "named") -> DataFrame:
    rows = edges.filter((F.col("entity_id") == entity_id) & passes(min_tier, source))
    return rows.orderBy("container_id", F.asc_nulls_last("stage_idx"), "source")


def of_container(edges: DataFrame, container_id: str, source: str = "all", min_tier: str = "named") -> DataFrame:
    rows = edges.filter((F.col("container_id") == container_id) & passes(min_tier, source))
    return rows.orderBy("entity_id", F.asc_nulls_last("stage_idx"), "source")


def of_chunk(
    edges: DataFrame, container_id: str, stage_idx: int, source: str = "all", min_tier: str = "named"
) -> DataFrame:
    return of_container(edges.filter(F.col("stage_idx") == stage_idx), container_id, source, min_tier)


def by_container(edges: DataFrame) -> DataFrame:
    """Appearances rolled up by container: the rows themselves, with the number of edges of their container by layer."""
    layer = lambda s: F.count_if(F.col("source") == s)
    counts = edges.groupBy("container_id").agg(
        F.count(F.lit(1)).alias("n_edges"),
        layer("deterministic").alias("n_explicit"),
        layer("participant").alias("n_participant"),
        layer("summary").alias("n_summary"),
    )
    return edges.join(counts, "container_id")


def key_ids(summary: DataFrame) -> DataFrame:
    """Distinct (container_id, entity_id) of the key-name layer."""
    return summary.select("container_id", "entity_id").distinct()
