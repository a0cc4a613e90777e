"""Entity layer: operators, curated entries and names seeded from unresolved key names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from scriptloom.functions import text as tx
from scriptloom.operators import aliases as al

# Entity types (the first is reserved for table rows) and provenance labels.
ENTITY_TYPES = ("operator", "npc", "organization", "location", "group", "protagonist", "unknown")
TABLE_SOURCE = "character_table"
ALIAS_SOURCE = "char_alias.txt"
CURATED_SOURCE = "entities_curated.jsonl"
SEED_SOURCE = "kb_summaries:<关键人物>"
FIRST_CONTAINERS = 5

ENTITY_COLUMNS = [
    "entity_id", "name", "entity_type", "char_id", "appellation", "aliases", "sources", "notes",
    "first_container_ids",
]


def _shaped(df: DataFrame) -> DataFrame:
    missing = {
        "char_id": "string", "appellation": "string", "notes": "string",
        "first_container_ids": "array<string>",
    }
    for name, kind in missing.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.select(*ENTITY_COLUMNS)


def operator_entities(entities: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """One row per table entity; aliases are its own names and its curated ones, in order."""
    ranked = al.manifest_aliases(entities, curated)
    listed = ranked.groupBy("entity_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "alias"))), lambda p: p["alias"]).alias("aliases")
    )
    rows = entities.join(listed, "entity_id", "left")
    if curated is not None:
        known = curated.select(F.col("canonical").alias("name")).distinct()
        known = known.join(al.ambiguous_names(entities), "name", "left_anti").withColumn("_known", F.lit(True))
        rows = rows.join(known, "name", "left")
    else:
        rows = rows.withColumn("_known", F.lit(None).cast("boolean"))
    sources = F.array_compact(F.array(F.lit(TABLE_SOURCE), F.when(F.col("_known"), F.lit(ALIAS_SOURCE))))
    return _shaped(
        rows.select(
            "entity_id", "name", F.lit("operator").alias("entity_type"),
            F.col("entity_id").alias("char_id"), "appellation",
            F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), sources.alias("sources"),
        )
    )


def curated_entities(entries: DataFrame, owner_rows: DataFrame) -> DataFrame:
    """Curated entries whose name is no operator alias.

    `entries`: line_no, name, entity_type, id, aliases, appellation, notes.
    """
    known = owner_rows.select(F.col("alias").alias("name")).distinct()
    kept = entries.join(known, "name", "left_anti")
    own = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    cleaned = F.array_distinct(F.filter(own, lambda a: a.isNotNull() & (a != "")))
    given = F.when(F.col("id") != "", F.col("id"))
    return _shaped(
        kept.select(
            F.coalesce(given, tx.entity_id("name")).alias("entity_id"), "name", "entity_type",
            "appellation", cleaned.alias("aliases"), F.array(F.lit(CURATED_SOURCE)).alias("sources"),
            F.when(F.col("notes") != "", F.col("notes")).alias("notes"), "line_no",
        ).drop("line_no")
    )


def curated_conflicts(entries: DataFrame, owner_rows: DataFrame) -> DataFrame:
    """Warnings: names dropped because an operator owns them, and ids claimed by an earlier entry."""
    known = owner_rows.groupBy(F.col("alias").alias("name")).agg(F.array_sort(F.collect_set("entity_id")).alias("candidates"))
    dropped = entries.join(known, "name").select(
        "line_no", "name", F.lit("matches an operator alias").alias("reason"), "candidates"
    )
    given = F.when(F.col("id") != "", F.col("id"))
    kept = entries.join(known, "name", "left_anti").withColumn(
        "entity_id", F.coalesce(given, tx.entity_id("name"))
    )
    first = kept.groupBy("entity_id").agg(F.min("line_no").alias("_first"))
    clash = kept.join(first, "entity_id").filter(F.col("line_no") > F.col("_first"))
    shadowed = clash.select(
        "line_no", "name", F.lit("id collision").alias("reason"), F.lit(None).cast("array<string>").alias("candidates")
    )
    return dropped.unionByName(shadowed)


def by_id(entities: DataFrame, order: str = "line_no") -> DataFrame:
    """Later row wins where ids repeat."""
    rest = [c for c in entities.columns if c != "entity_id"]
    return entities.groupBy("entity_id").agg(
        *[F.max_by(F.struct(c), order)[c].alias(c) for c in rest]
    )


def first_containers(unresolved: DataFrame, limit: int = FIRST_CONTAINERS) -> DataFrame:
    """name -> first containers in order; the rank limit also applies before the shuffle."""
    order = Window.partitionBy("name").orderBy("container_id")
    first = unresolved.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= limit)
    return first.groupBy("name").agg(F.array_sort(F.collect_list("container_id")).alias("first_container_ids"))


def auto_seeded(unresolved: DataFrame, curated: DataFrame, taken: DataFrame) -> DataFrame:
    """Unknown entities for unresolved names; the smallest name claims an id."""
    names = first_containers(unresolved).join(curated.select("name").distinct(), "name", "left_anti")
    minted = names.withColumn("entity_id", tx.entity_id("name"))
    free = minted.join(taken.select("entity_id").distinct(), "entity_id", "left_anti")
    claimed = free.groupBy("entity_id").agg(F.min(F.struct("name", "first_container_ids")).alias("c"))
    return _shaped(
        claimed.select(
            "entity_id", "c.name", F.lit("unknown").alias("entity_type"), F.array("c.name").alias("aliases"),
            F.array(F.lit(SEED_SOURCE)).alias("sources"), "c.first_container_ids",
        )
    )


def all_entities(operators: DataFrame, curated: DataFrame, unresolved: DataFrame) -> DataFrame:
    taken = operators.select("entity_id").unionByName(curated.select("entity_id"))
    seeded = auto_seeded(unresolved, curated, taken)
    return operators.unionByName(curated).unionByName(seeded)


def ordered(entities: DataFrame) -> DataFrame:
    return entities.orderBy(F.when(F.col("entity_type") == "operator", 0).otherwise(1), "entity_id")


def alias_owners(entities: DataFrame) -> DataFrame:
    """(alias, entity_id) of every entity, the input of `aliases.index`."""
    rows = entities.select(F.explode("aliases").alias("alias"), "entity_id")
    return rows.filter(F.col("alias") != "").distinct()
