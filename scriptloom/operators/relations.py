"""Typed relations: response parsing, tail resolution, collation and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import tags as tg
from scriptloom.operators import aliases as al

KEY = ["head", "type", "tail", "tail_name"]


def row_problem(df: DataFrame) -> Column:
    """Reason a relation row is not acceptable, or null. `has_tail` tells whether the key was given."""
    given = F.col("has_tail") if "has_tail" in df.columns else F.lit(True)
    return (
        F.when(F.coalesce("head", F.lit("")) == "", "missing/empty head")
        .when(F.coalesce("type", F.lit("")) == "", "missing/empty type")
        .when(~given, "missing key tail")
        .when(F.col("tail") == "", "tail must be a string or null")
    )


def parsed_lines(responses: DataFrame, text: str = "response") -> DataFrame:
    """One row per relation line of each response (unit_id, line_no, raw, type, tail_name, notes, reason)."""
    usable, _ = tg.repaired(text, [tg.RELATION_TAG])
    return responses.select("unit_id", F.explode(tg.relation_lines(usable)).alias("l")).select("unit_id", "l.*")


def untagged(responses: DataFrame, text: str = "response") -> DataFrame:
    _, lost = tg.repaired(text, [tg.RELATION_TAG])
    return responses.filter(F.size(lost) > 0).select("unit_id")


def resolved_rows(lines: DataFrame, alias_index: DataFrame) -> DataFrame:
    good = lines.filter("type is not null")
    return al.resolve(good, alias_index, "tail_name")


def relation_rows(resolved: DataFrame, owner_rows: DataFrame) -> DataFrame:
    """Rows kept from responses: resolved tails keep the id, ambiguous ones a null tail and the ids it may mean.

    owner_rows: (alias, entity_id), the owners of each alias.
    """
    kept = resolved.filter("status != 'missing'")
    names = kept.filter("status = 'ambiguous'").select(F.col("tail_name").alias("alias")).distinct()
    ids = owner_rows.join(names, "alias").groupBy(F.col("alias").alias("tail_name")).agg(
        F.array_sort(F.collect_set("entity_id")).alias("ambiguous_candidates"))
    return kept.join(ids, "tail_name", "left").select(
        F.col("unit_id").alias("head"), "type", F.col("entity_id").alias("tail"), "tail_name",
        F.when(F.col("status") == "ambiguous", F.col("ambiguous_candidates")).alias("ambiguous_candidates"), "notes", "line_no",
    )


def warnings(responses: DataFrame, lines: DataFrame, resolved: DataFrame) -> DataFrame:
    blank = F.lit(None).cast("string")
    lost = untagged(responses).select(
        "unit_id", F.lit(None).cast("int").alias("line_no"), blank.alias("type"), blank.alias("tail_name"),
        F.lit("missing tag").alias("reason"),
    )
    bad = lines.filter("reason is not null").select(
        "unit_id", "line_no", blank.alias("type"), blank.alias("tail_name"), "reason"
    )
    shape = ["unit_id", "line_no", "type", "tail_name"]
    missing = resolved.filter("status = 'missing'").select(*shape, F.lit("unresolved tail").alias("reason"))
    novel = resolved.filter((F.col("status") != "missing") & ~F.col("type").isin(*tg.RELATION_TYPES))
    novel = novel.select(*shape, F.lit("novel relation type").alias("reason"))
    return lost.unionByName(bad).unionByName(missing).unionByName(novel)


def collate(baked: DataFrame, curated: DataFrame) -> DataFrame:
    """One row per (head, type, tail, tail_name): curated beats baked, a later row beats an earlier one.

    Grouping treats null keys as equal, and `max_by` keeps one partial row per key on each task.
    Both inputs carry `seq`, their order within the source.
    """
    both = baked.withColumn("source", F.lit("bake")).unionByName(
        curated.withColumn("source", F.lit("curated")), allowMissingColumns=True
    )
    order = F.struct((F.col("source") == "curated").alias("c"), F.col("seq"))
    rest = [c for c in both.columns if c not in KEY and c != "seq"]
    return both.groupBy(*KEY).agg(F.max_by(F.struct(*rest), order).alias("_w")).select(*KEY, "_w.*")


def ordered(rows: DataFrame) -> DataFrame:
    return rows.orderBy("head", "type", F.coalesce("tail", F.lit("")), F.coalesce("tail_name", F.lit("")))


def touching(rows: DataFrame, entity_id: str) -> DataFrame:
    return rows.filter((F.col("head") == entity_id) | (F.col("tail") == entity_id))


def between(rows: DataFrame, a: str, b: str, directed: bool = False) -> DataFrame:
    forth = (F.col("head") == a) & (F.col("tail") == b)
    back = (F.col("head") == b) & (F.col("tail") == a)
    return rows.filter(forth if directed else forth | back)


def types(rows: DataFrame) -> DataFrame:
    return rows.select("type").distinct().orderBy("type")


def of_type(rows: DataFrame, kind: str | None = None) -> DataFrame:
    return rows if kind is None else rows.filter(F.col("type") == kind)
