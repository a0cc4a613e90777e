"""Alias dictionary: curated attachment, classes, ambiguity and name resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import text as tx

# Role and common words that never count as an alias; class precedence.
BLOCKLIST = (
    "博士", "干员", "罗德岛", "医疗", "近卫", "重装", "狙击",
    "术师", "辅助", "特种", "先锋", "源石", "矿石病",
)
CLASS_RANK = {"canonical": 4, "curated": 3, "canonical_short": 2, "fuzzy": 1}


def ambiguous_names(entities: DataFrame) -> DataFrame:
    """Display names owned by more than one entity."""
    named = entities.filter(F.col("name") != "").select("name", "entity_id").distinct()
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("n_ids")).filter("n_ids > 1")


def curated_pairs(entities: DataFrame, curated: DataFrame, skip_ambiguous: bool) -> DataFrame:
    """(entity_id, alias) of curated lines joined on the display name.

    Matching and manifests skip names with several owners, the resolver attaches to all of them.
    """
    named = entities.filter(F.col("name") != "").select("entity_id", "name")
    if skip_ambiguous:
        named = named.join(ambiguous_names(entities), "name", "left_anti")
    pairs = curated.filter(F.col("alias") != "").select(F.col("canonical").alias("name"), "alias")
    return named.join(pairs, "name").select("entity_id", "alias").distinct()


def own_names(entities: DataFrame) -> DataFrame:
    both = F.explode(F.array("name", "appellation"))
    return (
        entities.select("entity_id", both.alias("alias"))
        .filter(F.col("alias").isNotNull() & (F.col("alias") != ""))
        .distinct()
    )


def owners(entities: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """Resolver rows (alias, entity_id): names, appellations and curated aliases of all owners."""
    rows = own_names(entities)
    if curated is not None:
        rows = rows.unionByName(curated_pairs(entities, curated, skip_ambiguous=False))
    return rows.distinct()


def index(owner_rows: DataFrame) -> DataFrame:
    """alias -> number of owners and, when there is just one, that owner.

    Partial aggregation keeps one row per alias however many entities share it; the full candidate
    lists stay in the owner rows.
    """
    return owner_rows.groupBy("alias").agg(
        F.count(F.lit(1)).alias("n_ids"), F.min("entity_id").alias("_first")
    ).select("alias", "n_ids", F.when(F.col("n_ids") == 1, F.col("_first")).alias("sole_id"))


def status_of(n: Column) -> Column:
    return F.when(F.coalesce(n, F.lit(0)) == 0, "missing").when(n == 1, "resolved").otherwise("ambiguous")


def resolve(names: DataFrame, alias_index: DataFrame, name: str = "name") -> DataFrame:
    """Add status, entity_id (when resolved) and the number of candidates to each name row."""
    side = alias_index.select(F.col("alias").alias(name), "n_ids", "sole_id")
    joined = names.join(side, name, "left")
    return joined.select(
        *[F.col(c) for c in names.columns],
        status_of(F.col("n_ids")).alias("status"),
        F.col("sole_id").alias("entity_id"),
        F.coalesce("n_ids", F.lit(0)).cast("bigint").alias("n_candidates"),
    )


def candidates(resolved: DataFrame, owner_rows: DataFrame, name: str = "name") -> DataFrame:
    """One row per (ambiguous name, candidate)."""
    names = resolved.filter(F.col("status") == "ambiguous").select(F.col(name).alias("alias")).distinct()
    return owner_rows.join(names, "alias", "left_semi").select(F.col("alias").alias(name), "entity_id")


def classify(alias: Column | str, source: Column | str) -> Column:
    """Match class of an alias, or null when it must not be matched."""
    a, s = tx.col(alias), tx.col(source)
    usable = a.isNotNull() & (a != "") & ~a.isin(*BLOCKLIST)
    short = F.length(a) == 1
    return F.when(
        usable,
        F.when((s == "canonical") & short, "canonical_short")
        .when(s == "canonical", "canonical")
        .when(~short, s),
    )


def class_rank(c: Column | str) -> Column:
    rank = F.when(F.lit(False), F.lit(0))
    for name, value in CLASS_RANK.items():
        rank = rank.when(tx.col(c) == name, value)
    return rank


def match_aliases(entities: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """One (entity_id, alias, match_class, mode) row per alias text, the strongest class winning."""
    rows = own_names(entities).withColumn("source", F.lit("canonical"))
    if curated is not None:
        extra = curated_pairs(entities, curated, skip_ambiguous=True)
        rows = rows.unionByName(extra.withColumn("source", F.lit("curated")))
    classed = rows.withColumn("match_class", classify("alias", "source")).filter("match_class is not null")
    return (
        classed.groupBy("entity_id", "alias")
        .agg(F.max_by("match_class", class_rank("match_class")).alias("match_class"))
        .withColumn("mode", tx.alias_mode("alias"))
    )


def _before(n: int) -> Column:
    """Order key ahead of every line of a file."""
    return F.struct(F.lit(n).cast("bigint").alias("line_no"), F.lit(0).alias("pos"))


def manifest_aliases(entities: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """(entity_id, alias, rank): name, appellation, then curated aliases in file order."""
    base = entities.select(
        "entity_id",
        F.explode(
            F.array(
                F.struct(_before(-2).alias("ord"), F.col("name").alias("alias")),
                F.struct(_before(-1).alias("ord"), F.col("appellation").alias("alias")),
            )
        ).alias("e"),
    ).select("entity_id", "e.ord", "e.alias")
    if curated is not None:
        named = entities.filter(F.col("name") != "").select("entity_id", "name")
        named = named.join(ambiguous_names(entities), "name", "left_anti")
        extra = curated.select(F.col("canonical").alias("name"), "alias", "ord")
        base = base.unionByName(named.join(extra, "name").select("entity_id", "ord", "alias"))
    kept = base.filter(F.col("alias").isNotNull() & (F.col("alias") != ""))
    return kept.groupBy("entity_id", "alias").agg(F.min("ord").alias("ord"))
