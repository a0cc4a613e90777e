"""Containers, their chunks, explicit links and ordered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptloom.functions import text as tx


def positions(df: DataFrame, container: str, order: str, width: int = 1_000_000, out: str = "stage_idx") -> DataFrame:
    """0-based position of each row inside its container, ordered by a unique integer column.

    A plain window would put a whole container into one task. Here the order column is cut into
    ranges of `width`, only the per-range counts are summed in order, and rows are numbered inside
    (container, range), which never holds more than `width` rows.
    """
    cut = F.floor(F.col(order) / width)
    ranged = df.withColumn("_range", cut)
    counts = ranged.groupBy(container, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(container).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(container, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(container, "_range").orderBy(order)
    numbered = ranged.withColumn("_pos", F.row_number().over(inner) - 1)
    joined = numbered.join(starts, [container, "_range"])
    return joined.withColumn(out, (F.col("_start") + F.col("_pos")).cast("bigint")).drop("_range", "_pos", "_start")


def rollup(chunks: DataFrame, container: str = "container_id") -> DataFrame:
    """Length, chunk count and distinct path prefixes per container; all partially aggregated.

    The number of distinct prefixes is kept as a count; `prefixes` lists them one per row.
    """
    return chunks.groupBy(container).agg(
        F.sum(F.length("body").cast("bigint")).alias("total_length"),
        F.count(F.lit(1)).alias("stage_count"),
    )


def prefixes(chunks: DataFrame, path: str, container: str = "container_id") -> DataFrame:
    """Distinct non-empty path prefixes per container, one row each."""
    return (
        chunks.select(container, tx.path_prefix(path).alias("prefix"))
        .filter(F.col("prefix") != "")
        .distinct()
    )


def resolve_links(links: DataFrame, index: DataFrame, key: str = "link_key") -> DataFrame:
    """Classify each link by how many chunks carry its key: linked, missing or ambiguous.

    The index is reduced to one row per key with partial aggregation, so a key shared by a third of
    all chunks stays one row. Candidates of ambiguous links come from `link_candidates`.
    """
    hits = index.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.min(F.struct("container_id", "stage_idx")).alias("_hit"),
    )
    joined = links.join(hits, key, "left")
    n = F.coalesce(F.col("n_hits"), F.lit(0))
    status = F.when(n == 0, "missing").when(n == 1, "linked").otherwise("ambiguous")
    only = n == 1
    return joined.select(
        *[F.col(c) for c in links.columns],
        status.alias("status"),
        n.cast("bigint").alias("n_hits"),
        F.when(only, F.col("_hit.container_id")).alias("container_id"),
        F.when(only, F.col("_hit.stage_idx")).alias("stage_idx"),
    )


def link_candidates(resolved: DataFrame, index: DataFrame, key: str = "link_key") -> DataFrame:
    """One row per candidate chunk of an ambiguous link key.

    Links sharing a key share its candidates, so keys are made distinct before the join.
    """
    keys = resolved.filter(F.col("status") == "ambiguous").select(key).distinct()
    return index.join(keys, key, "left_semi").select(key, "container_id", "stage_idx")


def text_parts(chunks: DataFrame) -> DataFrame:
    """Whole-container text as ordered parts.

    Concatenating the parts by (stage_idx, part) gives the document; keeping them as rows means no
    container is ever gathered into one task. Part 0 of a container is its header.
    """
    header = chunks.select("container_id", "container_name").distinct().select(
        "container_id",
        F.lit(-1).cast("bigint").alias("stage_idx"),
        F.concat(F.lit("<活动名称>"), "container_name", F.lit("</活动名称>")).alias("part"),
    )
    body = F.concat(
        F.lit("<章节>\n<章节名称>"), tx.chapter_title("name", "tag"),
        F.lit("</章节名称>\n<章节简介>"), F.coalesce("info", F.lit("")),
        F.lit("</章节简介>\n<正文>\n"), F.col("body"), F.lit("\n</正文>\n</章节>\n"),
    )
    parts = chunks.select("container_id", F.col("stage_idx").cast("bigint").alias("stage_idx"), body.alias("part"))
    return header.unionByName(parts)


def stage_table(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "container_id", "stage_idx", "name", "tag", "source_family",
        tx.path_prefix("path").alias("path_prefix"),
        tx.chunk_file("stage_idx", "name", "tag").alias("file"),
        F.length("body").cast("bigint").alias("length"),
    )


def family_counts(containers: DataFrame, family: str | Column = "source_family") -> DataFrame:
    """Containers per family with every family present, also the empty ones."""
    names = containers.sparkSession.createDataFrame([(f,) for f in tx.FAMILIES], "source_family string")
    counted = containers.groupBy(tx.col(family).alias("source_family")).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(names).join(counted, "source_family", "left").select(
        "source_family", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_containers")
    )


def family_ids(containers: DataFrame, family: str | Column = "source_family") -> DataFrame:
    """(source_family, container_id) in long form: a family's list is as long as the corpus."""
    return containers.select(tx.col(family).alias("source_family"), "container_id").distinct()
