"""Page strings, link tables and index rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx
from scriptloom.operators.chunks import positions

# File prefixes that separate table entities from other ones.
ENTITY_PREFIX = "char"
OTHER_PREFIX = "extended"


def rendered(c, tags, title_tag: str, version_tag: str = "version") -> Column:
    """Page text: title, version line and one `## tag` section per tag; null when a tag is missing."""
    title = F.replace(tx.strip(tg.first_body(c, title_tag)), F.lit("\n"), F.lit(""))
    version = tx.strip(tg.first_body(c, version_tag))
    parts = [F.concat(F.lit("# "), title), F.concat(F.lit("页面版本:"), version)]
    parts += [F.concat(F.lit(f"## {t}\n"), tx.strip(tg.first_body(c, t))) for t in tags]
    whole = F.concat_ws("\n", *parts)
    needed = [*tags, title_tag, version_tag]
    return F.when(F.size(tg.missing_tags(c, needed)) == 0, whole)


def link_lines(items: DataFrame, links: DataFrame, key: str, text: str) -> DataFrame:
    """Non-blank lines of `text` as bullets, a known key replaced by its link.

    items: key + text; links: name, link (one row per name). The result is one row per line.
    """
    rows = items.select(key, F.posexplode(F.split(text, "\n", -1)).alias("ord", "line"))
    rows = rows.withColumn("line", tx.strip("line")).filter(F.col("line") != "")
    named = rows.withColumn("name", F.when(tx.split_at(F.col("line")) > 0, tx.key_part(F.col("line"))))
    joined = named.join(links.select("name", "link"), "name", "left")
    return joined.select(key, F.col("ord").cast("bigint").alias("ord"), tx.key_value_line("line", F.col("link")).alias("bullet"))


def merge_indexes(first: DataFrame, second: DataFrame, first_dir: str, second_dir: str) -> DataFrame:
    """Outer union of two page generations (name, file); the second one decides the kind."""
    a = first.groupBy("name").agg(F.max("file").alias("f1"))
    b = second.groupBy("name").agg(F.max("file").alias("f2"))
    both = a.join(b, "name", "full_outer")
    old = F.when(F.col("f1") != "", F.concat(F.lit(f"[v1]({first_dir}"), "f1", F.lit(")")))
    new = F.when(F.col("f2") != "", F.concat(F.lit(f"[v2]({second_dir}"), "f2", F.lit(")")))
    display = F.concat("name", F.lit("("), F.concat_ws(",", old, new), F.lit(")"))
    compact = F.when(
        F.col("f2").isNotNull(),
        F.concat(
            F.lit("["), "name", F.lit(f"]({second_dir}"), "f2", F.lit(")"),
            F.coalesce(F.concat(F.lit(f"([v1]({first_dir}"), "f1", F.lit("))")), F.lit("")),
        ),
    )
    file = F.coalesce("f2", "f1")
    kind = F.when(file.startswith(ENTITY_PREFIX), "entity").when(file.startswith(OTHER_PREFIX), "other")
    return both.select("name", file.alias("file"), kind.alias("kind"), display.alias("display"), compact.alias("compact"))


def index_rows(items: DataFrame, group: str, order: str, text: str, columns: int) -> DataFrame:
    """Items in rows of `columns` cells, the last row padded; `order` is a unique integer."""
    if columns <= 0:
        raise ValueError("Number of columns must be greater than 0.")
    placed = positions(items.select(group, order, text), group, order, out="_p")
    row, cell = F.floor(F.col("_p") / columns).cast("bigint"), F.col("_p") % columns
    cells = [F.coalesce(F.max(F.when(cell == i, F.col(text))), F.lit("")) for i in range(columns)]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return placed.groupBy(F.col(group), row.alias("row_no")).agg(line.alias("line"))


def whats_new(new_ids: DataFrame, items: DataFrame, pages: DataFrame, owners: DataFrame) -> DataFrame:
    """New item -> link with its owner, or the reason it cannot be linked.

    new_ids: item_id; items: item_id, name; pages: name, file; owners: name, owner (one row each).
    """
    joined = new_ids.join(items, "item_id", "left").join(pages, "name", "left").join(owners, "name", "left")
    link = F.concat(
        F.lit("["), "name", F.lit("](docs/stories/"), "file", F.lit(")"),
        F.coalesce(F.concat(F.lit("("), "owner", F.lit(")")), F.lit("")),
    )
    reason = F.when(F.col("name").isNull(), "unknown item").when(F.col("file").isNull(), "no page")
    return joined.select("item_id", F.when(reason.isNull(), link).alias("link"), reason.alias("reason"))


def story_owners(links: DataFrame) -> DataFrame:
    """link_name -> owner, the last one (by `seq`) winning."""
    return links.groupBy(F.col("link_name").alias("name")).agg(F.max_by("owner", "seq").alias("owner"))


def index_counts(pages: DataFrame, kind: str = "kind") -> DataFrame:
    return pages.groupBy(kind).agg(F.count(F.lit(1)).alias("n_pages"))
