"""Update flow: new items, candidate names, similar names and related containers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import text as tx
from scriptloom.session import written

MIN_SIMILAR = 2
MIN_INSIDE = 3


def new_items(source: DataFrame, outputs: list[DataFrame], key: str) -> DataFrame:
    """Source rows found in none of the output places."""
    for made in outputs:
        source = source.join(made.select(key).distinct(), key, "left_anti")
    return source


def candidates(raw: DataFrame, alias_map: DataFrame, playable: DataFrame, pages: DataFrame, prefix: str = "extended_char_") -> DataFrame:
    """Partition raw names (name, container_id) into names with a page and new ones: canonical, raw_name, page_id, kind, status.

    alias_map: alias, canonical (one row per alias). playable: name, char_id (one row per name). pages: page_id of what
    exists. A canonical is reported once, through its smallest raw name. Its page is that of the playable character of
    that name if it exists, else the extended page named after the canonical; kind tells which.
    """
    names = raw.select("name").distinct().join(alias_map.withColumnRenamed("alias", "name"), "name", "left")
    first = names.groupBy(F.coalesce("canonical", "name").alias("canonical")).agg(F.min("name").alias("raw_name"))
    known = pages.select("page_id").distinct()
    own = playable.join(known, F.col("char_id") == F.col("page_id"), "left_semi").select(F.col("name").alias("canonical"), "char_id")
    extra = known.select(F.col("page_id").alias("extended"))
    both = first.join(own, "canonical", "left").withColumn("_extended", F.concat(F.lit(prefix), tx.safe_slug("canonical")))
    both = both.join(extra, F.col("_extended") == F.col("extended"), "left")
    page = F.coalesce("char_id", "extended")
    return both.select(
        "canonical", "raw_name", page.alias("page_id"),
        F.when(F.col("char_id").isNotNull(), "playable").when(F.col("extended").isNotNull(), "extended").alias("kind"),
        F.when(page.isNotNull(), "existing").otherwise("new").alias("status"),
    )


def candidate_containers(found: DataFrame, raw: DataFrame) -> DataFrame:
    """(canonical, container_id): where the reported raw name of each canonical stands."""
    return raw.select(F.col("name").alias("raw_name"), "container_id").distinct().join(
        found.select("canonical", "raw_name"), "raw_name").select("canonical", "container_id")


def _pieces(text: str) -> Column:
    """Distinct two-character pieces."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(F.col(text), i, F.lit(2))))


def _inside(long: DataFrame, text: str, short: DataFrame, out: str) -> DataFrame:
    """(text, out): each value of `long` with every value of `short` that it contains.

    Both sides meet on one two-character piece of the short value: of its pieces the one that the fewest long values hold, as
    counted. A start or an ending that most names share is therefore no key, unless a name has nothing else, and a short
    value with a piece that no long value holds meets none.
    """
    held = written(long.filter(F.length(text) >= 2).select(text, F.explode(_pieces(text)).alias("piece")), "pieces")
    often = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    each = short.filter(F.length(out) >= 2).select(out).distinct().select(out, F.explode(_pieces(out)).alias("piece")).join(often, "piece", "left")
    keyed = each.groupBy(out).agg(F.min(F.struct("n", "piece")).alias("k"), F.bool_and(F.col("n").isNotNull()).alias("all_held"))
    met = held.join(keyed.filter("all_held").select(out, F.col("k.piece").alias("piece")), "piece")
    return met.filter(F.contains(F.col(text), F.col(out))).select(text, out)


def similar_names(raw: DataFrame, canonicals: DataFrame) -> DataFrame:
    """Smallest canonical that contains, or is contained in, each raw name; no pair of all names is built."""
    left = raw.select("name").filter(F.length("name") >= MIN_SIMILAR).distinct()
    right = canonicals.select("canonical").filter(F.length("canonical") >= MIN_SIMILAR).distinct()
    both = _inside(left, "name", right, "canonical").unionByName(_inside(right, "canonical", left, "name"))
    both = both.filter(F.col("name") != F.col("canonical"))
    return both.groupBy("name").agg(F.min("canonical").alias("similar"))


def related_containers(chunks: DataFrame, key_names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(entity_id, container_id): the entity speaks there or a key name points at it.

    A line `...name:` counts as speech whatever precedes the name, so every suffix of the text before
    a half-width colon, up to the longest alias, is a candidate for the equi-join. Key names count when
    equal to the alias or, for aliases of three characters and more, when they contain it.
    """
    names = written(aliases.select("entity_id", "alias").distinct(), "names")
    longest = names.agg(F.max(F.length("alias")).alias("n")).first()["n"] or 0
    # the text before each colon, cut to the longest alias; it meets the aliases on its last two characters
    padded = F.concat(F.lit("\u0000" * longest), F.col("body"))
    before = F.regexp_extract_all(padded, F.lit(rf"(?s)(?=(.{{{longest}}}):)"), F.lit(1))
    texts = chunks.filter(F.col("body").contains(":")).select("container_id", F.explode(F.array_distinct(before)).alias("t"))
    tail = lambda c, n: F.substring(c, F.length(c) - (n - 1), F.lit(n))
    keyed = names.select("entity_id", "alias", tail(F.col("alias"), 2).alias("end"))
    # one-character aliases have themselves as their end
    ends = F.explode(F.array_distinct(F.array(tail(F.col("t"), 2), tail(F.col("t"), 1))))
    spoken = texts.distinct().select("container_id", "t", ends.alias("end")).join(keyed, "end")
    size = F.length("alias")
    by_speech = spoken.filter(F.substring(F.col("t"), F.length("t") - size + 1, size) == F.col("alias")).select("entity_id", "container_id")
    keys = key_names.select("container_id", F.col("name").alias("key")).distinct()
    equal = keys.join(names, keys["key"] == names["alias"]).select("entity_id", "container_id")
    long = names.filter(F.length("alias") >= MIN_INSIDE)
    within = _inside(keys.select("key").distinct(), "key", long.select("alias").distinct(), "alias")
    inside = keys.join(within, "key").join(long, "alias").select("entity_id", "container_id")
    by_key = equal.unionByName(inside)
    return by_speech.unionByName(by_key).distinct()
