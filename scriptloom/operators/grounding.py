"""Grounding audit: where the names of a summary stand in the texts it was made from.

A name is sought under its forms: itself, and every alias of the entity that it stands for alone. Forms meet the texts
once, whatever the number of summaries, and leave a table of postings (chunk, form, start, end). A summary's source is its
own chunk, or all chunks of its container; postings outside of the sources of a name go before anything is
gathered. Places where several forms of a name overlap are one piece of evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import text as tx
from scriptloom.operators.participants import CHUNK, spans
from scriptloom.session import written

AUDIT = ["container_id", "stage_idx", "name", "status", "entity_id", "n_chunks", "n_mentions", "n_places",
         "first_stage", "first_start", "first_end", "first_form"]


def name_forms(names: DataFrame, owner_rows: DataFrame, alias_index: DataFrame) -> DataFrame:
    """name, entity_id (if it has one owner), form: the name itself and the aliases of that owner."""
    each = names.filter("name <> ''").select("name").distinct()
    known = each.join(alias_index.select(F.col("alias").alias("name"), F.col("sole_id").alias("entity_id")), "name", "left")
    others = known.join(owner_rows.filter("alias <> ''"), "entity_id").select("name", "entity_id", F.col("alias").alias("form"))
    return known.select("name", "entity_id", F.col("name").alias("form")).unionByName(others).distinct()


def postings(chunks: DataFrame, forms: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """container_id, stage_idx, form, start, end of every mention of a form. Mentions of one form do not overlap.

    names: container_id, name of the summaries; only mentions of the forms of a container's own names are kept then.
    """
    scope = None
    if names is not None:
        asked = names.select("container_id", "name").join(forms.select("name", F.col("form").alias("alias")), "name")
        scope = written(asked.select("container_id", "alias").distinct(), "name-scope")
    found = spans(chunks, forms.select(F.col("form").alias("alias")).distinct(), scope)
    return found.select(*CHUNK, F.col("alias").alias("form"), "start", (F.col("start") + F.col("size")).alias("end"))


def merged_count(places: Column) -> Column:
    """How many separate stretches the sorted structs (start, end, ...) cover; touching ones are separate."""
    done = F.aggregate(
        places, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("upto")),
        lambda acc, x: F.struct(
            (acc["n"] + F.when(x["start"] >= acc["upto"], 1).otherwise(0)).alias("n"), F.greatest(acc["upto"], x["end"]).alias("upto")))
    return done["n"]


def evidence(found: DataFrame, forms: DataFrame, names: DataFrame) -> DataFrame:
    """container_id, stage_idx, name, n_mentions, n_places, first: the postings of each name in each chunk of the containers whose
    summaries hold it."""
    asked = names.select("container_id", "name").distinct()
    rows = found.join(forms.select("name", "form"), "form").join(asked, ["container_id", "name"], "left_semi")
    place = F.struct("start", "end", "form")
    each = rows.groupBy(*CHUNK, "name").agg(F.array_sort(F.collect_list(place)).alias("p"))
    return each.select(*CHUNK, "name", F.size("p").cast("bigint").alias("n_mentions"), merged_count(F.col("p")).alias("n_places"),
                       F.element_at("p", 1).alias("first"))


def audit(names: DataFrame, forms: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row for each (container_id, stage_idx, name) of `names` (stage_idx null: a summary of the whole container): its
    status OK or MISS, and its evidence. chunks: one row per (container_id, stage_idx)."""
    names = names.select("container_id", F.col("stage_idx").cast("bigint").alias("stage_idx"), "name").distinct()
    forms = written(forms, "name-forms")
    by_chunk = written(evidence(postings(chunks, forms, names), forms, names), "evidence")
    of_chunk = by_chunk.select(
        *CHUNK, "name", F.lit(1).cast("bigint").alias("n_chunks"), "n_mentions", "n_places",
        F.struct(F.col("stage_idx").alias("stage"), "first").alias("at"))
    of_container = by_chunk.groupBy("container_id", "name").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum("n_mentions").alias("n_mentions"), F.sum("n_places").alias("n_places"),
        F.min(F.struct(F.col("stage_idx").alias("stage"), "first")).alias("at"))
    whole = names.filter("stage_idx is null").join(of_container, ["container_id", "name"], "left")
    single = names.filter("stage_idx is not null").join(of_chunk, [*CHUNK, "name"], "left")
    rows = single.unionByName(whole).join(forms.select("name", "entity_id").distinct(), "name", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.select(
        "container_id", "stage_idx", "name", F.when(F.col("n_mentions") > 0, "OK").otherwise("MISS").alias("status"), "entity_id",
        count("n_chunks"), count("n_mentions"), count("n_places"), F.col("at.stage").alias("first_stage"),
        F.col("at.first.start").cast("bigint").alias("first_start"), F.col("at.first.end").cast("bigint").alias("first_end"),
        F.col("at.first.form").alias("first_form"))


def missing(rows: DataFrame) -> DataFrame:
    """Ungrounded names with the number of summaries that hold them."""
    return rows.filter("status = 'MISS'").groupBy("name").agg(
        F.count(F.lit(1)).alias("n_summaries"), F.min("container_id").alias("first_container_id"))


def cited(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """The grounded rows with the line of their first evidence: line_no (from 1) and snippet."""
    some = rows.filter("status = 'OK'")
    keys = [F.col("t.container_id") == F.col("r.container_id"), F.col("t.stage_idx") == F.col("r.first_stage")]
    both = some.alias("r").join(chunks.select(*CHUNK, "body").alias("t"), keys)
    number = F.size(tx.lines(F.concat(F.substring("body", F.lit(1), F.col("first_start").cast("int")), F.lit("."))))
    return both.select(*[F.col(f"r.{c}") for c in rows.columns], number.cast("bigint").alias("line_no"),
                       tx.snippet(F.get(tx.lines("body"), number - 1)).alias("snippet"))


def coverage(edges: DataFrame, names: DataFrame, alias_index: DataFrame) -> DataFrame:
    """Entities that speak or are named in a container's chunks and that its summaries do not hold: container_id, entity_id, n_chunks."""
    told = names.select("container_id", "name").distinct().join(
        alias_index.select(F.col("alias").alias("name"), F.col("sole_id").alias("entity_id")), "name").filter("entity_id is not null")
    seen = edges.filter("stage_idx is not null and tier in ('speaker', 'named')").groupBy("container_id", "entity_id").agg(
        F.count_distinct("stage_idx").alias("n_chunks"))
    return seen.join(told.select("container_id", "entity_id").distinct(), ["container_id", "entity_id"], "left_anti")
