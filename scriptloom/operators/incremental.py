"""Content hashes, run decisions, unit state, cost estimates and request texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx

# Projected sizes of one service answer, in characters.
SINGLE_OUT = 900
STAGE_REDUCE_OUT = 400
MERGE_OUT = 900
STAGE_SUMMARY_OUT = 500
RELATION_OUT = 1000
CHARS_PER_TOKEN = 1.0

LANES = 9


def _nul(c: Column) -> Column:
    return F.concat(c, F.lit("\u0000"))


def content_hash(texts: DataFrame, key: str = "unit_id") -> DataFrame:
    """Hash of each unit over its (name, text) pairs, names unique inside a unit.

    Each pair `name \\0 text \\0` is hashed where it lies, the digests are added up in lanes (order does not
    matter, partial sums combine), and the sums are hashed. One rule for every size, one scan, and no unit is
    gathered in a task.
    """
    digests = texts.select(key, F.sha2(F.encode(F.concat(_nul(F.col("name")), _nul(F.col("text"))), "UTF-8"), 256).alias("h"))
    lane = lambda i: F.conv(F.substring("h", 7 * i + 1, 7), 16, 10).cast("bigint")
    summed = digests.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(lane(i)).alias(f"l{i}") for i in range(LANES)]
    )
    parts = F.concat_ws(":", "n", *[f"l{i}" for i in range(LANES)])
    return summed.select(key, F.sha2(parts, 256).alias("source_hash"))


def decide(current: DataFrame, state: DataFrame, outputs: DataFrame, key: str = "unit_id", force: bool = False) -> DataFrame:
    """run / skip / stale per unit: skip needs an equal stored hash and an existing output."""
    prior = state.select(key, F.col("source_hash").alias("prior_hash"), F.lit(True).alias("_known"))
    made = outputs.select(key).distinct().withColumn("_out", F.lit(True))
    joined = current.select(key, "source_hash").withColumn("_now", F.lit(True)).join(prior, key, "full_outer")
    joined = joined.join(made, key, "left")
    same = F.col("source_hash").eqNullSafe(F.col("prior_hash")) & F.coalesce("_out", F.lit(False))
    keep = same & F.lit(not force)
    status = F.when(F.col("_now").isNull(), "stale").when(keep, "skip").otherwise("run")
    return joined.select(key, "source_hash", "prior_hash", status.alias("status"))


def dry_run(units: DataFrame, state: DataFrame, outputs: DataFrame, key: str = "unit_id", force: bool = False) -> DataFrame:
    """Plan without hashing: a unit runs when forced, unknown to the state or without output."""
    known = state.select(key).distinct().withColumn("_known", F.lit(True))
    made = outputs.select(key).distinct().withColumn("_out", F.lit(True))
    joined = units.join(known, key, "left").join(made, key, "left")
    would = F.lit(force) | F.col("_known").isNull() | F.col("_out").isNull()
    return joined.withColumn("would_run", would).drop("_known", "_out")


def stale_keys(old: DataFrame, current: DataFrame, key: str = "unit_id", complete: bool = True) -> DataFrame:
    """Keys of earlier outputs that left the current build; none after a filtered or broken run."""
    gone = old.select(key).distinct().join(current.select(key).distinct(), key, "left_anti")
    return gone if complete else gone.limit(0)


def upsert_state(state: DataFrame, written: DataFrame, current: DataFrame | None = None, key: str = "unit_id") -> DataFrame:
    """New state: written rows replace earlier ones, units that left the build are dropped."""
    both = state.withColumn("_new", F.lit(0)).unionByName(written.withColumn("_new", F.lit(1)))
    rest = [c for c in state.columns if c != key]
    merged = both.groupBy(key).agg(F.max_by(F.struct(*rest), "_new").alias("_w")).select(key, "_w.*")
    return merged if current is None else merged.join(current.select(key).distinct(), key, "left_semi")


def run_report(results: DataFrame) -> DataFrame:
    """Counts per status and whether the run is complete: one terminal error makes the whole run incomplete."""
    counted = results.groupBy("status").agg(F.count(F.lit(1)).alias("n_units"))
    failed = F.coalesce(F.max(F.col("status") == "terminal_error").over(Window.partitionBy()), F.lit(False))  # a row per status
    return counted.withColumn("complete", ~failed)


def run_outcome(plan: DataFrame, failed: DataFrame, old: DataFrame, key: str = "unit_id", filtered: bool = False) -> DataFrame:
    """One row per unit: run, skip, terminal_error, pruned or kept_stale.

    Units of the plan that are in `failed` ended with a terminal error. Outputs of units that left the build are
    pruned, but after a filtered run or one with an error they stay.
    """
    errors = failed.select(key).distinct().withColumn("_failed", F.lit(True))
    tried = plan.filter("status <> 'stale'").join(errors, key, "left")
    tried = tried.select(key, F.when(F.col("_failed") & (F.col("status") == "run"), "terminal_error")
                         .otherwise(F.col("status")).alias("status"))
    broken = tried.agg(F.coalesce(F.max(F.col("status") == "terminal_error"), F.lit(False)).alias("_broken"))
    gone = stale_keys(old, plan.filter("status <> 'stale'"), key).join(F.broadcast(broken), F.lit(True))  # one row
    keep = F.col("_broken") | F.lit(filtered)
    return tried.unionByName(gone.select(key, F.when(keep, "kept_stale").otherwise("pruned").alias("status")))


def container_cost(units: DataFrame, overhead_single: int, overhead_stage: int, overhead_merge: int) -> DataFrame:
    """Projected calls and characters of one container summary."""
    multi = tx.multi_pass("total_length", "stage_count")
    n = F.greatest(F.col("stage_count"), F.lit(1))
    reduced = STAGE_REDUCE_OUT * n
    return units.withColumns(
        {
            "passes": F.when(multi, "multi").otherwise("single"),
            "llm_calls": F.when(multi, n + 1).otherwise(1).cast("bigint"),
            "in_chars": F.when(multi, overhead_stage * n + F.col("total_length") + overhead_merge + reduced)
            .otherwise(overhead_single + F.col("total_length")).cast("bigint"),
            "out_chars": F.when(multi, reduced + MERGE_OUT).otherwise(SINGLE_OUT).cast("bigint"),
        }
    )


def single_cost(units: DataFrame, overhead: int, out_chars: int) -> DataFrame:
    """Projected size of a unit that always takes one call (chunk summary or relation run)."""
    return units.withColumns(
        {
            "passes": F.lit("single"),
            "llm_calls": F.lit(1).cast("bigint"),
            "in_chars": (F.col("total_length") + overhead).cast("bigint"),
            "out_chars": F.lit(out_chars).cast("bigint"),
        }
    )


def cost_totals(costed: DataFrame) -> DataFrame:
    """Sums split by run or done."""
    tokens = lambda c: F.round(F.sum(c) / CHARS_PER_TOKEN).cast("bigint")
    return costed.groupBy("would_run").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.count_if(F.col("passes") == "single").alias("n_single"),
        F.count_if(F.col("passes") == "multi").alias("n_multi"),
        F.sum("llm_calls").alias("llm_calls"),
        F.sum("in_chars").alias("in_chars"),
        F.sum("out_chars").alias("out_chars"),
        tokens("in_chars").alias("in_tokens"),
        tokens("out_chars").alias("out_tokens"),
    )


def single_pass_requests(chunks: DataFrame, totals: DataFrame, template: str) -> DataFrame:
    """One request text per container below the multi-pass limits, which bound what is joined.

    `template` holds `{text}`. Containers above the limits get one request per chunk instead.
    """
    fits = totals.filter(~tx.multi_pass("total_length", "stage_count")).select("container_id")
    ordered = F.array_sort(F.collect_list(F.struct("stage_idx", "body")))
    joined = F.array_join(F.transform(ordered, lambda p: p["body"]), "\n\n")
    text = chunks.join(fits, "container_id", "left_semi").groupBy("container_id").agg(joined.alias("_t"))
    head, tail = template.split("{text}")
    return text.select("container_id", F.concat(F.lit(head), "_t", F.lit(tail)).alias("request"))


def chunk_requests(chunks: DataFrame, totals: DataFrame, template: str) -> DataFrame:
    """One request per chunk of the containers above the multi-pass limits."""
    large = totals.filter(tx.multi_pass("total_length", "stage_count")).select("container_id")
    head, tail = template.split("{text}")
    return chunks.join(large, "container_id", "left_semi").select(
        "container_id", "stage_idx", F.concat(F.lit(head), "body", F.lit(tail)).alias("request")
    )


def merge_requests(responses: DataFrame, totals: DataFrame, tags, template: str, between: str = "\n\n---\n\n") -> DataFrame:
    """Request that merges the chunk responses of each container above the multi-pass limits, as ordered parts.

    responses: container_id, stage_idx, response. Each response is rebuilt from its tags; a container with a response
    that lacks one has no request. Parts (container_id, part_no, part) stay rows, so no container is gathered.
    """
    large = totals.filter(tx.multi_pass("total_length", "stage_count")).select("container_id")
    blocks = responses.join(large, "container_id", "left_semi").select("container_id", "stage_idx", tg.rebuild("response", tags).alias("block"))
    whole = blocks.groupBy("container_id").agg(F.min("stage_idx").alias("_first"), F.bool_and(F.col("block").isNotNull()).alias("_ok"))
    whole = whole.filter("_ok").select("container_id", "_first")
    head, tail = template.split("{stage_summaries}")
    told = blocks.join(whole, "container_id").select(
        "container_id", F.col("stage_idx").alias("part_no"),
        F.concat(F.when(F.col("stage_idx") > F.col("_first"), between).otherwise(""), "block").alias("part"))
    ends = F.explode(F.array(F.struct(F.lit(-1).cast("bigint").alias("part_no"), F.lit(head).alias("part")),
                             F.struct(F.lit((1 << 63) - 1).alias("part_no"), F.lit(tail).alias("part"))))
    return told.unionByName(whole.select("container_id", ends.alias("e")).select("container_id", "e.*"))


def selected_units(units: DataFrame, only: DataFrame | None = None, inputs: DataFrame | None = None, key: str = "unit_id") -> DataFrame:
    """Units with a name, of a list of ids if one is given, less those without an input row."""
    kept = units.filter(F.col("name") != "")
    for side in (only, inputs):
        if side is not None:
            kept = kept.join(side.select(key).distinct(), key, "left_semi")
    return kept


def section_document(sections: list[tuple[str, Column]]) -> Column:
    """`=== name ===` headed sections in the given order; null sections are left out."""
    parts = [
        F.when(c.isNotNull(), F.concat(F.lit(f"=== {name} ===\n"), tx.strip(c))) for name, c in sections
    ]
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")


def pending(related: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    return related.join(cached.select(*keys).distinct(), keys, "left_anti")


def summary_document(front: list[tuple[str, Column]], body: Column) -> Column:
    """Front matter lines, a blank line and the validated body."""
    head = [F.lit("---"), *[F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in front], F.lit("---")]
    return F.concat(F.concat_ws("\n", *head), F.lit("\n\n"), tx.rstrip(body), F.lit("\n"))
