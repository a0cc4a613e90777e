"""Quality rules with thresholds that follow the data.

Each document gets a handful of integer measures. A mergeable quantile sketch is kept for every measure of
every (language, source): counts of values in buckets whose width grows with the value (exact below 32, at
most 1/16 of the value beyond). Such counts add up in any order, so partial sketches of tasks, of sources and
of languages merge without loss and the thresholds do not depend on how the rows were dealt. Outer fences
around the quartiles replace fixed cut-offs; documents meet the fences of their group in a join.

A group leans on its parent by one rule for every size: the sketch of all rows, scaled down to `prior` documents,
is added to that of a language, and the sketch of the language so made, scaled down likewise, to that of its sources. A
source of three documents so follows its language, one of a million itself, with no step between. DataFrame functions
only.

Edge cases: a null or white-space text has no words, fails the base rule and is not kept. Null language or
source is a group of its own. Repeated rows are judged one by one. An empty table gives an empty result.
Columns of the input named like a measure are overwritten by `measured`, left alone by `kept_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptloom.llm.cols import covered_by_repeats, let, window_hashes, words_of
from scriptloom.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BROADCAST_ROWS = 100_000  # groups joined by broadcast; beyond, Spark chooses


@dataclass(frozen=True)
class Fence:
    """Values beyond a quartile by more than `reach` times the quartile distance (at least `least`) fail."""

    measure: str
    reach: int
    least: int
    low: bool = False


#: Measures are whole numbers: per mille, or hundredths of a character.
FENCES = (
    Fence("word_length", 5, 40, low=True),
    Fence("symbol_rate", 3, 20),
    Fence("dup_line_rate", 3, 150),
    Fence("repeat_rate", 3, 60),
    Fence("capital_rate", 3, 60),
    Fence("shout_rate", 3, 60),
)
PRIOR = 100  # documents that the parent of a group counts for


def facts(text: Column) -> Column:
    """struct of the base counts of one text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    marks = F.regexp_replace(whole, f"[^{SYMBOLS}!?\\p{{Lu}}]+", "")  # the few characters counted below
    besides = lambda m, chars: (F.length(m) - F.length(F.translate(m, chars, ""))).cast("bigint")
    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        let(lines, lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            F.size(x).cast("bigint").alias("n_lines"))).alias("lines"),
        covered_by_repeats(window_hashes(w, WINDOW), WINDOW).cast("bigint").alias("n_repeat_words"),
        let(marks, lambda m: F.struct(
            besides(m, SYMBOLS).alias("n_symbols"), besides(m, "!?").alias("n_shouts"),
            F.length(F.translate(m, SYMBOLS + "!?", "")).cast("bigint").alias("n_capitals"))).alias("marks"),
    ))


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with the base counts, base_failed, and one column for each measure."""
    out = documents.withColumn("_facts", facts(F.col(text)))
    at = {"n_dup_lines": "lines.", "n_lines": "lines.", "n_symbols": "marks.", "n_shouts": "marks.", "n_capitals": "marks."}
    f = lambda name: F.col(f"_facts.{at.get(name, '')}{name}")
    ratio = lambda a, b, by=1000: F.expr(f"({by} * _facts.{at.get(a, '')}{a}) div greatest(_facts.{at.get(b, '')}{b}, 1)")
    return out.withColumns({
        **{name: f(name) for name in BASE},
        "base_failed": (f("n_words") < 10) | (100 * f("n_repeat_words") > 20 * f("n_words")),
        "word_length": ratio("word_chars", "n_words", 100),
        "symbol_rate": ratio("n_symbols", "n_words"),
        "dup_line_rate": ratio("n_dup_lines", "n_lines"),
        "repeat_rate": ratio("n_repeat_words", "n_words"),
        "capital_rate": ratio("n_capitals", "word_chars"),
        "shout_rate": ratio("n_shouts", "n_words"),
    }).drop("_facts")


def bucket(value: str) -> Column:
    """Sketch bucket of a whole number >= 0, in the order of the values."""
    return F.expr(f"case when {value} < 32 then {value} else 16 * (length(bin({value})) - 5) "
                  f"+ shiftright({value}, length(bin({value})) - 5) end")


def sketch(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Counts by keys, measure, bucket with the largest value met in the bucket; partial counts before the shuffle."""
    long = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])).alias("m")).select(*keys, "m.*")
    return long.groupBy(*keys, "measure", bucket("value").alias("bucket")).agg(
        F.count("*").alias("n"), F.max("value").alias("value"))


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups added up."""
    return parts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"), F.max("value").alias("value"))


def cells(sk: DataFrame, keys: list[str]) -> DataFrame:
    """n_docs and cells (bucket, value, n) by keys and measure: a sketch as one row. It has few buckets whatever its rows."""
    return sk.groupBy(*keys, "measure").agg(
        F.sum("n").alias("n_docs"), F.sum("n").cast("double").alias("weight"),
        F.collect_list(F.struct("bucket", F.col("value").cast("bigint").alias("value"), F.col("n").cast("double").alias("n"))).alias("cells"))


def leaning(groups: DataFrame, parents: DataFrame, keys: list[str], prior: int) -> DataFrame:
    """groups (see `cells`) with the cells of their parent (by keys) added, scaled to `prior` documents."""
    up = parents.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("measure").alias("_measure"),
                        F.col("cells").alias("_cells"), F.col("weight").alias("_weight"))
    same = F.col("measure") == F.col("_measure")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    scaled = F.transform("_cells", lambda c: F.struct(
        c["bucket"].alias("bucket"), c["value"].alias("value"), (c["n"] * prior / F.col("_weight")).alias("n")))
    return groups.join(up, same).withColumns(
        {"cells": F.concat("cells", scaled), "weight": F.col("weight") + prior}).select(*groups.columns)


def cut(part: int) -> Column:
    """Value up to which `part` quarters of the weight lie."""
    empty = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("bigint").alias("at"))

    def step(acc: Column, c: Column) -> Column:
        upto = acc["upto"] + c["n"]
        return F.struct(upto.alias("upto"), F.coalesce(
            acc["at"], F.when(4 * upto >= part * F.col("weight"), c["value"])).alias("at"))

    return F.aggregate(F.sort_array("cells"), empty, step)["at"]


def quartiles(sk: DataFrame, keys: list[str]) -> DataFrame:
    """n_docs, q1 and q3 by keys and measure of a sketch that leans on no other."""
    return of_cells(cells(sk, keys), keys)


def of_cells(groups: DataFrame, keys: list[str]) -> DataFrame:
    return groups.select(*keys, "measure", "n_docs", cut(1).alias("q1"), cut(3).alias("q3"))


def fences(rows: DataFrame, rules=FENCES, prior: int = PRIOR) -> DataFrame:
    """One row for each (lang, source) of rows: struct of limits by rule."""
    names, group = [r.measure for r in rules], ["lang", "source"]
    fine = written(sketch(rows.filter(~F.col("base_failed")).select(*group, *names), group, names), "quality-sketch")
    langs = leaning(cells(merge(fine, ["lang"]), ["lang"]), cells(merge(fine, []), []), [], prior)
    q = of_cells(leaning(cells(fine, group), langs, ["lang"], prior), group)
    reach = {r.measure: r.reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(r.least)) for r in rules}
    of = lambda r, value: F.max(F.when(F.col("measure") == r.measure, value))
    wide = q.groupBy(*group).agg(
        *[of(r, F.col("q3") + reach[r.measure]).alias(f"{r.measure}_max") for r in rules],
        *[of(r, F.col("q1") - reach[r.measure]).alias(f"{r.measure}_min") for r in rules if r.low])
    return wide.select(*group, F.struct(*[c for c in wide.columns if c not in group]).alias("limits"))


def verdict(rows: DataFrame, limits: DataFrame, rules=FENCES) -> DataFrame:
    """Measured rows with `kept`, joined with the limits of their group (written, see `fences`)."""
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("limits").alias("_limits"))
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    within = F.lit(True)
    for r in rules:
        within &= F.col(r.measure) <= F.col("_limits")[f"{r.measure}_max"]
        if r.low:
            within &= F.col(r.measure) >= F.col("_limits")[f"{r.measure}_min"]
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return (rows.join(limits, same, "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False)))
            .drop("_lang", "_source", "_limits"))


def judged(documents: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, kept and measures of every document. The texts are read once."""
    names = [r.measure for r in FENCES]
    rows = written(measured(documents.select("doc_id", "lang", "source", "text"))
                   .select("doc_id", "lang", "source", *BASE, "base_failed", *names), "quality-measures")
    return verdict(rows, written(fences(rows), "quality-limits")).select("doc_id", *BASE, "base_failed", "kept", *names)


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns as they came.

    The counts are taken once and written beside the documents, so the texts are not shuffled to meet their verdict.
    """
    rows = written(measured(documents.select(F.struct("*").alias("_doc"), "lang", "source", "text")).drop("text"),
                   "quality-documents")
    return verdict(rows, written(fences(rows), "quality-limits")).filter("kept").select("_doc.*")
