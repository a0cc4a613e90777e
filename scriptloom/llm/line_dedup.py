"""Removal of line runs that occur again: repeated runs come from the suffixes of line-ID sequences.

The lines with a word of every document form a sequence of line ids (64-bit hashes of the whole line). A run is
a stretch of consecutive such lines with at least `min_words` words. A run that equals one at an earlier place
(smaller doc_id, or further up in the same document) is a later copy and its lines are deleted; every deleted
line therefore still stands at an earlier place.

How runs are found. Suffixes are named by prefix doubling: the name of the first 2k lines of a suffix is made of
the names of its first k and of the k lines after them. The set of suffixes that share their first d lines is a
longest-common-prefix interval of depth d; its identity is the name of that prefix, put together from the two
(overlapping) doubling names that cover d lines. Names are content hashes, so a round of doubling needs no
exchange of ranks, and grouping by a name gives the same intervals as cutting a sorted suffix array at depth d.
From each suffix the intervals of just those depths are taken that are minimal from either end: dropping the
first or the last line would leave fewer than `min_words` words. Every maximal repeated run is the union of such
windows, so the union of the later copies' windows is the union of the later copies of all maximal runs, and no
more than two windows for each line are ever made, whatever the number or size of the groups.

Only lines that occur twice can be part of a repeated run, so all others leave before the doubling; stretches
of repeated lines with too few words leave too. DataFrame functions only.

Edge cases: null and empty texts have no lines and stay as they are. Lines without a word are never compared and
never deleted. Rows equal in doc_id and text are one document. A null doc_id comes before all others. An empty
table gives an empty result. Columns of the input stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptloom.llm.cols import let, words_of
from scriptloom.session import written

MIN_WORDS = 50
WORD = "[^\\x20\\x09-\\x0D]"
ID = ["_doc_id", "_hash"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def worded(text: Column) -> Column:
    """Array of (line, place in the text) of the lines with a word."""
    return F.filter(F.transform(lines_of(text), lambda x, i: F.struct(x.alias("line"), i.alias("at"))),
                    lambda e: e["line"].rlike(WORD))


def line_ids(documents: DataFrame) -> DataFrame:
    """_doc_id, _hash, r (number among the lines with a word), h (line id), n (words)."""
    rows = documents.select(F.col("doc_id").alias("_doc_id"), F.xxhash64("text").alias("_hash"),
                            F.posexplode(worded(F.col("text"))).alias("r", "e"))
    return rows.select(*ID, "r", F.xxhash64("e.line").alias("h"), F.size(words_of(F.col("e.line"))).cast("bigint").alias("n"))


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Stretches of repeated lines with enough words: ID, seg and per line r, h, and the depths first..last of its windows."""
    twice = lines.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    again = lines.join(twice, "h").dropDuplicates([*ID, "r"])
    by = Window.partitionBy(*ID, "seg")
    rows = (again.withColumn("seg", F.col("r") - F.row_number().over(Window.partitionBy(*ID).orderBy("r")))
            .withColumn("words", F.sum("n").over(by)).filter(F.col("words") >= min_words)
            .withColumn("end", F.max("r").over(by) + 1)
            .withColumn("before", F.sum("n").over(by.orderBy("r")) - F.col("n")))
    # the next line before which min_words words have passed; the growing frame makes this linear
    passed = F.min("r").over(by.orderBy(F.desc("before")).rangeBetween(Window.unboundedPreceding, -min_words))
    rows = rows.withColumn("first", F.when(F.col("words") - F.col("before") >= min_words,
                                           F.coalesce(passed, F.col("end")) - F.col("r")))
    rows = rows.withColumn("last", F.greatest(
        F.col("first"), F.coalesce(F.lead("first").over(by.orderBy("r")), F.col("end") - F.col("r"))))
    return rows.groupBy(*ID, "seg").agg(F.sort_array(F.collect_list(F.struct("r", "h", "first", "last"))).alias("lines"))


def windows(found: DataFrame, min_words: int) -> DataFrame:
    """ID, r, d, name: each window of the stretches by its first line, depth and prefix name."""
    levels = (min_words + 1).bit_length()  # a window has no more lines than min_words + 1

    def doubled(names: Column, k: int, then) -> Column:
        """names[j][i]: name of the 2**j lines from i on."""
        top, step = F.element_at(names, k), 1 << (k - 1)
        return let(top, lambda t: let(F.concat(names, F.array(F.transform(
            t, lambda x, i: F.when(i + step < F.size(t), F.xxhash64(x, F.get(t, i + step)))))),
            lambda more: then(more) if k + 1 >= levels else doubled(more, k + 1, then)))

    def of_line(names: Column, e: Column, i: Column) -> Column:
        return F.transform(F.sequence(e["first"], e["last"]), lambda d: F.struct(
            e["r"].alias("r"), d.alias("d"), F.xxhash64(*_cover(names, i, d)).alias("name")))

    runs = let(F.col("lines"), lambda ls: doubled(
        F.array(F.transform(ls, lambda e: e["h"])), 1,
        lambda names: F.flatten(F.transform(ls, lambda e, i: F.when(
            e["first"].isNotNull(), of_line(names, e, i)).otherwise(F.array().cast("array<struct<r:int,d:int,name:bigint>>"))))))
    return found.select(*ID, F.explode(runs).alias("w")).select(*ID, "w.*")


def _cover(names: Column, i: Column, d: Column) -> tuple[Column, Column]:
    """The two doubling names that cover d lines from i on."""
    k = F.length(F.bin(d.cast("bigint"))) - 1
    level = F.element_at(names, k + 1)
    return F.get(level, i), F.get(level, i + d - F.pow(F.lit(2), k).cast("int"))


def deleted_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """ID and `gone`: the numbers of the deleted lines of each document that loses some, in order."""
    lines = written(line_ids(documents), "line-ids")
    runs = written(windows(stretches(lines, min_words), min_words), "line-windows")
    place = F.struct(*ID, "r")
    first = runs.groupBy("name", "d").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    later = runs.join(first, ["name", "d"]).filter(place > F.col("_first"))
    gone = later.select(*ID, F.explode(F.sequence(F.col("r"), F.col("r") + F.col("d") - 1)).alias("r"))
    return gone.groupBy(*ID).agg(F.sort_array(F.collect_set("r")).alias("gone"))


def without(text: Column, gone: Column) -> Column:
    """text less the lines with a word numbered in `gone` (sorted): what lies between them, in one pass."""
    def cut(ls: Column) -> Column:
        places = F.transform(F.filter(F.transform(ls, lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull()), lambda i: i)
        return let(places, lambda at: let(
            F.concat(F.array(F.lit(-1)), F.transform(gone, lambda r: F.get(at, r)), F.array(F.size(ls))),
            lambda marks: F.array_join(F.flatten(F.transform(
                F.sequence(F.lit(1), F.size(marks) - 1),
                lambda k: F.slice(ls, F.get(marks, k - 1) + 2, F.get(marks, k) - F.get(marks, k - 1) - 1))), "\n")))

    return F.when(gone.isNull(), text).otherwise(let(lines_of(text), cut))


def marked(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_doc (the row as it came), _text (without its later copies), _n_deleted."""
    gone = deleted_lines(documents, min_words)
    rows = documents.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), F.col("text").alias("_whole"))
    same = F.col("_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("_whole") == F.col("_hash"))
    return rows.join(gone, same, "left").select(
        "_doc", without(F.col("_whole"), F.col("gone")).alias("_text"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("_n_deleted"))


def deduplicated(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without later copies, n_lines (with a word, before), n_deleted of every document."""
    return marked(documents, min_words).select(
        "_doc.doc_id", F.col("_text").alias("text"),
        F.size(worded(F.col("_doc.text"))).cast("bigint").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"))


def cleaned_documents(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their text cut, own columns kept; documents that lose every line with a word go.

    n_chars, where there is one, follows the new text.
    """
    rows = marked(documents, min_words).filter((F.col("_n_deleted") == 0) | F.col("_text").rlike(WORD))
    new = {"text": F.col("_text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("_n_deleted") > 0, F.length("_text").cast(documents.schema["n_chars"].dataType)) \
            .otherwise(F.col("_doc.n_chars"))
    return rows.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in documents.columns])
