"""Column helpers shared by the training-data operators. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

WHITE = "[\\x20\\x09-\\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: lambdas inside body may refer to it without computing it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words between runs of ASCII white space; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def window_hashes(words: Column, n: int) -> Column:
    """One 64-bit hash for each n-word window, in order; none where there are fewer words."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)])))


def covered_by_repeats(hashes: Column, n: int) -> Column:
    """Words that lie in a window whose hash occurs twice or more, the first occurrence included."""
    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, starts)

    def starts(s: Column) -> Column:
        again = F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))
        places = F.sort_array(F.transform(again, lambda e: e["i"]))
        done = F.aggregate(
            places, F.struct(F.lit(0).alias("words"), F.lit(0).alias("upto")),
            lambda acc, x: F.struct((acc["words"] + n - F.greatest(F.lit(0), acc["upto"] - x)).alias("words"),
                                    (x + n).alias("upto")))
        return done["words"]

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(count(h)))
