"""Bounded samples of labelled texts for fitting a model on the driver."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def labelled(documents: DataFrame, labels: DataFrame, label: str, per_class: int, where: Column | None = None) -> DataFrame:
    """doc_id, text, label: at most per_class rows of each class, the first in the order of a hash of the doc_id.

    One row for each doc_id: of repeated ids the one with the largest text hash counts.
    """
    seen = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).filter("_id is not null and _label is not null")
    if where is not None:
        seen = seen.filter(where)
    order = [F.xxhash64("_id"), F.col("_id"), F.col("_label")]
    sample = None
    for value in (0, 1):
        part = seen.filter(F.col("_label") == value).orderBy(*order).limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    one = sample.groupBy("_id").agg(F.max("_label").alias("_label"))  # at most 2 * per_class short rows
    rows = documents.select("doc_id", "text").join(F.broadcast(one), F.col("doc_id") == F.col("_id"))
    return rows.groupBy("doc_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.max("_label").alias("label"))


def counted(rows: DataFrame, features: Callable[[str], Counter]) -> DataFrame:
    """doc_id, label, feature, n of a bounded sample; the feature '' has the number of all features of the text."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, label, text in zip(batch["doc_id"], batch["label"], batch["text"], strict=True):
                found = features(text) if isinstance(text, str) else Counter()
                names = ["", *found]
                yield pd.DataFrame({"doc_id": doc_id, "label": label, "feature": names,
                                    "n": [sum(found.values()), *found.values()]})

    return rows.mapInPandas(count, "doc_id bigint, label int, feature string, n int")


def telling(counts: DataFrame, least_ratio: float, least_z: float) -> DataFrame:
    """feature, low, high (texts of label 0 and 1 with it) of the features whose share of texts differs between the labels.

    By least_z standard deviations of what one common share would give, and by the ratio of the shares.
    """
    total = counts.filter("feature = ''").agg(F.sum(1 - F.col("label")).alias("_low"), F.sum("label").alias("_high"))
    each = counts.filter("feature <> ''").groupBy("feature").agg(F.sum(1 - F.col("label")).alias("low"), F.sum("label").alias("high"))
    rows = each.join(F.broadcast(total), F.lit(True))  # one row of totals
    a, b = F.col("high") / F.col("_high"), F.col("low") / F.col("_low")
    common = (F.col("high") + F.col("low")) / (F.col("_high") + F.col("_low"))
    sd = F.sqrt(common * (1 - common) * (1 / F.col("_high") + 1 / F.col("_low")))
    far = (F.abs(a - b) >= least_z * sd) & (
        F.greatest(a, b) + 1 / F.col("_high") >= least_ratio * (F.least(a, b) + 1 / F.col("_high")))
    return rows.filter((F.col("_low") > 0) & (F.col("_high") > 0) & far).select("feature", "low", "high")
