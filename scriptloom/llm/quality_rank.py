"""Document quality by Bradley-Terry pairwise ranking.

The chance that document i is preferred to j is sigmoid(s_i - s_j) with s = w . f(text). w is learned by logistic
loss on the feature differences of preference pairs: each pair is a document labelled good and one labelled bad,
drawn from a bounded sample of labelled rows that are not held out (`Params.per_class` rows of each label, first
in the order of a hash of the doc_id). The cut is the quantile of the scores of all documents at the share of bad
labels; scores are mapped to 0..1 so that the cut falls on `Params.level`.

Features are counts and rates of the whole text, taken by built-in functions; labels, language, source and
doc_id are no inputs.

Edge cases: null and empty texts have zero counts and a score like any other. Rows with a null label or doc_id
are not learned from; without labels of both kinds every score is `Params.level`. Repeated rows get equal scores.
A null doc_id is not held out. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.llm.cols import let, words_of
from scriptloom.llm.quality_rules import measured
from scriptloom.llm.samples import labelled
from scriptloom.session import written


@dataclass(frozen=True)
class Params:
    per_class: int = 5_000  # labelled texts of each label, at most
    pairs: int = 40_000  # preference pairs drawn from them
    rounds: int = 40
    ridge: float = 1e-3
    level: float = 0.7  # score of the cut
    held_out: int = 2  # rows whose hash has this remainder by 4 are not learned from


FEATURES = [
    "symbols", "dup_lines", "repeats", "capitals", "shouts", "word_length", "word_length_sq", "length",
    "variety", "variety_sq", "symbols_any", "capitals_many",
]


def held_out(doc_id: Column, p: Params = Params()) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == p.held_out, F.lit(False))


def featured(documents: DataFrame) -> DataFrame:
    """doc_id and the features of its text as columns."""
    rows = measured(documents.select("doc_id", "text"))
    log = lambda name: F.log1p(F.col(name).cast("double"))
    n = F.col("n_words").cast("double")
    distinct = let(words_of(F.col("text")), lambda w: F.size(F.array_distinct(w))).cast("double")
    length = F.least(F.col("word_length") / 100.0, F.lit(50.0))
    # distinct words fall with length in ordinary texts; their logarithms grow about in proportion
    variety = F.log1p(n) - F.log1p(distinct)
    cols = {
        "symbols": log("symbol_rate"), "dup_lines": log("dup_line_rate"), "repeats": log("repeat_rate"),
        "capitals": log("capital_rate"), "shouts": log("shout_rate"),
        "word_length": length, "word_length_sq": length * length, "length": F.log1p(n),
        "variety": variety, "variety_sq": variety * variety,
        "symbols_any": (F.col("symbol_rate") > 50).cast("double"), "capitals_many": (F.col("capital_rate") > 300).cast("double"),
    }
    return rows.select("doc_id", *[c.alias(k) for k, c in cols.items()])


def fit(good: np.ndarray, bad: np.ndarray, p: Params = Params()) -> np.ndarray:
    """Weights from preference pairs, by Newton steps on the logistic loss of feature differences."""
    draw = np.random.default_rng(11)
    d = good[draw.integers(0, len(good), p.pairs)] - bad[draw.integers(0, len(bad), p.pairs)]
    scale = d.std(0) + 1e-9
    d = d / scale
    w = np.zeros(d.shape[1])
    for _ in range(p.rounds):
        miss = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # chance given to the wrong order
        step = np.linalg.solve((d * (miss * (1 - miss))[:, None]).T @ d / len(d) + p.ridge * np.eye(len(w)),
                               d.T @ miss / len(d) - p.ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w / scale


def trained(documents: DataFrame, labels: DataFrame, p: Params = Params()) -> tuple[np.ndarray, float] | None:
    """Weights, and the share of bad labels; none without labels of both kinds."""
    learn = ~held_out(F.col("_id"), p)
    rows = labelled(documents, labels, "quality", p.per_class, learn)
    # bounded: at most 2 * per_class rows of a few numbers
    found = written(featured(rows.select("doc_id", "text")).join(
        rows.select(F.col("doc_id").alias("_id"), "label"), F.col("doc_id") == F.col("_id")), "rank-sample").orderBy("doc_id").collect()
    good, bad = ([[r[f] for f in FEATURES] for r in found if r.label == k] for k in (1, 0))
    if not good or not bad:
        return None
    seen = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), p))
    share = seen.agg(F.avg(1 - F.col("quality")).alias("bad")).first().bad
    return fit(np.array(good), np.array(bad), p), float(share)


def cut_at(scores: DataFrame, share: float) -> float:
    """The score below which `share` of all rows lie, from counts of rounded scores, coarse and then fine."""
    below, low, width = 0, -1024.0, 2048.0
    n = scores.count()
    if not n:
        return 0.0
    need = share * n
    for _ in range(3):
        width /= 1024
        cell = F.floor((F.col("raw") - low) / width)
        counts = scores.filter((F.col("raw") >= low) & (F.col("raw") < low + 1024 * width)) \
            .groupBy(cell.alias("cell")).count().orderBy("cell").collect()  # 1024 rows at most
        for row in counts:
            if below + row["count"] >= need:
                low += row.cell * width
                break
            below += row["count"]
    return low + width


def scored(documents: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = trained(documents, labels, p)
    if model is None:
        rows = documents.select("doc_id", F.lit(p.level).cast("double").alias("score"))
    else:
        w, share = model
        raw = sum((F.col(f) * float(x) for f, x in zip(FEATURES, w, strict=True)), F.lit(0.0))
        raw = written(featured(documents).select("doc_id", F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), raw)).alias("raw")), "rank-scores")
        cut = cut_at(raw, share)
        at_level = float(np.log(p.level / (1 - p.level)))
        rows = raw.select("doc_id", (1 / (1 + F.exp(-(F.col("raw") - cut + at_level)))).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id"), p).alias("held_out"), "score",
                       (F.col("score") >= p.level).cast("int").alias("predicted"))
