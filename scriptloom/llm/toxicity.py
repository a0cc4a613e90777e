"""Severity of toxic texts by a cumulative-link ordinal model over sparse word features.

P(grade > k) = sigmoid(w . x - b_k) with one weight vector shared by all thresholds b_1 < b_2 < ...; the
expected severity of a text is the sum of these probabilities. x holds 1 + ln(count) for each lower-case word
and word beginning of 4 to 6 letters. Features enter where their share of texts differs between the labels by
`Params.least_ratio` and by `Params.least_z` standard deviations, and an absolute penalty draws weights to zero,
so a text is scored by the few features that tell grades apart, however long it is. The model is fitted on the
driver to a bounded sample of labelled rows (`Params.per_class` rows of each label, first in the order of a hash
of the doc_id); everything else runs on all rows and whole texts.

Grades of the query: 0 for rows labelled not toxic; rows labelled toxic are 1, or 2 where a larger share of their
features than in the median toxic text consists of features that no clean text of the sample has.

Edge cases: null and empty texts have no features and the severity of a text without known words. Rows with a
null label are not learned from; without rows of two grades every text gets severity 0. Repeated rows get equal
severities. An empty table gives an empty result. Columns of the input stay as they are.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptloom.llm.samples import counted, labelled, telling
from scriptloom.session import written

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Params:
    per_class: int = 3_000  # labelled texts of each label fitted to, at most
    least_ratio: float = 3.0
    least_z: float = 3.3
    rounds: int = 200
    penalty: float = 1e-4
    cut: float = 0.5  # expected severity from which a text counts as toxic


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, text: str | None) -> float:
        """Expected grade of one text."""
        if not self.thresholds:
            return 0.0
        hits = Counter()
        if isinstance(text, str):
            known, heads = self.weights, self.heads
            for w in WORD.findall(text.lower()):
                if w[:4] in heads:
                    hits.update(f for f in forms(w) if f in known)
        score = sum(self.weights[f] * (1 + np.log(hits[f])) for f in sorted(hits))
        return float(sum(1 / (1 + np.exp(np.clip(b - score, -50, 50))) for b in self.thresholds))

    @functools.cached_property
    def heads(self) -> set[str]:
        return {f[:4] for f in self.weights}


def forms(word: str) -> list[str]:
    """A word, and its beginnings marked by a hyphen."""
    return [word, *[word[:n] + "-" for n in (4, 5, 6) if len(word) >= n]]


def features(text: str) -> Counter:
    return Counter(f for w in WORD.findall(text.lower()) for f in forms(w))


def grades(labels: dict[int, int], counts: dict[int, dict[str, int]], total: dict[int, int], marked: set[str]) -> dict[int, int]:
    """Grades 0, 1, 2 by doc_id, see above."""
    share = {d: sum(n for f, n in counts.get(d, {}).items() if f in marked) / max(1, total[d]) for d in labels}
    middle = np.median([share[d] for d, label in labels.items() if label] or [0])
    return {d: 0 if not label else 2 if share[d] > middle else 1 for d, label in labels.items()}


def fit(found: list[dict[str, int]], graded: list[int], params: Params = Params()) -> Model:
    """Gradient steps with a step size of each weight's own, shrinking weights by the penalty; thresholds stay in order."""
    grade = np.asarray(graded, dtype=int)
    top = int(grade.max()) if len(grade) else 0
    if top == 0 or not (grade == 0).any():
        return Model({}, ())
    vocabulary = sorted({f for c in found for f in c})
    number = {f: i for i, f in enumerate(vocabulary)}
    pairs = [(i, number[f], n) for i, c in enumerate(found) for f, n in c.items()]
    rows, cols = (np.fromiter((p[k] for p in pairs), "int64", len(pairs)) for k in (0, 1))
    values = 1 + np.log(np.fromiter((p[2] for p in pairs), "float64", len(pairs)))
    above = grade[:, None] > np.arange(top)[None, :]
    share = np.clip(above.mean(0), 1e-3, 1 - 1e-3)
    balance = np.where(above, 0.5 / share, 0.5 / (1 - share)) / len(grade)
    b = np.arange(top) * 1.0
    w = np.zeros(len(vocabulary))
    seen_w, seen_b = np.full(len(vocabulary), 1e-10), np.full(top, 1e-10)
    for _ in range(params.rounds):
        score = np.bincount(rows, w[cols] * values, minlength=len(grade))
        wrong = (1 / (1 + np.exp(np.clip(b[None, :] - score[:, None], -50, 50))) - above) * balance
        g_w = np.bincount(cols, wrong.sum(1)[rows] * values, minlength=len(vocabulary))
        g_b = -wrong.sum(0)
        seen_w += g_w * g_w
        seen_b += g_b * g_b
        step = 1.0 / np.sqrt(seen_w)
        w -= step * g_w
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * params.penalty)
        b = np.maximum.accumulate(b - 0.5 * g_b / np.sqrt(seen_b) + np.arange(top) * 1e-9)
    return Model({f: float(x) for f, x in zip(vocabulary, w, strict=True) if x}, tuple(b.tolist()))


def trained(documents: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    counts = written(counted(labelled(documents, labels, "toxic", params.per_class), features), "toxic-sample")
    chosen = {r.feature: r.low for r in telling(counts, params.least_ratio, params.least_z).collect()}
    label, total, found = {}, {}, {}
    # the rows of the bounded sample, each with few features
    keys = counts.sparkSession.createDataFrame([("",), *[(f,) for f in chosen]], "feature string")
    for r in counts.join(F.broadcast(keys), "feature").collect():
        if r.feature == "":
            label[r.doc_id], total[r.doc_id] = r.label, r.n
        else:
            found.setdefault(r.doc_id, {})[r.feature] = r.n
    graded = grades(label, found, total, {f for f, low in chosen.items() if not low})
    ids = sorted(label)
    return fit([found.get(d, {}) for d in ids], [graded[d] for d in ids], params)


def severity(model: Model) -> callable:
    """Column function: expected severity of a text column."""
    @F.arrow_udf("double")
    def rate(text: pa.Array) -> pa.Array:
        # one text at a time becomes a Python string; a batch may hold thousands of long ones
        return pa.array([model.severity(t.as_py()) for t in text], pa.float64())

    return rate


def rated(documents: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, severity, toxic, kept of every document."""
    rate = severity(trained(documents, labels, params))
    return (documents.select("doc_id", rate("text").alias("severity"))
            .withColumns({"toxic": F.col("severity") >= params.cut, "kept": F.col("severity") < params.cut}))


def clean_documents(documents: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents below the cut, with their own columns as they came."""
    rate = severity(trained(documents, labels, params))
    return documents.select(F.struct("*").alias("_doc"), rate("text").alias("_severity")) \
        .filter(F.col("_severity") < params.cut).select("_doc.*")
