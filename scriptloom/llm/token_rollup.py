"""Token totals by source, language and tokenizer version, kept by signed changes.

A batch holds inserts, deletes and revised counts. Each becomes signed rows: an insert adds a document and its
tokens to its group, a delete takes them away, a revision does both, in what may be two groups (another source,
language or tokenizer version). Signed rows are summed before the shuffle and after it, so a batch leaves one row
for each group it touches, and totals are the sum over batches: nothing is counted again.

A batch is committed under its id in one folder, which counts once Spark's job for it has finished (`_SUCCESS`).
Delivering a batch again changes nothing; a batch whose job broke off is written anew. `compact` folds the
committed batches into one base and remembers their ids, so late repeats stay without effect.

One batch id is written by one job at a time. Edge cases: null source, language or version is a group of its
own; a null count is 0 tokens; groups whose documents and tokens have come to nothing are left out; a folder
without batches has no totals. Repeated rows of one batch are changes of their own. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptloom.llm.bpe_words import encoder, groups, tokenizer_path
from scriptloom.session import checkpoint_root, written

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, n_docs bigint, n_tokens bigint"
TOKENIZER = "word_bpe_49k"


def counted(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, lang, words, tokens of every whole text."""
    path = path or tokenizer_path(f"{TOKENIZER}.json")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            tokens = [len(raw) // 4 for a, b in groups(texts) for raw in enc.packed(texts[a:b])]
            words = [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in texts]
            yield batch[["doc_id", "source", "lang"]].assign(words=words, tokens=tokens)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", "text")
    return rows.mapInPandas(run, "doc_id bigint, source string, lang string, words bigint, tokens bigint")


def inserts(rows: DataFrame, version: str, tokens: str) -> DataFrame:
    """Changes that add each row's count under a version."""
    return rows.select(F.lit(1).alias("sign"), "source", "lang", F.lit(version).alias("version"), F.col(tokens).alias("n_tokens"))


def deletes(rows: DataFrame, version: str, tokens: str) -> DataFrame:
    """Changes that take each row's count away."""
    return inserts(rows, version, tokens).withColumn("sign", F.lit(-1))


def revisions(rows: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """Changes from one (version, count column) to another."""
    return deletes(rows, *old).unionByName(inserts(rows, *new))


def deltas(changes: DataFrame) -> DataFrame:
    """Signed totals of a batch by group."""
    return changes.groupBy(*KEYS).agg(
        F.sum("sign").cast("bigint").alias("n_docs"),
        F.sum(F.col("sign") * F.coalesce(F.col("n_tokens"), F.lit(0))).cast("bigint").alias("n_tokens"))


@dataclass(frozen=True)
class Rollup:
    spark: SparkSession
    folder: str

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Write the batch's signed totals; False, without reading the changes, where it is committed already."""
        if batch_id in self.committed():
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch_id}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens: the sum of the base and of all later batches."""
        base, merged = self._base()
        paths = [f"{self.folder}/batches/{b}" for b in self._done("batches") if b not in merged]
        parts = [p for p in (base and f"{base}/totals", *paths) if p]
        rows = self.spark.read.schema(SCHEMA).parquet(*parts) if parts else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
            .filter("n_docs <> 0 or n_tokens <> 0")

    def committed(self) -> set[str]:
        return self._done("batches") | self._base()[1]

    def compact(self) -> None:
        """Fold all committed batches into a new base. The ids are written last and make it count."""
        ids = sorted(self.committed())
        number = len(self._list("bases"))
        base = f"{self.folder}/bases/{number:08d}-{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{base}/totals")
        self.spark.createDataFrame([(i,) for i in ids], "id string").write.parquet(f"{base}/ids")

    def _base(self) -> tuple[str | None, set[str]]:
        full = [b for b in sorted(self._list("bases")) if self._exists(f"bases/{b}/ids/_SUCCESS")]
        if not full:
            return None, set()
        base = f"{self.folder}/bases/{full[-1]}"
        return base, {r.id for r in self.spark.read.schema("id string").parquet(f"{base}/ids").collect()}  # one row a batch

    def _done(self, kind: str) -> set[str]:
        return {b for b in self._list(kind) if self._exists(f"{kind}/{b}/_SUCCESS")}

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        system, path = self._path(name)
        return system.exists(path)

    def _list(self, name: str) -> list[str]:
        system, path = self._path(name)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def rolled_up(documents: DataFrame, restored: bool = False) -> DataFrame:
    """Totals after four deliveries, or five.

    `load` inserts every document with its white-space words as version `words`; `recount` revises every document
    to the ids of the tokenizer; `withdraw` deletes the documents without an id; `recount` comes once more. Where
    restored, `restore` inserts the withdrawn documents again, so the totals cover every document.
    """
    spark = documents.sparkSession
    rows = written(counted(documents), "token-counts")
    rollup = Rollup(spark, f"{checkpoint_root(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    recount = revisions(rows, ("words", "words"), (TOKENIZER, "tokens"))
    rollup.commit("load", inserts(rows, "words", "words"))
    rollup.commit("recount", recount)
    empty = rows.filter("tokens = 0")
    rollup.commit("withdraw", deletes(empty, TOKENIZER, "tokens"))
    rollup.commit("recount", recount)
    if restored:
        rollup.commit("restore", inserts(empty, TOKENIZER, "tokens"))
    return rollup.totals()
