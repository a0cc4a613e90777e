"""Fitted models on held-out rows, and the pipeline as a whole."""

import os
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptloom.llm import quality_rank, quality_rules, toxicity
from scriptloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")}


@needs_tables
def test_ranking_on_held_out_rows(tables):
    rows = quality_rank.scored(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.93
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.97


@needs_tables
def test_held_out_labels_are_not_read(tables):
    turned = tables["labels"].withColumn("quality", F.when(quality_rank.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (sorted(map(tuple, quality_rank.scored(tables["documents"], x).select("doc_id", "score").collect()))
                  for x in (tables["labels"], turned))
    assert one == other


def test_ranking_edges(spark):
    docs = brute.documents(spark, [None, "", "a b c"], [1, None, 1])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert [r.score for r in quality_rank.scored(docs, labels).collect()] == [0.7] * 3
    assert quality_rank.scored(docs.filter("doc_id < 0"), labels).count() == 0


def test_pairs_order_the_weights():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (300, 2)), rng.normal(0, 1, (300, 2))
    w = quality_rank.fit(good, bad)
    assert np.mean((good @ w)[:, None] > (bad @ w)[None, :]) > 0.75


def test_cut_is_the_quantile(spark):
    raw = spark.range(10_000).selectExpr("id", "double(id * 7919 % 10007) / 13 - 300 as raw")
    cut = quality_rank.cut_at(raw, 0.2)
    assert abs(raw.filter(F.col("raw") < cut).count() - 2000) <= 1
    assert quality_rank.cut_at(raw.filter("id < 0"), 0.2) == 0.0


def test_thresholds_share_weights():
    texts = [{"plain": 3}] * 40 + [{"plain": 2, "mean": 1}] * 20 + [{"plain": 1, "mean": 9}] * 20
    model = toxicity.fit(texts, [0] * 40 + [1] * 20 + [2] * 20)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    low, middle, high = (model.severity(t) for t in ("plain plain", "plain mean", "mean " * 9))
    assert 0 <= low < 0.5 < middle < high <= 2
    assert model.severity(None) == model.severity("") <= middle
    assert toxicity.fit(texts, [0] * 80).severity("mean") == 0.0


@needs_tables
def test_toxicity_on_rows_not_learned_from(tables):
    learn = tables["labels"].filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    other = tables["labels"].join(learn, "doc_id", "left_anti")
    rows = toxicity.rated(tables["documents"], learn).join(other.withColumnRenamed("toxic", "label"), "doc_id").collect()
    seen = Counter((r.label, r.toxic) for r in rows)
    assert seen[0, True] <= 0.05 * (seen[0, True] + seen[0, False])
    assert seen[1, True] >= 0.6 * (seen[1, True] + seen[1, False])


def test_toxicity_edges(spark):
    docs = brute.documents(spark, [None, "", "a b c"], [1, None, 1])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    assert {r.severity for r in toxicity.rated(docs, labels).collect()} == {0.0}
    clean = toxicity.clean_documents(docs, labels)
    assert clean.columns == docs.columns and clean.count() == 3


@needs_tables
def test_pipeline_stage_by_stage(spark, tables, tmp_path):
    docs = tables["documents"].limit(400).withColumn("_doc", F.lit(1))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, out)
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    before, out = seen["quality_rules"]
    kept = {r.doc_id for r in out.collect()}
    for i, text in before.items():
        n, _, _, _, repeated = brute.base(text)
        assert i not in kept or (n >= 10 and 100 * repeated <= 20 * n)
    before, out = seen["line_dedup"]
    want = {k[0]: v for k, v in brute.line_dedup(list(before.items())).items() if v == k[1] or brute.WORD.search(v)}
    assert {r.doc_id: r.text for r in out.collect()} == want
    before, out = seen["near_dedup"]
    ids = sorted(before)
    sets = [brute.shingles(before[i]) for i in ids]
    tops, _ = brute.grouped(len(ids), lambda i, j: brute.near(sets[i], sets[j]))
    assert {r.doc_id for r in out.collect()} == {ids[t] for t in tops}
    before, out = seen["packing"]
    assert {r.doc_id for r in out.collect()} == set(before)


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    folder = FOLDER.replace("0.01", "0.001")
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    got = QUERIES[name](spark, folder).select(*cols).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))


def test_rules_query_keeps_what_stage_keeps(spark):
    docs = brute.documents(spark, [" ".join(map(str, range(n))) for n in (3, 12, 40)])
    judged = {r.doc_id for r in quality_rules.judged(docs).filter("kept").collect()}
    assert judged == {r.doc_id for r in quality_rules.kept_documents(docs).collect()}
