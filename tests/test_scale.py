"""Queries whose work must follow the cores and not be done twice; every test builds its own rows."""

from scriptloom.operators import gram_index as gi
from scriptloom.plans.bind import Corpus
from scriptloom.plans.catalog import QUERIES

SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def corpus(spark, folder, **tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return Corpus(spark, str(folder))


def test_cards_of_a_part_table_in_one_file_use_all_cores(spark, tmp_path):
    rows = [(k, f"n{k}", "b", "t", k % 50, 1.0) for k in range(200)]
    c = corpus(spark, tmp_path, part=[*rows, rows[0], (None, "n", "b", "t", 1, 1.0)])
    cards = QUERIES["q_fact_card"](c)
    assert cards.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and cards.count() == 202


def test_lengths_of_chunks_are_taken_once(spark, tmp_path):
    c = corpus(spark, tmp_path, documents=[(k, "x" * k, "en", "s", k) for k in range(10)], pages=[(0, "http://h/a", "<p>x</p>")],
               conversations=[(0, 0, "user", "hi")])
    stats = QUERIES["q_corpus_stats"](c)
    assert all("chunk-lengths" in f for f in stats.inputFiles())
    assert {r.stat: r.value for r in stats.collect()}["count"] == 12


def test_postings_need_no_sample_of_all_grams(spark, tmp_path, monkeypatch):
    def sampled(*_):
        raise AssertionError("a pass over all grams to find the bounds of ranges")

    rows = [("c", k, "the same gram " * 3 + str(k)) for k in range(40)] + [("d", 0, None), (None, 1, "the")]
    chunks = spark.createDataFrame(rows, "container_id string, stage_idx bigint, body string")
    monkeypatch.setattr(type(chunks), "repartitionByRange", sampled)
    index = gi.GramIndex.write(chunks, str(tmp_path / "index"), folders=4, blocks=16)
    assert index.frequencies("the")["the"] == 41
    assert {r.stage_idx for r in index.grep("gram 7").collect()} == {7}
