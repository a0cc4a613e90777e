"""Quality rules and line removal against plain Python."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from scriptloom.llm import line_dedup, quality_rules

EDGES = [None, "", " \t\n\x0b\x0c\r", "a", "a b c d e a b c d e", "x x x x x x x x x x x x", "é" * 10, "\n\n", "a|b <c> #$%&*", "w\x1fw v",
         "one two three four five six seven eight nine ten eleven", "A B\nA B\n\nA B \n", "a " * 20_000]


def test_base_counts_and_verdict(spark):
    rng = random.Random(5)
    texts = EDGES + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rows = quality_rules.judged(brute.documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_fences_follow_the_group(spark):
    rng = random.Random(1)
    plain = [" ".join(rng.choice(["word", "other", "third", "some"]) + str(rng.randint(0, 9999)) for _ in range(30)) for _ in range(150)]
    loud = ["### ".join(t.split()) for t in plain[:3]]
    docs = brute.documents(spark, plain + loud).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(150))
    # a group in which symbols are the rule keeps its own
    docs = brute.documents(spark, ["### ".join(t.split()) for t in plain] + plain).withColumns(
        {"lang": F.lit("en"), "source": F.when(F.col("doc_id") < 150, "a").otherwise("b")})
    assert quality_rules.kept_documents(docs).count() == 300


def test_kept_against_brute_force(spark):
    """Groups of 1 to 150 documents, each with its own share of symbols and capitals."""
    rng = random.Random(8)
    rows = []
    for lang, source, n, loud in (("en", "a", 150, 0.02), ("en", "b", 99, 0.3), ("en", None, 1, 0.9), ("de", "a", 12, 0.5), (None, "c", 40, 0.0)):
        for _ in range(n):
            share = loud if rng.random() < 0.8 else rng.random()
            words = [("# " if rng.random() < share / 2 else "") + (str.upper if rng.random() < share else str)(
                "w" * rng.randint(1, 9) + str(rng.randint(0, 999))) for _ in range(rng.randint(8, 60))]
            rows.append((" ".join(words) + "!" * rng.choice([0, 0, 1, 20]), lang, source))
    rows += [(None, "en", "a"), ("", None, "c"), rows[0], rows[0]]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string").repartition(4)
    want = brute.quality_kept(rows, quality_rules.PRIOR)
    assert {r.doc_id: r.kept for r in quality_rules.judged(docs).collect()} == dict(enumerate(want))
    assert sorted(r.doc_id for r in quality_rules.kept_documents(docs).collect()) == [i for i, k in enumerate(want) if k]
    assert 0 < sum(want) < len(rows) - 20


def test_sketches_merge(spark):
    rows = spark.range(5000).selectExpr("id % 3 as lang", "id % 7 as source", "id * id % 9973 as m")
    fine = quality_rules.sketch(rows, ["lang", "source"], ["m"])
    merged = quality_rules.merge(fine, [])
    whole = quality_rules.sketch(rows, [], ["m"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    q = quality_rules.quartiles(whole, []).first()
    exact = sorted(r.m for r in rows.collect())
    for got, want in ((q.q1, exact[1249]), (q.q3, exact[3749])):
        assert want <= got <= want * (1 + 1 / 16) + 1


def test_rules_on_an_empty_table(spark):
    empty = brute.documents(spark, ["x"]).filter("doc_id < 0")
    assert quality_rules.judged(empty).count() == 0
    assert quality_rules.kept_documents(empty).columns == empty.columns
    assert line_dedup.deduplicated(empty).count() == 0


def lines(rng, pool, n):
    return "\n".join(rng.choice(pool) for _ in range(n))


@pytest.mark.parametrize("least", [6, 50])
def test_line_runs(spark, least):
    rng = random.Random(least)
    words = lambda n: " ".join(str(rng.randint(0, 10**6)) for _ in range(n))
    pool = [words(n) for n in (1, 2, 3, 5, 9, 20, 30, 49, 50, 60)] + ["", "  "]
    texts = [lines(rng, pool, rng.randint(0, 12)) for _ in range(50)]
    texts += [None, "", pool[-3], pool[-3] + "\n" + pool[-3], "\n".join([pool[5]] * 7), texts[3], texts[3]]
    ids = [*range(len(texts) - 2), len(texts) - 3, None]
    docs = brute.documents(spark, texts, ids)
    want = brute.line_dedup(list(zip(ids, texts, strict=True)), least)
    got = line_dedup.deduplicated(docs, least).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((k[0], v) for k, v in
                  ((key, want[key]) for key in zip(ids, texts, strict=True))), key=str)
    left = line_dedup.cleaned_documents(docs, least)
    assert left.columns == docs.columns
    whole = {k: v for k, v in want.items() if v == k[1] or brute.WORD.search(v)}
    assert left.count() == sum(k in whole for k in zip(ids, texts, strict=True))
    for r in left.collect():
        assert r.n_chars == len(r.text or "")


def test_repeated_rows_count_once(spark):
    text = " ".join(map(str, range(60)))
    docs = brute.documents(spark, [text, text, text], [4, 4, 5])
    assert sorted((r.doc_id, r.n_deleted) for r in line_dedup.deduplicated(docs).collect()) == [(4, 0), (4, 0), (5, 1)]


def test_long_document(spark):
    text = "\n".join(f"line {i % 3000} of it" for i in range(6000))
    row = line_dedup.deduplicated(brute.documents(spark, [text])).first()
    assert row.n_deleted == 3000
