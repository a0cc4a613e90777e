"""Encoders, packing, token store and rollups."""

import random
import zlib

import brute
import numpy as np
import pytest

from scriptloom.llm import bpe_words, packing, queries, token_rollup, token_store, unigram
from scriptloom.llm.bpe_words import WordEncoder, tokenizer_path

pytest.importorskip("public_tokenizers")
ODD = [None, "", " ", "a\x1cb c", "it's don't 'tis", "İstanbul ΣΑΣ é", "<|endoftext|> x<|startoftext|>y", "中文 字符　好", "ª µm² 1½",
       "a­b \x00 \x7f", "a" * 5000, "!!! ###$$$ a,b.c-d_e", "x\u0085y z", "😀 😀a", '" quote "', "word " * 3000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_encode_like_whole_texts(library):
    rng = random.Random(2)
    signs = list("abzAZ09'.,!<|>\t\n \x0b\x1c\x1f\xa0éÉßµª½²́̈İſΣς中😀　​\xad\x85\x00")
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    enc = WordEncoder(tokenizer_path("word_bpe_49k.json"))
    for at in range(0, len(texts), 50):
        for text, raw in zip(texts[at:at + 50], enc.packed(texts[at:at + 50]), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text), repr(text)


def test_remembered_words_stay_few(library, monkeypatch):
    """Frequent words outlive a full dictionary; what is remembered is bounded by two generations and a batch."""
    monkeypatch.setattr(bpe_words, "WORDS", 100)
    monkeypatch.setattr(bpe_words, "KEPT_RUNS", 80)
    enc, sought = WordEncoder(tokenizer_path("word_bpe_49k.json")), []
    plain = enc._words
    monkeypatch.setattr(enc, "_words", lambda words: (sought.extend(words), plain(words))[1])
    for k in range(60):
        text = " ".join(["Often,", "中文", *[f"w{'abcdefghij'[i % 10]}{k}x{i}" for i in range(20)]])
        assert enc.ids(text).tolist() == ids_of(library, text)
        assert len(enc.words) + len(enc.old_words) <= 2 * 100 + 2 * 22
        assert len(enc.runs) + len(enc.old_runs) <= 2 * 80 + 2 * 100
    assert len(sought) > 1000 and sought.count("Often,") == sought.count("中文") == 1


def test_pieces_take_few_texts_at_a_time(spark, monkeypatch):
    """Arrow batches become Python strings in small parts; rows are numbered across them."""
    docs = brute.documents(spark, [f"word {i}" if i % 7 else None for i in range(1000)], [*range(999), None]).coalesce(1)
    rows = packing.pieces(docs)
    assert "MapInArrow" in rows._jdf.queryExecution().executedPlan().toString()
    found = rows.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == [*range(999)] and [r._row for r in found] == [*range(1000)]


def test_store_round_trip(spark, library):
    texts = ODD + ["same"] * 20
    ids = [*range(len(ODD)), *[7] * 10, *[None] * 10]
    docs = brute.documents(spark, texts, ids).repartition(4)
    rows = token_store.read_back(docs).orderBy("shard", "record").collect()
    want = sorted((((i is not None, i or 0), crc(ids_of(library, t) + [1])) for i, t in zip(ids, texts, strict=True)))
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids_crc32) for r in rows) == want
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [k for k, _ in want]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()


def test_lookup_of_some_keys(spark):
    docs = brute.documents(spark, ["a b", "c", "d e f"], [10, 11, 12])
    store = token_store.write_store(docs)
    asked = spark.createDataFrame([(11,), (99,), (None,)], "doc_id bigint")
    assert [r.doc_id for r in store.records(asked).collect()] == [11]
    assert token_store.write_store(docs.filter("doc_id < 0")).records(asked).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-2**62, 2**62, 5000))
    raw = token_store.index_bytes(keys, *(np.arange(len(keys)) % m for m in (50, 1000, 3)))
    table, _ = token_store.PerfectHash.from_bytes(raw)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    found, rows = token_store.look_up(raw, keys)
    assert found.all() and (rows["record"] == np.arange(len(keys)) % 1000).all()
    assert not token_store.look_up(raw, keys + 1)[0][~np.isin(keys + 1, keys)].any()


def test_best_fit_is_the_tightest():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 64) for _ in range(500)), reverse=True)
    bins, want = [], []
    for n in lengths:
        fits = [k for k, room in enumerate(bins) if room >= n]
        k = min(fits, key=lambda i: bins[i]) if fits else len(bins)
        bins[k:] = bins[k:] or [64]
        want.append(64 - bins[k])
        bins[k] -= n
    sequences, offsets = packing.best_fit(lengths, 64)
    assert offsets == want and max(sequences) + 1 == len(bins)


def test_packing(spark, library):
    texts = ODD + ["x y z"] * 5
    rows = packing.packed(brute.documents(spark, texts, [*range(len(ODD)), *[3] * 5])).collect()
    for i, text in enumerate(ODD):
        ids = ids_of(library, text) + [0]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        want = [(k, at, len(ids[at:at + 2048]), crc(ids[at:at + 2048])) for k, at in enumerate(range(0, len(ids), 2048))]
        assert set(want) <= set(got)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 1
    assert packing.packed(brute.documents(spark, ["x"]).filter("doc_id < 0")).count() == 0


def test_sequences_hold_the_ids(spark, library):
    out = packing.sequences(brute.documents(spark, ["a b c", "d " * 3000, None])).collect()
    assert sorted(len(r.ids) for r in out)[-1] == 2048
    assert sum(len(r.ids) for r in out) == 4 + 3001 + 1


def test_rollup(spark, library, tmp_path):
    texts = ODD + ["b c"]
    docs = brute.documents(spark, texts)
    want = {}
    for r in docs.collect():
        n = len(ids_of(library, r.text))
        if n:
            d, t = want.get((r.source, r.lang), (0, 0))
            want[(r.source, r.lang)] = (d + 1, t + n)
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in token_rollup.rolled_up(docs).collect()}
    assert got == want
    assert token_rollup.rolled_up(docs.filter("doc_id < 0")).count() == 0


def test_rollup_query_counts_every_document(spark, library, tmp_path):
    rows = [(0, None, "a", "en"), (1, "", "a", "en"), (2, "b c", "a", "en"), (3, " ", "only empty", None), (4, None, "only empty", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for _, text, source, lang in rows:
        d, t = want.get((source, lang), (0, 0))
        want[(source, lang)] = (d + 1, t + len(ids_of(library, text)))
    got = queries.op3_token_counts(spark, str(tmp_path)).collect()
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in got} == want and len(got) == len(want)


def test_batches_commit_once(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([("a", "en", 3, 5), ("a", "en", 4, 6), (None, None, None, 1)], "source string, lang string, x bigint, y bigint")
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_rollup.inserts(rows, "v1", "x"))
    assert not rollup.commit("one", token_rollup.inserts(rows, "v1", "x"))
    assert rollup.commit("two", token_rollup.revisions(rows.limit(2), ("v1", "x"), ("v2", "y")))
    # a batch whose job broke off is written anew
    (tmp_path / "rollup/batches/three").mkdir()
    assert rollup.commit("three", token_rollup.deletes(rows.filter("x is null"), "v1", "x"))
    want = [("a", "en", "v2", 2, 11)]
    assert [tuple(r) for r in rollup.totals().collect()] == want
    rollup.compact()
    assert not rollup.commit("two", token_rollup.inserts(rows, "v1", "x"))
    assert [tuple(r) for r in rollup.totals().collect()] == want
    assert rollup.commit("four", token_rollup.inserts(rows.limit(1), "v2", "y"))
    assert [r.n_docs for r in rollup.totals().collect()] == [3]


@pytest.fixture(scope="module")
def pieces():
    return unigram.Encoder(unigram.model_path())


def test_best_sum(pieces):
    def most(text):
        best = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - pieces.longest), end):
                s = pieces.score.get(text[start:end], pieces.missing if end - start == 1 else -np.inf)
                best[end] = max(best[end], best[start] + s)
        return best[-1]

    for text in ["the quick brown fox", "  two  spaces ", "中文😀x", "a\nb\tc", "naïve co-op $$$", "\x00"]:
        whole = pieces.normal(text)
        spans = pieces.trace(whole, len(whole), [0.0], 0)
        assert "".join(whole[a:b] for a, b in spans) == whole
        assert sum(pieces.score.get(whole[a:b], pieces.missing) for a, b in spans) == most(whole)
        assert pieces.encode(text) == unigram.packed(pieces.ids_of(whole, spans))
        assert pieces.decode(pieces.encode(text)) == text


@pytest.mark.parametrize("chunk", [5, 40])
def test_chunks_change_no_id(spark, pieces, chunk):
    texts = [t for t in ODD if len(t or "") < 300] + ["Erreon$$$ thorea$$$ thhaer$$$  x " * 5, "the same words again " * 9]
    rows = unigram.encoded(brute.documents(spark, texts), p=unigram.Params(chunk=chunk)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == np.frombuffer(pieces.encode(texts[r.doc_id]), "<u4").tolist()
        assert r.round_trip and r.n_ids == len(r.ids) and r.ids_crc32 == crc(r.ids)
    back = unigram.decoded(spark.createDataFrame([(r.doc_id, r.ids) for r in rows], "doc_id bigint, ids array<int>"))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_encoding_an_empty_table(spark):
    assert unigram.encoded(brute.documents(spark, ["x"]).filter("doc_id < 0")).count() == 0
