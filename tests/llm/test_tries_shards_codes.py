"""Prefix trie, shards and vector codes against plain Python."""

import hashlib
import math
import random
import zlib

import brute
import numpy as np
import pytest

from scriptloom.llm import pivot_codes, prefix_trie, queries, sharding


@pytest.fixture
def many_parts(spark):
    """Small tables stay in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ---- trie


def trie(conversations):
    """Node rows of {conv_id: [(role, text), ...]}."""
    at = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            at.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for k in at:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    rows = []
    for k, members in at.items():
        below = [x for x in at if x[:len(k)] == k]
        saved = sum((len(at[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ending = sorted(c for c in members if len(conversations[c]) == len(k))
        rows.append((min(members), len(k), min(at[k[:-1]]) if k else None, len(members), len(kids.get(k, [])),
                     sum(x not in kids for x in below), saved, hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuilt(rows):
    turns = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    return out


def conversations(rng, n=60):
    rows = []
    for c in range(n):
        if c in (20, 35):
            continue
        shared = [("user", f"hello {rng.randrange(2)}"), ("assistant", f"é {rng.randrange(2)}")]
        own = [(rng.choice(["user", None, ""]), rng.choice(["x", "", None, f"t{rng.randrange(3)}"])) for _ in range(rng.randrange(12))]
        for k, (role, text) in enumerate((shared + own)[rng.randrange(3):] or [("user", "a")]):
            rows.append((c, k if k or c % 2 else None, role, text))
    rows += [(c, k, "user", f"same {k}") for c in range(1000, 1040) for k in range(5)]
    rows += [(77, k, "user", "long" * (k % 3)) for k in range(400)]
    rows += [(None, 0, "user", "nobody")]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("turns", [100_000, 6])
def test_trie(spark, many_parts, turns):
    rows = conversations(random.Random(turns))
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", key int, node string").repartition(5)
    got = [tuple(r) for r in prefix_trie.rebuilt_nodes(df, prefix_trie.Params(turns)).collect()]
    assert sorted(got, key=str) == trie(rebuilt(rows))


def test_trie_of_plain_conversations(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "c"), (3, 0, "u", "c")]
    got = prefix_trie.prefix_nodes(spark.createDataFrame(rows, SCHEMA)).collect()
    want = trie({1: [("u", "a"), ("u", "b")], 2: [("u", "a")], 3: [("u", "c"), ("u", "c")]})
    assert sorted((tuple(r) for r in got), key=str) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_nodes(empty).count() == prefix_trie.rebuilt_nodes(empty).count() == 0


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(c, 0, "user", "gone")]
    got = [tuple(r) for r in prefix_trie.rebuilt_nodes(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == trie({c: []})


def test_tree_layouts_and_paths():
    rng = random.Random(1)
    for fan in (3, 4, 5, 16, 17, 48, 49, 256):
        keys = sorted({bytes([b]) + rng.randbytes(15) + (rng.randbytes(16) if b % 3 else b"") for b in rng.sample(range(256), fan)})
        root = prefix_trie.built(keys)
        kinds = {4: prefix_trie.Sorted, 16: prefix_trie.Sorted, 48: prefix_trie.Indexed, 256: prefix_trie.Direct}
        assert isinstance(root.children, kinds[next(m for m in kinds if fan <= m)])
        assert [b for b, _ in root.children] == [k[0] for k in keys]
        nodes = prefix_trie.trie_nodes(keys, [1] * fan, list(range(fan)), [[1, 1]] * fan)
        assert len(nodes) == 1 + sum(len(k) // 16 for k in keys)
        assert {n[0] for n in nodes} <= {0, 1, 2}
    assert prefix_trie.common(b"abcdef", b"xxabcxef", 2) == 3 and prefix_trie.common(b"ab", b"abc") == 2


# ---- shards


def shards(rows, n=8):
    """{(doc_id, text): set of (shard, slot)} by the law of equal bytes."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    size = lambda t: len((t or "").encode()) + 1
    total, before, places = sum(size(t) for _, t in rows), 0, []
    for _, t in rows:
        places.append(n * (2 * before + size(t)) // (2 * total))
        before += size(t)
    return [(i, t, s, places[:k].count(s)) for k, ((i, t), s) in enumerate(zip(rows, places, strict=True))]


def test_shards(spark, many_parts):
    rng = random.Random(5)
    texts = [rng.choice([None, "", "é" * rng.randrange(30), "x" * rng.randrange(200), "long " * 900]) for _ in range(150)]
    ids = rng.sample(range(10_000), 150)
    docs = brute.documents(spark, texts, ids).withColumnRenamed("words", "shard").withColumnRenamed("key", "slot")
    got = sharding.digests(docs).collect()
    want = shards(list(zip(ids, texts, strict=True)))
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), s, k) for i, t, s, k in want)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    sums = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(sums) - min(sums) <= 2 * 4501
    whole = sharding.sharded(docs).first().doc
    assert whole.asDict().keys() == set(docs.columns) and whole.shard == "w"


def test_shards_of_tied_rows_are_split(spark, many_parts):
    docs = brute.documents(spark, ["same"] * 103, [None] * 50 + [7] * 53)
    got = sharding.digests(docs, 4).collect()
    assert len(got) == 103
    assert sorted(r.shard for r in got) == sorted(s for *_, s, _ in shards([(None, "same")] * 50 + [(7, "same")] * 53, 4))
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    ordered = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert ordered == [None] * 50 + [7] * 53


def test_shard_files(spark, tmp_path):
    docs = brute.documents(spark, ["a" * k for k in range(40)])
    sums = sharding.write_shards(docs, str(tmp_path / "shards"), 3).collect()
    assert sum(r.n_rows for r in sums) == 40 and sum(r.n_bytes for r in sums) == sum(range(1, 41))
    back = spark.read.parquet(str(tmp_path / "shards")).orderBy("shard", "slot").collect()
    assert [len(r.text) for r in back] == list(range(40))
    assert sharding.digests(docs.filter("doc_id < 0")).count() == 0
    one = sharding.digests(docs.filter("doc_id = 3")).collect()
    assert [(r.shard, r.slot) for r in one] == [(4, 0)]


# ---- vector codes


def codes(rows, entries=256, rounds=4):
    """vec_id -> (code, error, label_error), and the digest of the codebooks, in plain integers."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    vectors = {i: [math.floor(1024 * float(x)) for x in v] for i, v, _ in fine}
    w = len(next(iter(vectors.values()))) // 4
    part = lambda v, q: v[q * w:(q + 1) * w]
    books = [[part(vectors[i], q) for i in sorted(vectors)[:entries]] for q in range(4)]
    near = lambda v, b: min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(b))
    for _ in range(rounds):
        for q in range(4):
            members = {}
            for v in vectors.values():
                members.setdefault(near(part(v, q), books[q])[1], []).append(part(v, q))
            books[q] = [[sum(c) // len(c) for c in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(books[q])]
    best = {i: [near(part(v, q), books[q]) for q in range(4)] for i, v in vectors.items()}
    sums = {}
    for i, _, label in fine:
        sums[label] = sums.get(label, 0) + sum(d for d, _ in best[i])
    text = ",".join(str(x) for b in books for e in b for x in e)
    return {i: ("".join(f"{k:02x}" for _, k in best[i]), sum(d for d, _ in best[i]), sums[label]) for i, _, label in fine}, hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, label, "n") for i, v, label in rows], f"vec_id bigint, embedding array<{kind}>, label int, n string").repartition(4)


@pytest.mark.parametrize("scale, kind", [(1, "float"), (0.01, "float"), (1e6, "double")])
def test_codes(spark, scale, kind):
    rng = np.random.default_rng(7)
    values = [[float(np.float32(x)) for x in rng.standard_normal(16) * scale] for _ in range(330)]
    values[40:60] = [values[3]] * 20
    rows = [(9000 - 7 * k, v, [0, 1, None][k % 3]) for k, v in enumerate(values)]
    odd = [(1, None, 0), (2, [None] + [1.0] * 15, 0), (3, [float("nan")] * 16, 1), (4, [float("inf")] * 16, 1), (5, [1.0] * 3, 1)]
    got = pivot_codes.compressed(table(spark, rows + odd, kind)).collect()
    want, sha = codes(rows)
    fits = lambda x: x if x < 2 ** 63 else None
    want = {i: (code, fits(error), fits(total)) for i, (code, error, total) in want.items()}
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want and len(got) == len(want)
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_few_vectors_and_none(spark):
    rows = [(5, [0.0, 1.0, -1.0, 0.5], None), (6, [0.0, 1.0, -1.0, 0.5], 2), (7, [9.0, 1.0, 1.0, 1.0], 2)]
    got = pivot_codes.compressed(table(spark, rows)).collect()
    want, sha = codes(rows)
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want and got[0].codebooks_sha256 == sha
    assert pivot_codes.compressed(table(spark, rows).filter("vec_id < 0")).count() == 0
    assert [r.code for r in pivot_codes.compressed(table(spark, [(1, [], 0)])).collect()] == ["00000000"]
    again = pivot_codes.compressed(table(spark, [*rows, (None, [1.0] * 4, 2), (5, [3.0] * 4, 2)])).collect()
    assert len(again) == 5


def test_pivots_prune_and_keep_ties():
    rng = np.random.default_rng(2)
    centers = rng.integers(-5000, 5000, (256, 16))
    parts = centers[rng.integers(0, 256, 2000)] + rng.integers(-60, 60, (2000, 16))
    entries = np.concatenate([centers[:200], centers[:56]])  # the last ones repeat earlier ones
    pivots = pivot_codes.far_pivots(entries, 8)
    to, of = pivot_codes.distances(parts, pivots).astype("float32"), pivot_codes.distances(entries, pivots)
    evaluated = [0]
    index, best = pivot_codes.nearest(parts, to, entries, of, evaluated=evaluated)
    exact = pivot_codes.squared(parts[:, None, :], entries[None])
    assert (index == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert evaluated[0] < 0.4 * exact.size


def test_queries_read_their_tables(spark, tmp_path):
    spark.createDataFrame([(1, 0, "u", "a")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    brute.documents(spark, ["a", None]).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, [(1, [1.0] * 8, 0)]).write.parquet(str(tmp_path / "embeddings.parquet"))
    counts = [queries.QUERIES[q](spark, str(tmp_path)).count() for q in ("op11_prefix_trie", "op12_sharding", "op13_vector_codes")]
    assert counts[1:] == [2, 1] and counts[0] >= 1
