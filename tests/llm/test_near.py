"""Near-duplicate documents and vectors against brute force."""

import random

import brute
import numpy as np
import pytest

from scriptloom.llm import graph, nn_descent, setsketch


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    want = {}
    ids = sorted({x for p in pairs for x in p})
    tops, _ = brute.grouped(len(ids), lambda i, j: (ids[i], ids[j]) in pairs or (ids[j], ids[i]) in pairs)
    want = {ids[i]: ids[t] for i, t in enumerate(tops) if any(ids[i] in p and p[0] != p[1] for p in pairs)}
    got = graph.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.id: r.component for r in got.collect()} == want


def variants(rng, n, edits, words=60):
    base = [str(rng.randint(0, 10**6)) for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = str(rng.randint(0, 10**6))
        yield " ".join(copy)


@pytest.mark.parametrize("block", [128, 4])
def test_near_documents(spark, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rng = random.Random(9)
    texts = [None, "", " ", "a", "A", "a b c", "A B C", "a b c d", "Ä b c d", "ä b c d", "a\nb\tc d"]
    texts += [*variants(rng, 60, 5), *variants(rng, 12, 1, 200), *variants(rng, 5, 0)]
    texts += [" ".join(str(rng.randint(0, 10**6)) for _ in range(50)) for _ in range(20)]
    ids = [*rng.sample(range(1000), len(texts) - 1), None]
    rows = setsketch.near_duplicates(brute.documents(spark, texts, ids)).collect()
    sets = [brute.shingles(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: 10**9 if ids[i] is None else ids[i])
    tops, _ = brute.grouped(len(texts), lambda i, j: brute.near(sets[order[i]], sets[order[j]]))
    want = {ids[order[k]]: (len(sets[order[k]]), ids[order[t]]) for k, t in enumerate(tops)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)


def test_kept_documents_keep_their_columns(spark):
    docs = brute.documents(spark, ["a b c d e", "a b c d e", None, "x"], [3, 2, 1, 2])
    kept = setsketch.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(2, "a b c d e"), (2, "x")]
    assert kept.count() == 3
    assert setsketch.near_duplicates(docs.filter("doc_id < 0")).count() == 0


def test_sketches_merge_and_estimate():
    p = setsketch.Params()
    rng = np.random.default_rng(3)
    for share in (0.3, 0.8, 0.95):
        n = 2000
        common = int(n * 2 * share / (1 + share))
        all_ = rng.integers(0, 2**63, 2 * n - common, dtype="uint64")
        one, other = np.unique(all_[:n]), np.unique(all_[n - common:])
        a, b = setsketch.sketch(one, p), setsketch.sketch(other, p)
        assert (setsketch.merged(a, b) == setsketch.sketch(np.union1d(one, other), p)).all()
        guess = setsketch.likeliest(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([float(len(one))]), np.array([float(len(other))]), p)[0]
        assert abs(guess - share) < 0.15


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows],
                                 "vec_id bigint, embedding array<float>, label int, node string").repartition(4)


@pytest.mark.parametrize("k", [3, 10])
def test_near_vectors(spark, k):
    rng = np.random.default_rng(k)
    points = [rng.standard_normal(16) for _ in range(150)]
    for spread, n in ((0.02, 30), (0.12, 40), (0.3, 20)):
        center = rng.standard_normal(16)
        points += [center + spread * rng.standard_normal(16) * np.linalg.norm(center) / 4 for _ in range(n)]
    points += [points[0]] * 5 + [points[0] * 2]
    rows = [(1000 - i, np.float32(v)) for i, v in enumerate(points)]
    odd = [(2001, None), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] * 16), (2005, []), (2006, [float("inf")] + [1.0] * 15)]
    got = {r.vec_id: r for r in nn_descent.linked(vectors(spark, rows + odd), nn_descent.Params(k=k, block=16)).collect()}
    assert len(got) == len(rows) + len(odd)
    rows.sort(key=lambda r: r[0])
    u = np.array([np.asarray(v, "f8") / np.linalg.norm(np.asarray(v, "f8")) for _, v in rows])
    link = u @ u.T >= 0.9
    tops, degree = brute.grouped(len(rows), lambda i, j: link[i, j])
    right = sum(got[i].n_links == degree[n] for n, (i, _) in enumerate(rows))
    assert right >= 0.97 * len(rows)
    assert sum(got[i].component_id == rows[tops[n]][0] for n, (i, _) in enumerate(rows)) >= 0.97 * len(rows)
    for n, (i, _) in enumerate(rows):
        assert got[i].n_links <= degree[n]
    for i, _ in odd:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_vectors_of_an_empty_table(spark):
    assert nn_descent.linked(vectors(spark, [(1, [1.0])]).filter("vec_id < 0")).count() == 0
    assert nn_descent.linked(vectors(spark, [(1, [1.0])])).first().n_links == 0


def test_huge_and_tiny_vectors_and_a_hub(spark):
    """Lengths whose squares leave the doubles; one node that all others name."""
    rows = [(0, [3e200, 4e200]), (1, [3e-200, 4e-200]), (2, [3.0, 4.0]), (3, [-3e200, 4e200]), (4, [1e-320, 1e200])]
    got = nn_descent.linked(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3), 4: (0, 4)}
    named = spark.range(5000).selectExpr("0L as a", "id + 1 as b", "cast(id % 977 as double) as sim")
    top = nn_descent.lists(named.unionAll(named), 10).collect()
    assert sorted((r.sim, r.b) for r in top) == sorted(((i % 977) * 1.0, i + 1) for i in range(5000))[-10:]


def clouds(rng, centers, n, spread, dim):
    """n distinct vectors about each centre."""
    return [np.float32(c + spread * rng.standard_normal(dim) / dim ** 0.5) for c in centers for _ in range(n)]


def against_brute_force(got, points):
    u = np.array([np.asarray(v, "f8") / np.linalg.norm(np.asarray(v, "f8")) for v in points])
    link = u @ u.T >= 0.9
    tops, degree = brute.grouped(len(points), lambda i, j: link[i, j])
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (degree[i], tops[i]) for i in range(len(points))}
    return degree


@pytest.mark.parametrize("across", [0.93, 0.89])
def test_tight_clouds_near_each_other(spark, across):
    rng = np.random.default_rng(5)
    e = np.eye(32)
    points = clouds(rng, [e[0], across * e[0] + (1 - across ** 2) ** 0.5 * e[1], e[2]], 50, 0.05, 32)
    degree = against_brute_force(nn_descent.linked(vectors(spark, list(enumerate(points)))).collect(), points)
    assert degree[100] == 49 and (across < 0.9 or degree[0] == 99)


def test_audit_is_not_blinded_by_a_large_cloud(spark):
    """A third of all nodes in one cloud, and pairs elsewhere whose links were not found."""
    rng = np.random.default_rng(6)
    cloud = clouds(rng, [np.eye(32)[0]], 60, 0.05, 32)
    pairs = [v for _ in range(60) for v in clouds(rng, [rng.standard_normal(32)], 2, 0.05, 32)]
    nodes = nn_descent.nodes_of(vectors(spark, list(enumerate(cloud + pairs))), "<f4")
    p = nn_descent.Params()
    ids = {r.least_id: r.node for r in nodes.collect()}
    rows = [(ids[i], 59 if i < 60 else 0, i < 60) for i in range(180)]
    found = spark.createDataFrame(rows, "node bigint, links bigint, full boolean")
    assert nn_descent.audited(found, nodes, "<f4", p) == 0.0
    found = spark.createDataFrame([(n, 10 if full else 1, full) for n, _, full in rows], "node bigint, links bigint, full boolean")
    assert abs(nn_descent.audited(found, nodes, "<f4", p) - 10 / 59) < 1e-9


@pytest.mark.parametrize("starts", [1, 0])
def test_vectors_in_a_cone_are_all_found(spark, monkeypatch, starts):
    """Pairs in a narrow cone; a search whose recall is not reached ends in the exact comparison."""
    rng = np.random.default_rng(8)
    cone = 3 * np.eye(32)[0]
    points = [v for _ in range(150) for v in clouds(rng, [cone + rng.standard_normal(32) * 0.4], 2, 0.3, 32)]
    points += clouds(rng, [np.eye(32)[5]], 20, 0.05, 32)
    if not starts:
        monkeypatch.setattr(nn_descent, "audited", lambda *a: 0.0)
    p = nn_descent.Params(block=16, fill=8, tables=1, rounds=0, starts=1)
    against_brute_force(nn_descent.linked(vectors(spark, list(enumerate(points))), p).collect(), points)


def test_one_row_of_each_group_is_kept(spark):
    """Null ids, repeated rows and near copies under one doc_id; rows without words all stay."""
    base = [str(i) for i in range(60)]
    near = " ".join([*base[:-1], "x"])
    text = " ".join(base)
    texts = ["n a b c d", "n a b c d", "n a b c d", text, text, near, near, "q r s t u", "q r s t u", None, " ", " "]
    ids = [None, None, None, 7, 7, 7, 9, 4, None, None, 3, 3]
    kept = setsketch.kept_documents(brute.documents(spark, texts, ids)).collect()
    words = [(r.doc_id, r.text) for r in kept if (r.text or "").strip()]
    assert sorted((i is None, i or 0, t[:1]) for i, t in words) == [(False, 4, "q"), (False, 7, "0"), (True, 0, "n")]
    assert len(kept) == 6
