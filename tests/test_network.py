"""Components, shortest paths, skewed lookups and the grounding audit against plain Python."""

import random
import re
from collections import deque

import pytest

from scriptloom.operators import aliases as al
from scriptloom.operators import grounding as gr
from scriptloom.operators import network as net
from scriptloom.operators import skew
from scriptloom.session import written

CHUNK = "container_id string, stage_idx bigint, body string"


def neighbours(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return near


def smallest_reachable(edges):
    near, out = neighbours(edges), {}
    for start in sorted(near):
        if start in out:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


@pytest.mark.parametrize("least", [3, 10_000])
def test_components(spark, least):
    rng = random.Random(least)
    edges = [(f"n{rng.randrange(70):02d}", f"n{rng.randrange(70):02d}") for _ in range(45)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(90)] + [("hub", f"leaf{i}") for i in range(40)] + [("x", "x")]
    got = net.components(written(spark.createDataFrame(edges, "a string, b string"), "edges"), least)
    assert {r.node: r.component for r in got.collect()} == smallest_reachable(edges)
    assert net.component_of(got, "c050").count() == 91
    assert {r.component: r.n_nodes for r in net.component_sizes(got).collect()}["hub"] == 41


def test_large_star_and_no_edges(spark):
    leaves = spark.range(100_000).selectExpr("'hub' as a", "concat('leaf', id) as b")
    chain = spark.range(300).selectExpr("concat('k', lpad(id, 4, '0')) as a", "concat('k', lpad(id + 1, 4, '0')) as b")
    got = net.components(written(leaves.unionByName(chain), "edges"))
    assert {r.component: r.n_nodes for r in net.component_sizes(got).collect()} == {"hub": 100_001, "k0000": 301}
    assert net.components(written(leaves.limit(0), "edges")).count() == 0


def shortest(edges, source, target, most):
    """The shortest path with the smallest nodes, or None."""
    near = neighbours([(a, b) for a, b, _ in edges])
    far = {target: 0}
    todo = deque([target])
    while todo:
        x = todo.popleft()
        for y in near.get(x, ()):
            if y not in far:
                far[y] = far[x] + 1
                todo.append(y)
    if source not in far or not 0 < far[source] <= most:
        return None
    path, x = [], source
    while x != target:
        x = min(y for y in near[x] if far.get(y) == far[x] - 1)
        path.append(x)
    return path


@pytest.mark.parametrize("least", [4, 10_000])
@pytest.mark.parametrize("most", [6, 3])
def test_paths(spark, least, most):
    rng = random.Random(most)
    edges = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}", rng.choice("xyz")) for _ in range(75)]
    edges += [("hub", f"n{i:02d}", "h") for i in range(0, 12)] + [(f"c{i}", f"c{i + 1}", "c") for i in range(8)]
    edges = [e for e in edges if e[0] != e[1]]
    pairs = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(40)] + [("c0", "c5"), ("c0", "c8"), ("c0", "n01"), ("n01", "nowhere")]
    rows = net.paths(written(spark.createDataFrame(edges, "a string, b string, type string"), "edges"),
                     spark.createDataFrame(pairs, "source string, target string"), most, least).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.hop):
        got.setdefault((r.source, r.target), []).append(r.via)
        prior = ([r.source] + got[(r.source, r.target)])[r.hop - 1]
        assert r.type == min(t for a, b, t in edges if {a, b} == {prior, r.via})
    want = {p: path for p in set(pairs) if (path := shortest(edges, *p, most))}
    assert got == want and any(len(x) == most for x in want.values())


def test_heavy_keys_are_dealt(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), ("none", 2)], "k string, v bigint")
    table = spark.createDataFrame([("hot", 7), ("cold", 8), ("other", 9)], "k string, w bigint")
    heavy = {r.k: r._parts for r in skew.heavy_keys(rows, "k", 50).collect()}
    assert heavy == {"hot": 10}
    got = skew.lookup(rows, table, "k", ["v"], least=50)
    assert sorted((r.k, r.w) for r in got.collect()) == sorted([("hot", 7)] * 500 + [("cold", 8)])
    assert skew.lookup(rows, table, "k", ["v"], "left", 50).filter("w is null").count() == 1


def test_grounding_against_brute_force(spark):
    ents = spark.createDataFrame([("e1", "林澈", "Lin Che"), ("e2", "暮", "Mu"), ("e3", "暮", "Dusk")], "entity_id string, name string, appellation string")
    curated = spark.createDataFrame([("林澈", "林澈澈", 0), ("林澈", "Lin", 1)], "canonical string, alias string, ord bigint")
    rng = random.Random(4)
    pieces = ["林澈", "澈", "Lin Che", "Lin", "Linx", "暮", "Mu", "\n", " ", "abc", "林"]
    data = [(f"c{i % 3}", i, "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))) for i in range(30)] + [("c0", 99, None)]
    chunks = spark.createDataFrame(data, CHUNK)
    names = [("c0", None, "林澈"), ("c1", None, "暮"), ("c2", None, "河伯"), ("c0", 3, "Lin"), ("c1", 4, "Lin Che"), ("c2", 5, "Mu"), ("c0", 99, "林澈"), ("c9", None, "林澈")]
    ndf = spark.createDataFrame(names, "container_id string, stage_idx bigint, name string")
    owners = al.owners(ents, curated)
    forms = gr.name_forms(ndf, owners, al.index(owners))
    rows = gr.audit(ndf, forms, chunks)
    got = {(r.container_id, r.stage_idx, r.name): r for r in rows.collect()}
    own = {"林澈": ["林澈", "Lin Che", "林澈澈", "Lin"], "暮": ["暮"], "河伯": ["河伯"], "Mu": ["Mu", "暮"]}
    own["Lin"] = own["Lin Che"] = own["林澈"]

    def found(body, form):
        if form.isascii():
            return [m.span() for m in re.finditer(f"(?<![A-Za-z0-9]){re.escape(form)}(?![A-Za-z0-9])", body)]
        out, at = [], body.find(form)
        while at >= 0:
            out.append((at, at + len(form)))
            at = body.find(form, at + len(form))
        return out

    for c, s, name in names:
        mentions, places, n_chunks, first = 0, 0, 0, None
        for container, stage, body in sorted(data, key=lambda d: d[1]):
            if container != c or s not in (None, stage):
                continue
            spans = sorted(x for f in own[name] for x in found(body or "", f))
            if spans:
                n_chunks, mentions, first = n_chunks + 1, mentions + len(spans), first or (stage, *spans[0])
                upto = -1
                for a, b in spans:
                    places += a >= upto
                    upto = max(upto, b)
        r = got[(c, s, name)]
        assert (r.status, r.n_chunks, r.n_mentions, r.n_places) == ("OK" if mentions else "MISS", n_chunks, mentions, places)
        assert first is None or (r.first_stage, r.first_start, r.first_end) == first
    assert {r.name for r in gr.missing(rows).collect()} >= {"河伯"}
    texts = {(c, s): b for c, s, b in data}
    for r in gr.cited(rows, chunks).collect():
        body = texts[(r.container_id, r.first_stage)]
        assert r.line_no == body[:r.first_start].count("\n") + 1
        assert r.snippet == body.split("\n")[r.line_no - 1][:len(r.snippet)]


def test_entities_that_a_summary_lacks(spark):
    edges = spark.createDataFrame([("e1", "c", 0, "named"), ("e1", "c", 1, "speaker"), ("e2", "c", 0, "mentioned"), ("e3", "c", 0, "named"), ("e4", "d", None, "named")],
                                  "entity_id string, container_id string, stage_idx bigint, tier string")
    names = spark.createDataFrame([("c", 0, "三")], "container_id string, stage_idx bigint, name string")
    index = spark.createDataFrame([("三", 1, "e3")], "alias string, n_ids bigint, sole_id string")
    assert [tuple(r) for r in gr.coverage(edges, names, index).collect()] == [("c", "e1", 2)]


def test_only_mentions_inside_a_names_sources_are_written(spark, monkeypatch):
    chunks = spark.createDataFrame([("c0", 0, "Lin and Mu, 暮暮暮"), ("c1", 1, "Lin Mu 暮"), ("far", 2, "Lin Mu 暮 " * 50), ("c0", 3, None)], CHUNK)
    names = spark.createDataFrame([("c0", None, "Lin"), ("c0", 0, "暮"), ("c1", None, "Mu"), (None, None, "Lin")],
                                  "container_id string, stage_idx bigint, name string")
    owners = spark.createDataFrame([], "alias string, entity_id string")
    kept = []

    def seen(df, name):
        table = written(df, name)
        if name == "places":
            kept.extend((r.container_id, r.alias) for r in table.collect())
        return table

    monkeypatch.setattr("scriptloom.operators.participants.written", seen)
    rows = gr.audit(names, gr.name_forms(names, owners, al.index(owners)), chunks)
    got = {(r.container_id, r.stage_idx, r.name): r.n_mentions for r in rows.collect()}
    assert got == {("c0", None, "Lin"): 1, ("c0", 0, "暮"): 3, ("c1", None, "Mu"): 1, (None, None, "Lin"): 0}
    assert sorted(kept) == sorted([("c0", "Lin"), *[("c0", "暮")] * 3, ("c1", "Mu")])
