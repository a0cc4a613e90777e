import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import pyarrow
import pytest
from pyspark.sql import functions as F

from scriptloom.operators import aliases as al
from scriptloom.operators import candidates as ca
from scriptloom.operators import cards as cd
from scriptloom.operators import chunks as ch
from scriptloom.operators import cooccurrence as co
from scriptloom.operators import edges as ed
from scriptloom.operators import entities as en
from scriptloom.operators import incremental as inc
from scriptloom.operators import pages as pg
from scriptloom.operators import participants as pa
from scriptloom.operators import relations as rel
from scriptloom.operators import search as se
from scriptloom.operators import stats as st

CHUNK = "container_id string, stage_idx bigint, body string"
ENTITY = "entity_id string, name string, appellation string"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_positions_match_a_plain_sort_even_with_one_hot_container(spark):
    data = [("hot" if i % 3 else f"c{i % 7}", i * 17 % 5003) for i in range(3000)]
    got = rows(ch.positions(spark.createDataFrame(data, "c string, o bigint"), "c", "o", width=64), "c", "o", "stage_idx")
    want = sorted((c, o, p) for c in {d[0] for d in data} for p, o in enumerate(sorted(x for k, x in data if k == c)))
    assert got == want


def alias_table(spark, names, curated=()):
    ents = spark.createDataFrame(names, ENTITY)
    cur = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(curated)], "canonical string, alias string, ord bigint")
    return al.match_aliases(ents, cur)


def test_participant_tiers(spark):
    names = [("e1", "阿米娅", "Amiya"), ("e2", "年", None), ("e3", "W", "W"), ("e4", "博士", None)]
    al_df = alias_table(spark, names, [("阿米娅", "小驴")])
    bodies = [("阿米娅:你好"), ("见到阿米娅。"), ("今年好"), ("年和年"), ("World"), ("找W。"), ("小驴来了"), ("小驴和小驴"), ("博士好")]
    chunks = spark.createDataFrame([("c", i, b) for i, b in enumerate(bodies)], CHUNK)
    got = {(r[0], r[1]): r[2] for r in pa.participants(chunks, al_df).select("entity_id", "stage_idx", "tier").collect()}
    assert got == {("e1", 0): "speaker", ("e1", 1): "named", ("e2", 2): "mentioned", ("e2", 3): "named", ("e3", 5): "named",
                   ("e1", 6): "mentioned", ("e1", 7): "named"}
    lifted = pa.participants(chunks, al_df, None, spark.createDataFrame([("c", "e2")], "container_id string, entity_id string"))
    assert lifted.filter("entity_id = 'e2' and stage_idx = 2").first()["tier"] == "named"
    explicit = spark.createDataFrame([("e1", "c", 1)], "entity_id string, container_id string, stage_idx bigint")
    left = pa.participants(chunks, al_df, explicit).filter("entity_id = 'e1'")
    assert sorted(r[0] for r in left.select("stage_idx").collect()) == [0, 6, 7]


def expected_count(body, alias):
    if all(ord(c) < 128 for c in alias):
        return len(re.findall(f"(?<![A-Za-z0-9]){re.escape(alias)}(?![A-Za-z0-9])", body))
    return body.count(alias)


def brute_spans(body, alias):
    if all(ord(c) < 128 for c in alias):
        return [m.start() for m in re.finditer(f"(?<![A-Za-z0-9]){re.escape(alias)}(?![A-Za-z0-9])", body)]
    out, at = [], body.find(alias)
    while at >= 0:
        out.append(at)
        at = body.find(alias, at + len(alias))
    return out


@pytest.mark.parametrize("case", ["short", "shuffled", "long", "overlapping"])
def test_matcher_against_brute_force(spark, monkeypatch, case):
    """Random texts over a tiny alphabet: boundaries, punctuation, overlaps, text ends, pages, aliases longer than a page."""
    if case == "shuffled":  # the way of a dictionary too large to broadcast
        monkeypatch.setattr(pa, "BROADCAST_BYTES", -1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(case)
    letters = "ab1é年哈-. " if case != "overlapping" else "年哈-a"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    aliases = {t for t in (text(rng.randint(1, 4)).strip() for _ in range(160)) if t}
    bodies = [text(rng.randint(0, 60)) for _ in range(100)] + [text(rng.randint(100, 900)) for _ in range(20)] + [None, "", "年" * 500]
    if case == "long":
        for size in (15, 29, 30, 31, 32, 60, 200, 300):
            aliases |= {text(size).strip() for _ in range(6)} | {"a" * size, "é" * size, "a-" * (size // 2), "x" * (size - 1) + "年"}
        for a in sorted(aliases, key=len)[-40:]:
            bodies += [a, f"{text(120)}{a}", f"{a}b{a}-{a}", f"{text(7)} {a} {a}{a}" * 3, a[:-1], f"b{a}"]
    if case == "overlapping":
        aliases |= {t for t in ("".join(rng.choice("年哈") for _ in range(rng.randint(2, 9))) for _ in range(900)) if t[0] == t[-1]}
        bodies += ["".join(rng.choice("年哈") for _ in range(400)) for _ in range(20)]
        assert sum(len(a) > 1 and a[0] == a[-1] for a in aliases) >= 200
    aliases = sorted(aliases)
    adf = spark.createDataFrame([("e", a, "canonical", "ascii") for a in aliases], "entity_id string, alias string, match_class string, mode string")
    cdf = spark.createDataFrame([("c", i, b) for i, b in enumerate(bodies)], CHUNK).repartition(4)
    got = {(r.stage_idx, r.alias): r.n for r in pa.mention_counts(cdf, adf).collect()}
    want = {(i, a): n for i, b in enumerate(bodies) for a in aliases if (n := expected_count(b or "", a))}
    places = sorted((r.stage_idx, r.alias, r.start) for r in pa.spans(cdf, adf).collect())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want
    assert places == sorted((i, a, at) for i, b in enumerate(bodies) for a in aliases for at in brute_spans(b or "", a))


def test_aliases_are_sought_in_distinct_words(spark, monkeypatch):
    """Texts of few different words: what is searched is these words, long ones and texts for aliases with blanks."""
    searched, plain = [], pa.found
    monkeypatch.setattr(pa, "found", lambda chunks, words, *rest, **named: (searched.append(chunks), plain(chunks, words, *rest, **named))[1])
    aliases = ["Lin", "é年", "年年", "ab cd", "x." * 3, "z" * 40]
    long_word = "年" * 71 + "é年"
    bodies = ["Lin: Lin,Lin 年年年 xé年é年\nab cd x.x.x.x. Lins", f"{'z' * 40} ab cd\tab {long_word}\n{long_word}", "Lin 年年 " * 300, "a", None, ""]
    adf = spark.createDataFrame([("e", a, "canonical", "ascii") for a in aliases], "entity_id string, alias string, match_class string, mode string")
    chunks = spark.createDataFrame([("c", i, b) for i, b in enumerate(bodies)], CHUNK)
    got = {(r.stage_idx, r.alias): (r.spoke, r.n) for r in pa.alias_hits(chunks, adf).collect()}
    want = {(i, a): (int(i == 0 and a == "Lin"), expected_count(b or "", a)) for i, b in enumerate(bodies) for a in aliases}
    assert got == {k: v for k, v in want.items() if any(v)}
    assert searched[0].count() == len({w for b in bodies for w in re.split("[ \n]", b or "") if 0 < len(w) < 65})
    # a text that comes twice counts twice, but once for aliases that may overlap themselves
    twice = {(r.stage_idx, r.alias): r.n for r in pa.alias_hits(chunks.unionAll(chunks), adf.filter("alias in ('Lin', '年年')")).collect()}
    assert twice == {(0, "Lin"): 6, (0, "年年"): 1, (1, "年年"): 70, (2, "Lin"): 600, (2, "年年"): 300}


def test_sorted_aliases_of_an_edge(spark):
    """As bits for up to 64 aliases of an entity, as a set for more."""
    for n in (3, 64, 65):
        names = [f"n{k}" for k in range(n)]
        adf = spark.createDataFrame([("e", a, "canonical", "ascii") for a in names], "entity_id string, alias string, match_class string, mode string")
        cdf = spark.createDataFrame([("c", 0, " ".join(reversed(names))), ("c", 1, f"n2 n{n - 1} n2"), ("c", 2, "n")], CHUNK)
        got = {r.stage_idx: (r.matched_aliases, r.mention_count) for r in pa.participants(cdf, adf).collect()}
        assert got == {0: (sorted(names), n), 1: (sorted({"n2", f"n{n - 1}"}), 3)}


def test_alias_policies(spark):
    ents = spark.createDataFrame([("e1", "暮", "Mu"), ("e2", "暮", "Mu2"), ("e3", "林澈", "Lin")], ENTITY)
    cur = spark.createDataFrame([("暮", "沉渊", 0), ("林澈", "小林", 1), ("林澈", "L", 2)], "canonical string, alias string, ord bigint")
    assert rows(al.ambiguous_names(ents), "name", "n_ids") == [("暮", 2)]
    owners = al.owners(ents, cur)
    assert ("沉渊", "e1") in rows(owners, "alias", "entity_id") and ("沉渊", "e2") in rows(owners, "alias", "entity_id")
    matched = rows(al.match_aliases(ents, cur), "entity_id", "alias", "match_class")
    assert ("e1", "暮", "canonical_short") in matched and ("e3", "小林", "curated") in matched
    assert not [m for m in matched if m[1] in ("沉渊", "L")]
    names = spark.createDataFrame([("暮",), ("林澈",), ("谁",)], "name string")
    got = rows(al.resolve(names, al.index(owners)), "name", "status", "n_candidates")
    assert got == sorted([("暮", "ambiguous", 2), ("林澈", "resolved", 1), ("谁", "missing", 0)])
    assert rows(al.candidates(al.resolve(names, al.index(owners)), owners), "name", "entity_id") == [("暮", "e1"), ("暮", "e2")]


def test_links(spark):
    links = spark.createDataFrame([("a", "k1"), ("b", "k2"), ("c", "k3")], "entity_id string, link_key string")
    index = spark.createDataFrame([("k1", "x", 0), ("k2", "x", 1), ("k2", "y", 0)], "link_key string, container_id string, stage_idx bigint")
    r = ch.resolve_links(links, index)
    assert [tuple(x) for x in r.select("entity_id", "status", "container_id", "stage_idx").orderBy("entity_id").collect()] == [
        ("a", "linked", "x", 0), ("b", "ambiguous", None, None), ("c", "missing", None, None)]
    assert rows(ch.link_candidates(r, index), "link_key", "container_id") == [("k2", "x"), ("k2", "y")]


def test_summary_edges(spark):
    names = lambda d: spark.createDataFrame(d, "container_id string, stage_idx bigint, ord bigint, name string")
    idx = spark.createDataFrame([("甲", 1, "e1"), ("乙", 1, "e2"), ("丙", 2, None)], "alias string, n_ids bigint, sole_id string")
    stage = names([("c", 0, 0, "甲"), ("c", 0, 1, "丁"), ("c", 1, 0, "丙"), ("c", 2, 0, "乙")])
    event = names([("c", None, 0, "甲"), ("c", None, 1, "乙"), ("d", None, 0, "甲"), ("d", None, 1, "戊")]).drop("stage_idx")
    explicit = spark.createDataFrame([("e2", "c", 2)], "entity_id string, container_id string, stage_idx bigint")
    got = {tuple(r) for r in ed.summary_edges(stage, event, idx, explicit).select("entity_id", "container_id", "stage_idx").collect()}
    assert got == {("e1", "c", 0), ("e1", "d", None)}
    both = stage.select("container_id", "name").unionByName(event.select("container_id", "name"))
    assert rows(ed.unresolved(ed.resolved_names(both, idx)), "container_id", "name") == [("c", "丁"), ("d", "戊")]


def edge_rows(spark, data):
    return spark.createDataFrame(data, "entity_id string, container_id string, stage_idx bigint, source string, tier string")


def brute_pairs(data):
    ok = [d for d in data if d[3] == "deterministic" or d[4] != "mentioned"]
    cells, conts = {}, {}
    for e, c, s, *_ in ok:
        conts.setdefault(c, set()).add(e)
        if s is not None:
            cells.setdefault((c, s), set()).add(e)
    stage, event = Counter(), {}
    for m in cells.values():
        stage.update(combinations(sorted(m), 2))
    for c, m in conts.items():
        for p in combinations(sorted(m), 2):
            event.setdefault(p, []).append(c)
    return {p: (stage[p], len(cs), sorted(cs)[:3]) for p, cs in event.items()}


def test_places_are_sought_once_in_each_distinct_word(spark, monkeypatch):
    """Only distinct words go through the matcher, and texts with words of more than 64 characters; other words are blank there."""
    searched, plain = [], pa.found

    def counting(chunks, words, **kinds):
        searched.append([r.body for r in chunks.select("body").collect()])
        return plain(chunks, words, **kinds)

    monkeypatch.setattr(pa, "found", counting)
    chunks = spark.createDataFrame([("c", i, "Lin met W, Lin\nmet aa-aa-aa " * 40) for i in range(30)] + [("c", 99, "Lin " + "Lin-" * 30)], CHUNK)
    aliases = spark.createDataFrame([("Lin",), ("aa-aa",), ("W,",)], "alias string")
    got = sorted((r.stage_idx, r.alias, r.start) for r in pa.spans(chunks, aliases).collect())
    want = [(r.stage_idx, a, at) for r in chunks.collect() for a in ("Lin", "aa-aa", "W,") for at in brute_spans(r.body, a)]
    assert got == sorted(want)
    assert sorted(searched[0]) == ["Lin", "W,", "aa-aa-aa", "met"] and searched[1:] == [["    " + "Lin-" * 30]]


def test_places_over_pages_and_long_words(spark):
    """Words at every offset of a page, words of 63 to 66 characters and longer ones, aliases with blanks, wide characters."""
    draw, data = random.Random(8), []
    pieces = ["Lin", "Lin-Lin", "W", "林澈", "a.a.a.a", "x" * 61 + "Lin", "Lin" + "y" * 62, "é𝒳Lin", "林" * 70, "Lin." * 17, "to go", "", "\n", "𝒳", "q" * 31 + "-W"]
    for i in range(24):
        data.append(("c", i, " " * i + draw.choice([" ", "\n"]).join(draw.choice(pieces) for _ in range(draw.choice([3, 150, 700])))))
    aliases = ["Lin", "林", "林澈", "a.a", "𝒳", "to go", "W", "林林", "q" * 31 + "-W", "Lin.Lin", "x" * 61 + "Lin", "林" * 66, "go Lin", "-"]
    chunks = spark.createDataFrame([*data, ("c", 99, None), ("d", 1, "Lin")], CHUNK)
    adf = spark.createDataFrame([(a,) for a in aliases], "alias string")
    got = Counter((r.container_id, r.stage_idx, r.alias, r.start, r.size) for r in pa.spans(chunks, adf).collect())
    want = Counter((c, i, a, at, len(a)) for c, i, b in [*data, ("d", 1, "Lin")] for a in aliases for at in brute_spans(b, a))
    assert got == want
    scope = spark.createDataFrame([("c", "Lin"), ("c", "to go"), ("d", "W")], "container_id string, alias string")
    some = Counter((r.container_id, r.stage_idx, r.alias, r.start, r.size) for r in pa.spans(chunks, adf, scope).collect())
    assert some == Counter({k: n for k, n in want.items() if k[0] == "c" and k[2] in ("Lin", "to go")})


@pytest.mark.parametrize("block", [4, 512])
def test_pairs_with_a_hot_container(spark, block):
    rng = random.Random(3)
    data = [(f"e{rng.randint(0, 40):02d}", "hot" if rng.random() < 0.4 else f"c{rng.randint(0, 9)}", rng.choice([0, 1, 2, None]),
             "deterministic" if rng.random() < 0.1 else "participant", rng.choice(["speaker", "named", "mentioned"])) for _ in range(600)]
    edges, want = edge_rows(spark, data), brute_pairs(data)
    got = {(r.a, r.b): (r.co_stage_count, r.co_container_count, r.sample_containers) for r in co.table(edges, block=block).collect()}
    assert got == want
    rank = sorted(((-v[0], -v[1], *p) for p, v in want.items()))
    flat = lambda df: [(-r.co_stage_count, -r.co_container_count, r.a, r.b) for r in df.collect()]
    for k in (1, 7, 5000):
        assert flat(co.top(edges, k, block=block)) == rank[:k]
    assert flat(co.for_entity(edges, "e05", None)) == [r for r in rank if "e05" in r[2:]]
    lo, hi = next(iter(want))
    one = co.between(edges, hi, lo).first()
    assert (one.a, one.b, one.co_stage_count, one.co_container_count) == (lo, hi, *want[(lo, hi)][:2])
    assert co.between(edges, "e00", "nobody").count() == 0


def test_best_pairs_of_flat_degrees_meet_few(spark, monkeypatch):
    """Every entity is in about 30 chunks, ten of them hot; twelve pairs share most of theirs."""
    draw, data = random.Random(5), set()
    for e in range(240):
        own = [f"s{e // 2}_{i}" for i in range(16)] if e < 24 else []
        own += [f"r{draw.randrange(600)}" for _ in range(20 - len(own))] + [f"hot{i}" for i in range(10)]
        data |= {(f"e{e:03}", c, 1, "participant", "named") for c in own}
    edges, want = edge_rows(spark, sorted(data)), brute_pairs(data)
    made, full = [], co.pairs

    def counting(members, block):
        met = full(members, block)
        made.append(met.count())
        return met

    monkeypatch.setattr(co, "pairs", counting)
    got = [(r.a, r.b, r.co_stage_count) for r in co.top(edges, 12).collect()]
    assert got == sorted(((*p, v[0]) for p, v in want.items()), key=lambda r: (-r[2], r[:2]))[:12]
    assert {(a, b) for a, b, _ in got} == {(f"e{e:03}", f"e{e + 1:03}") for e in range(0, 24, 2)}
    assert sum(made) < sum(v[0] for v in want.values()) / 10


def test_pairs_are_counted_without_a_shuffle_of_pairs(spark, monkeypatch):
    """Behind the deal of member lists no exchange follows, whatever the number of blocks; nulls meet nobody."""
    data = [(f"e{e:02}", f"c{c}", c % 2, "participant", "named") for e in range(30) for c in range(5)]
    edges = edge_rows(spark, [*data, (None, "c0", 0, "participant", "named"), ("e00", None, 0, "participant", "named")])
    monkeypatch.setattr(co, "PAIRS", 40)
    found = co.table(edges, block=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    behind = plan[:plan.index("Exchange hashpartitioning(_task")]
    assert "Exchange" not in behind and "Join" not in behind
    assert {(r.a, r.b): (r.co_stage_count, r.co_container_count, r.sample_containers) for r in found.collect()} == brute_pairs(data)
    monkeypatch.setattr(co, "FULL", 12)
    assert [(r.a, r.b) for r in co.top(edges, 3, block=4).collect()] == [("e00", "e01"), ("e00", "e02"), ("e00", "e03")]


def test_best_pairs_write_only_what_reaches_the_bound(spark, monkeypatch):
    """Flat degrees, all pairs counted: a few entities give a bound, and pairs below it are not written."""
    draw, data = random.Random(9), set()
    for e in range(60):
        own = [f"s{e // 2}_{i}" for i in range(5)] if e < 12 else []
        own += draw.sample([f"r{k}" for k in range(30)], 7 - len(own))
        data |= {(f"e{e:02}", c, 1, "participant", "named") for c in own}
    edges, want = edge_rows(spark, sorted(data)), brute_pairs(data)
    kept, plain = [], co.written

    def counting(df, name):
        out = plain(df, name)
        if name == "pair-counts":
            kept.append(out.count())
        return out

    monkeypatch.setattr(co, "written", counting)
    monkeypatch.setattr(co, "FULL", 12)
    got = [(r.a, r.b, r.co_stage_count) for r in co.top(edges, 5).collect()]
    assert got == sorted(((*p, v[0]) for p, v in want.items()), key=lambda r: (-r[2], r[:2]))[:5]
    assert kept and sum(kept) < len(want) / 20


@pytest.mark.parametrize("limit", [12, 60])
def test_many_candidates_are_not_looked_up(spark, monkeypatch, limit):
    """Candidates whose lookups exceed the memberships are counted in the tasks of their blocks; only the best are looked up."""
    draw, data = random.Random(5), set()
    for e in range(240):
        own = [f"s{e // 2}_{i}" for i in range(16)] if e < 24 else []
        own += [f"r{draw.randrange(600)}" for _ in range(20 - len(own))] + [f"hot{i}" for i in range(10)]
        data |= {(f"e{e:03}", c, 1, "participant", "named") for c in own}
    edges, want = edge_rows(spark, sorted(data)), brute_pairs(data)
    sought, plain = [], co.verified

    def counting(candidates, members, degree):
        sought.append(candidates.count())
        return plain(candidates, members, degree)

    monkeypatch.setattr(co, "verified", counting)
    monkeypatch.setattr(co, "LOOKUPS", 0)
    monkeypatch.setattr(co, "MEETINGS", 1e9)
    got = [(r.a, r.b, r.co_stage_count, r.co_container_count) for r in co.top(edges, limit).collect()]
    rank = sorted(((*p, *v[:2]) for p, v in want.items()), key=lambda r: (-r[2], -r[3], r[:2]))
    assert got == rank[:limit]
    assert sum(sought) == sum(r[2] >= rank[limit - 1][2] for r in rank)


def test_pairs_are_added_up_in_arrays(spark):
    """Behind the deal of member lists no row stands for a meeting: nothing is exploded, sorted by pair or windowed there."""
    data = [(f"e{e:02}", f"c{c}", c % 2, "participant", "named") for e in range(30) for c in range(5)]
    found = co.table(edge_rows(spark, data), block=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    behind = plan[:plan.index("Exchange hashpartitioning(_task")]
    assert "Generate" not in behind and "Window" not in behind
    assert {(r.a, r.b): (r.co_stage_count, r.co_container_count, r.sample_containers) for r in found.collect()} == brute_pairs(data)
    assert all(r.sample_containers == [] for r in co.table(edge_rows(spark, data), sample=0).collect())


@pytest.mark.parametrize("n_cells, met", [(6, 50), (6, 10**6), (900, 300)])
@pytest.mark.parametrize("blocks", [1, 2])
def test_a_task_counts_dense_and_sparse_blocks(monkeypatch, n_cells, met, blocks):
    """Few cells: most pairs meet; many cells: few do. A batch of meetings holds one entity at least."""
    draw = random.Random(n_cells + met)
    names = [sorted(f"é{draw.randrange(10**6)}" for _ in range(40)) for _ in range(blocks)]
    held = {(f"c{draw.randrange(n_cells):03}", draw.choice([-1, 0, 1]), b, x) for b in range(blocks) for x in range(40) for _ in range(12)}
    lists = {}
    for c, cell, b, x in sorted(held):
        lists.setdefault((c, cell, b), []).append(x)
    rows = [{"_own": b, "_names": names[b]} for b in range(blocks)]
    rows += [{"container_id": c, "cell": cell, "_own": b, "_ats": at} for (c, cell, b), at in lists.items()]
    types = {"container_id": pyarrow.string(), "cell": pyarrow.int64(), "_own": pyarrow.int32(), "_ats": pyarrow.list_(pyarrow.int16()), "_names": pyarrow.list_(pyarrow.string())}
    batches = pyarrow.Table.from_pylist(rows, schema=pyarrow.schema(list(types.items()))).to_batches(max_chunksize=7)
    want = {}
    for (c, cell, b), at in sorted(lists.items()):
        for c2, cell2, b2 in ((c, cell, k) for k in range(blocks)):
            for x in at:
                for y in lists.get((c2, cell2, b2), []):
                    if (b == b2 and x < y and blocks == 1) or (b < b2):
                        pair = tuple(sorted((names[b][x], names[b2][y])))
                        n = want.setdefault(pair, [0, []])
                        n[0] += cell != -1
                        n[1] += [c] * (cell == -1)
    monkeypatch.setattr(co, "MET", met)
    got = [tuple(r.values()) for batch in co._counted_in_task(batches, 3, 0) for r in batch.to_pylist()]
    assert sorted(got, key=str) == sorted(((*p, n, len(cs), *(sorted(cs) + [None] * 3)[:3]) for p, (n, cs) in want.items()), key=str)
    some = [tuple(r.values()) for batch in co._counted_in_task(batches, 0, 2) for r in batch.to_pylist()]
    assert sorted(some) == sorted((*p, n, len(cs)) for p, (n, cs) in want.items() if n >= 2)


def test_members_go_to_few_blocks_and_as_numbers(spark, monkeypatch):
    """A chunk of more members than `BLOCK` is not cut for that; its lists hold two bytes for a member, not its name."""
    data = [(f"e{e:04}", "c", e % 2, "participant", "named") for e in range(1300)]
    made, plain = {}, co.written
    monkeypatch.setattr(co, "written", lambda df, name: made.setdefault(name, plain(df, name)))
    met = co.met_apart(co.memberships(edge_rows(spark, data)))
    lists = made["cell-lists"]
    assert dict(lists.dtypes)["_ats"] == "array<smallint>" and "string" not in dict(lists.drop("container_id").dtypes).values()
    assert lists.select("_own").distinct().count() == 1 and met.count() == 1300 * 1299 // 2


def test_edge_order_and_filters(spark):
    e = edge_rows(spark, [("e", "c", None, "summary", "named"), ("e", "c", 1, "participant", "mentioned"), ("e", "c", 0, "deterministic", None)])
    assert [r.stage_idx for r in ed.of_entity(e, "e").collect()] == [0, None]
    assert [r.stage_idx for r in ed.of_container(e, "c", min_tier="mentioned").collect()] == [0, 1, None]
    assert ed.of_chunk(e, "c", 0, "summary").count() == 0


def test_collation(spark):
    shape = "head string, type string, tail string, tail_name string, notes string, seq bigint"
    baked = spark.createDataFrame([("a", "t", "b", "B", "old", 1), ("a", "t", "b", "B", "newer", 2), ("a", "t", None, "X", None, 1), ("a", "t", None, "Y", None, 1)], shape)
    over = spark.createDataFrame([("a", "t", "b", "B", "mine", 0)], shape)
    got = [tuple(r) for r in rel.ordered(rel.collate(baked, over)).select("tail", "tail_name", "notes", "source").collect()]
    assert got == [(None, "X", None, "bake"), (None, "Y", None, "bake"), ("b", "B", "mine", "curated")]
    all_rows = rel.collate(baked, over)
    assert rel.between(all_rows, "b", "a").count() == 1 and rel.between(all_rows, "b", "a", directed=True).count() == 0
    assert rel.touching(all_rows, "a").count() == 3 and [r[0] for r in rel.types(all_rows).collect()] == ["t"]


def test_entities(spark):
    unresolved = spark.createDataFrame([(f"c{i}", "某") for i in range(7)] + [("c1", "有")], "container_id string, name string")
    curated = spark.createDataFrame([("ent_x", "有")], "entity_id string, name string")
    got = en.auto_seeded(unresolved, curated, curated.select("entity_id")).collect()
    assert [(r.name, r.first_container_ids) for r in got] == [("某", ["c0", "c1", "c2", "c3", "c4"])]


def test_later_entity_wins_by_id(spark):
    df = spark.createDataFrame([("x", "first", 1), ("x", "second", 2), ("y", "only", 0)], "entity_id string, name string, line_no bigint")
    assert rows(en.by_id(df), "entity_id", "name") == [("x", "second"), ("y", "only")]


def test_request_parts(spark):
    ents = spark.createDataFrame([("e", "甲")], "entity_id string, name string")
    als = spark.createDataFrame([("e", "甲", 0), ("e", "乙", 1)], "entity_id string, alias string, ord bigint")
    docs = spark.createDataFrame([("甲", "档案")], "name string, dossier string")
    told = spark.createDataFrame([("e", 3, "事", "文")], "entity_id string, ord bigint, title string, text string")
    got = [(r.block, r.text) for r in cd.request_parts(ents, als, docs, told).orderBy("block", "ord").collect()]
    assert got == [(0, "名称:甲\n已知其他名称(可能有更多):甲;乙"), (1, "档案"), (2, "<活动名称>事</活动名称>\n<相关内容>\n文\n</相关内容>\n\n")]
    assert rows(cd.unknown_aliases(als, docs), "entity_id", "alias") == [("e", "乙")]


def test_content_hash(spark):
    data = [("u1", "b", "二"), ("u1", "a", "一"), ("u2", "a", "一" * 50)]
    df = spark.createDataFrame(data, "unit_id string, name string, text string")
    digests = [hashlib.sha256(f"{n}\0{t}\0".encode()).hexdigest() for n, t in (("a", "一"), ("b", "二"))]
    lanes = [sum(int(h[7 * i:7 * i + 7], 16) for h in digests) for i in range(inc.LANES)]
    exact = dict(rows(inc.content_hash(df), "unit_id", "source_hash"))
    assert exact["u1"] == hashlib.sha256(":".join(map(str, [2, *lanes])).encode()).hexdigest()
    assert exact == dict(rows(inc.content_hash(df.orderBy(F.desc("name"))), "unit_id", "source_hash"))
    changed = dict(rows(inc.content_hash(df.withColumn("text", F.concat("text", F.lit("!")))), "unit_id", "source_hash"))
    assert exact["u1"] != changed["u1"]
    renamed = dict(rows(inc.content_hash(df.withColumn("name", F.concat("name", F.lit("!")))), "unit_id", "source_hash"))
    assert renamed["u1"] != exact["u1"]


def test_unit_decisions(spark):
    s = lambda d: spark.createDataFrame(d, "unit_id string, source_hash string")
    now, old = s([("same", "1"), ("new", "2"), ("changed", "3"), ("lost", "4")]), s([("same", "1"), ("changed", "0"), ("lost", "4"), ("gone", "9")])
    outs = s([("same", ""), ("changed", ""), ("gone", "")])
    got = dict(rows(inc.decide(now, old, outs), "unit_id", "status"))
    assert got == {"same": "skip", "new": "run", "changed": "run", "lost": "run", "gone": "stale"}
    assert dict(rows(inc.decide(now, old, outs, force=True), "unit_id", "status"))["same"] == "run"
    dry = dict(rows(inc.dry_run(now, old, outs), "unit_id", "would_run"))
    assert dry == {"same": False, "new": True, "changed": False, "lost": True}
    assert rows(inc.stale_keys(old, now), "unit_id") == [("gone",)] and inc.stale_keys(old, now, complete=False).count() == 0
    state = inc.upsert_state(old, s([("changed", "3")]), now)
    assert rows(state, "unit_id", "source_hash") == [("changed", "3"), ("lost", "4"), ("same", "1")]


def test_cost(spark):
    u = spark.createDataFrame([("a", 100, 2, True), ("b", 90_000, 3, True), ("c", 10, 11, False)], "unit_id string, total_length bigint, stage_count bigint, would_run boolean")
    got = {r.unit_id: (r.passes, r.llm_calls, r.in_chars, r.out_chars) for r in inc.container_cost(u, 10, 20, 30).collect()}
    assert got == {"a": ("single", 1, 110, 900), "b": ("multi", 4, 60 + 90_000 + 30 + 1200, 2100), "c": ("multi", 12, 220 + 10 + 30 + 4400, 5300)}


def test_percentiles(spark):
    rng = random.Random(1)
    values = [rng.randint(0, 9000) for _ in range(777)]
    shares = {"median": 0.5, "p90": 0.9, "p95": 0.95}
    got = dict(rows(st.percentiles(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", shares), "stat", "value"))
    assert got == {k: sorted(values)[int(len(values) * p)] for k, p in shares.items()}


def test_grep(spark):
    c = spark.createDataFrame([("c", 0, "a.b\nxx\na.b" + "z" * 300), ("c", 1, "aXb")], CHUNK)
    got = se.grep_text("a.b", "events", chunks=c).orderBy("stage_idx", "line_no").collect()
    assert [(r.stage_idx, r.line_no, len(r.snippet)) for r in got] == [(0, 1, 3), (0, 3, 200)]
    assert se.grep_text("a.b", "events", regex=True, chunks=c).count() == 3
    with pytest.raises(ValueError):
        se.grep_text("a", "nowhere", chunks=c)


def test_update_flow(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    sim = ca.similar_names(names("老林", "林", "云海"), spark.createDataFrame([("老林头",), ("云",), ("海云海",)], "canonical string"))
    assert rows(sim, "name", "similar") == sorted([("老林", "老林头"), ("云海", "海云海")])
    chunks = spark.createDataFrame([("c1", 0, "阿甲:早"), ("c2", 0, "甲 来"), ("c3", 0, "x")], CHUNK)
    keys = spark.createDataFrame([("c2", "大甲乙丙"), ("c3", "甲")], "container_id string, name string")
    als = spark.createDataFrame([("e", "甲"), ("f", "甲乙丙"), ("f", "乙丙")], "entity_id string, alias string")
    assert rows(ca.related_containers(chunks, keys, als), "entity_id", "container_id") == [("e", "c1"), ("e", "c3"), ("f", "c2")]
    table = pg.index_rows(spark.createDataFrame([("g", i, f"n{i}") for i in range(7)], "g string, o bigint, t string"), "g", "o", "t", 5)
    assert [r.line for r in table.orderBy("row_no").collect()] == ["| n0 | n1 | n2 | n3 | n4 |", "| n5 | n6 |  |  |  |"]
    with pytest.raises(ValueError):
        pg.index_rows(table, "g", "o", "t", 0)


def test_run_outcome(spark):
    plan = spark.createDataFrame([("a", "run"), ("b", "run"), ("c", "skip"), ("d", "stale")], "unit_id string, status string")
    old = spark.createDataFrame([("c",), ("d",), ("e",)], "unit_id string")
    none, bad = old.limit(0), spark.createDataFrame([("b",)], "unit_id string")
    base = {"a": "run", "b": "run", "c": "skip"}
    assert dict(rows(inc.run_outcome(plan, none, old), "unit_id", "status")) == base | {"d": "pruned", "e": "pruned"}
    kept = {"d": "kept_stale", "e": "kept_stale"}
    assert dict(rows(inc.run_outcome(plan, none, old, filtered=True), "unit_id", "status")) == base | kept
    broken = inc.run_outcome(plan, bad, old)
    assert dict(rows(broken, "unit_id", "status")) == base | {"b": "terminal_error"} | kept
    assert {r.complete for r in inc.run_report(broken).collect()} == {False}
    assert {r.complete for r in inc.run_report(plan).collect()} == {True}


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from scriptloom.session import checkpoint_root

    def session(master, conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))

    with pytest.raises(ValueError):
        checkpoint_root(session("spark://host:7077", {}))
    assert checkpoint_root(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"
    assert checkpoint_root(session("local[2]", {}))


def test_similar_names_with_a_long_name(spark):
    long = "甲" * 2500 + "林澈" + "乙" * 2500
    raw = spark.createDataFrame([(long,), ("澈澈",), ("a",)], "name string")
    canon = spark.createDataFrame([("林澈",), ("小澈澈",), (long,)], "canonical string")
    assert dict(rows(ca.similar_names(raw, canon), "name", "similar")) == {long: "林澈", "澈澈": "小澈澈"}


def test_containment_with_one_common_start(spark):
    """Names that all start with the same two characters meet on what sets them apart."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("甲乙丙丁戊己庚辛壬癸abcdefgh") for _ in range(n))
    long = sorted({"老王" + word(rng.randint(2, 7)) for _ in range(400)} | {"老王", "x"})
    short = sorted({"老王" + word(rng.randint(0, 2)) for _ in range(200)} | {"老王", "王", "zz", "甲乙"})
    left, right = spark.createDataFrame([(x,) for x in long], "t string"), spark.createDataFrame([(x,) for x in short], "s string")
    met = ca._inside(left, "t", right, "s")
    assert sorted(map(tuple, met.collect())) == sorted((t, s) for t in long for s in short if len(s) >= 2 and s in t)
    held = left.select("t", F.explode(ca._pieces("t")).alias("piece"))
    often = {r.piece: r["count"] for r in held.groupBy("piece").count().collect()}
    pieces = lambda s: {s[k:k + 2] for k in range(len(s) - 1)}
    keys = [min((often.get(p, 0), p) for p in pieces(s)) for s in short if len(s) >= 2 and s != "老王" and all(p in often for p in pieces(s))]
    # rows that meet stay near the number of names
    assert sum(n for n, _ in keys) < 20 * len(short) < len(long) * len(short) / 10


def test_candidates_list_their_containers(spark):
    raw = spark.createDataFrame([("小林", "c1"), ("小林", "c2"), ("林澈", "c3"), ("河伯", "c1"), ("Bo.b", "c9"), ("新人", "c4")], "name string, container_id string")
    amap = spark.createDataFrame([("小林", "林澈"), ("林澈", "林澈")], "alias string, canonical string")
    playable = spark.createDataFrame([("林澈", "char_1"), ("河伯", "char_2")], "name string, char_id string")
    slug = hashlib.sha256("河伯".encode()).hexdigest()[:6]
    pages = spark.createDataFrame([("char_1",), (f"extended_char_{slug}",), ("extended_char_Bo.b",)], "page_id string")
    found = ca.candidates(raw, amap, playable, pages)
    assert rows(found, "canonical", "raw_name", "page_id", "kind", "status") == sorted([
        ("林澈", "小林", "char_1", "playable", "existing"), ("河伯", "河伯", f"extended_char_{slug}", "extended", "existing"),
        ("Bo.b", "Bo.b", "extended_char_Bo.b", "extended", "existing"), ("新人", "新人", None, None, "new")])
    assert rows(ca.candidate_containers(found, raw), "canonical", "container_id") == sorted(
        [("林澈", "c1"), ("林澈", "c2"), ("河伯", "c1"), ("Bo.b", "c9"), ("新人", "c4")])
