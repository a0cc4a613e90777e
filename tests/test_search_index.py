"""Indexed search and mined phrases against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from scriptloom import session
from scriptloom.operators import gram_index as gi
from scriptloom.operators import mining as mi
from scriptloom.operators import search as se

CHUNK = "container_id string, stage_idx bigint, body string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["山谷", "river", "é", "abc abc", "token = 7", "x", "林澈走了", "\n", ". "]
    rows = [(f"c{i % 5}", i, " ".join(rng.choice(words) for _ in range(rng.randrange(25)))) for i in range(300)]
    rows[17] = ("c2", 17, "line one\nthe only needle here\nneedle too")
    rows[40] = ("c0", 40, "needl e, eedle")
    return rows + [("c1", 900, None), ("c1", 901, ""), ("c1", 902, "ab")]


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    return gi.GramIndex.write(spark.createDataFrame(texts, CHUNK), str(tmp_path_factory.mktemp("grams") / "index"), folders=8, blocks=32)


def lines(texts, pattern, container=None, stage=None):
    return sorted((c, s, n + 1, x) for c, s, b in texts if container in (None, c) and stage in (None, s)
                  for n, x in enumerate((b or "").split("\n")) if pattern in x)


def got(df):
    return sorted((r.container_id, r.stage_idx, r.line_no, r.line) for r in df.collect())


@pytest.mark.parametrize("pattern", ["needle", "token = 7", "山谷 river", "走了", "é", "absent text", "abc", "\n"])
def test_indexed_search_equals_the_scan(spark, texts, index, pattern):
    chunks = spark.createDataFrame(texts, CHUNK)
    want = lines(texts, pattern) if pattern != "\n" else []
    assert got(index.grep(pattern)) == want
    assert got(index.grep(pattern, "c2")) == [r for r in want if r[0] == "c2"] == got(gi.grep_scoped(chunks, pattern, "c2"))
    assert got(index.grep(pattern, "c2", 17)) == [r for r in want if r[:2] == ("c2", 17)] == got(gi.grep_scoped(chunks, pattern, "c2", 17))


def test_regex_with_a_literal(spark, texts, index):
    chunks = spark.createDataFrame(texts, CHUNK)
    want = got(se.grep(chunks, "n[e]+dle h", gi.KEYS, regex=True))
    assert want and got(index.grep("n[e]+dle h", regex=True, literal="dle h")) == want == got(index.grep("n[e]+dle h", regex=True))


def test_fewer_texts_are_read(index):
    """A rare literal reads one block of texts; the scope reaches the scan."""
    assert index.frequencies("needle")["nee"] == 2 and index.frequencies("zzz") == {"zzz": 0}
    some = index.candidate_texts("needle")
    # the second holds every gram of the literal, but not the literal: lines decide
    assert sorted((r.container_id, r.stage_idx) for r in some.select("container_id", "stage_idx").collect()) == [("c0", 40), ("c2", 17)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert any("block#" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
    all_files = len(index.texts().inputFiles())
    blocks = {r.block for r in index.candidates("needle").collect()}
    read = [f for f in index.texts().inputFiles() if int(f.split("block=")[1].split("/")[0]) in blocks]
    assert 1 <= len(read) <= 2 < all_files / 4
    scoped = gi.scoped(index.texts(), "c3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(container_id,c3)" in scoped


def brute(texts, least, most, words, often, spread, top, known):
    import re
    counts, where = Counter(), defaultdict(set)
    for c, s, b in texts:
        runs = re.findall(r"[^\W\d_]+(?: [^\W\d_]+)*", b or "") if words else re.findall("[一-鿿]+", b or "")
        for run in runs:
            u = run.split(" ") if words else list(run)
            for n in range(least, most + 1):
                for k in range(len(u) - n + 1):
                    p = (" " if words else "").join(u[k:k + n])
                    counts[c, p] += 1
                    where[c, p].add(s)
    kept = {k: n for k, n in counts.items() if n >= often and len(where[k]) >= spread}
    inside = set()
    for (c, p), n in kept.items():
        u = p.split(" ") if words else list(p)
        for part in (u[:-1], u[1:]):
            inside.add((c, (" " if words else "").join(part), n))
    out = []
    for c in {k[0] for k in kept}:
        rows = [(p, n) for (cc, p), n in kept.items() if cc == c and (c, p, n) not in inside and p not in known and p not in mi.BLOCKLIST]
        rows.sort(key=lambda x: (-x[1] * len(where[c, x[0]]), -len(x[0]), x[0]))
        out += [(c, p, n, len(where[c, p]), r + 1) for r, (p, n) in enumerate(rows[:top])]
    return sorted(out)


@pytest.mark.parametrize("words", [False, True])
def test_mined_names(spark, monkeypatch, words):
    monkeypatch.setattr(mi, "WINDOW", 5)
    rng = random.Random(3)
    pieces = ["特蕾西娅", "霜星", "博士", "走了", "山", "。", "Kal tsit", "of the Hill", " ", "  ", "z9", "\n"]
    data = [(f"c{i % 3}", i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(60)] + [("c0", 99, None)]
    known = spark.createDataFrame([("霜星",)], "alias string")
    got = mi.mined_names(spark.createDataFrame(data, CHUNK), known, 2, 4, top=8, words=words)
    assert sorted(tuple(r) for r in got.collect()) == brute(data, 2, 4, words, 3, 2, 8, {"霜星"})
    found = {r.phrase for r in got.collect()}
    assert words or ("特蕾西娅" in found and "蕾西娅" not in found)


@pytest.mark.parametrize("words", [False, True])
def test_places_of_phrases_are_shuffled_once(spark, words):
    """One exchange, in front of which each place is one row."""
    chunks = spark.createDataFrame([("c", i, "山高水长流" if not words else "on the high hill") for i in range(3)], CHUNK)
    found = mi.counted(chunks, 2, 4, words)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan[plan.index("Exchange "):].count("HashAggregate") == 0
    rows = {r.phrase: (r.n, r.spread) for r in found.collect()}
    assert len(rows) == (6 if words else 9) and set(rows.values()) == {(3, 3)}


@pytest.mark.parametrize("words", [False, True])
def test_rare_beginnings_go_before_phrases_are_made(spark, words):
    """Rows below the bounds are left out whatever the chunk number is (null, once, twice); none is made of a rare beginning."""
    unit = (lambda t: " ".join(t)) if words else (lambda t: "".join(t))
    data = [("c", 1, "甲乙丙丁"), ("c", 2, "甲乙丙"), ("c", None, "甲乙丙丁"), ("c", 3, "戊己庚戊己庚戊己"), ("c", None, "子丑"), ("c", None, "子丑"), ("c", 4, "子丑"), ("d", 1, "甲乙丙丁"),
            (None, 1, "甲乙"), (None, 2, "甲乙"), (None, 2, "甲乙")]
    chunks = spark.createDataFrame([(c, s, unit(b)) for c, s, b in data], CHUNK)
    every = {tuple(r) for r in mi.counted(chunks, 2, 4, words).collect()}
    for often, spread in ((3, 2), (1, 2), (2, 1)):
        found = mi.counted(chunks, 2, 4, words, often, spread)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in found.collect()} == {r for r in every if r[2] >= often and r[3] >= spread}
        assert plan.index("Generate explode(transform") < plan.index("Window [") and "Filter" in plan[plan.index("Generate explode(transform"):plan.index("Window [")] and plan.count("Exchange ") == 1


def test_containers_are_mined_in_passes(spark, monkeypatch):
    """Each pass holds whole containers, together all of them; what a pass shuffled is gone when it ends, the setting is as before."""
    data = [(f"c{i % 5}", i, f"the high hill {i % 7} on the high road") for i in range(60)] + [(None, 1, "the high hill"), ("c1", None, "the high hill"), ("c9", 1, None)]
    chunks = spark.createDataFrame(data, CHUNK)
    whole = sorted(map(str, mi.mined_names(chunks, least=2, most=4, words=True).collect()))
    seen, plain, setting = [], mi.counted, []

    def counting(some, *a):
        seen.append({(r.container_id, r.stage_idx) for r in some.collect()})
        return plain(some, *a)

    put = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, key, value: (setting.append((key, value)), put(self, key, value))[1])
    monkeypatch.setattr(mi, "counted", counting)
    monkeypatch.setattr(mi, "CHARS", 500)
    assert sorted(map(str, mi.mined_names(chunks, least=2, most=4, words=True).collect())) == whole
    assert len(seen) > 2 and sum(map(len, seen)) == len(set().union(*seen)) == len({d[:2] for d in data})
    homes = [{c for c, _ in s} for s in seen]
    assert sum(map(len, homes)) == len(set().union(*homes))
    assert setting.count((session.CLEANUP, "true")) == len(seen) and spark.conf.get(session.CLEANUP, None) != "true"
