"""Builds on top of earlier ones: what is matched again, which files stay, what readers see."""

import glob
import os
import shutil

import pytest

from scriptloom.operators import cooccurrence as co
from scriptloom.operators import participants as pa
from scriptloom.plans.build import Inputs, build
from scriptloom.plans.kb import KnowledgeBase
from scriptloom.sources.store import Build, Snapshot

TABLES = ["chunks", "participant_edges", "edges", "edges_by_entity", "entities", "cooccurrence", "relations", "chars", "match_aliases", "sections", "report"]


def inputs(root):
    return Inputs(str(root), f"{root}/sum", f"{root}/alias.txt", f"{root}/cur.jsonl", f"{root}/rel", f"{root}/relcur.jsonl", f"{root}/dossier")


def rows(snapshot, name):
    df = snapshot.read(name)
    return sorted(repr(sorted(r.asDict(recursive=True).items())) for r in df.collect())


def files(out):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/data/**/*.parquet", recursive=True)}


def same_as_a_full_build(spark, source, out, fresh):
    build(spark, inputs(source), fresh)
    a, b = Snapshot(spark, out), Snapshot(spark, fresh)
    assert a.entries.keys() == b.entries.keys()
    for name in TABLES:
        assert rows(a, name) == rows(b, name), name


def test_rebuild(spark, mini, tmp_path, monkeypatch):
    source, out = tmp_path / "source", str(tmp_path / "kb")
    shutil.copytree(mini, source)
    build(spark, inputs(source), out)
    first, old_files = Snapshot(spark, out), files(out)
    asked = []
    plain = pa.participants
    monkeypatch.setattr(pa, "participants", lambda chunks, *rest: asked.append({r[0] for r in chunks.select("container_id").distinct().collect()}) or plain(chunks, *rest))

    build(spark, inputs(source), out)  # nothing changed
    second = Snapshot(spark, out)
    assert asked.pop() == set() and second.version == first.version + 1
    for name in TABLES:
        assert {e for p, e in second.entries[name].items() if p >= 0 or e[1]} == {e for p, e in first.entries[name].items() if p >= 0 or e[1]}, name

    script = next(source.glob("zh_CN/gamedata/story/obt/main/y.txt"))
    script.write_bytes("林澈:到了。\n".encode())
    before, here = KnowledgeBase(spark, out), lambda kb: kb.event_chars("main_x").filter("entity_id = 'char_001_lin'")
    with monkeypatch.context() as m:  # a build that breaks off leaves the last one
        m.setattr(co, "table", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            build(spark, inputs(source), out)
    assert asked.pop() == {"main_x"}
    assert KnowledgeBase(spark, out).build.version == second.version and here(KnowledgeBase(spark, out)).count() == 0

    build(spark, inputs(source), out)  # one container changed
    assert here(before).count() == 0  # a reader keeps its build
    third = Snapshot(spark, out)
    assert asked.pop() == {"main_x"}
    assert here(KnowledgeBase(spark, out)).first().tier == "speaker"
    moved = {p for p in first.entries["chunks"] if p >= 0 and first.entries["chunks"][p] != third.entries["chunks"].get(p)}
    assert len(moved) == 1
    for name in ("sections", "match_aliases", "entities_raw", "relations", "alias_owners", "links"):
        assert third.entries[name] == first.entries[name]
    held = {f"{out}/{e[0]}" for name in first.entries for p, e in third.entries[name].items() if e in first.entries[name].values()}
    now = files(out)
    kept = [f for f in old_files if os.path.dirname(f) in held]
    assert len(kept) > 20 and all(now[f] == old_files[f] for f in kept)
    with open(source / "alias.txt", "a", encoding="utf-8") as f:
        f.write("林澈;山河\n")
    build(spark, inputs(source), out)  # an alias more: only containers that hold it
    assert asked.pop() == {"act_one"}
    same_as_a_full_build(spark, source, out, str(tmp_path / "full2"))


def test_parts_and_old_builds(spark, tmp_path):
    root = str(tmp_path)
    make = lambda n: spark.range(40).selectExpr("concat('k', id) as k", f"if(id = 3, {n}, 0) as v")
    folders = []
    for n in (1, 2, 2, 5):
        b = Build(spark, root)
        b.put(spark.range(3), "fixed")
        b.put_parts(make(n), "t", "k", ["k"])
        folders.append(b.commit().entries)
        assert sorted(tuple(r) for r in Snapshot(spark, root).read("t").collect()) == sorted(tuple(r) for r in make(n).collect())
    parts = [{p: e for p, e in f["t"].items() if p >= 0} for f in folders]
    assert sum(parts[0][p] != parts[1][p] for p in parts[0]) == 1 and parts[1] == parts[2]
    assert len({f["fixed"][-1][0] for f in folders}) == 1
    assert len(os.listdir(f"{root}/manifests")) == 2  # older builds are gone
    b = Build(spark, root)
    b.put_parts(make(1).limit(0), "t", "k", ["k"])
    b.commit()
    assert Snapshot(spark, root).read("t").count() == 0
