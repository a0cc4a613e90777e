import pytest
from pyspark.sql import functions as F

from scriptloom.operators import relations as rel
from scriptloom.plans.build import Inputs, build
from scriptloom.plans.kb import KnowledgeBase
from scriptloom.sources import game, lines, sinks


@pytest.fixture(scope="module")
def kb(spark, mini, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("kb"))
    inputs = Inputs(str(mini), f"{mini}/sum", f"{mini}/alias.txt", f"{mini}/cur.jsonl", f"{mini}/rel", f"{mini}/relcur.jsonl", f"{mini}/dossier")
    report = {r.counter: r.value for r in build(spark, inputs, out).collect()}
    return KnowledgeBase(spark, out), report


def test_report(kb):
    _, r = kb
    assert (r["events"], r["stages"], r["chars"], r["skipped_nameless"]) == (3, 6, 2, 1)
    assert (r["deterministic_link_count"], r["storyset_warnings"]) == (1, 1)
    assert (r["relation_count"], r["relation_bake_count"], r["relation_curated_count"]) == (3, 2, 1)
    assert (r["entity_operator_count"], r["entity_curated_count"], r["entity_auto_seeded_count"], r["entity_curated_errors"]) == (2, 1, 1, 4)


def test_report_has_families_and_warnings(kb):
    k, r = kb
    assert (r["events_mainline"], r["events_activity"], r["events_other"], r["pruned_events"], r["relation_curated_errors"], r["entity_curated_warnings"]) == (1, 1, 0, 0, 2, 1)
    kinds = {}
    for w in k.table("warnings").collect():
        kinds.setdefault(w.kind, []).append((w.subject, w.detail))
    assert kinds["nameless character"] == [("char_003_none", None)] and kinds["link"] == [("char_001_lin nowhere", "missing")]
    assert ("河伯", "act_one") in kinds["unresolved summary name"] and len(kinds["curated entity row"]) == 4
    assert kinds["curated entity"] == [("林澈", "matches an operator alias")] and len(kinds["curated relation row"]) == 2


def test_containers(kb):
    k, _ = kb
    fam = {r.source_family: r.n_containers for r in k.list_families().collect()}
    assert fam == {"mainline": 1, "activity": 1, "mini_activity": 0, "operator_record": 1, "other": 0}
    assert [(r.stage_idx, r.name, r.tag) for r in k.event_stages("act_one").collect()] == [(0, "序章", "行动前"), (1, "序章", "行动后"), (2, "终章", None)]
    assert [r.name for r in k.event_stages("main_x").collect()] == ["零", "一"]
    text = k.get_stage_text("act_one", 0).first()[0]
    assert "<章节名称>序章（行动前）</章节名称>\n<章节简介>简介01</章节简介>\n<正文>\n林澈:早上好，博士。\n旁白:碑文\n旁白:山河\n博士（多个选择）:去;不去\n</正文>" in text
    assert k.get_event("act_one").first().stage_count == 3 and k.get_event("none").count() == 0
    assert k.list_events("activity").first().path_prefixes == ["activities/act_one"]
    assert k.get_stage_meta("act_one", 9).count() == 0


def test_entities_and_cards(kb):
    k, _ = kb
    lin = k.list_chars("yan").first()
    assert (lin.entity_id, lin.sections, lin.storyset_count) == ("char_001_lin", ["profile", "voice", "archive", "skins", "modules"], 1)
    card = k.get_card("char_001_lin").first()
    assert card.basic_info == {"代号": "林澈", "出身地": "山谷"} and card.objective_record == "履历"
    assert (card.skin_names, card.module_names, card.storysets[0].container_id) == (["新衣"], ["模"], "mem_a")
    assert k.get_char_section("char_001_lin", "voice").first().text == "<干员语音>\n你好\n再见\n</干员语音>\n"
    assert k.get_char_section("char_001_lin").first().text.startswith("<干员招聘文本>")
    assert k.char_storysets("char_001_lin").first().link_name == "往事"
    assert [r.status for r in k.resolve_operator_name("小林").collect()] == ["resolved"]
    assert [(r.status, r.entity_id) for r in k.resolve_operator_name("孤名").collect()] == [("missing", None)]
    assert k.resolve_entity("山君").first().status == "resolved"
    assert [r.name for r in k.list_entities("npc").collect()] == ["山神"]
    assert [r.entity_type for r in k.list_entities().collect()][:2] == ["operator", "operator"]
    assert k.get_entity_section("ent_76be2e").first().text == "档案一\n档案二"


def test_appearances(kb):
    k, _ = kb
    got = [(r.container_id, r.stage_idx, r.source, r.tier) for r in k.char_appearances("char_001_lin").collect()]
    assert got == [("act_one", 0, "participant", "speaker"), ("act_one", 0, "summary", "named"), ("act_one", 2, "participant", "named"), ("mem_a", 0, "deterministic", None)]
    w = {(r.container_id, r.stage_idx): r.tier for r in k.char_appearances("char_002_w", "participant").collect()}
    assert w == {("act_one", 1): "named", ("main_x", 1): "speaker"}
    assert {r.entity_id for r in k.event_chars("act_one").collect()} == {"char_001_lin", "char_002_w"}
    assert [r.entity_id for r in k.stage_chars("act_one", 1).collect()] == ["char_002_w"]
    grouped = {(r.container_id, r.stage_idx, r.source, r.n_edges) for r in k.group_by_event(k.char_appearances("char_001_lin")).collect()}
    assert grouped == {("act_one", 0, "participant", 3), ("act_one", 0, "summary", 3), ("act_one", 2, "participant", 3), ("mem_a", 0, "deterministic", 1)}
    pair = k.cooccurrence_between("char_002_w", "char_001_lin").first()
    assert (pair.co_stage_count, pair.co_container_count, pair.sample_containers) == (0, 1, ["act_one"])
    assert k.cooccurrence_top(1).count() == 1 and k.cooccurrence_for_char("char_002_w", 5).count() == 1
    god = k.list_entities("npc").first().entity_id
    assert [(r.container_id, r.stage_idx) for r in k.entity_appearances(god).collect()] == [("act_one", None)]


def test_relations_and_search(kb):
    k, _ = kb
    assert [r.notes for r in k.relations_between_entities("char_002_w", "char_001_lin").collect()] == ["新"]
    assert k.relations_for_entity("char_001_lin").count() == 3 and k.list_relations("rival_of").count() == 0
    assert [r[0] for r in k.relation_types().collect()] == ["ally_of"]
    assert k.grep_text("碑文", "events").first().container_id == "act_one"
    assert {r.source for r in k.grep_text("林澈").collect()} == {"chunk", "char_section", "event_summary"}
    assert "关键人物" in k.get_event_summary("act_one").first().text


def test_warnings(kb):
    k, _ = kb
    warned = k.table("curated_entity_warnings").first()
    assert (warned.name, warned.reason) == ("林澈", "matches an operator alias")
    reasons = [r.reason for r in k.table("curated_entity_errors").orderBy("line_no").collect()]
    assert reasons == ["invalid JSON", "not a JSON object", "missing/empty `name`", "entity_type not allowed: operator"]
    assert [r.reason for r in k.table("curated_relation_errors").orderBy("line_no").collect()] == ["missing/empty head", "missing key tail"]


def test_small_sources(spark, mini, tmp_path):
    assert [r.item_id for r in lines.id_list(spark, f"{mini}/ids.txt").collect()] == ["act_one", "main_x"]
    assert lines.id_list(spark, f"{mini}/nope").count() == 0
    assert [r.item_id for r in game.output_names(spark, f"{mini}/pages").collect()] == ["main_x"]
    assert game.data_version(spark, f"{mini}/version.txt").first().version == "v1"
    assert game.data_version(spark, f"{mini}/none").first().version == "unknown"
    aliases = lines.alias_rows(lines.file_lines(spark, f"{mini}/alias.txt"))
    assert [(r.canonical, r.alias) for r in aliases.orderBy("ord").collect()] == [("林澈", "小林"), ("林澈", "澈澈"), ("无主", "孤名")]
    beside = lines.names_beside(lines.file_lines(spark, f"{mini}/alias.txt"), "小林").first()
    assert beside.is_canonical is False
    assert lines.table_or_empty(spark, f"{mini}/none", "a string").count() == 0
    bad = spark.createDataFrame([("", "t", None)], "head string, type string, tail string")
    with pytest.raises(Exception, match="missing/empty head"):
        sinks.relation_lines(bad, str(tmp_path / "r"))
    sinks.name_list(spark.createDataFrame([("甲",)], "n string"), "n", str(tmp_path / "names"))
    assert spark.read.text(str(tmp_path / "names")).first()[0] == "甲"
    assert game.by_name(game.merged_entities(spark, str(mini))).filter(F.col("name") == "W").first().entity_id == "char_002_w"


def test_missing_script_fails(spark, mini, tmp_path):
    import shutil

    broken = tmp_path / "broken"
    shutil.copytree(mini / "zh_CN", broken / "zh_CN", ignore=shutil.ignore_patterns("y.txt"))
    with pytest.raises(Exception, match="no script file"):
        game.raw_chunks(spark, str(broken)).collect()


def test_folders_may_be_named_like_the_layout(spark, tmp_path):
    for name, text in (("chars/events/stages/chars/ent_1/profile.md", "p"), ("chars/events/events/act.md", "e"), ("chars/events/stages/act/03.md", "s")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    root = str(tmp_path / "chars/events")
    assert [tuple(r) for r in game.container_summaries(spark, root).collect()] == [("act", "e")]
    assert [tuple(r) for r in game.stage_summaries(spark, root).collect()] == [("act", 3, "s")]
    assert [tuple(r) for r in game.dossier_sections(spark, f"{root}/stages").collect()] == [("ent_1", "profile", "p")]


def test_candidates_of_baked_relations_stay(spark, tmp_path):
    (tmp_path / "chars").mkdir()
    (tmp_path / "chars/a.jsonl").write_text('{"head": "a", "type": "ally_of", "tail": null, "tail_name": "x", "ambiguous_candidates": ["b", "c"]}\n')
    baked = game.relation_files(spark, str(tmp_path))
    assert baked.first().ambiguous_candidates == ["b", "c"]
    over = baked.limit(0)
    assert rel.collate(baked, over).first().ambiguous_candidates == ["b", "c"]


def test_state_is_replaced_from_itself(spark, tmp_path):
    from scriptloom.operators import incremental as inc

    root, schema = str(tmp_path), "unit_id string, source_hash string"
    make = lambda *r: spark.createDataFrame(list(r), schema)
    assert sinks.state(spark, root, "units", schema).count() == 0
    sinks.replace_state(make(("a", "1"), ("b", "1")), root, "units")
    for n in ("2", "3", "4"):
        sinks.replace_state(inc.upsert_state(sinks.state(spark, root, "units", schema), make(("a", n))), root, "units")
    assert sorted(map(tuple, sinks.state(spark, root, "units", schema).collect())) == [("a", "4"), ("b", "1")]
    (tmp_path / "units/v00000009").mkdir()  # a version whose job broke off
    assert sinks.state(spark, root, "units", schema).count() == 2


def test_event_has_its_stages(kb):
    row = kb[0].get_event("act_one").first()
    assert [(s.stage_idx, s.name) for s in row.stages] == [(0, "序章"), (1, "序章"), (2, "终章")]
