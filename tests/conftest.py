import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scriptloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


def _put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture(scope="session")
def mini(tmp_path_factory):
    """A small source folder: three containers, six chunks, two named entities and every side input."""
    root = tmp_path_factory.mktemp("mini")
    excel, story = root / "zh_CN/gamedata/excel", root / "zh_CN/gamedata/story"
    stage = lambda name, txt, sort, info=None, tag=None: {
        "storyId": txt, "storySort": sort, "storyName": name, "storyInfo": info, "storyTxt": txt, "avgTag": tag}
    table = {
        "act_one": {"id": "act_one", "name": "山谷", "entryType": "ACTIVITY", "infoUnlockDatas": [
            stage("终章", "activities/act_one/03", 3),
            stage("序章", "activities/act_one/01", 1, "info/act_one/01", "行动前"),
            stage("序章", "activities/act_one/02", 2, "info/act_one/02", "行动后")]},
        "main_x": {"id": "main_x", "name": "主线", "entryType": "MAINLINE", "infoUnlockDatas": [
            stage("一", "obt/guide/x", 1), {"storyId": "s", "storyName": "零", "storyInfo": None, "storyTxt": "obt/main/y"}]},
        "mem_a": {"id": "mem_a", "name": "回忆", "entryType": "NONE", "infoUnlockDatas": [stage("忆", "obt/memory/a 1+2", 1)]},
    }
    chars = {
        "char_001_lin": {"name": "林澈", "appellation": "Lin", "itemUsage": "用途", "itemDesc": "描述", "nationId": "yan"},
        "char_002_w": {"name": "W", "appellation": "W", "itemUsage": None, "itemDesc": None, "nationId": None},
        "char_003_none": {"name": None, "appellation": None, "itemUsage": None, "itemDesc": None, "nationId": None},
        "token_skip": {"name": "跳过", "appellation": "Skip", "itemUsage": "", "itemDesc": "", "nationId": None},
    }
    book = {"handbookDict": {"a": {"charID": "char_001_lin", "storyTextAudio": [
        {"storyTitle": "基础档案", "stories": [{"storyText": "【代号】林澈"}, {"storyText": "【出身地】\n山谷"}]},
        {"storyTitle": "客观履历", "stories": [{"storyText": " 履历 "}]}],
        "handbookAvgList": [
            {"storySetName": "往事", "avgList": [{"storyTxt": "obt/memory/a 1+2", "storyInfo": "info/act_one/01"}]},
            {"storySetName": "丢失", "avgList": [{"storyTxt": "nowhere", "storyInfo": "info/act_one/01"}]}]}}}
    words = {"charWords": {"k1": {"charId": "char_001_lin", "voiceText": "你好"}}, "charExtraWords": {"k2": {"charId": "char_001_lin", "voiceText": "再见"}}}
    skins = {"charSkins": {"char_001_lin@1": {"charId": "char_001_lin", "displaySkin": {"skinName": "新衣", "dialog": "d", "usage": "u", "description": "好看"}},
                           "char_001_lin@2": {"charID": "char_001_lin", "displaySkin": {"skinName": "旧衣", "dialog": "d", "usage": "u", "description": None}}}}
    mods = {"equipDict": {"m1": {"charId": "char_001_lin", "uniEquipName": "模", "uniEquipDesc": "块"}, "m2": {"charId": "char_001_lin", "uniEquipName": "空", "uniEquipDesc": None}}}
    for name, doc in [("story_review_table", table), ("character_table", chars), ("handbook_info_table", book),
                      ("charword_table", words), ("skin_table", skins), ("uniequip_table", mods)]:
        _put(excel / f"{name}.json", json.dumps(doc, ensure_ascii=False))
    scripts = {
        "activities/act_one/01": '[HEADER(key="t")]\r\n[name="林澈"]早上好，{@nickname}。\r\n[Sticker(id="s", text="碑文\\n 山河 ")]\r\n[Decision(options="去;不去", values="0;1")]\r\n',
        "activities/act_one/02": "World里没有她。\nW走出帐篷，又见到W。\n",
        "activities/act_one/03": "林澈走了。\n[Dialog]\n",
        "obt/guide/x": '[multiline(name="W",end=true)]走吧\n[Subtitle(text="夜", x=1)]\n',
        "obt/main/y": "无人\n", "obt/memory/a 1+2": "林澈的回忆\n",
    }
    for key, text in scripts.items():
        (story / key).parent.mkdir(parents=True, exist_ok=True)
        (story / f"{key}.txt").write_bytes(text.encode())
    for n in ("01", "02"):
        _put(story / f"[uc]info/act_one/{n}.txt", f"简介{n}")
    _put(root / "alias.txt", "林澈;小林; 澈澈 ;小林\n\n无主;孤名\n")
    md = "---\nevent_id: x\n---\n\n<关键人物>\n“林澈”;山神；W\n</关键人物>\n"
    _put(root / "sum/events/act_one.md", md)
    _put(root / "sum/stages/act_one/00.md", "<关键人物>小林;河伯</关键人物>")
    _put(root / "sum/stages/act_one/notes.md", "<关键人物>略</关键人物>")
    _put(root / "cur.jsonl", '# note\n{"name": "山神", "entity_type": "npc", "aliases": ["山君", "山神"]}\n{"name": "林澈"}\n{bad\n["x"]\n{"entity_type": "npc"}\n{"name": "q", "entity_type": "operator"}\n')
    _put(root / "rel/chars/char_001_lin.jsonl", '{"head": "char_001_lin", "type": "ally_of", "tail": "char_002_w", "tail_name": "W", "notes": "旧"}\n{"head": "char_001_lin", "type": "ally_of", "tail": null, "tail_name": "某甲"}\n{"head": "char_001_lin", "type": "ally_of", "tail": null, "tail_name": "某乙"}\n')
    _put(root / "relcur.jsonl", '{"head": "char_001_lin", "type": "ally_of", "tail": "char_002_w", "tail_name": "W", "notes": "新"}\n{"head": "", "type": "x", "tail": null}\n{"head": "a", "type": "x"}\n')
    _put(root / "dossier/chars/ent_76be2e/profile.md", "档案一")
    _put(root / "dossier/chars/ent_76be2e/voice_about.md", "档案二")
    _put(root / "version.txt", " v1 \n")
    for f in ("main_x.txt", "prompt_a.txt", "depre_b.txt", "c.md"):
        _put(root / "pages" / f, "x")
    _put(root / "ids.txt", "act_one\n\n main_x \n")
    return root
