import hashlib

import pytest
from pyspark.sql import functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "t string").select(*cols).first()


def test_clean_script(spark):
    raw = (
        '[HEADER(key="title_test", is_skippable=true)]\n[Dialog]\n[name="甲"]早上好，{@nickname}。\n\n'
        '[Sticker(id="st1", text="碑文\\n  山河 \\n")]\n[Sticker(id="st1")]\n[multiline(name="乙",end=true)]走\n'
        '[Decision(options="同意;拒绝", values="0;1")]\n[Subtitle(text="夜", x=1)]\n  [Delay(time=1)]  \n旁白文字[a]'
    )
    want = "甲:早上好，博士。\n旁白:碑文\n旁白:山河\n乙:走\n博士（多个选择）:同意;拒绝\n旁白:夜\n旁白文字[a]"
    assert one(spark, raw, tx.clean_script("t"))[0] == want


@pytest.mark.parametrize("path,kind,want", [
    ("obt/guide/beg/0", "MAINLINE", "mainline"), ("obt/main/x", "NONE", "mainline"), ("obt/memory/x", "NONE", "operator_record"),
    ("activities/a/b", "ACTIVITY", "activity"), ("activities/a/b", "MINI_ACTIVITY", "mini_activity"), ("activities/a", "NONE", "other"),
    ("\\obt\\main\\x", "NONE", "mainline"), ("/obt/memory/x", "NONE", "operator_record"), ("", "ACTIVITY", "other"), (None, "NONE", "other")])
def test_family(spark, path, kind, want):
    assert one(spark, path, tx.source_family("t", F.lit(kind)))[0] == want


def test_paths_and_slugs(spark):
    assert one(spark, "\\a/b\\c", tx.normal_path("t"), tx.path_prefix("t"))[:] == ("a/b/c", "a/b")
    assert one(spark, "Ab_1.x", tx.safe_slug("t"))[0] == "Ab_1.x"
    assert one(spark, "博士", tx.safe_slug("t"), tx.entity_id("t"))[:] == ("76be2e", "ent_76be2e")
    want = hashlib.sha256("序章_行动前".encode()).hexdigest()[:6]
    assert one(spark, "序章", tx.chunk_file(F.lit(3), "t", F.lit("行动前")))[0] == f"stage_03_{want}.txt"


@pytest.mark.parametrize("body,alias,n", [
    ("World wide", "W", 0), ("W走出帐篷，又见到W。", "W", 2), ("THRM-EX走来。后来THRM-EX离开。", "THRM-EX", 2), ("THRM-EX25型号。", "THRM-EX", 0),
    ("今年的年", "年", 2), ("哈哈哈", "哈哈", 1), ("a-a-a", "a-a", 1)])
def test_mention_count(spark, body, alias, n):
    df = spark.createDataFrame([(body, alias)], "b string, a string")
    assert df.select(tx.mention_count("b", "a")).first()[0] == n


def test_alias_mode(spark):
    got = [one(spark, t, tx.alias_mode("t"))[0] for t in ("W", "THRM-EX", "年", "阿米娅")]
    assert got == ["ascii", "ascii", "cjk_single", "cjk_multi"]


@pytest.mark.parametrize("line,want", [("甲:你好", "甲"), ("Mr. Nothing ：好", "Mr. Nothing"), ("无冒号", None), (" 甲:x", None), ("<a>:x", None), ("今年的事:x", "今年的事")])
def test_speaker(spark, line, want):
    assert one(spark, line, tx.speaker("t"))[0] == want


def test_lines(spark):
    text = "a\r\nb\x0bc\u2028d\x85e\x1ef\n"
    assert one(spark, text, tx.lines("t"))[0] == text.splitlines()
    assert one(spark, "", tx.lines("t"))[0] == []
    assert one(spark, "\u3000 x \x1f\xa0", tx.strip("t"))[0] == "x"


def test_bracket_fields(spark):
    got = one(spark, "垃圾\n【a】 1\n【b】\n 第一行 \n\n第二行\n【a】2", tx.bracket_fields("t"))[0]
    assert [(r["field"], r["value"]) for r in got] == [("a", "2"), ("b", "第一行\n第二行")]
    assert one(spark, None, tx.bracket_fields("t"))[0] == []


@pytest.mark.parametrize("text,missing,parts", [
    ("<a>first</a>\n<b>second value", [], ["<a>\nfirst\n</a>", "<b>\nsecond value\n</b>"]),
    ("【a】one【/a】\n【b】two【/b】", [], ["<a>\none\n</a>", "<b>\ntwo\n</b>"]),
    ("< a >one</ a >\n< b >two</ b >", [], ["<a>\none\n</a>", "<b>\ntwo\n</b>"]),
    ("<a>summary</a>\n**b**\nv1；v2", [], ["<b>\nv1；v2\n</b>"]),
    ("<a>x</a>\nb：alpha；beta", [], ["<b>\nalpha；beta\n</b>"]),
    ("<a>b 在这一章里出场了</a>", ["b"], ["<a>"]), ("<a>only a</a>", ["b"], [])])
def test_repair(spark, text, missing, parts):
    fixed, lost = one(spark, text, *tg.repaired("t", ["a", "b"]))
    assert lost == missing and all(p in fixed for p in parts)


def test_clean_tags_stay(spark):
    text = "<a>1</a>\n<b>2</b>"
    assert one(spark, text, *tg.repaired("t", ["a", "b"]))[:] == (text, [])
    assert one(spark, text, tg.rebuild("t", ["b", "a"]))[0] == "<b>\n2\n</b>\n\n<a>\n1\n</a>\n"
    assert one(spark, text, tg.rebuild("t", ["a", "c"]))[0] is None


def test_key_names(spark):
    assert one(spark, "<关键人物>“甲”;乙；甲; 「丙」 ;</关键人物>", tg.key_names("t"))[0] == ["甲", "乙", "丙"]
    assert one(spark, "none", tg.key_names("t"))[0] == []
    assert one(spark, "[关键人物]甲;甲;“乙”[/关键人物]", tg.raw_key_names("t"))[0] == ["甲", "甲", "“乙”"]


def test_relation_lines(spark):
    got = one(spark, "<关系>\n# c\n\nally_of;甲;友;人\nrival_of ; 乙 \nbroken\n</关系>", tg.relation_lines("t"))[0]
    assert [(r.line_no, r.type, r.tail_name, r.notes, r.reason) for r in got] == [
        (3, "ally_of", "甲", "友;人", None), (4, "rival_of", "乙", None, None), (5, None, None, None, "unparseable line")]
    assert one(spark, "<关系>\n无\n</关系>", tg.relation_lines("t"))[0] == []


def test_link_line(spark):
    df = lambda t, link=None: one(spark, t, tx.key_value_line("t", F.lit(link)))[0]
    assert df("**甲**：乙") == "-   **甲**：乙"
    assert df("甲: 乙", "[甲](x)") == "-   **[甲](x)**: 乙"
    assert df("无键") == "-   无键"
    assert df(":x") == "-   :x"


def test_sections(spark):
    shape = "usage string, item_desc string, nation_id string, words array<string>, skins array<struct<skinName:string,dialog:string,usage:string,description:string>>"
    df = spark.createDataFrame([("u", None, "yan", ["a", "b"], [("s", None, "u", None)]), (None, "", None, [], None)], shape)
    rows = df.select(tx.profile_section("usage", "item_desc", "nation_id"), tx.voice_section("words"), tx.skins_section("skins")).collect()
    assert rows[0][:] == ("<干员招聘文本>\nu\n</干员招聘文本>\n<国家>yan</国家>\n", "<干员语音>\na\nb\n</干员语音>\n", None)
    assert rows[1][:] == (None, None, None)
