"""Entity sections and fact cards. One row per entity in, narrow expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scriptloom.functions import text as tx

# Archive titles holding field blocks, and the source of each card field.
BASIC, EXAM, OBJECTIVE = "基础档案", "综合体检测试", "客观履历"
CARD_SOURCES = {
    "name": "character_table",
    "appellation": "character_table",
    "nationId": "character_table",
    "basic_info": "handbook_info_table:基础档案",
    "physical_exam": "handbook_info_table:综合体检测试",
    "objective_record": "handbook_info_table:客观履历",
    "archive_sections": "handbook_info_table:storyTextAudio titles",
    "skin_names": "skin_table",
    "module_names": "uniequip_table",
    "storysets": "handbook_info_table:handbookAvgList + story_review_table",
}


def section_texts(e: DataFrame) -> DataFrame:
    """(entity_id, section, text), empty sections left out.

    Columns: usage, item_desc, nation_id, words, stories, skins, modules.
    """
    texts = {
        "profile": tx.profile_section("usage", "item_desc", "nation_id"),
        "voice": tx.voice_section("words"),
        "archive": tx.archive_section("stories"),
        "skins": tx.skins_section("skins"),
        "modules": tx.modules_section("modules"),
    }
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("section"), v.alias("text")) for k, v in texts.items()]))
    return e.select("entity_id", long.alias("s")).select("entity_id", "s.section", "s.text").filter("text is not null")


def section_rank(section: str = "section"):
    return F.array_position(F.array(*[F.lit(s) for s in tx.SECTIONS]), F.col(section))


def all_sections(sections: DataFrame) -> DataFrame:
    """Every section of an entity in fixed order as one text; at most five parts per entity."""
    parts = F.array_sort(F.collect_list(F.struct(section_rank().alias("r"), "text")))
    return sections.groupBy("entity_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))


def fact_card(e: DataFrame) -> DataFrame:
    story = lambda title: F.get(F.filter("stories", lambda s: s["title"] == title), F.lit(0))["text"]
    fields = lambda title: tx.as_map(tx.bracket_fields(story(title)))
    record = tx.strip(story(OBJECTIVE))
    named = lambda items, name, shown: F.transform(
        F.filter(items, lambda s: s[shown].isNotNull() & (F.coalesce(s[name], F.lit("")) != "")), lambda s: s[name]
    )
    sources = F.create_map(*[F.lit(x) for kv in CARD_SOURCES.items() for x in kv])
    return e.select(
        "entity_id", "name", "appellation", "nation_id",
        fields(BASIC).alias("basic_info"), fields(EXAM).alias("physical_exam"),
        F.when(record != "", record).alias("objective_record"),
        F.transform("stories", lambda s: s["title"]).alias("archive_sections"),
        named("skins", "skinName", "description").alias("skin_names"),
        named("modules", "name", "desc").alias("module_names"),
        *([F.col("storysets")] if "storysets" in e.columns else []),
        sources.alias("sources"),
    )


def dossiers(e: DataFrame) -> DataFrame:
    """Whole-entity text for request documents: (entity_id, name, dossier)."""
    wrap = lambda tag, body: F.concat(F.lit(f"\n<{tag}>\n"), body, F.lit(f"\n</{tag}>"))
    hired = wrap("干员招聘文本", F.concat(tx.or_none(F.col("usage")), F.lit("\n"), tx.or_none(F.col("item_desc"))))
    voice = F.when(F.col("words").isNotNull(), wrap("干员语音", F.array_join("words", "\n")))
    told = F.transform("stories", lambda s: F.concat(s["title"], F.lit(":"), s["text"]))
    archive = F.when(F.col("stories").isNotNull(), wrap("干员档案", F.array_join(told, "\n")))
    text = F.concat_ws(
        "\n", F.lit("<干员信息>"), F.concat(F.lit("<干员名称>\n"), "name", F.lit("</干员名称>")),
        hired, voice, archive,
        _listed("skins", "干员皮肤", "description", lambda s: F.concat(
            F.lit("名称:"), tx.or_none(s["skinName"]), F.lit("\t描述:"), tx.or_none(s["dialog"]),
            F.lit("\t用途:"), tx.or_none(s["usage"]), F.lit("\t旁白:"), s["description"])),
        _listed("modules", "干员模组", "desc", lambda m: F.concat(
            F.lit("<模组名称>"), tx.or_none(m["name"]), F.lit("</模组名称>\n<模组描述>\n"), m["desc"],
            F.lit("\n</模组描述>\n"))),
        F.lit("</干员信息>"),
    )
    return e.filter(F.col("name").isNotNull()).select("entity_id", "name", text.alias("dossier"))


def _listed(items: str, tag: str, shown: str, line):
    rows = F.transform(F.filter(items, lambda s: s[shown].isNotNull()), line)
    return F.when(
        F.col(items).isNotNull(), F.concat_ws("\n", F.lit(f"\n<{tag}>"), rows, F.lit(f"</{tag}>"))
    )


def request_parts(entities: DataFrame, aliases: DataFrame, dossiers: DataFrame, parts: DataFrame) -> DataFrame:
    """Entity request document as ordered parts (entity_id, block, ord, text).

    Block 0 names the entity and its aliases, block 1 holds the dossier of every alias that is a known
    name (ord: the alias's rank), block 2 the container parts as tag pairs. aliases: entity_id, alias, ord. dossiers: name,
    dossier. parts: entity_id, ord, title, text. Parts stay rows, so no entity is gathered in one task.
    """
    listed = F.array_sort(F.collect_list(F.struct("ord", "alias")))
    names = aliases.groupBy("entity_id").agg(F.transform(listed, lambda p: p["alias"]).alias("_n"))
    head = entities.join(names, "entity_id").select(
        "entity_id", F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("ord"),
        F.concat(F.lit("名称:"), "name", F.lit("\n已知其他名称(可能有更多):"), F.array_join("_n", ";")).alias("text"),
    )
    ranked = names.select("entity_id", F.posexplode("_n").alias("ord", "alias"))
    known = ranked.join(dossiers.withColumnRenamed("name", "alias"), "alias").select(
        "entity_id", F.lit(1).alias("block"), F.col("ord").cast("bigint").alias("ord"), F.col("dossier").alias("text")
    )
    told = parts.select(
        "entity_id", F.lit(2).alias("block"), F.col("ord").cast("bigint").alias("ord"),
        F.concat(F.lit("<活动名称>"), "title", F.lit("</活动名称>\n<相关内容>\n"), "text", F.lit("\n</相关内容>\n\n")).alias("text"),
    )
    return head.unionByName(known).unionByName(told)


def unknown_aliases(aliases: DataFrame, dossiers: DataFrame) -> DataFrame:
    """Aliases without a dossier of their own."""
    return aliases.select("entity_id", "alias").join(dossiers.select(F.col("name").alias("alias")), "alias", "left_anti")
