"""Readers of the nested source tables and loose text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptloom.functions import text as tx
from scriptloom.sources.lines import exists

# File layout and record shapes of the source data.
EXCEL = "zh_CN/gamedata/excel"
STORY = "zh_CN/gamedata/story"
STORY_TABLE = """map<string,struct<id:string,name:string,entryType:string,infoUnlockDatas:array<struct<
  storyId:string,storySort:int,storyName:string,storyInfo:string,storyTxt:string,avgTag:string>>>>"""
CHARACTER_TABLE = "map<string,struct<name:string,appellation:string,itemUsage:string,itemDesc:string,nationId:string>>"
WORD_TABLE = """struct<charWords:map<string,struct<charId:string,voiceText:string>>,
  charExtraWords:map<string,struct<charId:string,voiceText:string>>>"""
HANDBOOK_TABLE = """struct<handbookDict:map<string,struct<charId:string,
  storyTextAudio:array<struct<storyTitle:string,stories:array<struct<storyText:string>>>>,
  handbookAvgList:array<struct<storySetName:string,avgList:array<struct<storyTxt:string,storyInfo:string>>>>>>>"""
SKIN_TABLE = """struct<charSkins:map<string,struct<charId:string,
  displaySkin:struct<skinName:string,dialog:string,usage:string,description:string>>>>"""
MODULE_TABLE = """struct<equipDict:map<string,struct<charId:string,uniEquipName:string,uniEquipDesc:string>>>"""
INFO_PREFIX = "[uc]"


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file, parsed strictly into column `d`.

    The owner key comes in two spellings that Spark's field names cannot tell apart, so the rarer one
    is rewritten. An unescaped quote before the key cannot be part of a JSON string.
    """
    text = F.regexp_replace("value", r'"charID"(\s*:)', '"charId"$1')
    return spark.read.text(path, wholetext=True).select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("d"))


def _at(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{EXCEL}/{name}.json"


def _unique(df: DataFrame, key: str) -> DataFrame:
    """Fail on a repeated key. The count shares the grouping any later join on the key needs."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    once = F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"repeated {key}: "), key))
    return df.join(counts, key).filter(once.isNull()).drop("_n")


def stages(spark: SparkSession, root: str) -> DataFrame:
    """One row per stage, in `storySort` order (absent sorts as 0, ties keep file order)."""
    d = document(spark, _at(root, "story_review_table"), STORY_TABLE)
    events = _unique(d.select(F.explode("d").alias("k", "e")).select("e.*"), "id")
    ranked = F.array_sort(
        F.transform(
            "infoUnlockDatas",
            lambda s, i: F.struct(F.coalesce(s["storySort"], F.lit(0)).alias("sort"), i.alias("ord"), s.alias("s")),
        )
    )
    rows = events.select(
        F.col("id").alias("container_id"), F.col("name").alias("container_name"),
        F.col("entryType").alias("entry_type"), F.posexplode(ranked).alias("pos", "r"),
    )
    return rows.select(
        "container_id", "container_name", "entry_type", F.col("pos").cast("bigint").alias("stage_idx"),
        F.col("r.s.storyName").alias("name"), F.col("r.s.avgTag").alias("tag"),
        F.col("r.s.storyInfo").alias("info_key"), F.col("r.s.storyTxt").alias("path"),
    )


def containers(spark: SparkSession, root: str) -> DataFrame:
    d = document(spark, _at(root, "story_review_table"), STORY_TABLE)
    events = d.select(F.explode("d").alias("k", "e")).select("e.*")
    ranked = F.array_sort(
        F.transform("infoUnlockDatas", lambda s, i: F.struct(F.coalesce(s["storySort"], F.lit(0)), i, s["storyTxt"].alias("t")))
    )
    first = F.coalesce(F.get(ranked, F.lit(0))["t"], F.lit(""))
    paths = F.transform("infoUnlockDatas", lambda s: tx.path_prefix(s["storyTxt"]))
    return events.select(
        F.col("id").alias("container_id"), "name", F.col("entryType").alias("entry_type"),
        tx.source_family(first, "entryType").alias("source_family"),
        F.array_sort(F.array_distinct(F.filter(paths, lambda p: p != ""))).alias("path_prefixes"),
    )


def file_key(spark: SparkSession, root: str) -> Column:
    """Path below the folder `root` without its suffix. Paths arrive percent-encoded; a plus sign is itself.

    The root is cut off as the file system qualifies it, so it may hold folders of any name.
    """
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    bare = lambda p: F.regexp_replace(p, r"\A[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    below = F.substring(bare(path), F.length(bare(F.lit(whole.rstrip("/")))) + 2, F.lit(1 << 30))
    return F.regexp_replace(below, r"\.[A-Za-z0-9]+\z", "")


def texts(spark: SparkSession, root: str) -> DataFrame:
    """(text_key, text) of every story file, line ends as in text mode."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    folder = f"{root.rstrip('/')}/{STORY}"
    files = read.text(folder, wholetext=True)
    return files.select(file_key(spark, folder).alias("text_key"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def _needed(value: Column, key: Column, what: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"no {what} file: "), key)))


def raw_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Stages with their raw script and info text; a stage whose file is missing fails the build."""
    t = texts(spark, root)
    scripts = t.select(F.col("text_key").alias("path"), F.col("text").alias("raw"), F.lit(True).alias("_has"))
    infos = t.filter(F.col("text_key").startswith(INFO_PREFIX)).select(
        F.expr(f"substring(text_key, {len(INFO_PREFIX) + 1})").alias("info_key"), F.col("text").alias("info")
    )
    joined = stages(spark, root).join(scripts, "path", "left").join(infos, "info_key", "left")
    info = F.when(F.col("info_key").isNull(), "").otherwise(_needed(F.col("info"), F.col("info_key"), "info"))
    return joined.select(
        "container_id", "container_name", "entry_type", "stage_idx", "name", "tag", "path",
        info.alias("info"), _needed(F.col("raw"), F.col("path"), "script").alias("raw"),
    )


# ---- entities -----------------------------------------------------------------------------------


def character_rows(spark: SparkSession, root: str) -> DataFrame:
    d = document(spark, _at(root, "character_table"), CHARACTER_TABLE)
    rows = d.select(F.explode("d").alias("entity_id", "c")).filter(F.col("entity_id").startswith("char"))
    return rows.select(
        "entity_id", "c.name", "c.appellation", F.col("c.itemUsage").alias("usage"),
        F.col("c.itemDesc").alias("item_desc"), F.col("c.nationId").alias("nation_id"),
    )


def voice_rows(spark: SparkSession, root: str) -> DataFrame:
    """Voice lines per entity in file order; the two source maps follow each other."""
    d = document(spark, _at(root, "charword_table"), WORD_TABLE)
    part = lambda name, rank: d.select(F.posexplode(f"d.{name}").alias("ord", "k", "w")).select(
        F.col("w.charId").alias("entity_id"), F.struct(F.lit(rank).alias("r"), "ord", F.col("w.voiceText").alias("t")).alias("x")
    )
    both = part("charWords", 0).unionByName(part("charExtraWords", 1))
    return both.groupBy("entity_id").agg(
        F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]).alias("words")
    )


def handbook_rows(spark: SparkSession, root: str) -> DataFrame:
    d = document(spark, _at(root, "handbook_info_table"), HANDBOOK_TABLE)
    h = d.select(F.explode("d.handbookDict").alias("k", "h")).select("h.*")
    told = F.transform(
        "storyTextAudio",
        lambda s: F.struct(
            s["storyTitle"].alias("title"),
            F.array_join(F.transform(s["stories"], lambda t: t["storyText"]), "\n").alias("text"),
        ),
    )
    titles = F.array_distinct(F.transform(told, lambda s: s["title"]))
    last = F.transform(titles, lambda t: F.element_at(F.filter(told, lambda s: s["title"] == t), -1))
    sets = F.transform(
        "handbookAvgList",
        lambda s: F.struct(
            s["storySetName"].alias("link_name"), F.element_at(s["avgList"], 1)["storyTxt"].alias("link_key"),
            F.element_at(s["avgList"], 1)["storyInfo"].alias("info_key"),
        ),
    )
    rows = h.select(F.col("charId").alias("entity_id"), last.alias("stories"), sets.alias("storysets"))
    return _unique(rows, "entity_id")


def skin_rows(spark: SparkSession, root: str) -> DataFrame:
    d = document(spark, _at(root, "skin_table"), SKIN_TABLE)
    rows = d.select(F.posexplode("d.charSkins").alias("ord", "k", "s")).filter(F.col("k").startswith("char"))
    return _listed(rows, "s", "skins", F.col("s.displaySkin"))


def module_rows(spark: SparkSession, root: str) -> DataFrame:
    d = document(spark, _at(root, "uniequip_table"), MODULE_TABLE)
    rows = d.select(F.posexplode("d.equipDict").alias("ord", "k", "s"))
    shape = F.struct(F.col("s.uniEquipName").alias("name"), F.col("s.uniEquipDesc").alias("desc"))
    return _listed(rows, "s", "modules", shape)


def _listed(rows: DataFrame, record: str, out: str, value: Column) -> DataFrame:
    pairs = rows.select(F.col(f"{record}.charId").alias("entity_id"), F.struct("ord", value.alias("v")).alias("x"))
    return pairs.groupBy("entity_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["v"]).alias(out))


def merged_entities(spark: SparkSession, root: str) -> DataFrame:
    """Full outer merge of the five entity tables by id; nameless rows are kept here."""
    out = character_rows(spark, root)
    for part in (voice_rows, handbook_rows, skin_rows, module_rows):
        out = out.join(part(spark, root), "entity_id", "full_outer")
    return out


def by_name(entities: DataFrame) -> DataFrame:
    """name -> entity_id over named rows; of several the last id wins, as ids have no other order."""
    return entities.filter(F.col("name") != "").groupBy("name").agg(F.max("entity_id").alias("entity_id"))


# ---- other inputs ---------------------------------------------------------------------------------


def data_version(spark: SparkSession, path: str) -> DataFrame:
    """One row with the stripped version text, `unknown` without a file."""
    if not exists(spark, path):
        return spark.createDataFrame([("unknown",)], "version string")
    return spark.read.text(path, wholetext=True).select(tx.strip("value").alias("version"))


def _markdown(spark: SparkSession, path: str) -> DataFrame | None:
    if not exists(spark, path):
        return None
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md")
    files = read.text(path, wholetext=True)
    return files.select(file_key(spark, path).alias("k"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def container_summaries(spark: SparkSession, root: str) -> DataFrame:
    files = _markdown(spark, f"{root.rstrip('/')}/events")
    if files is None:
        return spark.createDataFrame([], "container_id string, text string")
    return files.select(F.col("k").alias("container_id"), "text")


def stage_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Chunk summaries; files whose stem is no number are skipped."""
    files = _markdown(spark, f"{root.rstrip('/')}/stages")
    if files is None:
        return spark.createDataFrame([], "container_id string, stage_idx bigint, text string")
    parts = F.split("k", "/")
    rows = files.select(parts[0].alias("container_id"), F.expr("try_cast(split(k, '/')[1] AS BIGINT)").alias("stage_idx"), "text")
    return rows.filter("stage_idx is not null")


def dossier_sections(spark: SparkSession, root: str) -> DataFrame:
    """Hand-kept sections per entity: (entity_id, section, text)."""
    files = _markdown(spark, f"{root.rstrip('/')}/chars")
    if files is None:
        return spark.createDataFrame([], "entity_id string, section string, text string")
    parts = F.split("k", "/")
    return files.select(parts[0].alias("entity_id"), parts[1].alias("section"), "text")


def output_names(spark: SparkSession, path: str) -> DataFrame:
    """Stems of existing `.txt` outputs without drafts and retired ones; contents are not read."""
    if not exists(spark, path):
        return spark.createDataFrame([], "item_id string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path")
    name = F.regexp_extract(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), r"([^/]*)\.txt\z", 1)
    return files.select(name.alias("item_id")).filter(
        ~F.col("item_id").startswith("prompt_") & ~F.col("item_id").startswith("depre")
    )


def relation_files(spark: SparkSession, root: str) -> DataFrame:
    """Baked relation rows with their order: file name, then line."""
    from scriptloom.sources.lines import RELATION_LINE

    path = f"{root.rstrip('/')}/chars"
    schema = ("head string, type string, tail string, tail_name string, notes string, "
              "ambiguous_candidates array<string>, seq struct<file:string,pos:int>")
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    whole = spark.read.option("pathGlobFilter", "*.jsonl").text(path, wholetext=True)
    lines = whole.select(file_key(spark, path).alias("file"), F.posexplode(tx.lines("value")).alias("pos", "line"))
    kept = lines.filter(tx.strip("line") != "")
    parsed = kept.select("file", "pos", F.from_json("line", RELATION_LINE, {"mode": "FAILFAST"}).alias("p"),
                         F.array_contains(F.json_object_keys("line"), "tail").alias("has_tail"))
    rows = parsed.select("p.*", F.struct("file", "pos").alias("seq"), "has_tail")
    from scriptloom.operators.relations import row_problem

    problem = row_problem(rows)
    checked = rows.filter(F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean")))
    return checked.drop("has_tail")
