"""Column builders for line handling, script cleaning, naming and paths. No UDFs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# White space and line ends as the source corpus treats them, protagonist and
# narrator names, and the cleaning patterns for script directives. `\p{Alnum}` is the ASCII class;
# unlike a negated list of ranges it lets many threads match at full speed in one JVM.
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\p{Z}]"
LINE_END = r"\R|[\x1c-\x1e]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PROTAGONIST_MARK = "{@nickname}"
PROTAGONIST = "博士"
CHOICE_LABEL = "博士（多个选择）:"
NARRATOR_LABEL = "旁白:"
DECISION = rf'(?d)\[Decision\(options="(.*?)",{WS}*values=".*?"\)\]'
SUBTITLE = r'(?d)\[Subtitle\(text="(.*?)"(?:,.*?)?\)\]'
STICKER = r'(?d)\[Sticker\([^\]]*?text="(.*?)"[^\]]*?\)\]'
DIALOGUE = r'(?dm)^\[(?:multiline\()?name="([^"]+)"(?:,end=true)?\)?\](.*)$'
DIRECTIVE_LINE = rf"(?dm)^{WS}*\[[^\]]*\]{WS}*$"
SPEAKER = r"^([^\t\n\x0b\x0c\r\x1c-\x1f \x85\p{Z}<>:：][^<>:：]*?)" + WS + r"*[:：]"

FAMILIES = ("mainline", "activity", "mini_activity", "operator_record", "other")
SECTIONS = ("profile", "voice", "archive", "skins", "modules")

MULTI_PASS_LENGTH = 80_000
MULTI_PASS_STAGES = 10
SNIPPET_LENGTH = 200


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str, chars: str = WS_CHARS) -> Column:
    return F.btrim(col(c), F.lit(chars))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(WS_CHARS))


def lines(c: Column | str) -> Column:
    """Lines without their ends; a final line end opens no extra line and empty text has none."""
    parts = F.split(col(c), LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once: functions with lambdas would compute it at each mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nonblank(parts: Column) -> Column:
    return F.filter(parts, lambda x: strip(x) != "")


def clean_script(c: Column | str) -> Column:
    """Raw script with bracket directives -> `name:text` lines."""

    def narration(body: Column) -> Column:
        pieces = F.transform(F.split(body, r"\\n", -1), lambda p: strip(p))
        kept = F.filter(pieces, lambda p: p != "")
        return F.array_join(F.transform(kept, lambda p: F.concat(F.lit(NARRATOR_LABEL), p)), "\n")

    def with_stickers(t: Column) -> Column:
        between = F.split(t, STICKER, -1)
        woven = bound(F.regexp_extract_all(t, F.lit(STICKER), F.lit(1)), lambda bodies: F.transform(
            between, lambda p, i: F.concat(p, F.coalesce(narration(F.get(bodies, i)), F.lit("")))
        ))
        return F.when(t.contains("[Sticker("), F.array_join(woven, "")).otherwise(t)

    text = F.replace(col(c), F.lit(PROTAGONIST_MARK), F.lit(PROTAGONIST))
    text = F.regexp_replace(text, DECISION, CHOICE_LABEL + "$1")
    text = F.regexp_replace(text, SUBTITLE, NARRATOR_LABEL + "$1")
    text = bound(text, with_stickers)
    text = F.regexp_replace(text, DIALOGUE, "$1:$2")
    text = F.regexp_replace(text, DIRECTIVE_LINE, "")
    return strip(F.array_join(nonblank(bound(text, lines)), "\n"))


def speaker(line: Column | str) -> Column:
    """Name before the first colon of a dialogue line, or null."""
    name = strip(F.regexp_extract(col(line), SPEAKER, 1))
    has_colon = col(line).contains(":") | col(line).contains("：")
    return F.when(has_colon & (name != ""), name)


def hex6(c: Column | str) -> Column:
    return F.substring(F.sha2(F.encode(col(c), "UTF-8"), 256), 1, 6)


def safe_slug(c: Column | str) -> Column:
    return F.when(col(c).rlike(r"\A[a-zA-Z0-9_.]+\z"), col(c)).otherwise(hex6(c))


def entity_id(name: Column | str) -> Column:
    return F.concat(F.lit("ent_"), hex6(name))


def normal_path(c: Column | str) -> Column:
    return F.regexp_replace(F.translate(F.coalesce(col(c), F.lit("")), "\\", "/"), "^/+", "")


def path_prefix(c: Column | str) -> Column:
    return F.substring_index(normal_path(c), "/", 2)


def source_family(path: Column | str, entry_type: Column | str) -> Column:
    norm, kind = normal_path(path), col(entry_type)
    activity = norm.startswith("activities/")
    return (
        F.when(kind == "MAINLINE", "mainline")
        .when(norm.startswith("obt/main/"), "mainline")
        .when(norm.startswith("obt/memory/"), "operator_record")
        .when(activity & (kind == "ACTIVITY"), "activity")
        .when(activity & (kind == "MINI_ACTIVITY"), "mini_activity")
        .otherwise("other")
    )


def _tagged(tag: Column | str | None) -> Column:
    return F.coalesce(col(tag), F.lit("")) if tag is not None else F.lit("")


def chunk_file(stage_idx: Column | str, name: Column | str, tag: Column | str | None = None) -> Column:
    base = F.when(_tagged(tag) == "", col(name)).otherwise(F.concat(col(name), F.lit("_"), _tagged(tag)))
    return F.format_string("stage_%02d_%s.txt", col(stage_idx), safe_slug(base))


def chapter_title(name: Column | str, tag: Column | str | None = None) -> Column:
    return F.when(_tagged(tag) == "", col(name)).otherwise(
        F.concat(col(name), F.lit("（"), _tagged(tag), F.lit("）"))
    )


def format_chunk(container_id, container_name, stage_idx, name, tag, info, body) -> Column:
    """Chunk wrapper with its seven tags."""
    return F.concat(
        F.lit("<章节>\n<活动名称>"), col(container_name),
        F.lit("</活动名称>\n<活动ID>"), col(container_id),
        F.lit("</活动ID>\n<章节序号>"), F.format_string("%02d", col(stage_idx)),
        F.lit("</章节序号>\n<章节名称>"), chapter_title(name, tag),
        F.lit("</章节名称>\n<章节简介>"), F.coalesce(col(info), F.lit("")),
        F.lit("</章节简介>\n<正文>\n"), col(body), F.lit("\n</正文>\n</章节>\n"),
    )


def alias_mode(c: Column | str) -> Column:
    return (
        F.when(col(c).rlike(r"\A[\x00-\x7F]*\z"), "ascii")
        .when(F.length(col(c)) == 1, "cjk_single")
        .otherwise("cjk_multi")
    )


def mention_count(body: Column | str, alias: Column | str) -> Column:
    """ASCII aliases need a word boundary on both sides, others count as plain substrings."""
    text, name = col(body), col(alias)
    literal = F.regexp_replace(name, r"([^A-Za-z0-9])", r"\\$1")
    bounded = F.concat(F.lit(r"(?<!\p{Alnum})"), literal, F.lit(r"(?!\p{Alnum})"))
    plain = (F.length(text) - F.length(F.replace(text, name, F.lit("")))) / F.length(name)
    return F.when(alias_mode(name) == "ascii", F.regexp_count(text, bounded)).otherwise(plain).cast("bigint")


def multi_pass(total_length: Column | str, stage_count: Column | str) -> Column:
    return (col(total_length) > MULTI_PASS_LENGTH) | (col(stage_count) > MULTI_PASS_STAGES)


def snippet(line: Column | str, size: int = SNIPPET_LENGTH) -> Column:
    return F.substring(col(line), 1, size)


def key_value_line(line: Column | str, link: Column | None = None) -> Column:
    """`a：b` line as a bullet with a bold key, the key replaced by its link where one is known."""
    text = F.replace(col(line), F.lit("*"), F.lit(""))
    key, rest = key_part(col(line)), rest_part(col(line))
    head = F.coalesce(link, key) if link is not None else key
    bold = F.concat(F.lit("-   **"), head, F.lit("**"), rest)
    return F.when(split_at(col(line)) > 0, bold).otherwise(F.concat(F.lit("-   "), text))


def split_at(line: Column) -> Column:
    """0-based position of the later one of the first half- and the first full-width colon."""
    text = F.replace(line, F.lit("*"), F.lit(""))
    return F.greatest(F.instr(text, ":"), F.instr(text, "：")) - 1


def key_part(line: Column) -> Column:
    text = F.replace(line, F.lit("*"), F.lit(""))
    return strip(F.substring(text, F.lit(1), split_at(line)))


def rest_part(line: Column) -> Column:
    text = F.replace(line, F.lit("*"), F.lit(""))
    return F.substring(text, split_at(line) + 1, F.length(text))


# ---- entity section formatters ------------------------------------------------------------


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def profile_section(usage, desc, nation) -> Column:
    body = F.array_join(F.filter(F.array(col(usage), col(desc)), _filled), "\n")
    text = F.concat(F.lit("<干员招聘文本>\n"), body, F.lit("\n</干员招聘文本>\n"))
    country = F.when(
        _filled(col(nation)), F.concat(F.lit("<国家>"), col(nation), F.lit("</国家>\n"))
    ).otherwise("")
    return F.when(body != "", F.concat(text, country))


def voice_section(words) -> Column:
    body = F.array_join(col(words), "\n")
    return F.when(F.size(col(words)) > 0, F.concat(F.lit("<干员语音>\n"), body, F.lit("\n</干员语音>\n")))


def archive_section(stories) -> Column:
    """`stories` is an ordered array of (title, text)."""
    body = F.array_join(
        F.transform(col(stories), lambda s: F.concat(s["title"], F.lit(":\n"), s["text"])), "\n"
    )
    return F.when(F.size(col(stories)) > 0, F.concat(F.lit("<干员档案>\n"), body, F.lit("\n</干员档案>\n")))


def or_none(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def skins_section(skins) -> Column:
    kept = F.filter(col(skins), lambda s: s["description"].isNotNull())
    rows = F.transform(
        kept,
        lambda s: F.concat(
            F.lit("名称:"), or_none(s["skinName"]), F.lit("\t描述:"), or_none(s["dialog"]),
            F.lit("\t用途:"), or_none(s["usage"]), F.lit("\t旁白:"), s["description"],
        ),
    )
    text = F.concat(F.lit("<干员皮肤>\n"), F.array_join(rows, "\n"), F.lit("\n</干员皮肤>\n"))
    return F.when(F.size(kept) > 0, text)


def modules_section(modules) -> Column:
    kept = F.filter(col(modules), lambda m: m["desc"].isNotNull())
    rows = F.transform(
        kept,
        lambda m: F.concat(
            F.lit("<模组名称>"), or_none(m["name"]), F.lit("</模组名称>\n<模组描述>\n"),
            m["desc"], F.lit("\n</模组描述>\n"),
        ),
    )
    text = F.concat(F.lit("<干员模组>\n"), F.array_join(rows, "\n"), F.lit("</干员模组>\n"))
    return F.when(F.size(kept) > 0, text)


# ---- field blocks -----------------------------------------------------------------------------

FIELD_ENTRY = r"(?dm)^【([^】\n]+)】[ \t]*(.*(?:\n(?!【[^】\n]+】).*)*)"


def bracket_fields(c: Column | str) -> Column:
    """`【field】value` block -> array of (field, value) in first-seen order, the last value winning."""
    text = F.array_join(F.transform(lines(F.coalesce(col(c), F.lit(""))), lambda l: strip(l)), "\n")
    keys = F.transform(F.regexp_extract_all(text, F.lit(FIELD_ENTRY), F.lit(1)), lambda k: strip(k))
    values = F.transform(
        F.regexp_extract_all(text, F.lit(FIELD_ENTRY), F.lit(2)),
        lambda v: F.array_join(F.filter(F.split(v, "\n", -1), lambda l: l != ""), "\n"),
    )
    pairs = F.arrays_zip(keys.alias("field"), values.alias("value"))
    return F.transform(
        F.array_distinct(keys),
        lambda k: F.element_at(F.filter(pairs, lambda p: p["field"] == k), -1),
    )


def as_map(fields: Column) -> Column:
    return F.map_from_entries(fields)
