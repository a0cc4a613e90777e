"""DuckDB twins of the registered queries, written from the definitions rather than from the plans."""

from __future__ import annotations

from scriptloom.functions.text import WS
from scriptloom.operators.aliases import BLOCKLIST

ORACLES: dict[str, str] = {}

W = WS.replace(r"\x85", r"\x{85}")
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip(x: str, cls: str = W) -> str:
    return f"regexp_replace({x}, '^{cls}+|{cls}+$', '', 'g')"


def lines(x: str) -> str:
    return f"regexp_split_to_array({x}, '{LINE_BREAK}')"


HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"
FIRST = lambda c, t: f"regexp_extract({c}, '(?s)[<\\[]{t}[\\]>](.*?)[<\\[]/{t}[\\]>]', 1)"
HAS = lambda c, t: f"regexp_matches({c}, '(?s)[<\\[]{t}[\\]>](.*?)[<\\[]/{t}[\\]>]')"

NAV = """nav AS (
  SELECT page_id, url, ord, term FROM (
    SELECT page_id, url, unnest(t) AS term, CAST(generate_subscripts(t, 1) - 1 AS BIGINT) AS ord
    FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="/[^"]*">([^<]*)</a>', 1) AS t FROM pages))
  WHERE term <> '')"""
ENT = r"""ent AS (
  SELECT entity_id, term, name, lower(name) AS appellation, line_no FROM (
    SELECT 'op_' || substr(sha256(term), 1, 12) AS entity_id, term,
           regexp_replace(term, '^[\p{P}\p{S}]+|[\p{P}\p{S}]+$', '', 'g') AS name,
           min(page_id * 4294967296 + ord) AS line_no
    FROM nav GROUP BY term))"""
CUR = """curlines AS (
  SELECT line_no, name || ';' || term || CASE WHEN length(name) >= 5 THEN ';' || substr(name, 1, length(name) - 2) ELSE '' END AS line
  FROM ent WHERE name <> ''),
curnames AS (
  SELECT line_no, list_filter(list_transform(string_split(line, ';'), lambda x: """ + strip("x") + """), lambda x: x <> '') AS n FROM curlines),
cur AS (
  SELECT canonical, alias, min({'line_no': line_no, 'pos': pos}) AS ord FROM (
    SELECT n[1] AS canonical, line_no, unnest(n[2:]) AS alias, generate_subscripts(n[2:], 1) - 1 AS pos FROM curnames)
  GROUP BY ALL),
aliasmap AS (
  SELECT alias, arg_max(canonical, line_no) AS canonical FROM (SELECT line_no, n[1] AS canonical, unnest(n) AS alias FROM curnames) GROUP BY alias)"""
AMB = """amb AS (SELECT name, count(DISTINCT entity_id) AS n_ids FROM ent WHERE name <> '' GROUP BY name HAVING count(DISTINCT entity_id) > 1)"""
OWN = """own AS (
  SELECT DISTINCT alias, entity_id FROM (
    SELECT name AS alias, entity_id FROM ent UNION ALL SELECT appellation, entity_id FROM ent
    UNION ALL SELECT cur.alias, entity_id FROM ent JOIN cur ON canonical = name) WHERE alias <> ''),
idx AS (SELECT alias, count(*) AS n_ids, CASE WHEN count(*) = 1 THEN min(entity_id) END AS sole_id FROM own GROUP BY alias)"""
BLOCKED = ", ".join(f"'{b}'" for b in BLOCKLIST)
MAT = f"""mat0 AS (
  SELECT entity_id, name AS alias, 'canonical' AS s FROM ent UNION SELECT entity_id, appellation, 'canonical' FROM ent
  UNION SELECT entity_id, cur.alias, 'curated' FROM ent JOIN cur ON canonical = name WHERE name NOT IN (SELECT name FROM amb)),
mat1 AS (
  SELECT entity_id, alias, CASE WHEN s = 'canonical' AND length(alias) = 1 THEN 'canonical_short' WHEN s = 'canonical' THEN 'canonical'
         WHEN length(alias) >= 2 THEN s END AS match_class
  FROM mat0 WHERE alias <> '' AND alias NOT IN ({BLOCKED})),
mat AS (
  SELECT entity_id, alias, arg_max(match_class, CASE match_class WHEN 'canonical' THEN 4 WHEN 'curated' THEN 3 WHEN 'canonical_short' THEN 2 ELSE 1 END) AS match_class,
         CASE WHEN regexp_full_match(alias, '[\\x00-\\x7F]*') THEN 'ascii' WHEN length(alias) = 1 THEN 'cjk_single' ELSE 'cjk_multi' END AS mode
  FROM mat1 WHERE match_class IS NOT NULL GROUP BY entity_id, alias)"""
BASE = ",\n".join([NAV, ENT, CUR, AMB, OWN, MAT])

DOC = """doc AS (
  SELECT source || '-' || lang AS container_id, source AS container_name, doc_id AS stage_idx, 'doc ' || doc_id AS name, lang AS tag, text AS body,
         CASE lang WHEN 'en' THEN 'obt/main/' WHEN 'fr' THEN '/obt\\memory\\' ELSE 'activities/' END || source || '/' || doc_id AS path,
         CASE lang WHEN 'de' THEN 'ACTIVITY' WHEN 'es' THEN 'MINI_ACTIVITY' ELSE 'NONE' END AS entry_type
  FROM documents)""".replace("\\\\", "\\")
PAGE = f"""page AS (
  SELECT {HOST} AS container_id, page_id AS stage_idx, {FIRST('html', 'article')} AS body,
         regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path, 'NONE' AS entry_type FROM pages)"""


def plain(x: str) -> str:
    return f"""translate({x}, '"[]:：{{}}', '''()..()')"""


CONV = f"""conv AS (
  SELECT conv_id, turn, role, {plain('text')} AS t, coalesce({plain('term')}, role) AS who
  FROM conversations LEFT JOIN nav ON page_id = conv_id AND ord = turn),
script AS (
  SELECT conv_id, turn, role, who,
    {strip("who || ':博士 ' || replace(t, chr(10), ' ')")} || chr(10)
    || list_aggregate(list_transform(list_filter(list_transform(string_split(t, chr(10)), lambda p: {strip('p')}), lambda p: p <> ''), lambda p: '旁白:' || p || chr(10)), 'string_agg', '')
    || '博士（多个选择）:' || role || ';no' || chr(10) || '旁白:' || role AS body
  FROM conv)"""
CHUNK = """chunk AS (
  SELECT container_id, stage_idx, body FROM doc UNION ALL SELECT container_id, stage_idx, body FROM page
  UNION ALL SELECT 'conv' || conv_id, turn, body FROM script)"""

LINK = f"""link AS (SELECT entity_id, term AS link_name, regexp_replace(url, '[?#].*$', '') AS link_key FROM nav JOIN ent USING (term)),
linkhit AS (SELECT url AS link_key, count(*) AS n, min({HOST}) AS container_id, min(page_id) AS stage_idx FROM pages GROUP BY url),
det AS (
  SELECT entity_id, container_id, stage_idx, 'deterministic' AS source, min(link_name) AS story_set_name
  FROM link JOIN linkhit USING (link_key) WHERE n = 1 GROUP BY ALL)"""
QUOTES = "[“”\"''‘’「」『』 \\t]"


def names_of(x: str) -> str:
    one = strip(strip(strip("x"), QUOTES))
    return f"list_filter(list_transform(regexp_split_to_array({x}, '[;；]'), lambda x: {one}), lambda x: x <> '')"


KEYS = f"""sdoc AS (
  SELECT {HOST} AS container_id, page_id AS stage_idx, {names_of("replace(" + FIRST('html', 'h1') + ", ' ', ';')")} AS s,
         {names_of("replace(regexp_extract(html, '(?s)<div class=" + '"ad"' + ">(.*?)</div>', 1), ' ', ';')")} AS e FROM pages),
sraw AS (SELECT container_id, stage_idx, unnest(s) AS name, generate_subscripts(s, 1) AS p FROM sdoc),
sname AS (
  SELECT container_id, stage_idx, row_number() OVER (PARTITION BY stage_idx ORDER BY p) - 1 AS ord, name FROM (
    SELECT container_id, stage_idx, name, min(p) AS p FROM sraw GROUP BY ALL)),
eraw AS (SELECT container_id, stage_idx, unnest(e) AS name, generate_subscripts(e, 1) AS p FROM sdoc),
edist AS (
  SELECT container_id, stage_idx, row_number() OVER (PARTITION BY stage_idx ORDER BY p) - 1 AS pos, name FROM (
    SELECT container_id, stage_idx, name, min(p) AS p FROM eraw GROUP BY ALL)),
ename AS (SELECT container_id, name, min(stage_idx * 4294967296 + pos) AS ord FROM edist GROUP BY ALL)"""
SUMM = """sres AS (
  SELECT sole_id AS entity_id, container_id, stage_idx, ord, name FROM sname JOIN idx ON alias = name AND n_ids = 1
  WHERE (sole_id, container_id, stage_idx) NOT IN (SELECT entity_id, container_id, stage_idx FROM det)),
eres AS (
  SELECT sole_id AS entity_id, container_id, ord, name FROM ename JOIN idx ON alias = name AND n_ids = 1
  WHERE (sole_id, container_id) NOT IN (SELECT entity_id, container_id FROM det)
    AND (sole_id, container_id) NOT IN (SELECT entity_id, container_id FROM sres)),
summ AS (
  SELECT entity_id, container_id, stage_idx, string_agg(name, ';' ORDER BY ord, name) AS matched_aliases, 'summary' AS source, 'named' AS tier
  FROM sres GROUP BY entity_id, container_id, stage_idx
  UNION ALL
  SELECT entity_id, container_id, CAST(NULL AS BIGINT), string_agg(name, ';' ORDER BY ord, name), 'summary', 'named' FROM eres GROUP BY entity_id, container_id)"""
UNRES = """unres AS (
  SELECT DISTINCT container_id, name FROM (SELECT container_id, name FROM sname UNION ALL SELECT container_id, name FROM ename)
  WHERE name NOT IN (SELECT alias FROM idx))"""


def hits(src: str) -> str:
    """Mentions per (chunk, alias): runs of word characters for plain aliases, splitting for the others."""
    left = "(CASE WHEN s[i] <> '' THEN right(s[i], 1) WHEN i > 1 THEN right(alias, 1) ELSE ' ' END)"
    right = "(CASE WHEN s[i + 1] <> '' THEN left(s[i + 1], 1) WHEN i + 1 < len(s) THEN left(alias, 1) ELSE ' ' END)"
    ok = f"NOT regexp_full_match({left}, '[A-Za-z0-9]') AND NOT regexp_full_match({right}, '[A-Za-z0-9]')"
    return f"""word AS (
  SELECT container_id, stage_idx, alias, count(*) AS n
  FROM (SELECT container_id, stage_idx, unnest(regexp_split_to_array(body, '[^A-Za-z0-9]+')) AS alias FROM {src})
  WHERE alias IN (SELECT alias FROM mat) GROUP BY ALL),
split AS (
  SELECT container_id, stage_idx, alias, mode, string_split(body, alias) AS s
  FROM {src} JOIN (SELECT DISTINCT alias, mode FROM mat WHERE NOT regexp_full_match(alias, '[A-Za-z0-9]+')) ON contains(body, alias)),
other AS (
  SELECT container_id, stage_idx, alias,
         CASE WHEN mode = 'ascii' THEN len(list_filter(range(1, len(s)), lambda i: {ok})) ELSE len(s) - 1 END AS n FROM split),
hit AS (SELECT * FROM word UNION ALL SELECT * FROM other WHERE n > 0)"""


SPEECH = lambda src: f"""sline AS (SELECT container_id, stage_idx, unnest({lines('body')}) AS line FROM {src}),
spoken AS (
  SELECT container_id, stage_idx, speaker, count(*) AS n_lines FROM (
    SELECT container_id, stage_idx, {strip("regexp_extract(line, '^([^" + W[1:-1] + "<>:：][^<>:：]*?)" + W + "*[:：]', 1)")} AS speaker FROM sline)
  WHERE speaker <> '' GROUP BY ALL)"""
PART = """allhit AS (
  SELECT container_id, stage_idx, alias, sum(spoke) AS spoke, sum(n) AS n FROM (
    SELECT container_id, stage_idx, speaker AS alias, n_lines AS spoke, 0 AS n FROM spoken WHERE speaker IN (SELECT alias FROM mat)
    UNION ALL SELECT container_id, stage_idx, alias, 0, n FROM hit) GROUP BY ALL),
part0 AS (
  SELECT m.entity_id, b.container_id, b.stage_idx, sum(spoke) AS spoke_lines, sum(n) AS mention_count, string_agg(m.alias, ';' ORDER BY m.alias) AS matched_aliases,
         bool_or(n > 0 AND CASE mode WHEN 'cjk_multi' THEN match_class = 'canonical' WHEN 'ascii' THEN match_class IN ('canonical', 'canonical_short')
                 ELSE n >= 2 OR (m.entity_id, b.container_id) IN (SELECT entity_id, container_id FROM summ) END) AS strong
  FROM allhit b JOIN mat m ON m.alias = b.alias GROUP BY 1, 2, 3),
part1 AS (
  SELECT entity_id, container_id, stage_idx, 'participant' AS source,
         CASE WHEN spoke_lines > 0 THEN 'speaker' WHEN strong OR mention_count >= 2 THEN 'named' ELSE 'mentioned' END AS tier,
         CAST(spoke_lines AS BIGINT) AS spoke_lines, CAST(mention_count AS BIGINT) AS mention_count, matched_aliases
  FROM part0 WHERE (entity_id, container_id, stage_idx) NOT IN (SELECT entity_id, container_id, stage_idx FROM det))"""
EDGES = """edge AS (
  SELECT entity_id, container_id, stage_idx, source, CAST(NULL AS VARCHAR) AS tier, CAST(NULL AS BIGINT) AS spoke_lines, CAST(NULL AS BIGINT) AS mention_count,
         CAST(NULL AS VARCHAR) AS matched_aliases, story_set_name FROM det
  UNION ALL SELECT entity_id, container_id, stage_idx, source, tier, spoke_lines, mention_count, matched_aliases, NULL FROM part1
  UNION ALL SELECT entity_id, container_id, stage_idx, source, tier, NULL, NULL, matched_aliases, NULL FROM summ)"""
FULL = ",\n".join([BASE, DOC, PAGE, CONV, CHUNK, LINK, KEYS, SUMM, hits("chunk"), SPEECH("chunk"), PART, EDGES])
NAMED = ",\n".join([BASE, LINK, KEYS, SUMM, UNRES])
TIER_OK = lambda r: f"(source = 'deterministic' OR CASE tier WHEN 'speaker' THEN 3 WHEN 'named' THEN 2 ELSE 1 END >= {r})"

ENTRY = """entries AS (
  SELECT o AS line_no, name, CASE length(name) % 3 WHEN 0 THEN 'npc' WHEN 1 THEN 'organization' ELSE 'group' END AS entity_type,
         CAST(NULL AS VARCHAR) AS id, name || ';' || '~' || name AS aliases, 'seen in adverts' AS notes
  FROM (SELECT name, min(ord) AS o FROM ename WHERE length(name) >= 4 GROUP BY name)
  UNION ALL SELECT s_suppkey + 1000000000000, s_name, 'organization', '', s_name, '' FROM supplier
  UNION ALL SELECT n_nationkey + 1000000000000000, n_name, 'location', 'ent_region' || n_regionkey, n_name, NULL FROM nation),
curent AS (
  SELECT line_no, CASE WHEN id <> '' THEN id ELSE 'ent_' || substr(sha256(name), 1, 6) END AS entity_id, name, entity_type, aliases,
         CASE WHEN notes <> '' THEN notes END AS notes FROM entries WHERE name NOT IN (SELECT alias FROM own)),
seed AS (
  SELECT entity_id, min(name) AS name FROM (SELECT DISTINCT 'ent_' || substr(sha256(name), 1, 6) AS entity_id, name FROM unres)
  WHERE name NOT IN (SELECT name FROM curent) AND entity_id NOT IN (SELECT entity_id FROM curent) GROUP BY entity_id),
opal AS (
  SELECT entity_id, alias, min(o) AS o FROM (
    SELECT entity_id, name AS alias, {'line_no': CAST(-2 AS BIGINT), 'pos': CAST(0 AS BIGINT)} AS o FROM ent UNION ALL SELECT entity_id, appellation, {'line_no': CAST(-1 AS BIGINT), 'pos': CAST(0 AS BIGINT)} FROM ent
    UNION ALL SELECT entity_id, alias, {'line_no': CAST(ord.line_no AS BIGINT), 'pos': CAST(ord.pos AS BIGINT)} FROM ent JOIN cur ON canonical = name WHERE name NOT IN (SELECT name FROM amb) AND name <> '')
  WHERE alias <> '' GROUP BY ALL),
opent AS (
  SELECT e.entity_id, e.name, 'operator' AS entity_type, e.appellation, coalesce((SELECT string_agg(alias, ';' ORDER BY o, alias) FROM opal WHERE opal.entity_id = e.entity_id), '') AS aliases
  FROM ent e),
allent AS (
  SELECT entity_id, name, entity_type, aliases FROM opent UNION ALL SELECT entity_id, name, entity_type, aliases FROM curent
  UNION ALL SELECT entity_id, name, 'unknown', name FROM seed),
eal AS (SELECT DISTINCT unnest(string_split(aliases, ';')) AS alias, entity_id FROM allent WHERE aliases <> ''),
eidx AS (SELECT alias, count(*) AS n_ids, CASE WHEN count(*) = 1 THEN min(entity_id) END AS sole_id FROM eal GROUP BY alias)"""
ENTITIES = ",\n".join([NAMED, ENTRY])

# ---- text ----
ORACLES["q_clean_script"] = f"WITH {NAV}, {CONV} SELECT conv_id, turn, body AS script FROM script"
ORACLES["q_extract_tag"] = r"""
SELECT page_id, CAST(generate_subscripts(t, 1) - 1 AS BIGINT) AS pos, unnest(t) AS content
FROM (SELECT page_id, regexp_extract_all(html, '(?s)[<\[]p[\]>](.*?)[<\[]/p[\]>]', 1) AS t FROM pages)"""


def block(tag: str, x: str) -> str:
    return f"'<{tag}>' || chr(10) || {strip(x)} || chr(10) || '</{tag}>' || chr(10)"


ORACLES["q_validate_tags"] = f"""
SELECT page_id, array_to_string(list_filter([{', '.join(f"CASE WHEN NOT {HAS('html', t)} THEN '{t}' END" for t in ('title', 'article', 'footer', 'aside'))}], lambda x: x IS NOT NULL), ';') AS missing,
  CASE WHEN {' AND '.join(HAS('html', t) for t in ('title', 'article', 'footer'))} THEN
    {' || chr(10) || '.join(block(t, FIRST('html', t)) for t in ('title', 'article', 'footer'))} END AS rebuilt FROM pages"""

# a line that begins another block: heading, bold words or a short bracketed word
BEGINS = lambda y: (f"(regexp_matches({y}, '^[ \\t]*#{{1,6}}{W}') OR regexp_matches({y}, '^[ \\t]*[*][*][^*]{{1,24}}[*][*]') "
                    f"OR length(regexp_extract({y}, '^[ \\t]*[<\\[【《〈]{W}*/?{W}*([^>\\]】》〉]+)[>\\]】》〉]', 1)) BETWEEN 1 AND 24)")
CUT = lambda x: (f"array_to_string(string_split({x}, chr(10))[1:coalesce(nullif(list_position(list_transform(string_split({x}, chr(10))[2:], "
                 f"lambda y: {BEGINS('y')}), true), 0), 1000000000)], chr(10))")
BUILT = lambda body: f"{block('摘要', 'lang')} || chr(10) || {block('正文', body)}"
ORACLES["q_repair_tags"] = f"""
SELECT doc_id, CASE length(text) % 6
    WHEN 0 THEN '<摘要>' || lang || '</摘要>' || chr(10) || '<正文>' || text || '</正文>'
    WHEN 1 THEN {BUILT(CUT('text'))} WHEN 2 THEN {BUILT('text')} WHEN 3 THEN {BUILT(CUT('text'))}
    WHEN 4 THEN {block('摘要', 'lang')} ELSE {BUILT(CUT('text'))} END AS fixed,
  CASE length(text) % 6 WHEN 4 THEN '正文' ELSE '' END AS missing FROM documents"""
ORACLES["q_safe_slug"] = f"""WITH {NAV} SELECT page_id, ord, term,
  CASE WHEN regexp_full_match(term, '[a-zA-Z0-9_.]+') THEN term ELSE substr(sha256(term), 1, 6) END AS slug FROM nav"""
PATHS = """a AS (SELECT container_id, stage_idx, entry_type, ltrim(replace(path, chr(92), '/'), '/') AS norm FROM doc
  UNION ALL SELECT container_id, stage_idx, entry_type, ltrim(replace(path, chr(92), '/'), '/') FROM page
  UNION ALL SELECT 'conv' || conv_id, turn, 'MAINLINE', '' FROM conversations)"""
ORACLES["q_path"] = f"""WITH {DOC}, {PAGE}, {PATHS} SELECT container_id, stage_idx, norm, array_to_string(string_split(norm, '/')[1:2], '/') AS prefix FROM a"""
FAMILY = """CASE WHEN entry_type = 'MAINLINE' OR norm LIKE 'obt/main/%' THEN 'mainline' WHEN norm LIKE 'obt/memory/%' THEN 'operator_record'
  WHEN norm LIKE 'activities/%' AND entry_type = 'ACTIVITY' THEN 'activity' WHEN norm LIKE 'activities/%' AND entry_type = 'MINI_ACTIVITY' THEN 'mini_activity'
  ELSE 'other' END"""
ORACLES["q_family"] = f"""WITH {DOC}, {PAGE},
a AS (SELECT container_id, stage_idx, entry_type, ltrim(replace(path, chr(92), '/'), '/') AS norm FROM doc
  UNION ALL SELECT container_id, stage_idx, entry_type, ltrim(replace(path, chr(92), '/'), '/') FROM page
  UNION ALL SELECT 'conv' || conv_id, turn, 'MAINLINE', '' FROM conversations)
SELECT container_id, stage_idx, {FAMILY} AS family FROM a"""
FILE = "format('stage_{:02d}_', stage_idx) || substr(sha256(name || '_' || tag), 1, 6) || '.txt'"
ORACLES["q_format_chunk"] = f"""WITH {DOC} SELECT stage_idx AS doc_id,
  concat('<章节>', chr(10), '<活动名称>', container_name, '</活动名称>', chr(10), '<活动ID>', container_id, '</活动ID>', chr(10), '<章节序号>', format('{{:02d}}', stage_idx),
   '</章节序号>', chr(10), '<章节名称>', name, '（', tag, '）</章节名称>', chr(10), '<章节简介></章节简介>', chr(10), '<正文>', chr(10), body, chr(10), '</正文>', chr(10), '</章节>', chr(10)) AS chunk,
  {FILE} AS file FROM doc"""
ORACLES["q_bracket_block"] = """
SELECT p_partkey, CAST(0 AS BIGINT) AS pos, 'brand' AS field, CASE WHEN p_size > 25 THEN 'big ' ELSE '' END || p_brand AS value FROM part
UNION ALL SELECT p_partkey, 1, 'type', p_type || chr(10) || p_name FROM part UNION ALL SELECT p_partkey, 2, 'size', CAST(p_size AS VARCHAR) FROM part"""
ORACLES["q_fact_card"] = """
SELECT format('part{:09d}', p_partkey) AS entity_id, p_name AS name, p_brand AS appellation, CAST(NULL AS VARCHAR) AS nation_id,
  CASE WHEN p_size > 25 THEN 'big ' ELSE '' END || p_brand AS brand, p_type || chr(10) || p_name AS type, CAST(p_size AS VARCHAR) AS size, CAST(0 AS BIGINT) AS n_exam,
  p_type AS objective_record, '基础档案;客观履历' AS archive, CASE WHEN p_size > 10 THEN p_type ELSE '' END AS skins, p_brand AS modules,
  'handbook_info_table:基础档案' AS basic_source FROM part"""
ORACLES["q_sections"] = """
WITH p AS (SELECT *, format('part{:09d}', p_partkey) AS entity_id, chr(10) AS nl FROM part)
SELECT entity_id, 'profile' AS section, concat('<干员招聘文本>', nl, p_name, CASE WHEN p_size > 20 THEN nl || p_type ELSE '' END, nl, '</干员招聘文本>', nl,
  CASE WHEN p_size > 10 THEN '<国家>' || p_brand || '</国家>' || nl ELSE '' END) AS text FROM p
UNION ALL SELECT entity_id, 'voice', concat('<干员语音>', nl, p_type, nl, p_brand, nl, '</干员语音>', nl) FROM p WHERE p_size > 5
UNION ALL SELECT entity_id, 'archive', concat('<干员档案>', nl, p_type, ':', nl, p_name, nl, '</干员档案>', nl) FROM p
UNION ALL SELECT entity_id, 'skins', concat('<干员皮肤>', nl, '名称:', p_type, chr(9), '描述:None', chr(9), '用途:', p_brand, chr(9), '旁白:', p_name, nl, '</干员皮肤>', nl) FROM p WHERE p_size > 30
UNION ALL SELECT entity_id, 'modules', concat('<干员模组>', nl, '<模组名称>', p_brand, '</模组名称>', nl, '<模组描述>', nl, p_type, nl, '</模组描述>', nl, '</干员模组>', nl) FROM p WHERE p_size > 40"""
ORACLES["q_mention_count"] = f"WITH {BASE}, {DOC}, {PAGE}, {CONV}, {CHUNK}, {hits('chunk')} SELECT alias, count(*) AS n_chunks, CAST(sum(n) AS BIGINT) AS n_mentions FROM hit GROUP BY alias"
ORACLES["q_alias_mode"] = f"WITH {BASE} SELECT mode, count(*) AS n_aliases FROM mat GROUP BY mode"
ORACLES["q_key_names"] = f"WITH {KEYS} SELECT container_id, stage_idx, ord, name FROM sname"
ORACLES["q_entity_id"] = f"WITH {NAV}, {ENT} SELECT term, 'ent_' || substr(sha256(term), 1, 6) AS synthetic_id FROM ent"

KIND = "['member_of','ally_of','rival_of','family_of','mentor_of','subordinate_of','creator_of','identifies_as','origin_from','knows'][length(term) % 10 + 1]"
RESP = f"""rl AS (
  SELECT page_id, ord, term, {KIND} AS kind,
    CASE WHEN ord = 1 THEN '# remark' WHEN ord = 2 THEN term WHEN ord % 2 = 0 THEN {KIND} || ' ; ' || term || ';first;second' ELSE {KIND} || ';' || term END AS line FROM nav),
rshape AS (SELECT page_id, length(string_agg(line, chr(10) ORDER BY ord)) % 5 AS shape FROM rl GROUP BY page_id),
rp AS (
  SELECT 'page' || page_id AS unit_id, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS line_no, ord, kind, term, shape
  FROM rl JOIN rshape USING (page_id) WHERE shape IN (0, 1, 4)),
rparsed AS (
  SELECT unit_id, line_no, CASE WHEN ord <> 2 THEN kind END AS type, CASE WHEN ord <> 2 THEN term END AS tail_name,
         CASE WHEN ord <> 2 AND ord % 2 = 0 THEN 'first;second' END AS notes, CASE WHEN ord = 2 THEN 'unparseable line' END AS reason
  FROM rp WHERE ord <> 1 AND (shape <> 0 OR ord = 0))"""
ORACLES["q_parse_relations"] = f"WITH {NAV}, {RESP} SELECT unit_id, line_no, type, tail_name, notes, reason FROM rparsed"

LANES = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {7 * i + 1}, 7) AS BIGINT)) AS VARCHAR)" for i in range(9))
ALL = f"{NAV}, {DOC}, {PAGE}, {CONV}, {CHUNK}"
HASH = f"""{ALL},
piece AS (SELECT container_id AS unit_id, format('{{:012d}}', stage_idx) || chr(0) || body || chr(0) AS p FROM chunk),
hashed AS (SELECT unit_id, sha256(concat_ws(':', CAST(count(*) AS VARCHAR), {LANES})) AS source_hash FROM (SELECT unit_id, sha256(p) AS h FROM piece) GROUP BY unit_id)"""
UNIT = "unit AS (SELECT container_id AS unit_id, CAST(sum(length(body)) AS BIGINT) AS total_length, count(*) AS stage_count FROM chunk GROUP BY 1)"
ORACLES["q_content_hash"] = f"WITH {HASH} SELECT unit_id, source_hash FROM hashed"
ORACLES["q_multi_pass"] = f"WITH {ALL}, {UNIT} SELECT unit_id, total_length, stage_count, total_length > 80000 OR stage_count > 10 AS multi FROM unit"
ORACLES["q_zip_tags"] = """
SELECT doc_id, CAST(0 AS BIGINT) AS pos, source AS name, text AS content FROM documents WHERE length(text) % 7 <> 0
UNION ALL SELECT doc_id, 1, lang, source FROM documents WHERE length(text) % 7 <> 0
UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE length(text) % 7 = 0"""
ORACLES["q_positions"] = f"""WITH {ALL} SELECT container_id, stage_idx AS doc_id, row_number() OVER (PARTITION BY container_id ORDER BY stage_idx) - 1 AS stage_idx FROM chunk"""
ORACLES["q_container_text"] = f"""WITH {DOC} SELECT DISTINCT container_id, CAST(-1 AS BIGINT) AS stage_idx, '<活动名称>' || container_name || '</活动名称>' AS part FROM doc
UNION ALL SELECT container_id, stage_idx, concat('<章节>', chr(10), '<章节名称>', name, '（', tag, '）</章节名称>', chr(10), '<章节简介></章节简介>', chr(10), '<正文>', chr(10), body, chr(10), '</正文>', chr(10), '</章节>', chr(10)) FROM doc"""

# ---- aliases ----
ORACLES["q_alias_rows"] = f"WITH {NAV}, {ENT}, {CUR} SELECT canonical, alias FROM cur"
ORACLES["q_alias_map"] = f"WITH {NAV}, {ENT}, {CUR} SELECT alias, canonical FROM aliasmap"
ORACLES["q_ambiguous_names"] = f"WITH {NAV}, {ENT}, {AMB} SELECT name, n_ids FROM amb"
ORACLES["q_alias_index"] = f"WITH {BASE} SELECT alias, n_ids, sole_id FROM idx"
ORACLES["q_alias_owners"] = f"WITH {BASE} SELECT alias, entity_id FROM own"
ORACLES["q_alias_class"] = f"WITH {BASE} SELECT entity_id, alias, match_class, mode FROM mat"
RESOLVE = "SELECT DISTINCT name, CASE WHEN n_ids IS NULL THEN 'missing' WHEN n_ids = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, sole_id AS entity_id, coalesce(n_ids, 0) AS n_candidates FROM ename LEFT JOIN idx ON alias = name"
ORACLES["q_resolve_names"] = f"WITH {BASE}, {KEYS} {RESOLVE}"
ORACLES["q_resolve_candidates"] = f"WITH {BASE}, {KEYS}, r AS ({RESOLVE}) SELECT name, own.entity_id FROM r JOIN own ON alias = name WHERE status = 'ambiguous'"

# ---- links and edges ----
TEXTLINK = """lk AS (SELECT 'doc' || doc_id AS owner, md5(text) AS link_key FROM documents UNION ALL SELECT 'item' || item_id, md5(text) FROM benchmark),
ix AS (SELECT md5(text) AS link_key, source || '-' || lang AS container_id, doc_id AS stage_idx FROM documents),
hits AS (SELECT link_key, count(*) AS n FROM ix GROUP BY 1),
rs AS (SELECT owner, link_key, coalesce(n, 0) AS n_hits, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS status FROM lk LEFT JOIN hits USING (link_key))"""
ORACLES["q_resolve_links"] = f"WITH {TEXTLINK} SELECT owner, rs.link_key, status, n_hits, container_id, stage_idx FROM rs LEFT JOIN ix ON ix.link_key = rs.link_key AND status = 'linked'"
ORACLES["q_link_candidates"] = f"WITH {TEXTLINK} SELECT link_key, container_id, stage_idx FROM ix WHERE link_key IN (SELECT link_key FROM rs WHERE status = 'ambiguous')"
ORACLES["q_link_stats"] = f"WITH {TEXTLINK} SELECT status, count(*) AS n_links FROM rs GROUP BY status"
ORACLES["q_explicit_edges"] = f"WITH {NAV}, {ENT}, {LINK} SELECT * FROM det"
ORACLES["q_speaker_counts"] = f"WITH {ALL}, {SPEECH('chunk')} SELECT * FROM spoken"
ORACLES["q_participants"] = f"WITH {FULL} SELECT * FROM part1"
ORACLES["q_subtract_explicit"] = f"""WITH {BASE}, {DOC}, {PAGE}, {CONV}, {CHUNK}, {LINK}, summ AS (SELECT '' AS entity_id, '' AS container_id), {hits('chunk')}, {SPEECH('chunk')}, {PART}
SELECT entity_id, container_id, stage_idx, tier FROM part1"""
ORACLES["q_summary_edges"] = f"WITH {BASE}, {LINK}, {KEYS}, {SUMM} SELECT entity_id, container_id, stage_idx, source, tier, matched_aliases FROM summ"
ORACLES["q_unresolved_names"] = f"""WITH {NAMED} SELECT name, count(*) AS n_containers, array_to_string(list_sort(list(container_id))[1:5], ';') AS first_container_ids FROM unres GROUP BY name"""
ORACLES["q_edges_union"] = f"WITH {FULL} SELECT * FROM edge"
ORACLES["q_edges_min_tier"] = f"WITH {FULL} SELECT source, tier, count(*) AS n_edges FROM edge WHERE {TIER_OK(2)} GROUP BY ALL"
ORACLES["q_appearances"] = f"""WITH {FULL} SELECT entity_id, container_id, stage_idx, source, tier FROM edge
WHERE entity_id = (SELECT min(entity_id) FROM det) AND {TIER_OK(3)}"""
ORACLES["q_container_entities"] = f"WITH {FULL} SELECT entity_id, container_id, stage_idx, tier, mention_count FROM edge WHERE container_id = 'src7-en' AND source = 'participant' AND {TIER_OK(2)}"
ORACLES["q_chunk_entities"] = f"WITH {FULL} SELECT entity_id, container_id, stage_idx, source, tier, spoke_lines, mention_count FROM edge WHERE container_id = 'conv0' AND stage_idx = 0 AND {TIER_OK(1)}"
ORACLES["q_group_by_container"] = f"""WITH {FULL}, n AS (SELECT container_id, count(*) AS n_edges, count(*) FILTER (source = 'deterministic') AS n_explicit,
  count(*) FILTER (source = 'participant') AS n_participant, count(*) FILTER (source = 'summary') AS n_summary FROM edge GROUP BY 1)
SELECT container_id, entity_id, stage_idx, source, tier, n_edges, n_explicit, n_participant, n_summary FROM edge JOIN n USING (container_id)"""
ORACLES["q_key_ids"] = f"WITH {BASE}, {LINK}, {KEYS}, {SUMM} SELECT DISTINCT container_id, entity_id FROM summ"
ORACLES["q_entity_table"] = f"""WITH {FULL} SELECT entity_id, name, (SELECT count(*) FROM det WHERE det.entity_id = ent.entity_id) AS link_count,
  entity_id IN (SELECT entity_id FROM part1) AS has_participant_appearances FROM ent"""

# ---- containers ----
ORACLES["q_container_rollup"] = f"WITH {NAV}, {DOC}, {PAGE}, {CONV}, {CHUNK} SELECT container_id, CAST(sum(length(body)) AS BIGINT) AS total_length, count(*) AS stage_count FROM chunk GROUP BY 1"
ORACLES["q_container_prefixes"] = f"""WITH {DOC}, {PAGE}, a AS (SELECT container_id, ltrim(replace(path, chr(92), '/'), '/') AS norm FROM doc UNION ALL SELECT container_id, ltrim(path, '/') FROM page)
SELECT DISTINCT container_id, array_to_string(string_split(norm, '/')[1:2], '/') AS prefix FROM a WHERE norm <> ''"""
NORM = "(SELECT *, ltrim(replace(path, chr(92), '/'), '/') AS norm FROM doc)"
ORACLES["q_stage_table"] = f"""WITH {DOC} SELECT container_id, stage_idx, name, tag, {FAMILY} AS source_family, array_to_string(string_split(norm, '/')[1:2], '/') AS path_prefix,
  {FILE} AS file, length(body) AS length FROM {NORM}"""
ORACLES["q_family_ids"] = f"""WITH {DOC}, {PAGE}, {PATHS} SELECT arg_min({FAMILY}, stage_idx) AS source_family, container_id FROM a GROUP BY container_id"""
ORACLES["q_family_counts"] = f"""WITH {DOC}, {PAGE}, {PATHS}, f AS (SELECT container_id, arg_min({FAMILY}, stage_idx) AS fam FROM a GROUP BY 1)
SELECT source_family, count(fam) AS n_containers FROM (SELECT unnest(['mainline','activity','mini_activity','operator_record','other']) AS source_family) LEFT JOIN f ON fam = source_family GROUP BY 1"""
ORACLES["q_corpus_stats"] = f"""
WITH {ALL}, s AS (SELECT list_sort(list(length(body))) AS a FROM chunk)
SELECT 'count' AS stat, CAST(len(a) AS BIGINT) AS value FROM s UNION ALL SELECT 'max', a[len(a)] FROM s UNION ALL SELECT 'median', a[CAST(floor(len(a) * CAST(0.5 AS DOUBLE)) AS BIGINT) + 1] FROM s
UNION ALL SELECT 'p90', a[CAST(floor(len(a) * CAST(0.9 AS DOUBLE)) AS BIGINT) + 1] FROM s UNION ALL SELECT 'p95', a[CAST(floor(len(a) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1] FROM s"""
ORACLES["q_size_limits"] = f"WITH {ALL}, {UNIT} SELECT size_limit, (SELECT count(*) FROM unit WHERE total_length > size_limit) AS n FROM (SELECT CAST(unnest([50000, 80000, 100000, 150000, 200000]) AS BIGINT) AS size_limit)"

# ---- entities ----
ORACLES["q_operator_entities"] = f"""WITH {ENTITIES} SELECT entity_id, name, entity_type, entity_id AS char_id, appellation, aliases,
  CASE WHEN name IN (SELECT canonical FROM cur) AND name NOT IN (SELECT name FROM amb) THEN 'character_table;char_alias.txt' ELSE 'character_table' END AS sources FROM opent"""
ORACLES["q_curated_entities"] = f"WITH {ENTITIES} SELECT entity_id, name, entity_type, aliases, notes FROM curent"
ORACLES["q_curated_conflicts"] = f"""WITH {ENTITIES}
SELECT line_no, name, 'matches an operator alias' AS reason, (SELECT string_agg(DISTINCT entity_id, ';' ORDER BY entity_id) FROM own WHERE own.alias = name) AS candidates FROM entries JOIN idx ON alias = name
UNION ALL SELECT line_no, name, 'id collision', NULL FROM curent c WHERE EXISTS (SELECT 1 FROM curent d WHERE d.entity_id = c.entity_id AND d.line_no < c.line_no)"""
ORACLES["q_auto_seed"] = f"""WITH {ENTITIES} SELECT entity_id, name, (SELECT array_to_string(list_sort(list(container_id))[1:5], ';') FROM unres WHERE unres.name = seed.name) AS first_container_ids FROM seed"""
ORACLES["q_entities"] = f"WITH {ENTITIES} SELECT entity_id, name, entity_type, aliases FROM allent"
ORACLES["q_entities_by_type"] = f"WITH {ENTITIES} SELECT entity_type, count(*) AS n_entities FROM allent GROUP BY 1"
ORACLES["q_entity_aliases"] = f"WITH {ENTITIES} SELECT alias, n_ids FROM eidx"
ORACLES["q_entity_edges"] = f"""WITH {ENTITIES},
s2 AS (SELECT sole_id AS entity_id, container_id, stage_idx, ord, name FROM sname JOIN eidx ON alias = name AND n_ids = 1 WHERE sole_id NOT IN (SELECT entity_id FROM ent)),
e2 AS (SELECT sole_id AS entity_id, container_id, ord, name FROM ename JOIN eidx ON alias = name AND n_ids = 1 WHERE sole_id NOT IN (SELECT entity_id FROM ent)
  AND (sole_id, container_id) NOT IN (SELECT entity_id, container_id FROM s2))
SELECT entity_id, container_id, stage_idx, string_agg(name, ';' ORDER BY ord, name) AS matched_aliases FROM s2 GROUP BY 1, 2, 3
UNION ALL SELECT entity_id, container_id, NULL, string_agg(name, ';' ORDER BY ord, name) FROM e2 GROUP BY 1, 2"""
ORACLES["q_curated_lines"] = """
WITH p AS (SELECT *, CASE WHEN p_size % 6 = 0 THEN 'operator' WHEN p_size % 6 = 1 THEN 'group' ELSE 'npc' END AS t FROM part)
SELECT p_partkey AS line_no, CASE WHEN ok THEN p_name END AS name, CASE WHEN ok THEN t END AS entity_type, CASE WHEN ok THEN p_brand END AS aliases, reason
FROM (SELECT *, reason IS NULL AS ok FROM (SELECT *, CASE WHEN length(p_type) + p_size = 20 THEN 'invalid JSON' WHEN p_size = 11 THEN 'not a JSON object'
  WHEN p_size = 19 THEN 'missing/empty `name`' WHEN t = 'operator' THEN 'entity_type not allowed: operator' END AS reason FROM p
  WHERE length(p_type) + p_size = 20 OR p_size NOT IN (13, 17)))"""

# ---- relations ----
REL = """baked AS (
  SELECT c_name AS head, 'origin_from' AS type, n_name AS tail, n_name AS tail_name, c_mktsegment AS notes, c_custkey AS seq FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT s_name, 'origin_from', n_name, n_name, NULL, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT n_name, 'member_of', r_name, r_name, NULL, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT p_type, 'creator_of', p_brand, p_brand, p_name, p_partkey FROM part
  UNION ALL SELECT p_brand, 'ally_of', NULL, p_name, p_type, p_partkey FROM part),
over AS (
  SELECT s_name AS head, 'origin_from' AS type, n_name AS tail, n_name AS tail_name, 'checked' AS notes, s_suppkey AS seq FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT p_brand, 'rival_of', NULL, 'size ' || p_size, p_name, p_partkey FROM part),
rel AS (
  SELECT head, type, tail, tail_name, notes, source FROM (
    SELECT *, row_number() OVER (PARTITION BY head, type, tail, tail_name ORDER BY source DESC, seq DESC) AS rn FROM (
      SELECT *, 'bake' AS source FROM baked UNION ALL SELECT *, 'curated' FROM over)) WHERE rn = 1)"""
ORACLES["q_collate_relations"] = f"WITH {REL} SELECT * FROM rel"
ORACLES["q_relations_for"] = f"WITH {REL} SELECT * FROM rel WHERE head = 'NATION_3' OR tail = 'NATION_3'"
ORACLES["q_relations_between"] = f"WITH {REL} SELECT * FROM rel WHERE (head = 'ECONOMY' AND tail = 'Brand#2') OR (head = 'Brand#2' AND tail = 'ECONOMY')"
ORACLES["q_relation_types"] = f"WITH {REL} SELECT type, source, count(*) AS n_rows FROM rel GROUP BY ALL"
TAIL = f"{ENTITIES}, {RESP}, tail AS (SELECT r.*, n_ids, sole_id FROM rparsed r LEFT JOIN eidx ON alias = tail_name WHERE type IS NOT NULL)"
ORACLES["q_relation_rows"] = f"""WITH {TAIL} SELECT unit_id AS head, type, sole_id AS tail, tail_name, CASE WHEN n_ids > 1 THEN (SELECT string_agg(DISTINCT entity_id, ';' ORDER BY entity_id) FROM eal WHERE eal.alias = tail_name) END AS ambiguous_candidates, notes, line_no
FROM tail WHERE n_ids IS NOT NULL"""
ORACLES["q_relation_warnings"] = f"""WITH {TAIL}
SELECT 'page' || page_id AS unit_id, CAST(NULL AS BIGINT) AS line_no, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS VARCHAR) AS tail_name, 'missing tag' AS reason FROM rshape WHERE shape = 3
UNION ALL SELECT unit_id, line_no, NULL, NULL, reason FROM rparsed WHERE reason IS NOT NULL
UNION ALL SELECT unit_id, line_no, type, tail_name, 'unresolved tail' FROM tail WHERE n_ids IS NULL
UNION ALL SELECT unit_id, line_no, type, tail_name, 'novel relation type' FROM tail WHERE n_ids IS NOT NULL AND type = 'knows'"""

# ---- pairs ----
LOG = """le AS (
  SELECT format('u{:08d}', user_id) AS entity_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS container_id, CAST(minute(ts) // 10 AS BIGINT) AS stage_idx
  FROM events WHERE event_type <> 'error'),
cell AS (SELECT DISTINCT * FROM le), cont AS (SELECT DISTINCT container_id, entity_id FROM le),
ps AS (SELECT x.entity_id AS a, y.entity_id AS b, count(*) AS co_stage_count FROM cell x JOIN cell y ON x.container_id = y.container_id AND x.stage_idx = y.stage_idx AND x.entity_id < y.entity_id GROUP BY 1, 2),
pe AS (SELECT x.entity_id AS a, y.entity_id AS b, count(*) AS co_container_count, array_to_string(list_sort(list(x.container_id))[1:3], ';') AS sample_containers
  FROM cont x JOIN cont y ON x.container_id = y.container_id AND x.entity_id < y.entity_id GROUP BY 1, 2),
co AS (SELECT a, b, coalesce(co_stage_count, 0) AS co_stage_count, co_container_count, sample_containers FROM pe LEFT JOIN ps USING (a, b))"""
ORACLES["q_cooccurrence"] = f"WITH {LOG} SELECT * FROM co"
NOSAMPLE = "SELECT a, b, co_stage_count, co_container_count FROM co"
RANK = "ORDER BY co_stage_count DESC, co_container_count DESC, a, b"
ORACLES["q_cooccur_for"] = f"WITH {LOG} {NOSAMPLE} WHERE a = 'u00000008' OR b = 'u00000008' {RANK} LIMIT 20"
ORACLES["q_cooccur_top"] = f"WITH {LOG} {NOSAMPLE} {RANK} LIMIT 50"
ORACLES["q_cooccur_between"] = f"WITH {LOG} {NOSAMPLE} WHERE a = 'u00000008' AND b = 'u00000046'"


# ---- search ----
def grep(test) -> str:
    return f"""WITH {NAV}, {DOC}, {PAGE}, {CONV},
a AS (SELECT container_id, stage_idx, NULL AS entity_id, NULL AS section, body, 'chunk' AS source FROM doc
  UNION ALL SELECT NULL, NULL, 'conv' || conv_id, 't' || turn, body, 'char_section' FROM script
  UNION ALL SELECT 'page' || stage_idx, NULL, NULL, NULL, body, 'event_summary' FROM page),
l AS (SELECT *, {lines('body')} AS l FROM a WHERE {test('body')})
SELECT container_id, stage_idx, entity_id, section, line, line_no, substr(line, 1, 200) AS snippet, source
FROM (SELECT *, unnest(l) AS line, CAST(generate_subscripts(l, 1) AS BIGINT) AS line_no FROM l) WHERE {test('line')}"""


ORACLES["q_grep_literal"] = grep(lambda c: f"contains({c}, 'token = ')")
ORACLES["q_grep_regex"] = grep(lambda c: f"regexp_matches({c}, '(?:^| )[A-Z][a-z]+tion[.,]')")

# ---- hash-gated runs ----
PRIOR = """prior AS (
  SELECT DISTINCT source || '-' || lang AS unit_id, lang FROM documents WHERE lang <> 'es'
  UNION ALL SELECT DISTINCT 'gone-' || quality || toxic, 'none' FROM labels),
outs AS (SELECT unit_id FROM prior WHERE lang <> 'de'),
state AS (SELECT prior.unit_id, CASE WHEN lang = 'en' THEN 'changed' ELSE coalesce(source_hash, 'none') END AS source_hash FROM prior LEFT JOIN hashed USING (unit_id))"""
PLAN = """plan AS (
  SELECT coalesce(h.unit_id, s.unit_id) AS unit_id, h.source_hash, s.source_hash AS prior_hash,
    CASE WHEN h.unit_id IS NULL THEN 'stale' WHEN h.source_hash = s.source_hash AND h.unit_id IN (SELECT unit_id FROM outs) THEN 'skip' ELSE 'run' END AS status
  FROM hashed h FULL OUTER JOIN state s ON h.unit_id = s.unit_id)"""
ORACLES["q_unit_plan"] = f"WITH {HASH}, {PRIOR}, {PLAN} SELECT * FROM plan"
DRY = "dry AS (SELECT unit_id, total_length, stage_count, unit_id NOT IN (SELECT unit_id FROM prior) OR unit_id NOT IN (SELECT unit_id FROM outs) AS would_run FROM unit)"
ORACLES["q_dry_run_plan"] = f"WITH {HASH}, {PRIOR}, {UNIT}, {DRY} SELECT * FROM dry"
ORACLES["q_stale_keys"] = f"WITH {HASH}, {PRIOR} SELECT DISTINCT unit_id FROM prior WHERE unit_id NOT IN (SELECT unit_id FROM hashed)"
ORACLES["q_unit_state"] = f"WITH {HASH}, {PRIOR}, {PLAN} SELECT unit_id, CASE WHEN status = 'run' THEN source_hash ELSE prior_hash END AS source_hash FROM plan WHERE status <> 'stale'"
ORACLES["q_run_outcome"] = f"""WITH {HASH}, {PRIOR}, {PLAN},
t AS (SELECT unit_id, CASE WHEN status = 'run' AND unit_id LIKE '%-de' THEN 'terminal_error' ELSE status END AS status FROM plan WHERE status <> 'stale')
SELECT * FROM t UNION ALL SELECT unit_id, CASE WHEN (SELECT count(*) FROM t WHERE status = 'terminal_error') > 0 THEN 'kept_stale' ELSE 'pruned' END
FROM (SELECT DISTINCT unit_id FROM prior) WHERE unit_id NOT IN (SELECT unit_id FROM t)"""
ORACLES["q_run_report"] = f"WITH {HASH}, {PRIOR}, {PLAN} SELECT status, count(*) AS n_units, true AS complete FROM plan GROUP BY status"
ORACLES["q_cost_estimate"] = f"""WITH {HASH}, {PRIOR}, {UNIT}, {DRY},
k AS (SELECT *, total_length > 80000 OR stage_count > 10 AS multi FROM dry),
m AS (SELECT would_run, multi, CASE WHEN multi THEN stage_count + 1 ELSE 1 END AS calls,
  CASE WHEN multi THEN 700 * stage_count + total_length + 900 + 400 * stage_count ELSE 1200 + total_length END AS i,
  CASE WHEN multi THEN 400 * stage_count + 900 ELSE 900 END AS o FROM k)
SELECT would_run, count(*) AS n_units, count(*) FILTER (NOT multi) AS n_single, count(*) FILTER (multi) AS n_multi, CAST(sum(calls) AS BIGINT) AS llm_calls,
  CAST(sum(i) AS BIGINT) AS in_chars, CAST(sum(o) AS BIGINT) AS out_chars, CAST(sum(i) AS BIGINT) AS in_tokens, CAST(sum(o) AS BIGINT) AS out_tokens FROM m GROUP BY would_run"""
ORACLES["q_chunk_cost"] = f"""WITH {ALL} SELECT container_id, stage_idx, length(body) AS total_length, 'single' AS passes, CAST(1 AS BIGINT) AS llm_calls,
  length(body) + 800 AS in_chars, CAST(500 AS BIGINT) AS out_chars FROM chunk"""
ORACLES["q_requests"] = f"""WITH {ALL}, {UNIT}, big AS (SELECT unit_id FROM unit WHERE total_length > 80000 OR stage_count > 10)
SELECT container_id, concat('please read', chr(10), string_agg(body, chr(10) || chr(10) ORDER BY stage_idx), chr(10), 'thank you') AS request, CAST(NULL AS BIGINT) AS stage_idx
FROM chunk WHERE container_id NOT IN (SELECT unit_id FROM big) GROUP BY container_id
UNION ALL SELECT container_id, concat('please read', chr(10), body, chr(10), 'thank you'), stage_idx FROM chunk WHERE container_id IN (SELECT unit_id FROM big)"""
ORACLES["q_pending_units"] = "SELECT doc_id, source || '-' || lang AS container_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
ORACLES["q_summary_document"] = f"""WITH {DOC} SELECT stage_idx AS doc_id, concat('---', chr(10), 'event_id: ', container_id, chr(10), 'stage_idx: ', stage_idx, chr(10), 'avg_tag: ', tag, chr(10),
  'total_length: ', length(body), chr(10), 'note: ', chr(10), '---', chr(10), chr(10), '<正文>', chr(10), {strip('body')}, chr(10), '</正文>', chr(10)) AS document FROM doc"""
ORACLES["q_build_report"] = f"""WITH {FULL}, {UNRES}, {ENTRY}, {REL}
SELECT source || '_edges' AS counter, count(*) AS value FROM edge GROUP BY source UNION ALL SELECT source || '_entities', count(DISTINCT entity_id) FROM edge GROUP BY source
UNION ALL SELECT 'entity_' || entity_type, count(*) FROM allent GROUP BY entity_type UNION ALL SELECT 'relation_' || source, count(*) FROM rel GROUP BY source
UNION ALL SELECT 'chunks', count(*) FROM chunk UNION ALL SELECT 'containers', count(DISTINCT container_id) FROM chunk UNION ALL SELECT 'ambiguous_names', count(*) FROM amb
UNION ALL SELECT 'unresolved_names', count(*) FROM unres UNION ALL SELECT 'nameless', count(*) FROM ent WHERE name = ''"""

# ---- update flow and pages ----
ORACLES["q_new_items"] = "SELECT doc_id, source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 OR toxic = 1)"
SLUG = lambda x: f"'extended_char_' || CASE WHEN regexp_full_match({x}, '[a-zA-Z0-9_.]+') THEN {x} ELSE substr(sha256({x}), 1, 6) END"
FLOW = f"""{BASE},
rk AS (
  SELECT DISTINCT container_id, unnest(list_filter(list_transform(regexp_split_to_array(x, '[;；]'), lambda x: {strip('x')}), lambda x: x <> '')) AS name
  FROM (SELECT {HOST} AS container_id, replace(regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1), ' ', ';') AS x FROM pages)),
pl AS (SELECT name AS canonical, min(entity_id) AS char_id FROM ent WHERE name <> '' GROUP BY name),
pg AS (SELECT entity_id AS page_id FROM ent WHERE length(term) % 2 = 0 UNION SELECT {SLUG('name')} FROM rk WHERE length(name) % 3 = 0),
cn AS (SELECT coalesce(canonical, name) AS canonical, min(name) AS raw_name FROM (SELECT DISTINCT name FROM rk) LEFT JOIN aliasmap ON alias = name GROUP BY 1),
found AS (
  SELECT cn.canonical, raw_name, CASE WHEN char_id IN (SELECT page_id FROM pg) THEN char_id WHEN {SLUG('cn.canonical')} IN (SELECT page_id FROM pg) THEN {SLUG('cn.canonical')} END AS page_id,
    CASE WHEN char_id IN (SELECT page_id FROM pg) THEN 'playable' WHEN {SLUG('cn.canonical')} IN (SELECT page_id FROM pg) THEN 'extended' END AS kind
  FROM cn LEFT JOIN pl ON pl.canonical = cn.canonical)"""
ORACLES["q_candidates"] = f"WITH {FLOW} SELECT canonical, raw_name, page_id, kind, CASE WHEN page_id IS NULL THEN 'new' ELSE 'existing' END AS status FROM found"
ORACLES["q_candidate_containers"] = f"WITH {FLOW} SELECT canonical, container_id FROM found JOIN rk ON rk.name = raw_name"
ORACLES["q_similar_names"] = f"""WITH {BASE}, {KEYS},
r AS (SELECT DISTINCT name FROM ename WHERE name NOT IN (SELECT alias FROM aliasmap) AND length(name) >= 2), k AS (SELECT DISTINCT canonical FROM cur WHERE length(canonical) >= 2)
SELECT name, min(canonical) AS similar FROM r JOIN k ON name <> canonical AND (contains(name, canonical) OR contains(canonical, name)) GROUP BY name"""
ORACLES["q_related_containers"] = f"""WITH {BASE}, {KEYS}, {DOC}, {PAGE}, {CONV}, {CHUNK},
n AS (SELECT entity_id, name AS alias FROM ent WHERE name <> '' UNION SELECT entity_id, appellation FROM ent WHERE name <> '')
SELECT entity_id, container_id FROM n JOIN chunk ON contains(body, alias || ':')
UNION SELECT entity_id, container_id FROM n JOIN ename e ON e.name = alias OR (length(alias) >= 3 AND contains(e.name, alias))"""
ORACLES["q_link_lines"] = """
SELECT p_partkey, CAST(0 AS BIGINT) AS ord, '-   **[' || p_brand || '](brands/' || p_brand || '.md)**: ' || p_name AS bullet FROM part
UNION ALL SELECT p_partkey, 2, '-   **' || p_type || '：size**: ' || p_size FROM part
UNION ALL SELECT p_partkey, 3, '-   plain ' || p_name FROM part"""
ORACLES["q_index_rows"] = """
WITH r AS (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS p FROM part)
SELECT p_brand, CAST(p // 5 AS BIGINT) AS row_no, '| ' || string_agg(p_name, ' | ' ORDER BY p) || repeat(' | ', CAST(5 - count(*) AS BIGINT)) || ' |' AS line FROM r GROUP BY p_brand, p // 5"""
ORACLES["q_render_page"] = f"""SELECT page_id, CASE WHEN {' AND '.join(HAS('html', t) for t in ('h1', 'footer', 'article', 'title'))} THEN
  concat('# ', replace({strip(FIRST('html', 'title'))}, chr(10), ''), chr(10), '页面版本:2', chr(10), '## h1', chr(10), {strip(FIRST('html', 'h1'))}, chr(10), '## footer', chr(10), {strip(FIRST('html', 'footer'))},
    chr(10), '## article', chr(10), {strip(FIRST('html', 'article'))}) END AS page FROM pages"""
MERGED = """v1 AS (SELECT 'n' || substr(c_name, 10, 20) AS name, CASE WHEN c_nationkey < 12 THEN 'char_' ELSE 'extended_char_' END || c_custkey || '.md' AS f1 FROM customer UNION ALL SELECT n_name, 'char_n.md' FROM nation),
v3 AS (SELECT 'n' || substr(s_name, 10, 20) AS name, CASE WHEN s_nationkey < 12 THEN 'char_' WHEN s_nationkey < 20 THEN 'extended_char_' ELSE 'other_' END || s_suppkey || '.md' AS f2 FROM supplier),
mg AS (SELECT name, max(f1) AS f1, max(f2) AS f2 FROM (SELECT name, f1, NULL AS f2 FROM v1 UNION ALL SELECT name, NULL, f2 FROM v3) GROUP BY name),
mi AS (SELECT name, coalesce(f2, f1) AS file, CASE WHEN coalesce(f2, f1) LIKE 'char%' THEN 'entity' WHEN coalesce(f2, f1) LIKE 'extended%' THEN 'other' END AS kind,
  name || '(' || concat_ws(',', '[v1](chars/' || f1 || ')', '[v2](char_v3/' || f2 || ')') || ')' AS display,
  CASE WHEN f2 IS NOT NULL THEN '[' || name || '](char_v3/' || f2 || ')' || coalesce('([v1](chars/' || f1 || '))', '') END AS compact FROM mg)"""
ORACLES["q_merge_indexes"] = f"WITH {MERGED} SELECT * FROM mi"
ORACLES["q_page_index"] = f"WITH {MERGED} SELECT kind, count(*) AS n_pages FROM mi WHERE kind IS NOT NULL GROUP BY kind"
ORACLES["q_whats_new"] = """
SELECT l_orderkey AS item_id, CASE WHEN o_orderkey IS NOT NULL AND o_orderstatus <> 'P' THEN '[order ' || o_orderkey || '](docs/stories/' || o_orderkey || '.md)' || CASE WHEN o_orderpriority = '1-URGENT' AND c_name IS NOT NULL THEN '(' || c_name || ')' ELSE '' END END AS link,
  CASE WHEN o_orderkey IS NULL THEN 'unknown item' WHEN o_orderstatus = 'P' THEN 'no page' END AS reason
FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey"""

# ---- request documents ----
PARTS = "p AS (SELECT *, format('part{:09d}', p_partkey) AS entity_id, chr(10) AS nl FROM part)"
ORACLES["q_dossiers"] = f"""WITH {PARTS} SELECT entity_id, p_name AS name, concat('<干员信息>', nl, '<干员名称>', nl, p_name, '</干员名称>', nl,
  nl, '<干员招聘文本>', nl, p_name, nl, CASE WHEN p_size > 20 THEN p_type ELSE 'None' END, nl, '</干员招聘文本>', nl,
  CASE WHEN p_size > 5 THEN concat(nl, '<干员语音>', nl, p_type, nl, p_brand, nl, '</干员语音>', nl) ELSE '' END,
  nl, '<干员档案>', nl, p_type, ':', p_name, nl, '</干员档案>', nl, nl, '<干员皮肤>', nl,
  CASE WHEN p_size > 30 THEN concat('名称:', p_type, chr(9), '描述:None', chr(9), '用途:', p_brand, chr(9), '旁白:', p_name, nl) ELSE '' END, '</干员皮肤>', nl, nl, '<干员模组>', nl,
  CASE WHEN p_size > 40 THEN concat('<模组名称>', p_brand, '</模组名称>', nl, '<模组描述>', nl, p_type, nl, '</模组描述>', nl, nl) ELSE '' END, '</干员模组>', nl, '</干员信息>') AS dossier FROM p"""
ORACLES["q_relation_requests"] = f"""WITH {PARTS}, r AS (SELECT entity_id, concat('=== profile.txt ===', nl, '<干员招聘文本>', nl, p_name, CASE WHEN p_size > 20 THEN nl || p_type ELSE '' END, nl, '</干员招聘文本>',
  CASE WHEN p_size > 10 THEN nl || '<国家>' || p_brand || '</国家>' ELSE '' END, nl, nl, '=== archive.txt ===', nl, '<干员档案>', nl, p_type, ':', nl, p_name, nl, '</干员档案>',
  CASE WHEN p_size > 5 THEN concat(nl, nl, '=== voice.txt ===', nl, '<干员语音>', nl, p_type, nl, p_brand, nl, '</干员语音>') ELSE '' END) AS request FROM p)
SELECT entity_id, request, length(request) AS request_length FROM r"""
ORACLES["q_entity_requests"] = f"""WITH {ENTITIES},
kn AS (SELECT name, 'terms from ' || min(term) AS dossier FROM ent WHERE name <> '' GROUP BY name)
SELECT ent.entity_id, CAST(0 AS BIGINT) AS block, CAST(0 AS BIGINT) AS ord, '名称:' || name || chr(10) || '已知其他名称(可能有更多):' || (SELECT string_agg(alias, ';' ORDER BY o, alias) FROM opal WHERE opal.entity_id = ent.entity_id) AS text
FROM ent WHERE name <> ''
UNION ALL SELECT entity_id, 1, rank, dossier FROM (SELECT entity_id, alias, row_number() OVER (PARTITION BY entity_id ORDER BY o, alias) - 1 AS rank FROM opal) JOIN kn ON alias = name
UNION ALL SELECT entity_id, 2, stage_idx, concat('<活动名称>', container_id, '</活动名称>', chr(10), '<相关内容>', chr(10), {FIRST('html', 'title')}, chr(10), '</相关内容>', chr(10), chr(10))
FROM det JOIN pages ON page_id = stage_idx"""
ORACLES["q_merge_requests"] = f"""WITH {DOC}, big AS (SELECT container_id, min(stage_idx) AS first FROM doc GROUP BY 1
  HAVING (sum(length(body)) > 80000 OR count(*) > 10) AND count(*) FILTER (length(body) % 997 = 0) = 0)
SELECT container_id, CAST(stage_idx AS BIGINT) AS part_no, concat(CASE WHEN stage_idx > first THEN chr(10) || chr(10) || '---' || chr(10) || chr(10) ELSE '' END,
  {block('摘要', 'name')}, chr(10), {block('正文', 'tag')}) AS part FROM doc JOIN big USING (container_id)
UNION ALL SELECT container_id, -1, 'merge' || chr(10) FROM big UNION ALL SELECT container_id, 9223372036854775807, chr(10) || 'please' FROM big"""
ORACLES["q_selected_units"] = f"""WITH {FULL} SELECT entity_id, name FROM ent WHERE name <> ''
  AND entity_id IN (SELECT entity_id FROM det) AND entity_id IN (SELECT entity_id FROM part1)"""

# ---- audits ----
GNAMES = """gname AS (
  SELECT DISTINCT container_id, stage_idx, name FROM sname UNION SELECT DISTINCT container_id, CAST(NULL AS BIGINT), name FROM ename),
gknown AS (SELECT name, sole_id AS entity_id FROM (SELECT DISTINCT name FROM gname WHERE name <> '') LEFT JOIN idx ON alias = name),
gform AS (SELECT name, name AS form FROM gknown UNION SELECT name, alias FROM gknown JOIN own USING (entity_id) WHERE alias <> ''),
gmat AS (SELECT DISTINCT form AS alias, CASE WHEN regexp_full_match(form, '[\\x00-\\x7F]*') THEN 'ascii' ELSE 'other' END AS mode FROM gform)"""
ESCAPED = "regexp_replace(form, '([^A-Za-z0-9])', '\\\\\\1', 'g')"
ORACLES["q_grounding"] = f"""WITH {BASE}, {DOC}, {PAGE}, {CONV}, {CHUNK}, {LINK}, {KEYS}, {GNAMES},
{hits("chunk").replace("FROM mat", "FROM gmat")},
gev AS (
  SELECT container_id, stage_idx, name, alias AS form, n FROM hit JOIN gform ON form = alias
  WHERE n > 0 AND (container_id, name) IN (SELECT container_id, name FROM gname)),
gat AS (
  SELECT container_id, stage_idx, name, n, CASE WHEN regexp_full_match(form, '[\\x00-\\x7F]*')
    THEN length(regexp_extract(body, '(?s)^(.*?(?:^|[^A-Za-z0-9]))' || {ESCAPED} || '(?:[^A-Za-z0-9]|$)', 1)) ELSE instr(body, form) - 1 END AS start
  FROM gev JOIN chunk USING (container_id, stage_idx)),
gchunk AS (SELECT container_id, stage_idx, name, sum(n) AS n, min(start) AS start FROM gat GROUP BY ALL),
gall AS (
  SELECT container_id, stage_idx, name, 1 AS n_chunks, n, stage_idx AS first_stage, start FROM gchunk
  UNION ALL SELECT container_id, NULL, name, count(*), sum(n), min(stage_idx), arg_min(start, stage_idx) FROM gchunk GROUP BY container_id, name)
SELECT g.container_id, g.stage_idx, g.name, CASE WHEN n > 0 THEN 'OK' ELSE 'MISS' END AS status, entity_id, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks,
  CAST(coalesce(n, 0) AS BIGINT) AS n_mentions, first_stage, CAST(start AS BIGINT) AS first_start
FROM gname g LEFT JOIN gall a ON a.container_id = g.container_id AND a.name = g.name AND a.stage_idx IS NOT DISTINCT FROM g.stage_idx
LEFT JOIN gknown k ON k.name = g.name"""
ORACLES["q_entity_coverage"] = f"""WITH {FULL}
SELECT container_id, entity_id, count(DISTINCT stage_idx) AS n_chunks FROM part1 WHERE tier IN ('speaker', 'named')
  AND (container_id, entity_id) NOT IN (
    SELECT container_id, sole_id FROM (SELECT container_id, name FROM sname UNION SELECT container_id, name FROM ename) JOIN idx ON alias = name WHERE n_ids = 1)
GROUP BY ALL"""

# ---- relation network ----
RNET = f"""{REL},
rlink AS (
  SELECT DISTINCT head AS a, coalesce(tail, tail_name) AS b, type FROM rel
  WHERE head <> '' AND coalesce(tail, tail_name) <> '' AND head <> coalesce(tail, tail_name)),
rboth AS MATERIALIZED (SELECT a, b FROM rlink UNION SELECT b, a FROM rlink)"""
ROUNDS = 12  # more than the longest distance in these tables
ORACLES["q_relation_components"] = f"WITH {RNET}, c0 AS (SELECT DISTINCT a AS node, a AS component FROM rboth)" + "".join(
    f""",
c{k + 1} AS MATERIALIZED (
  SELECT c.node, least(c.component, min(o.component)) AS component FROM c{k} c JOIN rboth ON a = c.node JOIN c{k} o ON o.node = b GROUP BY c.node, c.component)"""
    for k in range(ROUNDS)) + f"\nSELECT node, component FROM c{ROUNDS}"


def _levels(name: str, start: str, most: int) -> str:
    """Distance of every node from one end of each pair, level by level."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT source, target, {start} AS node, 0 AS d FROM rpair)"]
    for k in range(most):
        steps.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT * FROM {name}{k} UNION ALL
  SELECT DISTINCT source, target, b AS node, {k + 1} AS d FROM {name}{k} f JOIN rboth ON a = node
  WHERE d = {k} AND NOT EXISTS (SELECT 1 FROM {name}{k} o WHERE o.source = f.source AND o.target = f.target AND o.node = b))""")
    return ",\n".join(steps)


MOST = 6
WALK = ",\n".join(f"""w{k + 1} AS MATERIALIZED (
  SELECT w.source, w.target, {k + 1} AS hop, w.via AS prior, min(b) AS via FROM w{k} w JOIN rboth ON a = w.via
  JOIN ron o ON o.source = w.source AND o.target = w.target AND o.node = b AND o.d = {k + 1} GROUP BY ALL)""" for k in range(MOST))
ORACLES["q_relation_path"] = f"""WITH {RNET},
rhome AS (SELECT a, n_nationkey FROM rlink JOIN nation ON n_name = b),
rfrom AS (SELECT n_nationkey, min(a) AS e FROM rhome WHERE starts_with(a, 'Customer') GROUP BY 1),
rto AS (SELECT n_nationkey, min(a) AS e FROM rhome WHERE starts_with(a, 'Supplier') GROUP BY 1),
rpair AS (
  SELECT f.e AS source, t.e AS target FROM rfrom f JOIN rto t ON t.n_nationkey = (f.n_nationkey + 5) % 25
  UNION SELECT DISTINCT p_brand, (SELECT 'size ' || max(p_size) FROM part) FROM part),
{_levels("fwd", "source", MOST)},
{_levels("bwd", "target", MOST)},
ron AS MATERIALIZED (
  SELECT f.source, f.target, f.node, f.d FROM fwd{MOST} f JOIN bwd{MOST} b USING (source, target, node)
  JOIN (SELECT source, target, min(f.d + b.d) AS best FROM fwd{MOST} f JOIN bwd{MOST} b USING (source, target, node) GROUP BY ALL) m USING (source, target)
  WHERE f.d + b.d = best AND best <= {MOST}),
w0 AS (SELECT source, target, 0 AS hop, CAST(NULL AS VARCHAR) AS prior, source AS via FROM rpair),
{WALK}
SELECT source, target, CAST(hop AS BIGINT) AS hop, via, (SELECT min(type) FROM rlink WHERE (a = prior AND b = via) OR (a = via AND b = prior)) AS type
FROM ({" UNION ALL ".join(f"SELECT * FROM w{k + 1}" for k in range(MOST))})"""


# ---- indexed search, mined names ----
LINES_OF = lambda where: f"""WITH {NAV}, {DOC}, {PAGE}, {CONV}, {CHUNK},
cl AS (SELECT container_id, stage_idx, unnest({lines('body')}) AS line, generate_subscripts({lines('body')}, 1) AS line_no FROM chunk)
SELECT container_id, stage_idx, line, CAST(line_no AS BIGINT) AS line_no, substr(line, 1, 200) AS snippet FROM cl WHERE {where}"""
ORACLES["q_grep_scoped"] = LINES_OF("container_id = 'src7-en' AND contains(line, ' = ')")
ORACLES["q_grep_indexed"] = LINES_OF("contains(line, 'token = ')")
ORACLES["q_mined_names"] = rf"""WITH {BASE}, {DOC}, {PAGE}, {CONV}, {CHUNK},
run AS (SELECT container_id, stage_idx, string_split(unnest(regexp_extract_all(body, '(\p{{L}}+(?: \p{{L}}+)*)', 1)), ' ') AS u FROM chunk),
gram AS (
  SELECT container_id, stage_idx, array_to_string(u[k:k + n - 1], ' ') AS phrase FROM (
    SELECT container_id, stage_idx, u, n, unnest(range(1, len(u) - n + 2)) AS k FROM run, (SELECT unnest([2, 3, 4]) AS n) WHERE len(u) >= n)),
freq AS MATERIALIZED (
  SELECT container_id, phrase, count(*) AS n, count(DISTINCT stage_idx) AS spread FROM gram GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT stage_idx) >= 2),
part AS (
  SELECT container_id, regexp_extract(phrase, '^(.*) [^ ]+$', 1) AS phrase, n FROM freq UNION SELECT container_id, regexp_extract(phrase, '^[^ ]+ (.*)$', 1), n FROM freq),
kept AS (
  SELECT * FROM freq WHERE (container_id, phrase, n) NOT IN (SELECT container_id, phrase, n FROM part)
    AND phrase NOT IN (SELECT alias FROM mat) AND phrase NOT IN ({BLOCKED})),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY container_id ORDER BY n * spread DESC, length(phrase) DESC, phrase) AS rank FROM kept)
SELECT container_id, phrase, n, spread, rank FROM ranked WHERE rank <= 20"""
