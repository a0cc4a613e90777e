"""Every registered query: name -> function of a `Corpus`. The SQL twins are in `oracles`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx
from scriptloom.operators import aliases as al
from scriptloom.operators import candidates as ca
from scriptloom.operators import chunks as ch
from scriptloom.operators import cooccurrence as co
from scriptloom.operators import edges as ed
from scriptloom.operators import entities as en
from scriptloom.operators import gram_index as gi
from scriptloom.operators import grounding as gr
from scriptloom.operators import incremental as inc
from scriptloom.operators import mining as mi
from scriptloom.operators import network as net
from scriptloom.operators import pages as pg
from scriptloom.operators import participants as pa
from scriptloom.operators import relations as rel
from scriptloom.operators import search as se
from scriptloom.operators import stats as st
from scriptloom.plans.bind import Corpus
from scriptloom.session import checkpoint_root, written
from scriptloom.sources import lines as ln

QUERIES: dict = {}
REPAIR_TAGS = ["摘要", "正文"]
OVERHEADS = (1200, 700, 900)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def big(c):
    return tx.col(c).cast("bigint")


def joined(c, sep=";"):
    return F.array_join(tx.col(c), sep)


# ---- text ---------------------------------------------------------------------------------


@query
def q_clean_script(c: Corpus) -> DataFrame:
    return c.raw_scripts().select("conv_id", "turn", tx.clean_script("raw").alias("script"))


@query
def q_extract_tag(c: Corpus) -> DataFrame:
    rows = c.texts("pages").select("page_id", F.posexplode(tg.tag_bodies("html", "p")).alias("pos", "content"))
    return rows.select("page_id", big("pos").alias("pos"), "content")


@query
def q_validate_tags(c: Corpus) -> DataFrame:
    need = ["title", "article", "footer", "aside"]
    p = c.texts("pages")
    return p.select(
        "page_id", joined(tg.missing_tags("html", need)).alias("missing"),
        tg.rebuild("html", need[:3]).alias("rebuilt"),
    )


def odd_documents(c: Corpus) -> DataFrame:
    """Documents wrapped in clean, unclosed, bracketed, labelled and absent tags."""
    d = c.texts("documents")
    lang, text = F.col("lang"), F.col("text")
    lit = F.lit
    clean = F.concat(lit("<摘要>"), lang, lit("</摘要>\n<正文>"), text, lit("</正文>"))
    shapes = [
        clean,
        F.concat(lit("<摘要>"), lang, lit("</摘要>\n<正文>"), text),
        F.concat(lit("【 摘要 】"), lang, lit("【/摘要】\n【正文】"), text, lit("【/ 正文】")),
        F.concat(lit("<摘要>"), lang, lit("</摘要>\n**正文**\n"), text),
        F.concat(lit("<摘要>"), lang, lit("</摘要>\n"), text),
        F.concat(lit("摘要："), lang, lit("\n### 正文\n"), text),
    ]
    pick = F.element_at(F.array(*shapes), (F.length("text") % 6 + 1).cast("int"))
    return d.select("doc_id", "text", pick.alias("odd"))


@query
def q_repair_tags(c: Corpus) -> DataFrame:
    text, missing = tg.repaired("odd", REPAIR_TAGS)
    return odd_documents(c).select("doc_id", text.alias("fixed"), joined(missing).alias("missing"))


@query
def q_safe_slug(c: Corpus) -> DataFrame:
    return c.nav_terms().select("page_id", "ord", "term", tx.safe_slug("term").alias("slug"))


@query
def q_path(c: Corpus) -> DataFrame:
    return c.chunks().select(
        "container_id", "stage_idx", tx.normal_path("path").alias("norm"), tx.path_prefix("path").alias("prefix")
    )


@query
def q_family(c: Corpus) -> DataFrame:
    return c.chunks().select("container_id", "stage_idx", tx.source_family("path", "entry_type").alias("family"))


@query
def q_format_chunk(c: Corpus) -> DataFrame:
    d = c.documents()
    whole = tx.format_chunk("container_id", "container_name", "stage_idx", "name", "tag", "info", "body")
    return d.select(
        F.col("stage_idx").alias("doc_id"), whole.alias("chunk"), tx.chunk_file("stage_idx", "name", "tag").alias("file")
    )


def field_blocks(c: Corpus) -> DataFrame:
    p = c.texts("part")
    again = F.when(F.col("p_size") > 25, F.concat(F.lit("\n【brand】 big "), "p_brand")).otherwise("")
    text = F.concat(
        F.lit("ignored\n【brand】 "), "p_brand", F.lit("\n【type】\n"), "p_type", F.lit("\n  "), "p_name",
        F.lit("  \n\n【size】"), F.col("p_size").cast("string"), again,
    )
    return p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", text.alias("block"))


@query
def q_bracket_block(c: Corpus) -> DataFrame:
    rows = field_blocks(c).select("p_partkey", F.posexplode(tx.bracket_fields("block")).alias("pos", "f"))
    return rows.select("p_partkey", big("pos").alias("pos"), "f.field", "f.value")


@query
def q_fact_card(c: Corpus) -> DataFrame:
    from scriptloom.operators.cards import fact_card

    none = F.lit(None).cast("string")
    e = field_blocks(c).select(
        F.format_string("part%09d", "p_partkey").alias("entity_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("appellation"), none.alias("nation_id"),
        F.array(F.struct(F.lit("基础档案").alias("title"), F.col("block").alias("text")),
                F.struct(F.lit("客观履历").alias("title"), F.concat(F.lit(" "), "p_type", F.lit("\n")).alias("text"))).alias("stories"),
        F.array(F.struct(F.col("p_type").alias("skinName"), none.alias("dialog"), none.alias("usage"),
                         F.when(F.col("p_size") > 10, F.col("p_name")).alias("description"))).alias("skins"),
        F.array(F.struct(F.col("p_brand").alias("name"), F.col("p_type").alias("desc"))).alias("modules"),
    )
    card = fact_card(e)
    return card.select(
        "entity_id", "name", "appellation", "nation_id", F.col("basic_info")["brand"].alias("brand"),
        F.col("basic_info")["type"].alias("type"), F.col("basic_info")["size"].alias("size"),
        big(F.size("physical_exam")).alias("n_exam"), "objective_record", joined("archive_sections").alias("archive"),
        joined("skin_names").alias("skins"), joined("module_names").alias("modules"),
        F.col("sources")["basic_info"].alias("basic_source"),
    )


def part_entities(c: Corpus) -> DataFrame:
    none = F.lit(None).cast("string")
    return c.table("part").select(
        F.format_string("part%09d", "p_partkey").alias("entity_id"), F.col("p_name").alias("name"), F.col("p_name").alias("usage"),
        F.when(F.col("p_size") > 20, F.col("p_type")).alias("item_desc"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("nation_id"),
        F.when(F.col("p_size") > 5, F.array("p_type", "p_brand")).alias("words"),
        F.array(F.struct(F.col("p_type").alias("title"), F.col("p_name").alias("text"))).alias("stories"),
        F.array(F.struct(F.col("p_type").alias("skinName"), none.alias("dialog"), F.col("p_brand").alias("usage"),
                         F.when(F.col("p_size") > 30, F.col("p_name")).alias("description"))).alias("skins"),
        F.array(F.struct(F.col("p_brand").alias("name"), F.when(F.col("p_size") > 40, F.col("p_type")).alias("desc"))).alias("modules"),
    )


@query
def q_sections(c: Corpus) -> DataFrame:
    from scriptloom.operators.cards import section_texts

    return section_texts(part_entities(c))


@query
def q_dossiers(c: Corpus) -> DataFrame:
    from scriptloom.operators.cards import dossiers

    return dossiers(part_entities(c))


@query
def q_relation_requests(c: Corpus) -> DataFrame:
    sections = [("profile.txt", tx.profile_section("usage", "item_desc", "nation_id")),
                ("archive.txt", tx.archive_section("stories")), ("voice.txt", tx.voice_section("words"))]
    e = part_entities(c).filter(F.col("name") != "")
    text = inc.section_document(sections)
    return e.select("entity_id", text.alias("request"), big(F.length(text)).alias("request_length"))


@query
def q_entity_requests(c: Corpus) -> DataFrame:
    from scriptloom.operators.cards import request_parts

    named = c.entities().filter(F.col("name") != "")
    known = named.groupBy("name").agg(F.concat(F.lit("terms from "), F.min("term")).alias("dossier"))
    told = c.explicit().join(c.page_chunks().select("container_id", "stage_idx", F.col("name").alias("text")), ["container_id", "stage_idx"])
    told = told.select("entity_id", F.col("stage_idx").alias("ord"), F.col("container_id").alias("title"), "text")
    rows = request_parts(named, al.manifest_aliases(c.entities(), c.curated()), known, told)
    return rows.withColumn("block", big("block"))


@query
def q_mention_count(c: Corpus) -> DataFrame:
    hits = pa.mention_counts(c.chunks(), c.match_aliases())
    return hits.groupBy("alias").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n").alias("n_mentions"))


@query
def q_alias_mode(c: Corpus) -> DataFrame:
    return c.match_aliases().groupBy("mode").agg(F.count(F.lit(1)).alias("n_aliases"))


@query
def q_key_names(c: Corpus) -> DataFrame:
    return c.stage_names()


@query
def q_entity_id(c: Corpus) -> DataFrame:
    return c.entities().select("term", tx.entity_id("term").alias("synthetic_id"))


@query
def q_parse_relations(c: Corpus) -> DataFrame:
    rows = rel.parsed_lines(c.responses())
    return rows.select("unit_id", big("line_no").alias("line_no"), "type", "tail_name", "notes", "reason")


@query
def q_content_hash(c: Corpus) -> DataFrame:
    return inc.content_hash(c.units())


@query
def q_multi_pass(c: Corpus) -> DataFrame:
    u = c.unit_totals()
    return u.select("unit_id", "total_length", "stage_count", tx.multi_pass("total_length", "stage_count").alias("multi"))


@query
def q_zip_tags(c: Corpus) -> DataFrame:
    doc = F.concat(
        F.lit("<活动名称>"), "source", F.lit("</活动名称>\n<相关内容>"), "text", F.lit("</相关内容>\n"),
        F.lit("<活动名称>"), "lang", F.lit("</活动名称>\n"),
        F.when(F.length("text") % 7 == 0, "").otherwise(F.concat(F.lit("<相关内容>"), "source", F.lit("</相关内容>"))),
    )
    d = c.texts("documents").select("doc_id", tg.zipped_bodies(doc, "活动名称", "相关内容").alias("z"))
    rows = d.select("doc_id", F.posexplode_outer("z").alias("pos", "pair"))
    return rows.select("doc_id", big("pos").alias("pos"), F.col("pair.name").alias("name"), F.col("pair.body").alias("content"))


@query
def q_positions(c: Corpus) -> DataFrame:
    d = c.chunks().select("container_id", F.col("stage_idx").alias("doc_id"))
    return ch.positions(d, "container_id", "doc_id", width=128)


@query
def q_container_text(c: Corpus) -> DataFrame:
    return ch.text_parts(c.documents())


# ---- aliases --------------------------------------------------------------------------------


@query
def q_alias_rows(c: Corpus) -> DataFrame:
    return c.curated().select("canonical", "alias")


@query
def q_alias_map(c: Corpus) -> DataFrame:
    return ln.alias_map(c.alias_lines())


@query
def q_ambiguous_names(c: Corpus) -> DataFrame:
    return al.ambiguous_names(c.entities())


@query
def q_alias_index(c: Corpus) -> DataFrame:
    return c.alias_index()


@query
def q_alias_owners(c: Corpus) -> DataFrame:
    return c.owners()


@query
def q_alias_class(c: Corpus) -> DataFrame:
    return c.match_aliases()


@query
def q_resolve_names(c: Corpus) -> DataFrame:
    names = c.container_names().select("name").distinct()
    return al.resolve(names, c.alias_index())


@query
def q_resolve_candidates(c: Corpus) -> DataFrame:
    names = c.container_names().select("name").distinct()
    return al.candidates(al.resolve(names, c.alias_index()), c.owners())


# ---- links, participants, edges --------------------------------------------------------------


def text_links(c: Corpus) -> tuple[DataFrame, DataFrame]:
    d, b = c.texts("documents"), c.table("benchmark")
    index = d.select(F.md5("text").alias("link_key"), F.concat_ws("-", "source", "lang").alias("container_id"), F.col("doc_id").alias("stage_idx"))
    links = d.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("owner"), F.md5("text").alias("link_key"))
    items = b.select(F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("owner"), F.md5("text").alias("link_key"))
    return links.unionByName(items), index


@query
def q_resolve_links(c: Corpus) -> DataFrame:
    return ch.resolve_links(*text_links(c))


@query
def q_link_candidates(c: Corpus) -> DataFrame:
    links, index = text_links(c)
    return ch.link_candidates(ch.resolve_links(links, index), index)


@query
def q_explicit_edges(c: Corpus) -> DataFrame:
    return c.explicit()


@query
def q_speaker_counts(c: Corpus) -> DataFrame:
    return pa.speaker_counts(c.chunks())


@query
def q_participants(c: Corpus) -> DataFrame:
    return c.participants().withColumn("matched_aliases", joined("matched_aliases"))


@query
def q_subtract_explicit(c: Corpus) -> DataFrame:
    hits = pa.participants(c.chunks(), c.match_aliases())
    left = hits.join(c.explicit(), ["entity_id", "container_id", "stage_idx"], "left_anti")
    return left.select("entity_id", "container_id", "stage_idx", "tier")


@query
def q_summary_edges(c: Corpus) -> DataFrame:
    return c.summary().withColumn("matched_aliases", joined("matched_aliases"))


@query
def q_unresolved_names(c: Corpus) -> DataFrame:
    u = c.unresolved()
    first = en.first_containers(u).select("name", joined("first_container_ids").alias("first_container_ids"))
    counted = u.groupBy("name").agg(F.count(F.lit(1)).alias("n_containers"))
    return counted.join(first, "name")


@query
def q_edges_union(c: Corpus) -> DataFrame:
    return c.edges().withColumn("matched_aliases", joined("matched_aliases"))


@query
def q_edges_min_tier(c: Corpus) -> DataFrame:
    return c.edges().filter(ed.passes("named")).groupBy("source", "tier").agg(F.count(F.lit(1)).alias("n_edges"))


@query
def q_appearances(c: Corpus) -> DataFrame:
    first = c.explicit().agg(F.min("entity_id")).first()[0]
    return c.edges_near(entity_id=first).filter(ed.passes("speaker")).select("entity_id", "container_id", "stage_idx", "source", "tier")


@query
def q_container_entities(c: Corpus) -> DataFrame:
    return ed.of_container(c.edges_near("src7-en"), "src7-en", "participant", "named").select(
        "entity_id", "container_id", "stage_idx", "tier", "mention_count"
    )


@query
def q_chunk_entities(c: Corpus) -> DataFrame:
    return ed.of_chunk(c.edges_near("conv0", 0), "conv0", 0, "all", "mentioned").select(
        "entity_id", "container_id", "stage_idx", "source", "tier", "spoke_lines", "mention_count"
    )


@query
def q_group_by_container(c: Corpus) -> DataFrame:
    return ed.by_container(c.edges()).select(
        "container_id", "entity_id", "stage_idx", "source", "tier", "n_edges", "n_explicit", "n_participant", "n_summary")


@query
def q_key_ids(c: Corpus) -> DataFrame:
    return ed.key_ids(c.summary())


@query
def q_entity_table(c: Corpus) -> DataFrame:
    seen = c.participants().select("entity_id").distinct().withColumn("seen", F.lit(True))
    linked = c.explicit().groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    e = c.entities().join(seen, "entity_id", "left").join(linked, "entity_id", "left")
    return e.select(
        "entity_id", "name", F.coalesce("n", F.lit(0)).alias("link_count"),
        F.col("seen").isNotNull().alias("has_participant_appearances"),
    )


# ---- containers -------------------------------------------------------------------------------


@query
def q_container_rollup(c: Corpus) -> DataFrame:
    return ch.rollup(c.chunks())


@query
def q_container_prefixes(c: Corpus) -> DataFrame:
    return ch.prefixes(c.chunks(), "path")


@query
def q_stage_table(c: Corpus) -> DataFrame:
    rows = c.documents().withColumn("source_family", tx.source_family("path", "entry_type"))
    return ch.stage_table(rows)


def container_families(c: Corpus) -> DataFrame:
    first = c.chunks().groupBy("container_id").agg(
        F.min_by(F.struct("path", "entry_type"), "stage_idx").alias("f")
    )
    return first.withColumn("source_family", tx.source_family("f.path", "f.entry_type"))


@query
def q_family_ids(c: Corpus) -> DataFrame:
    return ch.family_ids(container_families(c))


@query
def q_run_outcome(c: Corpus) -> DataFrame:
    plan = planned(c)
    failed = plan.filter("status = 'run' and unit_id like '%-de'")
    return inc.run_outcome(plan, failed, c.prior_state())


@query
def q_family_counts(c: Corpus) -> DataFrame:
    return ch.family_counts(container_families(c))


@query
def q_corpus_stats(c: Corpus) -> DataFrame:
    d = written(c.chunks().select(F.length("body").alias("n")), "chunk-lengths")  # read by three branches
    sizes = st.percentiles(d, "n", {"median": 0.5, "p90": 0.9, "p95": 0.95})
    plain = d.agg(*st.totals(d, "n")).select(
        F.explode(F.array(F.struct(F.lit("count").alias("stat"), F.col("n").alias("value")),
                          F.struct(F.lit("max").alias("stat"), F.col("max").alias("value")))).alias("x")
    ).select("x.*")
    return sizes.unionByName(plain)


@query
def q_size_limits(c: Corpus) -> DataFrame:
    return st.above_limits(c.unit_totals(), "total_length")


@query
def q_link_stats(c: Corpus) -> DataFrame:
    return ch.resolve_links(*text_links(c)).groupBy("status").agg(F.count(F.lit(1)).alias("n_links"))


# ---- entities ---------------------------------------------------------------------------------


@query
def q_operator_entities(c: Corpus) -> DataFrame:
    e = c.operator_entities()
    return e.select("entity_id", "name", "entity_type", "char_id", "appellation", joined("aliases").alias("aliases"), joined("sources").alias("sources"))


@query
def q_curated_entities(c: Corpus) -> DataFrame:
    e = c.curated_entities()
    return e.select("entity_id", "name", "entity_type", joined("aliases").alias("aliases"), "notes")


@query
def q_curated_conflicts(c: Corpus) -> DataFrame:
    return en.curated_conflicts(c.curated_entries(), c.owners()).withColumn("candidates", joined("candidates"))


@query
def q_auto_seed(c: Corpus) -> DataFrame:
    cur = c.curated_entities()
    taken = c.entities().select("entity_id").unionByName(cur.select("entity_id"))
    seeded = en.auto_seeded(c.unresolved(), cur, taken)
    return seeded.select("entity_id", "name", joined("first_container_ids").alias("first_container_ids"))


@query
def q_entities(c: Corpus) -> DataFrame:
    return c.all_entities().select("entity_id", "name", "entity_type", joined("aliases").alias("aliases"))


@query
def q_entities_by_type(c: Corpus) -> DataFrame:
    return c.all_entities().groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_entities"))


@query
def q_entity_aliases(c: Corpus) -> DataFrame:
    return al.index(en.alias_owners(c.all_entities())).select("alias", "n_ids")


@query
def q_entity_edges(c: Corpus) -> DataFrame:
    e = ed.summary_edges(c.stage_names(), c.container_names(), c.entity_index(), None, c.entities().select("entity_id"))
    return e.select("entity_id", "container_id", "stage_idx", joined("matched_aliases").alias("matched_aliases"))


def entity_lines(c: Corpus) -> DataFrame:
    """Curated entity file of the parts: good rows and each kind of broken row."""
    p = c.table("part")
    obj = F.concat(F.lit('{"name": " '), "p_name", F.lit('", "entity_type": "'),
                   F.when(F.col("p_size") % 6 == 0, "operator").when(F.col("p_size") % 6 == 1, "group").otherwise("npc"),
                   F.lit('", "aliases": ["'), "p_brand", F.lit('"]}'))
    line = (
        F.when(F.length("p_type") + F.col("p_size") == 20, obj.substr(F.lit(1), F.length(obj) - 4))
        .when(F.col("p_size") == 11, F.concat(F.lit('["'), "p_name", F.lit('"]')))
        .when(F.col("p_size") == 13, F.concat(F.lit("# "), "p_name")).when(F.col("p_size") == 17, F.lit("  "))
        .when(F.col("p_size") == 19, F.concat(F.lit('{"entity_type": "'), "p_type", F.lit('"}'))).otherwise(obj)
    )
    return p.select(F.col("p_partkey").alias("line_no"), line.alias("line"))


@query
def q_curated_lines(c: Corpus) -> DataFrame:
    good, bad = ln.curated_entity_rows(entity_lines(c))
    none = F.lit(None).cast("string")
    kept = good.select("line_no", "name", "entity_type", joined("aliases").alias("aliases"), none.alias("reason"))
    lost = bad.select("line_no", none.alias("name"), none.alias("entity_type"), none.alias("aliases"), "reason")
    return kept.unionByName(lost)


# ---- relations --------------------------------------------------------------------------------


@query
def q_collate_relations(c: Corpus) -> DataFrame:
    return c.relations().select("head", "type", "tail", "tail_name", "notes", "source")


@query
def q_relations_for(c: Corpus) -> DataFrame:
    return rel.touching(c.relations(), "NATION_3").select("head", "type", "tail", "tail_name", "notes", "source")


@query
def q_relations_between(c: Corpus) -> DataFrame:
    return rel.between(c.relations(), "ECONOMY", "Brand#2").select("head", "type", "tail", "tail_name", "notes", "source")


@query
def q_relation_types(c: Corpus) -> DataFrame:
    return c.relations().groupBy("type", "source").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def q_relation_rows(c: Corpus) -> DataFrame:
    rows = rel.resolved_rows(rel.parsed_lines(c.responses()), c.entity_index())
    kept = rel.relation_rows(rows, c.entity_owners()).withColumn("line_no", big("line_no"))
    return kept.withColumn("ambiguous_candidates", joined("ambiguous_candidates"))


@query
def q_relation_warnings(c: Corpus) -> DataFrame:
    lines = rel.parsed_lines(c.responses())
    rows = rel.warnings(c.responses(), lines, rel.resolved_rows(lines, c.entity_index()))
    return rows.withColumn("line_no", big("line_no"))


# ---- pairs ------------------------------------------------------------------------------------


@query
def q_cooccurrence(c: Corpus) -> DataFrame:
    return co.table(c.log_edges()).withColumn("sample_containers", joined("sample_containers"))


@query
def q_cooccur_for(c: Corpus) -> DataFrame:
    return co.for_entity(c.log_edges(), "u00000008", 20)


@query
def q_cooccur_top(c: Corpus) -> DataFrame:
    return co.top(c.log_edges(), 50)


@query
def q_cooccur_between(c: Corpus) -> DataFrame:
    return co.between(c.log_edges(), "u00000046", "u00000008")


# ---- search -----------------------------------------------------------------------------------


def searched(c: Corpus, pattern: str, regex: bool) -> DataFrame:
    sections = c.script_chunks().select(
        F.col("container_id").alias("entity_id"), F.concat(F.lit("t"), F.col("stage_idx").cast("string")).alias("section"),
        F.col("body").alias("text"),
    )
    summaries = c.texts("pages").select(
        F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("container_id"),
        F.coalesce(tg.first_body("html", "article"), F.lit("")).alias("text"),
    )
    return se.grep_text(pattern, "all", regex, c.documents(), sections, summaries)


@query
def q_grep_literal(c: Corpus) -> DataFrame:
    return searched(c, "token = ", False)


@query
def q_grep_regex(c: Corpus) -> DataFrame:
    return searched(c, r"(?:^| )[A-Z][a-z]+tion[.,]", True)


# ---- hash-gated runs --------------------------------------------------------------------------


def state_now(c: Corpus) -> DataFrame:
    """Stored hashes: equal to today's but for English units; gone units keep a dummy."""
    now = inc.content_hash(c.units())
    prior = c.prior_state().join(now, "unit_id", "left")
    changed = F.when(F.col("tag") == "en", F.lit("changed")).otherwise(F.coalesce("source_hash", F.lit("none")))
    return prior.select("unit_id", changed.alias("source_hash"))


def planned(c: Corpus) -> DataFrame:
    return inc.decide(inc.content_hash(c.units()), state_now(c), c.outputs())


@query
def q_unit_plan(c: Corpus) -> DataFrame:
    return planned(c)


@query
def q_dry_run_plan(c: Corpus) -> DataFrame:
    return inc.dry_run(c.unit_totals(), c.prior_state(), c.outputs()).select("unit_id", "total_length", "stage_count", "would_run")


@query
def q_stale_keys(c: Corpus) -> DataFrame:
    return inc.stale_keys(c.prior_state(), c.unit_totals())


@query
def q_unit_state(c: Corpus) -> DataFrame:
    ran = planned(c).filter("status = 'run'").select("unit_id", "source_hash")
    return inc.upsert_state(state_now(c), ran, c.unit_totals())


@query
def q_run_report(c: Corpus) -> DataFrame:
    return inc.run_report(planned(c))


@query
def q_cost_estimate(c: Corpus) -> DataFrame:
    units = inc.dry_run(c.unit_totals(), c.prior_state(), c.outputs())
    return inc.cost_totals(inc.container_cost(units, *OVERHEADS))


@query
def q_chunk_cost(c: Corpus) -> DataFrame:
    units = c.chunks().select("container_id", "stage_idx", big(F.length("body")).alias("total_length"))
    return inc.single_cost(units, 800, inc.STAGE_SUMMARY_OUT)


@query
def q_requests(c: Corpus) -> DataFrame:
    t = ch.rollup(c.chunks())
    one = inc.single_pass_requests(c.chunks(), t, "please read\n{text}\nthank you")
    one = one.withColumn("stage_idx", F.lit(None).cast("bigint"))
    return one.unionByName(inc.chunk_requests(c.chunks(), t, "please read\n{text}\nthank you"))


@query
def q_merge_requests(c: Corpus) -> DataFrame:
    close = F.when(F.length("body") % 997 == 0, F.lit("")).otherwise(F.lit("</正文>"))
    told = F.concat(F.lit("<摘要>"), "name", F.lit("</摘要> <正文> "), "tag", close)
    responses = c.documents().select("container_id", "stage_idx", told.alias("response"))
    return inc.merge_requests(responses, ch.rollup(c.documents()), ["摘要", "正文"], "merge\n{stage_summaries}\nplease")


@query
def q_selected_units(c: Corpus) -> DataFrame:
    return inc.selected_units(c.entities(), c.explicit(), c.participants(), "entity_id").select("entity_id", "name")


@query
def q_pending_units(c: Corpus) -> DataFrame:
    related = c.documents().select("container_id", F.col("stage_idx").alias("doc_id"))
    return inc.pending(related, c.table("labels").select("doc_id"), ["doc_id"])


@query
def q_summary_document(c: Corpus) -> DataFrame:
    d = c.documents()
    body = tg.block("正文", F.col("body"))
    front = [("event_id", F.col("container_id")), ("stage_idx", F.col("stage_idx")), ("avg_tag", F.col("tag")),
             ("total_length", F.length("body")), ("note", F.col("info"))]
    return d.select(F.col("stage_idx").alias("doc_id"), inc.summary_document(front, body).alias("document"))


@query
def q_build_report(c: Corpus) -> DataFrame:
    chunks, edges = c.chunks(), c.edges()
    by_layer = edges.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("entity_id").alias("e"))
    pair = lambda s, v: F.struct(s.alias("counter"), v.alias("value"))
    layers = by_layer.select(F.explode(F.array(
        pair(F.concat("source", F.lit("_edges")), F.col("n")), pair(F.concat("source", F.lit("_entities")), F.col("e")),
    )).alias("x")).select("x.*")
    ents = c.all_entities().groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"))
    rels = c.relations().groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    rest = st.counters({
        "chunks": st.row_count(chunks),
        "containers": st.row_count(chunks.select("container_id").distinct()),
        "ambiguous_names": st.row_count(al.ambiguous_names(c.entities())),
        "unresolved_names": st.row_count(c.unresolved()),
        "nameless": st.row_count(c.entities().filter(F.col("name") == "")),
    })
    return (
        layers.unionByName(ents.select(F.concat(F.lit("entity_"), "entity_type").alias("counter"), F.col("n").alias("value")))
        .unionByName(rels.select(F.concat(F.lit("relation_"), "source").alias("counter"), F.col("n").alias("value")))
        .unionByName(rest)
    )


# ---- update flow and pages ----------------------------------------------------------------------


@query
def q_new_items(c: Corpus) -> DataFrame:
    d, lab = c.texts("documents").select("doc_id", "source", "lang"), c.table("labels")
    return ca.new_items(d, [lab.filter("quality = 1"), lab.filter("toxic = 1")], "doc_id")


def candidate_flow(c: Corpus) -> tuple[DataFrame, DataFrame]:
    """Candidates of the advert words as they stand, and those words. Terms of even length have pages, as have words of a length
    that three divides."""
    raw = c.summary_docs().select("container_id", F.explode(tg.raw_key_names("container_doc")).alias("name"))
    playable = c.entities().filter(F.col("name") != "").groupBy("name").agg(F.min("entity_id").alias("char_id"))
    extended = raw.filter(F.length("name") % 3 == 0).select(F.concat(F.lit("extended_char_"), tx.safe_slug("name")).alias("page_id"))
    pages = c.entities().filter(F.length("term") % 2 == 0).select(F.col("entity_id").alias("page_id")).unionByName(extended)
    return ca.candidates(raw, ln.alias_map(c.alias_lines()), playable, pages), raw


@query
def q_candidates(c: Corpus) -> DataFrame:
    return candidate_flow(c)[0]


@query
def q_candidate_containers(c: Corpus) -> DataFrame:
    return ca.candidate_containers(*candidate_flow(c))


@query
def q_similar_names(c: Corpus) -> DataFrame:
    raw = c.container_names().select("name").distinct()
    canon = c.curated().select("canonical").distinct()
    unknown = raw.join(ln.alias_map(c.alias_lines()).select(F.col("alias").alias("name")), "name", "left_anti")
    return ca.similar_names(unknown, canon)


@query
def q_related_containers(c: Corpus) -> DataFrame:
    names = c.entities().filter(F.col("name") != "").select("entity_id", F.explode(F.array("name", "appellation")).alias("alias"))
    return ca.related_containers(c.chunks(), c.container_names(), names)


@query
def q_link_lines(c: Corpus) -> DataFrame:
    text = F.concat("p_brand", F.lit(": "), "p_name", F.lit("\n\n *"), "p_type", F.lit("*：size: "), F.col("p_size").cast("string"), F.lit("\nplain "), "p_name")
    items = c.table("part").select("p_partkey", text.alias("t"))
    links = c.table("part").select(F.col("p_brand").alias("name")).distinct()
    links = links.withColumn("link", F.concat(F.lit("["), "name", F.lit("](brands/"), "name", F.lit(".md)")))
    return pg.link_lines(items, links, "p_partkey", "t")


@query
def q_index_rows(c: Corpus) -> DataFrame:
    items = c.table("part").select("p_brand", "p_partkey", "p_name")
    return pg.index_rows(items, "p_brand", "p_partkey", "p_name", 5)


@query
def q_render_page(c: Corpus) -> DataFrame:
    whole = F.concat(F.col("html"), F.lit("<version> 2 </version>"))
    return c.texts("pages").select("page_id", pg.rendered(whole, ["h1", "footer", "article"], "title").alias("page"))


def page_files(c: Corpus) -> tuple[DataFrame, DataFrame]:
    s, k, n = c.table("supplier"), c.table("customer"), c.table("nation")
    v1 = k.select(F.concat(F.lit("n"), F.substring("c_name", 10, 20)).alias("name"),
                  F.concat(F.when(F.col("c_nationkey") < 12, "char_").otherwise("extended_char_"), F.col("c_custkey").cast("string"), F.lit(".md")).alias("file"))
    v3 = s.select(F.concat(F.lit("n"), F.substring("s_name", 10, 20)).alias("name"),
                  F.concat(F.when(F.col("s_nationkey") < 12, "char_").when(F.col("s_nationkey") < 20, "extended_char_").otherwise("other_"), F.col("s_suppkey").cast("string"), F.lit(".md")).alias("file"))
    v1 = v1.unionByName(n.select(F.col("n_name").alias("name"), F.lit("char_n.md").alias("file")))
    return v1, v3


@query
def q_merge_indexes(c: Corpus) -> DataFrame:
    return pg.merge_indexes(*page_files(c), "chars/", "char_v3/")


@query
def q_page_index(c: Corpus) -> DataFrame:
    merged = pg.merge_indexes(*page_files(c), "chars/", "char_v3/")
    return pg.index_counts(merged.filter("kind is not null"))


@query
def q_whats_new(c: Corpus) -> DataFrame:
    o, k = c.table("orders"), c.table("customer")
    ids = c.table("lineitem").select(F.col("l_orderkey").alias("item_id")).distinct()
    items = o.select(F.col("o_orderkey").alias("item_id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"))
    files = o.filter("o_orderstatus != 'P'").select(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".md")).alias("file"))
    links = o.filter("o_orderpriority = '1-URGENT'").join(k, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("link_name"), F.col("c_name").alias("owner"), F.col("o_orderkey").alias("seq"))
    return pg.whats_new(ids, items, files, pg.story_owners(links))


# ---- audits ---------------------------------------------------------------------------------------


def summary_names(c: Corpus) -> DataFrame:
    """Key names of page summaries, and of container summaries (without a stage)."""
    whole = c.container_names().select("container_id", F.lit(None).cast("bigint").alias("stage_idx"), "name")
    return c.stage_names().select("container_id", "stage_idx", "name").unionByName(whole)


@query
def q_grounding(c: Corpus) -> DataFrame:
    names = summary_names(c)
    rows = gr.audit(names, gr.name_forms(names, c.owners(), c.alias_index()), c.chunks())
    return rows.select("container_id", "stage_idx", "name", "status", "entity_id", "n_chunks", "n_mentions", "first_stage", "first_start")


@query
def q_entity_coverage(c: Corpus) -> DataFrame:
    return gr.coverage(c.participants(), summary_names(c), c.alias_index())


# ---- relation network ------------------------------------------------------------------------------


@query
def q_relation_components(c: Corpus) -> DataFrame:
    return net.components(written(net.links(c.relations()), "relation-links"))


@query
def q_relation_path(c: Corpus) -> DataFrame:
    """From the first customer of each nation to the first supplier of another of its region, and from each brand to the largest size."""
    r = written(net.links(c.relations()), "relation-links")
    home = c.table("nation").select(F.col("n_name").alias("b"), "n_nationkey")
    first = lambda prefix: r.filter(F.col("a").startswith(prefix)).join(home, "b").groupBy("n_nationkey").agg(F.min("a").alias("e"))
    sources, targets = first("Customer"), first("Supplier")
    pairs = sources.select(F.col("e").alias("source"), ((F.col("n_nationkey") + 5) % 25).alias("n_nationkey")).join(
        targets.select("n_nationkey", F.col("e").alias("target")), "n_nationkey").select("source", "target")
    last = c.table("part").agg(F.concat(F.lit("size "), F.max("p_size").cast("string")).alias("target"))  # one row
    pairs = pairs.unionByName(c.table("part").select(F.col("p_brand").alias("source")).distinct().join(F.broadcast(last), F.lit(True)))
    return net.paths(r, pairs, most=6)


# ---- indexed search, mined names ---------------------------------------------------------------------


@query
def q_grep_scoped(c: Corpus) -> DataFrame:
    """Lines with an equals sign in the chunks of one container."""
    return gi.grep_scoped(c.chunks(), " = ", "src7-en")


@query
def q_grep_indexed(c: Corpus) -> DataFrame:
    index = gi.GramIndex.write(c.chunks(), f"{checkpoint_root(c.spark).rstrip('/')}/grams-{uuid.uuid4().hex}")
    return index.grep("token = ")


@query
def q_mined_names(c: Corpus) -> DataFrame:
    return mi.mined_names(c.chunks(), c.match_aliases(), least=2, most=4, words=True)
