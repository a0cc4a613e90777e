"""Whole build: source folder -> written tables -> report.

Every step writes its table and reads it back. The tables are the product, they cut the lineage, and
their known sizes let Spark choose each join. Readers see the build when its manifest is written (see `store`).

A build on top of an earlier one matches only what can have changed: containers with another mark over their texts, explicit
edges and summary people, and containers that hold an alias that was added, dropped or reclassified. Edges of all other
containers are taken over, and parts of the large tables without a change keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx
from scriptloom.operators import aliases as al
from scriptloom.operators import cards as cd
from scriptloom.operators import chunks as ch
from scriptloom.operators import cooccurrence as co
from scriptloom.operators import edges as ed
from scriptloom.operators import entities as en
from scriptloom.operators import incremental as inc
from scriptloom.operators import participants as pa
from scriptloom.operators import relations as rel
from scriptloom.operators import stats as st
from scriptloom.session import written
from scriptloom.sources import game
from scriptloom.sources import lines as ln
from scriptloom.sources import sinks
from scriptloom.sources.store import Build, part_of


@dataclass
class Inputs:
    """Places to read from; everything but the game data is optional."""

    game_data: str
    summaries: str = ""
    aliases: str = ""
    curated_entities: str = ""
    relations: str = ""
    curated_relations: str = ""
    dossiers: str = ""
    version_file: str = ""


def key_name_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    rows = docs.select(*keys, F.posexplode(tg.key_names("text")).alias("ord", "name"))
    return rows.withColumn("ord", F.col("ord").cast("bigint"))


def build(spark: SparkSession, inputs: Inputs, out: str) -> DataFrame:
    """Run the build and return its report (counter, value)."""

    store = Build(spark, out)
    put = store.put

    # chunks and containers
    head = put(game.containers(spark, inputs.game_data), "containers")
    raw = game.raw_chunks(spark, inputs.game_data).withColumn("script", tx.clean_script("raw"))
    wrapped = tx.format_chunk("container_id", "container_name", "stage_idx", "name", "tag", "info", "script")
    chunks = raw.withColumns({"body": wrapped, "file": tx.chunk_file("stage_idx", "name", "tag")})
    chunks = chunks.join(head.select("container_id", "source_family"), "container_id")
    chunks = chunks.withColumn("length", F.length("body").cast("bigint")).drop("raw", "entry_type")
    fresh = written(chunks, "chunks")
    texts = container_marks(fresh.select("container_id", F.to_json(F.struct(*sorted(fresh.columns))).alias("row")))
    texts = put(texts, "text_marks")
    chunks = store.put_parts(fresh, "chunks", "container_id", ["container_id", "stage_idx"], _parts(_changed(store, "text_marks", texts)))

    # entities, sections, links, cards
    merged = put(game.merged_entities(spark, inputs.game_data), "entities_raw")
    named = sinks.named(merged)
    curated = put(ln.alias_rows(ln.file_lines(spark, inputs.aliases)) if inputs.aliases else _no_aliases(spark), "curated_aliases")
    sections = put(cd.section_texts(named), "sections", order=["entity_id"])
    links = named.select("entity_id", F.posexplode("storysets").alias("seq", "s")).select("entity_id", "seq", "s.link_name", "s.link_key")
    index = chunks.select(F.col("path").alias("link_key"), "container_id", "stage_idx")
    resolved = put(ch.resolve_links(links, index), "links", order=["entity_id"])
    put(ch.link_candidates(resolved, index), "link_candidates")
    linked = resolved.filter("status = 'linked'").groupBy("entity_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seq", F.col("link_name").alias("name"), "container_id", "stage_idx"))),
            lambda s: F.struct(s["name"].alias("name"), s["container_id"].alias("container_id"), s["stage_idx"].alias("stage_idx")),
        ).alias("links")
    )
    cards = named.drop("storysets").join(linked, "entity_id", "left").withColumnRenamed("links", "storysets")
    put(cd.fact_card(cards), "cards")

    # aliases
    ids = named.select("entity_id", "name", "appellation", "nation_id")
    owners = put(al.owners(ids, curated), "alias_owners")
    alias_index = put(al.index(owners), "alias_index")
    matchable = put(al.match_aliases(ids, curated), "match_aliases")
    ambiguous = put(al.ambiguous_names(ids), "ambiguous_names")

    # edges
    explicit = put(ed.explicit_edges(resolved), "explicit_edges")
    stage_docs = game.stage_summaries(spark, inputs.summaries) if inputs.summaries else spark.createDataFrame([], "container_id string, stage_idx bigint, text string")
    docs = game.container_summaries(spark, inputs.summaries) if inputs.summaries else spark.createDataFrame([], "container_id string, text string")
    put(docs, "summaries")
    stage_names = put(key_name_rows(stage_docs, ["container_id", "stage_idx"]), "stage_names")
    container_names = put(key_name_rows(docs, ["container_id"]), "container_names")
    summary = put(ed.summary_edges(stage_names, container_names, alias_index, explicit), "summary_edges")
    flags = ed.key_ids(summary)
    people, _ = matched(store, chunks, matchable, explicit, flags, texts)
    edges = store.put_parts(ed.union_edges(explicit, people, summary), "edges", "container_id", ["container_id", "entity_id"])
    store.put_parts(edges, "edges_by_entity", "entity_id", ["entity_id", "container_id"])
    names = stage_names.select("container_id", "name").unionByName(container_names.select("container_id", "name"))
    unresolved = put(ed.unresolved(ed.resolved_names(names, alias_index)), "unresolved_names")

    # entity layer
    entries, errors = ln.curated_entity_rows(ln.file_lines(spark, inputs.curated_entities)) if inputs.curated_entities else (None, None)
    if entries is None:
        entries, errors = ln.curated_entity_rows(spark.createDataFrame([], ln.LINE_SCHEMA))
    entries = put(entries, "curated_entries")
    errors = put(errors, "curated_entity_errors")
    conflicts = put(en.curated_conflicts(entries, owners), "curated_entity_warnings")
    everyone = en.all_entities(en.operator_entities(ids, curated), en.curated_entities(entries, owners), unresolved)
    everyone = put(everyone, "entities")
    entity_owners = put(en.alias_owners(everyone), "entity_alias_owners")
    entity_index = put(al.index(entity_owners), "entity_alias_index")
    operators = everyone.filter("entity_type = 'operator'").select("entity_id")
    put(ed.summary_edges(stage_names, container_names, entity_index, None, operators), "entity_edges")
    if inputs.dossiers:
        put(game.dossier_sections(spark, inputs.dossiers), "dossiers")

    # pairs and relations
    pairs = put(co.table(edges), "cooccurrence")
    baked = game.relation_files(spark, inputs.relations) if inputs.relations else _no_relations(spark)
    over, bad = ln.curated_relation_rows(
        ln.file_lines(spark, inputs.curated_relations) if inputs.curated_relations else spark.createDataFrame([], ln.LINE_SCHEMA)
    )
    over = over.withColumn("seq", F.struct(F.lit("").alias("file"), F.col("seq").cast("int").alias("pos")))
    relations = put(rel.collate(baked, over), "relations")
    bad = put(bad, "curated_relation_errors")

    # manifests and report
    flagged = people.select("entity_id").distinct().withColumn("has_participant_appearances", F.lit(True))
    sections = sections.groupBy("entity_id").agg(F.collect_set("section").alias("_s"))
    order = F.array(*[F.lit(s) for s in tx.SECTIONS])
    chars = ids.join(sections, "entity_id", "left").join(linked.select("entity_id", F.size("links").alias("_n")), "entity_id", "left")
    chars = chars.join(flagged, "entity_id", "left").select(
        "entity_id", "name", "appellation", "nation_id",
        F.array_intersect(order, F.coalesce("_s", F.array().cast("array<string>"))).alias("sections"),
        F.coalesce("_n", F.lit(0)).alias("storyset_count"),
        F.coalesce("has_participant_appearances", F.lit(False)).alias("has_participant_appearances"),
    )
    chars = put(chars, "chars")
    number, when = F.count(F.lit(1)), F.count_if
    ids_of = F.count_distinct("entity_id")
    families = {f"events_{f}": when(F.col("source_family") == f) for f in tx.FAMILIES}
    curated_row = (F.col("entity_type") != "operator") & F.col("first_container_ids").isNull()
    # one scan of each table, whatever the number of its counters
    parts = [
        (head, {"events": number, **families}), (chunks, {"stages": number}),
        (merged, {"chars": when(F.col("name") != ""), "skipped_nameless": when(F.coalesce("name", F.lit("")) == "")}),
        (explicit, {"deterministic_link_count": number, "deterministic_chars_with_edges": ids_of}),
        (people, {"participant_edge_count": number, "participant_chars_with_edges": ids_of}),
        (summary, {"summary_edge_count": number, "summary_chars_with_edges": ids_of}),
        (unresolved, {"unresolved_summary_names": number}), (ambiguous, {"ambiguous_canonicals": number}),
        (curated, {"curated_alias_canonicals": F.count_distinct("canonical")}),
        (everyone, {"entity_count": number, "entity_operator_count": when(F.col("entity_type") == "operator"),
                    "entity_auto_seeded_count": when(F.col("first_container_ids").isNotNull()), "entity_curated_count": when(curated_row)}),
        (errors, {"entity_curated_errors": number}), (conflicts, {"entity_curated_warnings": number}),
        (pairs, {"cooccurrence_pair_count": number, "cooccurrence_stage_total": F.sum("co_stage_count")}),
        (relations, {"relation_count": number, "relation_bake_count": when(F.col("source") == "bake"), "relation_curated_count": when(F.col("source") == "curated")}),
        (bad, {"relation_curated_errors": number}), (resolved, {"storyset_warnings": when(F.col("status") != "linked")}),
        (_gone(store, "containers", head, "container_id"), {"pruned_events": number}),
        (_gone(store, "chars", chars, "entity_id"), {"pruned_chars": number}),
    ]
    report = reduce(lambda x, y: x.unionByName(y), [st.of_table(df, values) for df, values in parts])
    put(_warnings(merged, unresolved, ambiguous, errors, conflicts, bad, resolved), "warnings")
    report = put(report, "report")
    store.commit()
    return report


def _gone(store: Build, name: str, now: DataFrame, key: str) -> DataFrame:
    """Keys of the last build's table that this build does not have."""
    before = store.before.read(name).select(key) if store.before.has(name) else now.select(key).limit(0)
    return inc.stale_keys(before, now, key)


def _warnings(merged, unresolved, ambiguous, errors, conflicts, bad, resolved) -> DataFrame:
    """Everything a build has to say, as rows (kind, subject, detail)."""
    def rows(df: DataFrame, kind: str, subject, detail) -> DataFrame:
        text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
        return df.select(F.lit(kind).alias("kind"), text(subject).alias("subject"), text(detail).alias("detail"))

    found = [
        rows(merged.filter(F.coalesce("name", F.lit("")) == ""), "nameless character", "entity_id", F.lit(None)),
        rows(unresolved, "unresolved summary name", "name", "container_id"),
        rows(ambiguous, "ambiguous name", "name", "n_ids"),
        rows(errors, "curated entity row", "line_no", "reason"), rows(conflicts, "curated entity", "name", "reason"),
        rows(bad, "curated relation row", "line_no", "reason"),
        rows(resolved.filter("status <> 'linked'"), "link", F.concat_ws(" ", "entity_id", "link_key"), "status"),
    ]
    return reduce(lambda x, y: x.unionByName(y), found)


def container_marks(rows: DataFrame) -> DataFrame:
    """container_id, mark: the same for the same rows (container_id, row) in any order."""
    each = rows.select("container_id", F.sha2("row", 256).alias("h"))
    lane = lambda k: F.sum(F.conv(F.substring("h", 9 * k + 1, 9), 16, 10).cast("decimal(38,0)"))
    return each.groupBy("container_id").agg(F.concat_ws(":", F.count(F.lit(1)), *[lane(k).cast("string") for k in range(4)]).alias("mark"))


def _changed(store: Build, name: str, now: DataFrame) -> DataFrame | None:
    """container_id of the containers that are new, gone or have another mark than in the last build; None before the first."""
    if not store.before.has(name):
        return None
    old = store.before.read(name).withColumnRenamed("mark", "_old")
    both = now.join(old, "container_id", "full_outer")
    return written(both.filter(~F.col("mark").eqNullSafe(F.col("_old"))).select("container_id"), "changed")


def _parts(changed: DataFrame | None) -> set[int] | None:
    return None if changed is None else {r[0] for r in changed.select(part_of("container_id")).distinct().collect()}


def matched(store: Build, chunks: DataFrame, aliases: DataFrame, explicit: DataFrame, flags: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Participant edges, and the containers that were matched for them (None: all)."""
    around = explicit.select("container_id", F.to_json(F.struct("entity_id", "stage_idx")).alias("row")).unionByName(
        flags.select("container_id", F.concat(F.lit("flag "), "entity_id").alias("row")))
    sides = store.put(texts.select("container_id", F.col("mark").alias("row")).unionByName(around).transform(container_marks), "match_marks")
    changed = _changed(store, "match_marks", sides)
    before = store.before
    if changed is None or not before.has("participant_edges") or not before.has("match_aliases"):
        return store.put_parts(pa.participants(chunks, aliases, explicit, flags), "participant_edges", "container_id", ["container_id", "entity_id"]), None
    old_aliases, old_edges = before.read("match_aliases"), before.read("participant_edges")
    columns = ["entity_id", "alias", "match_class", "mode"]
    moved = aliases.select(columns).exceptAll(old_aliases.select(columns)).unionByName(old_aliases.select(columns).exceptAll(aliases.select(columns)))
    moved = written(moved, "moved-aliases")
    if not moved.isEmpty():
        held = pa.alias_hits(chunks, moved).select("container_id")  # whatever holds one of them now
        had = old_edges.select("container_id", F.explode("matched_aliases").alias("alias")).join(moved.select("alias").distinct(), "alias", "left_semi")
        changed = written(changed.unionByName(held).unionByName(had.select("container_id")).distinct(), "changed")
    stay = old_edges.join(changed, "container_id", "left_anti")
    again = pa.participants(chunks.join(changed, "container_id", "left_semi"), aliases, explicit, flags)
    people = written(stay.unionByName(again), "participants")
    return store.put_parts(people, "participant_edges", "container_id", ["container_id", "entity_id"], _parts(changed)), changed


def _no_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "canonical string, alias string, ord struct<line_no:bigint,pos:int>")


def _no_relations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "head string, type string, tail string, tail_name string, notes string, "
            "ambiguous_candidates array<string>, seq struct<file:string,pos:int>"
    )
