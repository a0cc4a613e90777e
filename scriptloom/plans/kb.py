"""Read-only queries over the written tables. Every answer is a DataFrame; filters reach the scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptloom.operators import aliases as al
from scriptloom.operators import cards as cd
from scriptloom.operators import cooccurrence as co
from scriptloom.operators import edges as ed
from scriptloom.operators import entities as en
from scriptloom.operators import relations as rel
from scriptloom.operators import search as se
from scriptloom.sources.store import Snapshot

# Order of the hand-kept dossier sections.
ENTITY_SECTIONS = ("profile", "archive", "voice_about")


class KnowledgeBase:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.build = Snapshot(spark, root)  # a later build does not show in the answers of this object

    def table(self, name: str) -> DataFrame:
        return self.build.read(name)

    # ---- containers and chunks
    def list_events(self, family: str | None = None) -> DataFrame:
        t = self.table("containers")
        return (t if family is None else t.filter(F.col("source_family") == family)).orderBy("container_id")

    def list_families(self) -> DataFrame:
        from scriptloom.operators.chunks import family_counts

        return family_counts(self.table("containers"))

    def get_event(self, container_id: str) -> DataFrame:
        """One row with its sizes and its stages in order; the list is as long as one event."""
        stage = F.struct("stage_idx", "name", "tag", "length", "file", "path")
        sizes = self._chunk(container_id).groupBy("container_id").agg(
            F.sum("length").alias("total_length"), F.count(F.lit(1)).alias("stage_count"),
            F.array_sort(F.collect_list(stage)).alias("stages"),
        )
        return self.table("containers").filter(F.col("container_id") == container_id).join(sizes, "container_id", "left")

    def _chunk(self, container_id: str, stage_idx: int | None = None) -> DataFrame:
        t = self.table("chunks").filter(F.col("container_id") == container_id)
        return t if stage_idx is None else t.filter(F.col("stage_idx") == stage_idx)

    def event_stages(self, container_id: str) -> DataFrame:
        return self._chunk(container_id).select("stage_idx", "name", "tag", "length", "file", "path").orderBy("stage_idx")

    def get_stage_meta(self, container_id: str, stage_idx: int) -> DataFrame:
        return self._chunk(container_id, stage_idx).select("stage_idx", "name", "tag", "file", "length", "path")

    def get_stage_text(self, container_id: str, stage_idx: int) -> DataFrame:
        return self._chunk(container_id, stage_idx).select("body")

    def get_event_summary(self, container_id: str) -> DataFrame:
        return self.table("summaries").filter(F.col("container_id") == container_id).select("text")

    # ---- entities of the character table
    def list_chars(self, nation: str | None = None) -> DataFrame:
        t = self.table("chars")
        return (t if nation is None else t.filter(F.col("nation_id") == nation)).orderBy("entity_id")

    def _candidates(self, owners: str, name: str) -> DataFrame:
        found = self.table(owners).filter(F.col("alias") == name).select("entity_id").distinct()
        n = found.agg(F.count(F.lit(1)).alias("n"))
        status = n.select(F.lit(name).alias("name"), al.status_of(F.col("n")).alias("status"))
        listed = found.withColumn("name", F.lit(name))
        return status.join(listed, "name", "left").orderBy("entity_id")

    def resolve_operator_name(self, name: str) -> DataFrame:
        """One row per candidate: `resolved` has one, `ambiguous` several, `missing` a null one."""
        return self._candidates("alias_owners", name)

    def resolve_entity(self, name: str) -> DataFrame:
        return self._candidates("entity_alias_owners", name)

    def get_char_section(self, entity_id: str, section: str = "all") -> DataFrame:
        t = self.table("sections").filter(F.col("entity_id") == entity_id)
        if section != "all":
            return t.filter(F.col("section") == section).select("entity_id", "text")
        return cd.all_sections(t)

    def char_storysets(self, entity_id: str) -> DataFrame:
        t = self.table("links").filter((F.col("entity_id") == entity_id) & (F.col("status") == "linked"))
        return t.select("link_name", "link_key", "container_id", "stage_idx")

    def get_card(self, entity_id: str) -> DataFrame:
        return self.table("cards").filter(F.col("entity_id") == entity_id)

    # ---- appearances
    def char_appearances(self, entity_id: str, source: str = "all", min_tier: str = "named") -> DataFrame:
        return ed.of_entity(self.table("edges_by_entity"), entity_id, source, min_tier)

    def event_chars(self, container_id: str, source: str = "all", min_tier: str = "named") -> DataFrame:
        return ed.of_container(self.table("edges"), container_id, source, min_tier)

    def stage_chars(self, container_id: str, stage_idx: int, source: str = "all", min_tier: str = "named") -> DataFrame:
        return ed.of_chunk(self.table("edges"), container_id, stage_idx, source, min_tier)

    def group_by_event(self, appearances: DataFrame) -> DataFrame:
        return ed.by_container(appearances)

    # ---- search
    def grep_text(self, pattern: str, scope: str = "all", regex: bool = False) -> DataFrame:
        return se.grep_text(pattern, scope, regex, self.table("chunks"), self.table("sections"), self.table("summaries"))

    # ---- entity layer
    def list_entities(self, entity_type: str | None = None) -> DataFrame:
        t = self.table("entities")
        return en.ordered(t if entity_type is None else t.filter(F.col("entity_type") == entity_type))

    def get_entity(self, entity_id: str) -> DataFrame:
        return self.table("entities").filter(F.col("entity_id") == entity_id)

    def get_entity_section(self, entity_id: str, section: str = "all") -> DataFrame:
        t = self.table("dossiers").filter(F.col("entity_id") == entity_id)
        if section != "all":
            return t.filter(F.col("section") == section).select("entity_id", "text")
        rank = F.array_position(F.array(*[F.lit(s) for s in ENTITY_SECTIONS]), F.col("section"))
        parts = F.array_sort(F.collect_list(F.struct(rank.alias("r"), "text")))
        kept = t.filter(F.col("section").isin(*ENTITY_SECTIONS))
        return kept.groupBy("entity_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))

    def entity_appearances(self, entity_id: str) -> DataFrame:
        t = self.table("entity_edges").filter(F.col("entity_id") == entity_id)
        return t.orderBy("container_id", F.asc_nulls_first("stage_idx"))

    # ---- pairs and relations
    def cooccurrence_for_char(self, entity_id: str, limit: int | None = None) -> DataFrame:
        t = self.table("cooccurrence").filter((F.col("a") == entity_id) | (F.col("b") == entity_id))
        ranked = co.ranked(t)
        return ranked if limit is None else ranked.limit(limit)

    def cooccurrence_top(self, limit: int = 50) -> DataFrame:
        return co.ranked(self.table("cooccurrence")).limit(limit)

    def cooccurrence_between(self, a: str, b: str) -> DataFrame:
        lo, hi = sorted((a, b))
        return self.table("cooccurrence").filter((F.col("a") == lo) & (F.col("b") == hi))

    def relations_for_entity(self, entity_id: str) -> DataFrame:
        return rel.ordered(rel.touching(self.table("relations"), entity_id))

    def relations_between_entities(self, a: str, b: str, directed: bool = False) -> DataFrame:
        return rel.ordered(rel.between(self.table("relations"), a, b, directed))

    def list_relations(self, kind: str | None = None) -> DataFrame:
        return rel.ordered(rel.of_type(self.table("relations"), kind))

    def relation_types(self) -> DataFrame:
        return rel.types(self.table("relations"))
