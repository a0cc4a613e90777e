"""Model tables derived from the shared test tables. The only module that knows their names."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptloom.functions import tags as tg
from scriptloom.functions import text as tx
from scriptloom.operators import aliases as al
from scriptloom.operators import chunks as ch
from scriptloom.operators import edges as ed
from scriptloom.operators import entities as en
from scriptloom.operators import participants as pa
from scriptloom.session import spread, written
from scriptloom.sources import lines as ln

EDGE_MARKS = r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+\z"
WIDE = 1 << 32  # places of one page or chunk in a line number; more than a text can hold
TERM = r'<li><a href="/[^"]*">([^<]*)</a>'


TABLE_KEYS = {
    "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"], "events": ["event_id"],
    "part": ["p_partkey"],
}


def shared(method):
    """A layer several others read: written once per corpus, then scanned."""

    @functools.wraps(method)
    def once(self) -> DataFrame:
        if method.__name__ not in self._shared:
            self._shared[method.__name__] = written(method(self), method.__name__)
        return self._shared[method.__name__]

    return once


class Corpus:
    """Lazy views on one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._shared: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def texts(self, name: str) -> DataFrame:
        """A table with much work for each row, spread over the cores where its files give too few scan tasks."""
        if name not in self._shared:
            self._shared[name] = spread(self.table(name), *TABLE_KEYS[name])
        return self._shared[name]

    # ---- dictionary ---------------------------------------------------------------------

    @shared
    def nav_terms(self) -> DataFrame:
        """Navigation link terms: page_id, url, ord, term."""
        terms = F.regexp_extract_all("html", F.lit(TERM), F.lit(1))
        rows = self.texts("pages").select("page_id", "url", F.posexplode(terms).alias("ord", "term"))
        return rows.filter(F.col("term") != "").withColumn("ord", F.col("ord").cast("bigint"))

    @shared
    def entities(self) -> DataFrame:
        """One entity per distinct term: entity_id, term, name, appellation, line_no."""
        first = self.nav_terms().groupBy("term").agg(F.min(F.col("page_id") * WIDE + F.col("ord")).alias("line_no"))
        name = F.regexp_replace("term", EDGE_MARKS, "")
        return first.select(
            F.concat(F.lit("op_"), F.substring(F.sha2(F.encode("term", "UTF-8"), 256), 1, 12)).alias("entity_id"),
            "term", name.alias("name"), F.lower(name).alias("appellation"), "line_no",
        )

    def alias_lines(self) -> DataFrame:
        """Curated alias file: `name;term;stem` per term, the stem for names of five and more characters."""
        stem = F.when(F.length("name") >= 5, F.concat(F.lit(";"), F.expr("substring(name, 1, length(name) - 2)")))
        named = self.entities().filter(F.col("name") != "")
        return named.select(
            "line_no", F.concat("name", F.lit(";"), "term", F.coalesce(stem, F.lit(""))).alias("line")
        )

    @shared
    def curated(self) -> DataFrame:
        return ln.alias_rows(self.alias_lines())

    @shared
    def owners(self) -> DataFrame:
        return al.owners(self.entities(), self.curated())

    @shared
    def alias_index(self) -> DataFrame:
        return al.index(self.owners())

    @shared
    def match_aliases(self) -> DataFrame:
        return al.match_aliases(self.entities(), self.curated())

    # ---- chunks -------------------------------------------------------------------------

    def documents(self) -> DataFrame:
        d = self.texts("documents")
        top = (
            F.when(F.col("lang") == "en", "obt/main/").when(F.col("lang") == "fr", "/obt\\memory\\")
            .otherwise("activities/")
        )
        kind = F.when(F.col("lang") == "de", "ACTIVITY").when(F.col("lang") == "es", "MINI_ACTIVITY").otherwise("NONE")
        return d.select(
            F.concat_ws("-", "source", "lang").alias("container_id"), F.col("source").alias("container_name"),
            F.col("doc_id").alias("stage_idx"), F.concat(F.lit("doc "), "doc_id").alias("name"),
            F.col("lang").alias("tag"), F.lit(None).cast("string").alias("info"), F.col("text").alias("body"),
            F.concat(top, "source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), kind.alias("entry_type"),
        )

    def page_chunks(self) -> DataFrame:
        p = self.texts("pages")
        host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
        return p.select(
            host.alias("container_id"), host.alias("container_name"), F.col("page_id").alias("stage_idx"),
            F.coalesce(tg.first_body("html", "title"), F.lit("")).alias("name"),
            F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("tag"), F.lit(None).cast("string").alias("info"),
            F.coalesce(tg.first_body("html", "article"), F.lit("")).alias("body"),
            F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1).alias("path"), F.lit("NONE").alias("entry_type"),
        )

    def raw_scripts(self) -> DataFrame:
        """One raw script per conversation turn, spoken by the term of the page with that number."""
        plain = lambda c: F.translate(F.col(c), '"[]:：{}', "'()..()")
        terms = self.nav_terms().select(
            F.col("page_id").alias("conv_id"), F.col("ord").alias("turn"), plain("term").alias("term")
        )
        t = self.texts("conversations").join(terms, ["conv_id", "turn"], "left")
        who = F.coalesce("term", "role")
        one_line = F.replace(plain("text"), F.lit("\n"), F.lit(" "))
        escaped = F.replace(plain("text"), F.lit("\n"), F.lit("\\n"))
        says = F.when(F.col("role") == "user", F.concat(F.lit('[name="'), who, F.lit('"]'))).otherwise(
            F.concat(F.lit('[multiline(name="'), who, F.lit('",end=true)]'))
        )
        raw = F.concat(
            F.lit('[HEADER(key="title", is_skippable=true)]\n[Dialog]\n'), says, F.lit("{@nickname} "), one_line,
            F.lit('\n\n[Sticker(id="st1", text="'), escaped, F.lit('", x=1)]\n[Delay(time=1)]\n[Decision(options="'),
            F.col("role"), F.lit(';no", values="0;1")]\n[Subtitle(text="'), F.col("role"), F.lit('", y=2)]\n'),
        )
        return t.select("conv_id", "turn", "role", "text", who.alias("who"), raw.alias("raw"))

    def script_chunks(self) -> DataFrame:
        s = self.raw_scripts()
        conv = F.concat(F.lit("conv"), F.col("conv_id").cast("string"))
        return s.select(
            conv.alias("container_id"), conv.alias("container_name"), F.col("turn").alias("stage_idx"),
            F.col("role").alias("name"), F.lit(None).cast("string").alias("tag"), F.lit(None).cast("string").alias("info"),
            tx.clean_script("raw").alias("body"), F.lit("").alias("path"), F.lit("MAINLINE").alias("entry_type"),
        )

    def chunks(self) -> DataFrame:
        return self.documents().unionByName(self.page_chunks()).unionByName(self.script_chunks())

    def units(self) -> DataFrame:
        """Texts of all chunks per container as (unit_id, name, text) for the hash gate."""
        return self.chunks().select(
            F.col("container_id").alias("unit_id"), F.format_string("%012d", "stage_idx").alias("name"),
            F.col("body").alias("text"),
        )

    # ---- links and key names ------------------------------------------------------------

    def links(self) -> DataFrame:
        """A page's terms point at the page's address without query and fragment."""
        t = self.nav_terms().join(self.entities().select("term", "entity_id"), "term")
        return t.select(
            "entity_id", F.col("term").alias("link_name"), F.regexp_replace("url", r"[?#].*\z", "").alias("link_key"),
            "page_id", "ord",
        )

    def link_index(self) -> DataFrame:
        p = self.texts("pages")
        return p.select(
            F.col("url").alias("link_key"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("container_id"),
            F.col("page_id").alias("stage_idx"),
        )

    def resolved_links(self) -> DataFrame:
        return ch.resolve_links(self.links(), self.link_index())

    @shared
    def explicit(self) -> DataFrame:
        """Explicit edges, one per (entity, chunk)."""
        e = ed.explicit_edges(self.resolved_links())
        return e.groupBy("entity_id", "container_id", "stage_idx", "source").agg(
            F.min("story_set_name").alias("story_set_name")
        )

    def summary_docs(self) -> DataFrame:
        """Tagged documents: heading words as key people of a page, advert words as those of its host."""
        words = lambda c: F.concat(F.lit("<关键人物>"), F.replace(c, F.lit(" "), F.lit(";")), F.lit("</关键人物>"))
        ad = F.regexp_extract("html", r'(?s)<div class="ad">(.*?)</div>', 1)
        return self.texts("pages").select(
            F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("container_id"),
            F.col("page_id").alias("stage_idx"),
            words(F.coalesce(tg.first_body("html", "h1"), F.lit(""))).alias("stage_doc"), words(ad).alias("container_doc"),
        )

    @shared
    def stage_names(self) -> DataFrame:
        d = self.summary_docs().select("container_id", "stage_idx", F.posexplode(tg.key_names("stage_doc")).alias("ord", "name"))
        return d.withColumn("ord", F.col("ord").cast("bigint"))

    @shared
    def container_names(self) -> DataFrame:
        d = self.summary_docs().select(
            "container_id", "stage_idx", F.posexplode(tg.key_names("container_doc")).alias("pos", "name")
        )
        return d.groupBy("container_id", "name").agg(F.min(F.col("stage_idx") * WIDE + F.col("pos")).alias("ord"))

    @shared
    def summary(self) -> DataFrame:
        return ed.summary_edges(self.stage_names(), self.container_names(), self.alias_index(), self.explicit())

    @shared
    def unresolved(self) -> DataFrame:
        both = self.stage_names().select("container_id", "name").unionByName(
            self.container_names().select("container_id", "name")
        )
        return ed.unresolved(ed.resolved_names(both.distinct(), self.alias_index()))

    @shared
    def participants(self) -> DataFrame:
        return pa.participants(self.chunks(), self.match_aliases(), self.explicit(), ed.key_ids(self.summary()))

    def edges(self) -> DataFrame:
        return ed.union_edges(self.explicit(), self.participants(), self.summary())

    def edges_near(self, container_id: str | None = None, stage_idx: int | None = None, entity_id: str | None = None) -> DataFrame:
        """The edges of one container, chunk or entity: only its texts are read, only its aliases are matched."""
        def near(df: DataFrame) -> DataFrame:
            for name, value in (("container_id", container_id), ("stage_idx", stage_idx), ("entity_id", entity_id)):
                if value is not None and name in df.columns:
                    df = df.filter(F.col(name) == value)
            return df

        explicit, summary = near(self.explicit()), near(self.summary())
        flags = ed.key_ids(self.summary())
        flags = flags if container_id is None else flags.filter(F.col("container_id") == container_id)
        people = pa.participants(near(self.chunks()), near(self.match_aliases()), explicit, flags)
        return ed.union_edges(explicit, people, summary)

    # ---- entities -----------------------------------------------------------------------

    def curated_entries(self) -> DataFrame:
        """Curated entities: advert words of four and more characters, suppliers and nations."""
        words = self.container_names().filter(F.length("name") >= 4).groupBy("name").agg(F.min("ord").alias("o"))
        kind = F.when(F.length("name") % 3 == 0, "npc").when(F.length("name") % 3 == 1, "organization").otherwise("group")
        none = F.lit(None).cast("string")
        no_aliases = F.array().cast("array<string>")
        people = words.select(
            F.col("o").alias("line_no"), "name", kind.alias("entity_type"), none.alias("id"),
            F.array(F.concat(F.lit("~"), "name"), F.col("name")).alias("aliases"), none.alias("appellation"), F.lit("seen in adverts").alias("notes"),
        )
        firms = self.table("supplier").select(
            (F.col("s_suppkey") + 10**12).alias("line_no"), F.col("s_name").alias("name"),
            F.lit("organization").alias("entity_type"), F.lit("").alias("id"), no_aliases.alias("aliases"),
            none.alias("appellation"), F.lit("").alias("notes"),
        )
        places = self.table("nation").select(
            (F.col("n_nationkey") + 10**15).cast("bigint").alias("line_no"), F.col("n_name").alias("name"),
            F.lit("location").alias("entity_type"),
            F.concat(F.lit("ent_region"), F.col("n_regionkey").cast("string")).alias("id"), no_aliases.alias("aliases"),
            none.alias("appellation"), none.alias("notes"),
        )
        return people.unionByName(firms).unionByName(places)

    @shared
    def operator_entities(self) -> DataFrame:
        return en.operator_entities(self.entities(), self.curated())

    @shared
    def curated_entities(self) -> DataFrame:
        return en.curated_entities(self.curated_entries(), self.owners())

    @shared
    def all_entities(self) -> DataFrame:
        return en.all_entities(self.operator_entities(), self.curated_entities(), self.unresolved())

    @shared
    def entity_owners(self) -> DataFrame:
        return en.alias_owners(self.all_entities())

    @shared
    def entity_index(self) -> DataFrame:
        return al.index(self.entity_owners())

    # ---- event-log edges for pairs -------------------------------------------------------

    def log_edges(self) -> DataFrame:
        """Edges from the event log: hour as container, ten minutes as chunk, user as entity."""
        e = self.texts("events")
        source = F.when(F.col("event_type") == "signup", "deterministic").otherwise("participant")
        tier = (
            F.when(F.col("event_type") == "purchase", "speaker").when(F.col("event_type").isin("click", "view"), "named")
            .when(F.col("event_type") == "error", "mentioned")
        )
        return e.select(
            F.format_string("u%08d", "user_id").alias("entity_id"),
            F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("container_id"),
            F.floor(F.minute("ts") / 10).cast("bigint").alias("stage_idx"), source.alias("source"), tier.alias("tier"),
        )

    # ---- relations ----------------------------------------------------------------------

    def baked_relations(self) -> DataFrame:
        none = F.lit(None).cast("string")
        rel = lambda head, kind, tail, name, notes, seq: [
            head.alias("head"), F.lit(kind).alias("type"), tail.alias("tail"), name.alias("tail_name"),
            notes.alias("notes"), seq.cast("bigint").alias("seq"),
        ]
        nation, region = self.table("nation"), self.table("region")
        c = self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        s = self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        n = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        p = self.table("part")
        rows = c.select(*rel(F.col("c_name"), "origin_from", F.col("n_name"), F.col("n_name"), F.col("c_mktsegment"), F.col("c_custkey")))
        rows = rows.unionByName(s.select(*rel(F.col("s_name"), "origin_from", F.col("n_name"), F.col("n_name"), none, F.col("s_suppkey"))))
        rows = rows.unionByName(n.select(*rel(F.col("n_name"), "member_of", F.col("r_name"), F.col("r_name"), none, F.col("n_nationkey"))))
        rows = rows.unionByName(p.select(*rel(F.col("p_type"), "creator_of", F.col("p_brand"), F.col("p_brand"), F.col("p_name"), F.col("p_partkey"))))
        return rows.unionByName(p.select(*rel(F.col("p_brand"), "ally_of", none, F.col("p_name"), F.col("p_type"), F.col("p_partkey"))))

    def curated_relations(self) -> DataFrame:
        """Overrides: every supplier origin restated with a note, and part sizes as new rows."""
        s = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        p = self.table("part")
        rows = s.select(
            F.col("s_name").alias("head"), F.lit("origin_from").alias("type"), F.col("n_name").alias("tail"),
            F.col("n_name").alias("tail_name"), F.lit("checked").alias("notes"), F.col("s_suppkey").alias("seq"),
        )
        extra = p.select(
            F.col("p_brand").alias("head"), F.lit("rival_of").alias("type"), F.lit(None).cast("string").alias("tail"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("tail_name"), F.col("p_name").alias("notes"),
            F.col("p_partkey").alias("seq"),
        )
        return rows.unionByName(extra)

    @shared
    def relations(self) -> DataFrame:
        from scriptloom.operators import relations as re_

        return re_.collate(self.baked_relations(), self.curated_relations())

    def responses(self) -> DataFrame:
        """Service answers about relations, one per page: its terms as tails, in several odd shapes."""
        t = self.nav_terms()
        kind = F.element_at(
            F.array(*[F.lit(k) for k in (*tg.RELATION_TYPES, "knows")]), (F.length("term") % 10 + 1).cast("int")
        )
        line = (
            F.when(F.col("ord") == 1, F.lit("# remark")).when(F.col("ord") == 2, F.col("term"))
            .when(F.col("ord") % 2 == 0, F.concat(kind, F.lit(" ; "), "term", F.lit(";first;second")))
            .otherwise(F.concat(kind, F.lit(";"), "term"))
        )
        listed = F.array_sort(F.collect_list(F.struct("ord", line.alias("line"))))
        body = F.array_join(F.transform(listed, lambda x: x["line"]), "\n")
        docs = t.groupBy("page_id").agg(body.alias("b"))
        n = F.length("b") % 5
        text = (
            F.when(n == 0, F.concat(F.lit("<关系>\n"), "b")).when(n == 1, F.concat(F.lit("【关系】"), "b", F.lit("【/关系】")))
            .when(n == 2, F.lit("<关系>\n无\n</关系>")).when(n == 3, F.col("b"))
            .otherwise(F.concat(F.lit("<关系>\n"), "b", F.lit("\n</关系>")))
        )
        return docs.select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("unit_id"), text.alias("response"))

    # ---- unit state ---------------------------------------------------------------------

    def unit_totals(self) -> DataFrame:
        return ch.rollup(self.chunks()).withColumnRenamed("container_id", "unit_id")

    def prior_state(self) -> DataFrame:
        """State of an earlier run: English units have other content, Spanish ones are unknown,
        and each label value stands for a unit that has gone."""
        d = self.documents().select("container_id", "tag").distinct()
        kept = d.filter(F.col("tag") != "es").select(F.col("container_id").alias("unit_id"), "tag")
        gone = self.table("labels").select(
            F.concat(F.lit("gone-"), F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("unit_id"),
            F.lit("none").alias("tag"),
        ).distinct()
        return kept.unionByName(gone)

    def outputs(self) -> DataFrame:
        """Existing outputs: every prior unit but the German ones."""
        return self.prior_state().filter(F.col("tag") != "de").select("unit_id")
