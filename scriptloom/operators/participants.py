"""Matching an alias dictionary against chunk texts, and the tiers that follow from the matches.

The dictionary is never crossed with the texts. An alias without blanks and line feeds lies within one word of a text (what
these bound), and what follows or precedes it there decides its mention. Such aliases are therefore sought once in each
distinct word, and the words of the texts meet these counts (where places are asked for: places inside the word, to which the
place of the word is added) in one equi-join. Other aliases and words of more than `LONGEST` characters are sought in the texts
themselves, as are long aliases where only counts are asked for.

What is searched is cut, in one pass, into pages of `PAGE` characters with a
margin on both sides, and each page into runs of ASCII word characters and single other characters. These
places carry their position and meet the dictionary in one equi-join:

* aliases of ASCII letters and digits only match whole runs of such characters, so the runs are
  joined on the run itself (where only counts are asked for, straight from the text);
* every other alias holds at least one character outside that class. The first such character
  (preferring a non-ASCII one) and a neighbour form its anchor. Its place carries a window of a few characters, which
  decides the match of an alias of up to `SHORT` characters, so the text itself is not carried along;
* a longer alias meets its places by the part that such a window shows, and only what has passed there is decided
  on the text;
* speakers are joined on the name before the colon of a dialogue line.

Mentions of an alias do not overlap: of those found, the leftmost counts and the next one starts after it. Only an alias
with a border (a proper prefix that is also a suffix) can overlap itself, so only those keep their positions in the
shuffle; all other matches are counted before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptloom.functions import text as tx
from scriptloom.session import BROADCAST_BYTES, spread, written

# Tier ranks.
TIER_RANK = {"speaker": 3, "named": 2, "mentioned": 1}
# ASCII word characters and their complement.
WORD, NON_WORD = r"\p{Alnum}", r"\P{Alnum}"
PAGE = 160  # characters of a text that are looked at together
SHORT = 30  # longest alias that a window decides
SPACE = r"[ \n]"  # what bounds a word; none of it is an ASCII word character
LONGEST = 64  # characters of a word that is looked up among the distinct ones
TAKEN = 512  # characters of a text whose words are taken together where their places are asked for
RUN, SINGLE, LEFT, RIGHT, LONG_RUN, SPEECH = range(6)  # kinds of places
CHUNK = ["container_id", "stage_idx"]


def tier_rank(c: Column | str) -> Column:
    rank = F.when(F.lit(False), F.lit(0))
    for name, value in TIER_RANK.items():
        rank = rank.when(tx.col(c) == name, value)
    return rank


def speaker_lines(chunks: DataFrame) -> DataFrame:
    """One row per dialogue line: (container_id, stage_idx, speaker)."""
    talk = chunks.filter(F.col("body").contains(":") | F.col("body").contains("："))
    lines = talk.select(*CHUNK, F.explode(tx.lines("body")).alias("line"))
    lines = lines.filter(F.col("line").contains(":") | F.col("line").contains("："))
    return lines.select(*CHUNK, tx.speaker("line").alias("speaker")).filter("speaker is not null")


def speaker_counts(chunks: DataFrame) -> DataFrame:
    return speaker_lines(chunks).groupBy(*CHUNK, "speaker").agg(F.count(F.lit(1)).alias("n_lines"))


def _shape(alias: Column) -> Column:
    """0-based offset of the anchor character: first non-ASCII one, else first non-word one."""
    foreign = F.length(F.regexp_extract(alias, r"(?s)\A([\x00-\x7F]*)", 1))
    other = F.length(F.regexp_extract(alias, rf"(?s)\A({WORD}*)", 1))
    inked = F.length(F.regexp_extract(alias, rf"(?s)\A((?:{WORD}|\s)*)", 1))
    size = F.length(alias)
    return F.when(foreign < size, foreign).when(inked < size, inked).otherwise(other)


def _bordered(alias: Column) -> Column:
    size = F.length(alias)
    cuts = F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.exists(cuts, lambda k: F.substring(alias, F.lit(1), k) == F.substring(alias, size - k + 1, k))


def dictionary(aliases: DataFrame) -> DataFrame:
    """Distinct alias texts with the kind and key of the place they meet.

    seen, lead: the part of the alias that a window shows at most, and how much of it lies before the anchor.
    """
    alias, offset = F.col("alias"), _shape(F.col("alias"))
    simple = alias.rlike(rf"\A{WORD}+\z")
    words = aliases.select("alias").filter(alias != "").distinct().select(
        "alias", F.length(alias).alias("size"), tx.alias_mode(alias).alias("mode"), offset.alias("offset"),
        simple.alias("simple"), (~simple & _bordered(alias)).alias("bordered"),
    )
    at, size = F.col("offset"), F.col("size")
    kind = (
        F.when(F.col("simple"), F.when(size <= SHORT, RUN).otherwise(LONG_RUN)).when(size == 1, SINGLE)
        .when(at == size - 1, LEFT).otherwise(RIGHT)
    )
    pair = F.substring(alias, F.when(at == size - 1, at).otherwise(at + 1), F.lit(2))
    lead = F.least(at, F.lit(SHORT - 1))
    return words.select(
        "alias", "size", "mode", "offset", "bordered", kind.alias("kind"), (size > SHORT).alias("long"),
        F.when(kind.isin(LEFT, RIGHT), pair).otherwise(F.substring(alias, 1, SHORT)).alias("key"), lead.alias("lead"),
        F.substring(alias, at - lead + 1, lead + SHORT).alias("seen"),
    )


def _pages(left: int) -> Column:
    """Pages of the body: `left` characters before and SHORT + 1 after it belong to the neighbours or lie outside."""
    padded = F.concat(F.lit(" " * left), "body", F.lit(" " * (SHORT + 1)))
    page = rf"(?s)(?=(.{{1,{left + PAGE + SHORT + 1}}})).{{1,{PAGE}}}"
    return F.regexp_extract_all(padded, F.lit(page), F.lit(1))


def found(chunks: DataFrame, words: DataFrame, speech: bool, placed: bool) -> DataFrame:
    """alias, spoke (1 for a speaker line, else 0), start (in the text), long (still to be decided on the text), bordered
    of every place that an alias of the dictionary `words` meets. Mentions of an alias may overlap here.

    Without `placed`, aliases that are runs are compared with the runs of the whole text, which tells no start.
    """
    facts = words.agg(
        F.collect_set("kind").alias("kinds"),
        F.coalesce(F.sum(2 * (F.octet_length("alias") + F.octet_length("key") + F.octet_length("seen") + 48)), F.lit(0)).alias("bytes"),
        F.max("lead").alias("lead"),
        F.bool_or(F.substring("alias", F.col("offset") + 1, F.lit(1)).rlike(r"\s")).alias("spaces"),
    ).first()
    left, kinds = (facts["lead"] or 0) + 1, set(facts["kinds"])
    signs, runs = sorted(kinds & {SINGLE, LEFT, RIGHT}), bool(kinds & {RUN, LONG_RUN})
    sign = rf"(?={NON_WORD})" if facts["spaces"] else rf"(?={NON_WORD})(?=\S)"
    begin = rf"(?<!{WORD})(?={WORD})"
    at_places = [*([sign] if signs else []), *([begin] if runs and placed else [])]
    none = F.array().cast("array<string>")
    told = F.filter(tx.lines("body"), lambda x: x.contains(":") | x.contains("："))
    # pages, whole runs and speakers of a text, in one pass
    parts = [
        _pages(left) if at_places else none,
        F.split("body", NON_WORD + "+", -1) if runs and not placed else none,
        F.filter(F.transform(told, lambda x: tx.speaker(x)), lambda x: x.isNotNull()) if speech else none,
    ]
    cut = chunks.select(*CHUNK, F.length("body").alias("_length"), F.posexplode(F.array(*parts)).alias("_part", "_texts"))
    cut = cut.select(*CHUNK, "_length", "_part", F.posexplode("_texts").alias("page", "text"))
    # a place of a page is what the page holds from there on
    rest = F.regexp_extract_all("text", F.lit(rf"(?s)(?:{'|'.join(at_places)})(?=(.*))"), F.lit(1))
    places = F.when(F.col("_part") == 0, rest).otherwise(F.array("text")) if at_places else F.array("text")
    cut = cut.select(*CHUNK, "_length", "_part", "page", "text", F.explode(places).alias("rest"))
    at = F.length("text") - F.length("rest")
    cut = cut.select("*", F.when(F.col("_part") == 0, at).alias("at")).filter((F.col("_part") > 0) | (F.col("at") >= left) & (F.col("at") < left + PAGE))
    meets = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    keys = {SINGLE: F.substring("rest", 1, 1), LEFT: F.substring("text", F.col("at"), F.lit(2)), RIGHT: F.substring("rest", 1, 2)}
    run = F.regexp_extract("rest", rf"\A{WORD}+", 0)
    of_run = F.array(F.when(F.length(run) <= SHORT, meets(RUN, run)).otherwise(meets(LONG_RUN, F.substring(run, 1, SHORT))))
    of_sign = F.array(*[meets(k, keys[k]) for k in signs])
    met = of_sign if signs else of_run
    if signs and runs and placed:
        met = F.when(F.col("rest").rlike(rf"\A{WORD}"), of_run).otherwise(of_sign)
    whole = F.array(meets(RUN, F.col("rest")))
    met = F.when(F.col("_part") == 0, met).when(F.col("_part") == 1, whole).otherwise(F.array(meets(SPEECH, F.col("rest"))))
    cut = cut.select(*CHUNK, "_length", "page", "at", "text", F.explode(met).alias("_m")).select("*", "_m.*").drop("_m")
    known = words if placed else words.withColumns({  # a whole run is met by its own text
        "key": F.when(F.col("kind") == LONG_RUN, F.col("alias")).otherwise(F.col("key")),
        "long": F.col("long") & (F.col("kind") != LONG_RUN),
        "kind": F.when(F.col("kind") == LONG_RUN, RUN).otherwise(F.col("kind"))})
    if speech:
        known = known.unionByName(known.withColumns({"kind": F.lit(SPEECH), "key": F.col("alias")}))
    side = F.broadcast(known) if facts["bytes"] <= BROADCAST_BYTES else known
    met = cut.join(side, ["kind", "key"])
    windowed = F.col("kind").isin(SINGLE, LEFT, RIGHT)
    first = F.col("at") + 1 - F.col("lead")
    before = F.substring(F.col("text"), first - 1, F.lit(1))
    after = F.substring(F.col("text"), first + F.col("size"), F.lit(1))
    bounded = (F.col("mode") != "ascii") | F.col("long") | (before.rlike(NON_WORD) & after.rlike(NON_WORD))
    exact = F.substring(F.col("text"), first, F.length("seen")) == F.col("seen")
    start = F.col("page") * PAGE + F.col("at") - left - F.when(windowed, F.col("offset")).otherwise(0)
    inside = (start >= 0) & (start + F.col("size") <= F.col("_length"))
    said = F.when(F.col("kind") == SPEECH, 1).otherwise(0).cast("bigint")
    return met.filter(F.when(windowed, inside & exact & bounded).otherwise(True)).select(
        *CHUNK, "alias", "size", "mode", "bordered", "long", said.alias("spoke"), F.when(F.col("kind") != SPEECH, start).alias("start"))


def _apart(starts: Column, size: Column) -> Column:
    """Sorted starts without those that lie inside the one kept before."""
    none = F.array().cast("array<int>")
    done = F.aggregate(
        F.array_sort(starts), F.struct(none.alias("kept"), F.lit(0).alias("upto")),
        lambda acc, x: F.when(x < acc["upto"], acc).otherwise(
            F.struct(F.concat(acc["kept"], F.array(x)).alias("kept"), (x + size).alias("upto"))))
    return done["kept"]


def _count_apart(starts: Column, size: Column) -> Column:
    done = F.aggregate(
        F.array_sort(starts), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda acc, x: F.when(x < acc["upto"], acc).otherwise(F.struct((acc["n"] + 1).alias("n"), (x + size).alias("upto"))))
    return done["n"]


def _decided(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """The starts of long aliases at which the text holds them: rows of CHUNK, alias, size, mode, starts, spoke."""
    literal = lambda p: F.substring(F.col("body"), p + 1, F.col("size")) == F.col("alias")
    edge = lambda p: F.coalesce(F.substring(F.col("body"), p, F.lit(1)).rlike(rf"\A{WORD}"), F.lit(False))
    free = lambda p: ~(((p > 0) & edge(p)) | edge(p + F.col("size") + 1))
    texts = rows.join(chunks.select(*CHUNK, "body"), CHUNK)
    fits = F.filter("starts", lambda p: literal(p) & ((F.col("mode") != "ascii") | free(p)))
    return texts.select(*CHUNK, "alias", "size", "mode", fits.alias("starts"), "spoke")


def _settled(rows: DataFrame, chunks: DataFrame, any_long: bool) -> DataFrame:
    """CHUNK, alias, size, starts, spoke: places that may overlap or were to be decided on the text, where the alias stands."""
    each = rows.groupBy(*CHUNK, "alias", "size", "mode", "long").agg(F.collect_list("start").alias("starts"), F.sum("spoke").alias("spoke"))
    sure = each.filter("not long").drop("long")
    if any_long:
        sure = sure.unionByName(_decided(each.filter("long").drop("long"), chunks))
    return sure.select(*CHUNK, "alias", "size", "starts", "spoke")


def _open(words: DataFrame) -> tuple[bool, bool]:
    """Whether any alias may overlap itself or is long; whether any is long."""
    facts = words.agg(F.bool_or(F.col("bordered") | F.col("long")), F.bool_or("long")).first()
    return bool(facts[0]), bool(facts[1])


def _text_spans(chunks: DataFrame, words: DataFrame, scope: DataFrame | None = None, name: str = "places") -> DataFrame:
    """CHUNK, alias, size, bordered, long, start of the dictionary `words`, sought in the texts as they are."""
    columns = [*CHUNK, "alias", "size", "mode", "bordered", "long", "start", "spoke"]
    rows = found(chunks, words, speech=False, placed=True).select(*columns)
    if scope is not None:
        rows = rows.join(scope, ["container_id", "alias"], "left_semi").select(*columns)
    rows = written(rows, name)
    kept = [*CHUNK, "alias", "size", "bordered", "long", "start"]
    simple = rows.filter("not bordered and not long").select(*kept)
    any_open, any_long = _open(words)
    if not any_open:
        return simple
    settled = _settled(rows.filter("bordered or long"), chunks, any_long)
    settled = settled.select(*CHUNK, "alias", "size", F.explode(_apart(F.col("starts"), F.col("size"))).alias("start"))
    return simple.unionByName(settled.join(words.select("alias", "bordered", "long"), "alias").select(*kept))


def _word_spans(chunks: DataFrame, words: DataFrame, scope: DataFrame | None) -> DataFrame:
    """CHUNK, alias, start, size of the dictionary `words`, whose aliases hold no SPACE.

    An alias is sought once in each distinct word of all texts. The words of a text are taken from pages of `TAKEN` characters, so that
    the place of a word costs no more than a look at its page. Texts that hold words of more than `LONGEST` characters are searched
    as they are, with blanks for all other words.
    """
    parts = F.split("body", " ", -1)
    blank = F.transform(parts, lambda w: F.when(F.length(w) <= LONGEST, F.repeat(F.lit(" "), F.length(w))).otherwise(w))
    any_long = F.col("body").rlike(rf"[^ ]{{{LONGEST + 1}}}")
    texts = chunks.select(*CHUNK, F.replace("body", F.lit("\n"), F.lit(" ")).alias("body"))
    texts = written(texts.select(*CHUNK, "body", F.when(any_long, F.array_join(blank, " ")).alias("long_words")), "chunk-texts")
    whole = (F.col("word") != "") & (F.length("word") <= LONGEST)
    known = written(texts.select(F.explode(parts).alias("word")).filter(whole).distinct(), "distinct-words")
    known = spread(known, "word").select(F.col("word").alias("container_id"), F.lit(0).cast("bigint").alias("stage_idx"), F.col("word").alias("body"))
    hits = _text_spans(known, words, name="places-in-words").withColumnsRenamed({"container_id": "word", "start": "inside"}).drop("stage_idx")
    hits = written(hits, "word-hits")
    size = hits.agg(F.coalesce(F.sum(2 * (F.octet_length("word") + F.octet_length("alias") + 64)), F.lit(0))).first()[0]
    side = F.broadcast(hits) if size <= BROADCAST_BYTES else hits
    # a page has one character before it and holds the words that begin in it, with one character after them at least
    page = rf"(?s)(?=(.{{1,{TAKEN + LONGEST + 1}}})).{{1,{TAKEN}}}"
    pages = F.posexplode(F.regexp_extract_all(F.concat(F.lit(" "), "body"), F.lit(page), F.lit(1))).alias("page", "text")
    each = texts.select(*CHUNK, pages).select(*CHUNK, "page", "text", F.posexplode(F.split("text", " ", -1)).alias("at", "word")).filter((F.col("at") > 0) & whole)
    first = F.length(F.call_function("substring_index", F.col("text"), F.lit(" "), F.col("at")))  # of the word, from 0 in its page
    each = each.select(*CHUNK, "page", "word", first.alias("first")).filter(F.col("first") < TAKEN)
    columns = [*CHUNK, "alias", "size", "bordered", "long", "start"]
    rows = each.join(side, "word").withColumn("start", F.col("page") * TAKEN + F.col("first") + F.col("inside")).select(*columns)
    if scope is not None:
        rows = rows.join(scope, ["container_id", "alias"], "left_semi").select(*columns)
    long_texts = texts.filter("long_words is not null").select(*CHUNK, F.col("long_words").alias("body"))
    rows = written(rows, "places").unionByName(_text_spans(long_texts, words, scope).select(*columns))
    plain = [*CHUNK, "alias", "start", "size"]
    # aliases that may overlap themselves are taken apart once more, so that a text that comes twice counts once for them
    again = rows.filter("bordered and not long").groupBy(*CHUNK, "alias", "size").agg(F.collect_list("start").alias("starts"))
    apart = again.select(*CHUNK, "alias", F.explode(_apart(F.col("starts"), F.col("size"))).alias("start"), "size")
    return rows.filter("not bordered or long").select(*plain).unionByName(apart.select(*plain))


def spans(chunks: DataFrame, aliases: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Mentions as (chunk, alias, start, size), not overlapping for each alias; start from 0.

    scope: distinct (container_id, alias), a written table; other containers are not cut, and mentions outside of it are not kept.
    """
    words = written(dictionary(aliases), "dictionary")
    in_word = ~F.col("alias").rlike(SPACE)

    def near(some: DataFrame | None) -> DataFrame:
        if some is None:
            return chunks
        # written, so that its size is known: texts are not dealt by container while the list of containers is short
        return chunks.join(written(some.select("container_id").distinct(), "scope-containers"), "container_id", "left_semi")

    rows = _word_spans(near(scope), words.filter(in_word), scope)
    others = words.filter(~in_word)
    if others.isEmpty():
        return rows
    if scope is not None:
        scope = written(scope.join(others.select("alias"), "alias", "left_semi"), "scope-in-texts")
    return rows.unionByName(_text_spans(near(scope), others, scope).select(*CHUNK, "alias", "start", "size"))


def _text_hits(chunks: DataFrame, words: DataFrame, speech: bool) -> DataFrame:
    """CHUNK, alias, spoke, n of the dictionary `words`, sought in the texts as they are."""
    any_open, any_long = _open(words)
    rows = found(chunks, words, speech, placed=False)
    counts = F.sum("spoke").alias("spoke"), F.sum(1 - F.col("spoke")).alias("n")
    if not any_open:
        return rows.groupBy(*CHUNK, "alias").agg(*counts)
    # counted at once, but for aliases whose places may overlap or are still to be decided: those keep their places
    single = F.col("bordered") | F.col("long")
    rows = rows.groupBy(*CHUNK, "alias", "size", "mode", "bordered", "long", F.when(single, F.col("start")).alias("start")).agg(*counts)
    rows = written(rows, "alias-hits")
    n = _count_apart(F.col("starts"), F.col("size")).alias("n")
    settled = _settled(rows.filter("bordered or long"), chunks, any_long).select(*CHUNK, "alias", "spoke", n)
    return rows.filter("not bordered and not long").select(*CHUNK, "alias", "spoke", "n").unionByName(settled.filter("spoke > 0 or n > 0"))


def _word_hits(chunks: DataFrame, words: DataFrame, speech: bool) -> DataFrame:
    """CHUNK, alias, spoke, n of the dictionary `words`, whose aliases hold no SPACE and are not long.

    An alias is counted once in each distinct word of all texts. Texts are made once and written, as they are read thrice.
    """
    parts = F.split(F.replace("body", F.lit("\n"), F.lit(" ")), " ", -1)  # a single character is split at without a pattern
    any_long = F.col("body").rlike(rf"[^ \n]{{{LONGEST + 1}}}")
    long_words = F.array_join(F.filter(parts, lambda w: F.length(w) > LONGEST), " ")
    chunks = written(chunks.select(*CHUNK, "body", F.when(any_long, long_words).alias("long_words")), "chunk-texts")
    each = chunks.select(*CHUNK, F.posexplode(parts).alias("at", "word")).filter((F.col("word") != "") & (F.length("word") <= LONGEST))
    known = written(each.select("word").distinct(), "distinct-words")
    known = spread(known, "word").select(F.col("word").alias("container_id"), F.lit(0).cast("bigint").alias("stage_idx"), F.col("word").alias("body"))
    hits = _text_hits(known, words, speech=False).select(F.col("container_id").alias("word"), "alias", "n")
    hits = written(hits.join(words.select("alias", "bordered"), "alias"), "word-hits")
    size = hits.agg(F.coalesce(F.sum(2 * (F.octet_length("word") + F.octet_length("alias") + 48)), F.lit(0))).first()[0]
    side = F.broadcast(hits) if size <= BROADCAST_BYTES else hits
    zero, once = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # aliases that may overlap themselves keep the place of the word, so that a text that comes twice counts once for them
    kept = lambda c: F.when(F.col("bordered"), F.col(c)).alias(c)
    rows = each.join(side, "word").select(*CHUNK, "alias", "bordered", kept("at"), kept("word"), zero.alias("spoke"), "n")
    flags = words.select("alias", "bordered")
    more = _text_hits(chunks.select(*CHUNK, F.col("long_words").alias("body")).filter("body is not null"), words, speech=False).join(flags, "alias")
    if speech:
        said = speaker_lines(chunks).withColumnRenamed("speaker", "alias").join(flags, "alias")
        more = more.unionByName(said.withColumns({"spoke": once, "n": zero}))
    rows = rows.unionByName(more, allowMissingColumns=True)
    counts = F.sum("spoke").alias("spoke"), F.sum("n").alias("n")
    if not _open(words)[0]:
        return rows.groupBy(*CHUNK, "alias").agg(*counts)
    n = F.when(F.col("word").isNull(), F.sum("n")).otherwise(F.max("n")).alias("n")
    rows = written(rows.groupBy(*CHUNK, "alias", "bordered", "at", "word").agg(F.sum("spoke").alias("spoke"), n), "word-alias-hits")
    sure = rows.filter("not bordered").select(*CHUNK, "alias", "spoke", "n")
    return sure.unionByName(rows.filter("bordered").groupBy(*CHUNK, "alias").agg(*counts))


def alias_hits(chunks: DataFrame, aliases: DataFrame, speech: bool = True) -> DataFrame:
    """Spoken lines and exact non-overlapping mentions per (chunk, alias), rows without either left out.

    `chunks` must hold one row per (container_id, stage_idx).
    """
    words = written(dictionary(aliases), "dictionary")
    in_word = ~F.col("long") & ~F.col("alias").rlike(SPACE)
    hits = _word_hits(chunks, words.filter(in_word), speech)
    others = words.filter(~in_word)
    return hits if others.isEmpty() else hits.unionByName(_text_hits(chunks, others, speech))


def mention_counts(chunks: DataFrame, aliases: DataFrame) -> DataFrame:
    return alias_hits(chunks, aliases, speech=False).select(*CHUNK, "alias", "n")


def _names(aliases: DataFrame) -> tuple[DataFrame, bool]:
    """The sorted aliases of each entity; whether a long has a bit for each of them and the table can be broadcast."""
    names = aliases.groupBy("entity_id").agg(F.array_sort(F.collect_set("alias")).alias("_names"))
    size = F.sum(2 * (F.octet_length("entity_id") + F.octet_length(F.array_join("_names", " ")) + 48))
    most, size, unnamed = names.agg(F.max(F.size("_names")), size, F.count_if(F.col("entity_id").isNull())).first()
    return names, (most or 0) <= 64 and (size or 0) <= BROADCAST_BYTES and not unnamed


def _bit(names: str, alias: str) -> Column:
    """The bit that stands for an alias among the sorted ones of its entity."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.array_position(names, F.col(alias)) - 1).cast("int"))


def participants(
    chunks: DataFrame,
    aliases: DataFrame,
    explicit: DataFrame | None = None,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Tiered edges (entity, chunk).

    aliases: entity_id, alias, match_class, mode. explicit: entity_id, container_id, stage_idx rows
    that suppress an edge. summary: (container_id, entity_id) pairs that lift a lone hit of a
    one-character name.
    """
    names, narrow = _names(aliases)
    known = aliases.join(F.broadcast(names), "entity_id").withColumn("_bit", _bit("_names", "alias")).drop("_names") if narrow else aliases
    rows = alias_hits(chunks, aliases).join(known, "alias")
    lone = (F.col("mode") == "cjk_single") & (F.col("n") > 0)
    if summary is not None:
        flagged = summary.select("container_id", "entity_id").distinct().withColumn("in_summary", F.lit(True))
        rows = rows.join(flagged, ["container_id", "entity_id"], "left")
        lifted = F.coalesce("in_summary", F.lit(False))
    else:
        lifted = F.lit(False)
    strong = (
        F.when(F.col("n") == 0, False)
        .when(F.col("mode") == "cjk_multi", F.col("match_class") == "canonical")
        .when(F.col("mode") == "ascii", F.col("match_class").isin("canonical", "canonical_short"))
        .otherwise(lone & ((F.col("n") >= 2) | lifted))
    )
    edges = rows.groupBy("entity_id", *CHUNK).agg(
        F.sum("spoke").alias("spoke_lines"),
        F.sum("n").alias("mention_count"),
        F.bool_or(strong).alias("_strong"),
        F.bit_or("_bit").alias("_bits") if narrow else F.array_sort(F.collect_set("alias")).alias("matched_aliases"),
    )
    if narrow:
        matched = F.filter("_names", lambda _, i: F.call_function("shiftright", F.col("_bits"), i).bitwiseAND(F.lit(1)) != 0)
        edges = edges.join(F.broadcast(names), "entity_id").withColumn("matched_aliases", matched).drop("_names", "_bits")
    if explicit is not None:
        edges = edges.join(explicit.select("entity_id", *CHUNK), ["entity_id", *CHUNK], "left_anti")
    tier = (
        F.when(F.col("spoke_lines") > 0, "speaker")
        .when(F.col("_strong") | (F.col("mention_count") >= 2), "named")
        .otherwise("mentioned")
    )
    return edges.select(
        "entity_id", *CHUNK, F.lit("participant").alias("source"), tier.alias("tier"),
        "spoke_lines", "mention_count", "matched_aliases",
    )
