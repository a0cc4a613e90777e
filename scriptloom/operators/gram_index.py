"""Text search by an inverted index of three-character grams.

Written once, beside the texts: `postings` (gram, chunk), in folders by a hash of the gram and sorted by gram, `grams` with the number of
chunks that hold each, and `texts`, in folders (blocks) by a hash of the chunk. A search reads the frequencies of
the grams of its literal, the postings of the rarest of them, and the texts of the blocks in which all of these meet;
only there are lines compared. Frequent grams are never read unless nothing rarer exists, and no list of a gram is ever gathered: postings
are rows. A scope (container, chunk) reaches the scans of postings and texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptloom.operators.search import grep

GRAM = 3
PARTS = 8  # parts of a folder of postings, by block
KEYS = ["container_id", "stage_idx"]


def grams_of(text: str) -> list[str]:
    return sorted({text[k:k + GRAM] for k in range(len(text) - GRAM + 1)})


def _folder(c: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(folders)).cast("int")


def scoped(chunks: DataFrame, container_id: str | None = None, stage_idx: int | None = None) -> DataFrame:
    """The chunks of one container, or one of its chunks; plain equalities, which reach the scan of a written table."""
    if container_id is not None:
        chunks = chunks.filter(F.col("container_id") == container_id)
    if stage_idx is not None:
        chunks = chunks.filter(F.col("stage_idx") == stage_idx)
    return chunks


def grep_scoped(chunks: DataFrame, pattern: str, container_id: str | None = None, stage_idx: int | None = None, regex: bool = False) -> DataFrame:
    return grep(scoped(chunks, container_id, stage_idx), pattern, KEYS, regex=regex)


class GramIndex:
    """An index in a folder. folders: of postings; blocks: of texts. Both are kept with the index."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        sizes = spark.read.parquet(f"{self.path}/sizes").first()
        self.folders, self.blocks = sizes.folders, sizes.blocks

    @staticmethod
    def write(chunks: DataFrame, path: str, folders: int = 64, blocks: int = 256) -> GramIndex:
        """Index of chunks (one row per container_id, stage_idx). Chunks with a null body hold nothing."""
        spark, path = chunks.sparkSession, path.rstrip("/")
        block = F.pmod(F.xxhash64(*KEYS), F.lit(blocks)).cast("int").alias("block")
        texts = chunks.filter("body is not null").select(*KEYS, "body", block)
        texts.repartition("block").sortWithinPartitions("block", *KEYS).write.partitionBy("block").parquet(f"{path}/texts")
        held = spark.read.parquet(f"{path}/texts")
        each = F.array_distinct(F.regexp_extract_all("body", F.lit(rf"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))
        rows = held.select(*KEYS, "block", F.explode(each).alias("gram")).withColumn("folder", _folder(F.col("gram"), folders))
        # a frequent gram lies in PARTS files; dealt by hash, as ranges would need a pass over all grams to sample their bounds
        part = F.pmod(F.col("block"), F.lit(PARTS))
        rows.repartition(folders * PARTS, "folder", part).sortWithinPartitions("folder", "gram", "block") \
            .write.partitionBy("folder").parquet(f"{path}/postings")
        counts = spark.read.parquet(f"{path}/postings").groupBy("folder", "gram").agg(F.count(F.lit(1)).alias("n_chunks"))
        counts.repartition("folder").sortWithinPartitions("folder", "gram").write.partitionBy("folder").parquet(f"{path}/grams")
        spark.createDataFrame([(folders, blocks)], "folders int, blocks int").coalesce(1).write.parquet(f"{path}/sizes")
        return GramIndex(spark, path)

    def texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def _at(self, table: str, grams: list[str]) -> DataFrame:
        """Rows of some grams: only their folders are listed and read."""
        asked = self.spark.createDataFrame([(g,) for g in grams], "gram string")
        folders = sorted({r[0] for r in asked.select(_folder(F.col("gram"), self.folders)).collect()})
        return self.spark.read.parquet(f"{self.path}/{table}").filter(F.col("folder").isin(folders) & F.col("gram").isin(grams))

    def frequencies(self, literal: str) -> dict[str, int]:
        """Number of chunks of each gram of a literal; a gram that no chunk holds has 0."""
        grams = grams_of(literal)
        found = {r.gram: r.n_chunks for r in self._at("grams", grams).collect()} if grams else {}
        return {g: found.get(g, 0) for g in grams}

    def candidates(self, literal: str, container_id: str | None = None, stage_idx: int | None = None, most: int = 4) -> DataFrame | None:
        """container_id, stage_idx, block of the chunks that hold the `most` rarest grams of the literal; None if it has no gram."""
        by_count = sorted(self.frequencies(literal).items(), key=lambda x: (x[1], x[0]))
        if not by_count:
            return None
        chosen = [g for g, _ in by_count[:most]]
        rows = scoped(self._at("postings", chosen), container_id, stage_idx)
        return rows.groupBy(*KEYS, "block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(chosen)).drop("_n")

    def candidate_texts(self, literal: str, container_id: str | None = None, stage_idx: int | None = None) -> DataFrame:
        """The chunks that may hold the literal; all of the scope if it is shorter than a gram."""
        some = self.candidates(literal, container_id, stage_idx)
        texts = scoped(self.texts(), container_id, stage_idx)
        if some is None:
            return texts
        blocks = [r.block for r in some.select("block").distinct().collect()]  # at most as many as there are folders of texts
        return texts.filter(F.col("block").isin(blocks)).join(some.drop("block"), KEYS, "left_semi")

    def grep(self, pattern: str, container_id: str | None = None, stage_idx: int | None = None, regex: bool = False, literal: str | None = None) -> DataFrame:
        """Matching lines as `search.grep` finds them. For a regex, `literal` is a text that every match holds."""
        held = (literal or "") if regex else pattern
        return grep(self.candidate_texts(held, container_id, stage_idx), pattern, KEYS, regex=regex)
