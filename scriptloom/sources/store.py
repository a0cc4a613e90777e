"""Tables of a build behind one manifest.

Every build writes new folders and, as its last step, a manifest that names the folders of all its tables. Readers take the last
finished manifest, so they see one whole build, never a mix; a build that breaks off leaves no manifest and
changes nothing for them. A table, or a part of one, that did not change keeps its old folder. One build runs at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptloom.sources import sinks

PARTS = 16  # parts of a table that is replaced part by part
ENTRY = "table string, part int, folder string, mark string"


def part_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def marks(df: DataFrame, part: Column) -> DataFrame:
    """part, mark: the same for the same rows in any order. Rows are hashed where they lie."""
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))
    each = df.select(part.alias("part"), F.sha2(row, 256).alias("h"))
    lane = lambda k: F.sum(F.conv(F.substring("h", 9 * k + 1, 9), 16, 10).cast("decimal(38,0)"))
    summed = each.groupBy("part").agg(F.concat_ws(":", F.count(F.lit(1)), *[lane(k).cast("string") for k in range(4)]).alias("mark"))
    return summed


class Snapshot:
    """The tables of one finished build."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        found = _finished(spark, self.root)
        self.version = version if version is not None else (found[-1] if found else 0)
        rows = spark.read.schema(ENTRY).parquet(_manifest(self.root, self.version)).collect() if self.version else []
        self.entries: dict[str, dict[int, tuple[str, str]]] = {}
        for r in rows:  # one for each table or part of one
            self.entries.setdefault(r.table, {})[r.part] = (r.folder, r.mark)

    def read(self, name: str) -> DataFrame:
        folders = [folder for folder, _ in self.entries[name].values()]
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def has(self, name: str) -> bool:
        return name in self.entries


class Build:
    """A build in progress on top of the last finished one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.before = spark, root.rstrip("/"), Snapshot(spark, root)
        self.entries: dict[str, dict[int, tuple[str, str]]] = {}

    def put(self, df: DataFrame, name: str, order: list[str] | None = None) -> DataFrame:
        """Write a whole table and read it back. If its rows are those of the last build, its old folder stays."""
        folder = f"data/{name}/{uuid.uuid4().hex}"
        out = sinks.table(df, self.root, folder, order=order)
        mark = "|".join(r.mark for r in marks(out, F.lit(0)).collect()) + "|" + out.schema.simpleString()
        old = self.before.entries.get(name, {}).get(-1)
        if old and old[1] == mark:
            _remove(self.spark, [f"{self.root}/{folder}"])
            folder = old[0]
        self.entries[name] = {-1: (folder, mark)}
        return self.spark.read.schema(out.schema).parquet(f"{self.root}/{folder}")

    def put_parts(self, df: DataFrame, name: str, key: str, order: list[str], parts: set[int] | None = None) -> DataFrame:
        """Write the parts of a table (rows by a hash of `key`) that changed; the others keep their folders.

        parts: those that may have changed; None compares the rows of every part with the last build.
        """
        old = self.before.entries.get(name, {})
        keyed = df.withColumn("_part", part_of(key))
        if not old:
            parts = set(range(PARTS))
        elif parts is None:
            now = {r.part: r.mark for r in marks(df, part_of(key)).collect()}  # at most PARTS rows
            parts = {p for p in now if p not in old or old[p][1] != now[p]} | {p for p in old if p >= 0 and p not in now}
        entries = {p: e for p, e in old.items() if p not in parts and p >= 0}
        folder = f"data/{name}/{uuid.uuid4().hex}"
        keyed.filter(F.col("_part").isin(sorted(parts))).repartitionByRange("_part", *order).sortWithinPartitions("_part", *order) \
            .write.partitionBy("_part").parquet(f"{self.root}/{folder}")
        # an empty file keeps the schema of a table without rows
        df.limit(0).coalesce(1).write.parquet(f"{self.root}/{folder}/empty")
        entries[-1] = (f"{folder}/empty", "")
        back = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}/empty", *[f"{self.root}/{folder}/_part={p}" for p in self._written(folder)])
        for r in marks(back, part_of(key)).collect():
            entries[r.part] = (f"{folder}/_part={r.part}", r.mark)
        self.entries[name] = entries
        return self.spark.read.schema(df.schema).parquet(*[f"{self.root}/{f}" for f, _ in entries.values()])

    def _written(self, folder: str) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in _names(self.spark, f"{self.root}/{folder}") if n.startswith("_part="))

    def commit(self, keep: int = 2) -> Snapshot:
        """Make this build the one that readers see. Folders that none of the last `keep` builds name are removed."""
        rows = [(t, p, folder, mark) for t, parts in self.entries.items() for p, (folder, mark) in parts.items()]
        version = self.before.version + 1
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(_manifest(self.root, version))
        finished = _finished(self.spark, self.root)
        named = lambda v: {folder for parts in Snapshot(self.spark, self.root, v).entries.values() for folder, _ in parts.values()}
        stay = set().union(*[named(v) for v in finished[-keep:]])
        gone = [v for v in finished[:-keep]]
        for v in gone:
            _remove(self.spark, [f"{self.root}/{f}" for f in named(v) - stay])
        _remove(self.spark, [_manifest(self.root, v) for v in gone])
        return Snapshot(self.spark, self.root, version)


def _manifest(root: str, version: int) -> str:
    return f"{root}/manifests/v{version:08d}"


def _finished(spark: SparkSession, root: str) -> list[int]:
    """Versions whose manifest is complete, in order."""
    return [int(n[1:]) for n in sinks._versions(spark, f"{root.rstrip('/')}/manifests")[1]]


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def _remove(spark: SparkSession, folders: list[str]) -> None:
    sc = spark.sparkContext
    for folder in folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
