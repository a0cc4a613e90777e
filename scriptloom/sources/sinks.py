"""Table writers. Each one replaces its table; rows that left the build go with the old files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptloom.operators.relations import row_problem


def table(df: DataFrame, root: str, name: str, partition_by: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Write one table and read it back, so later steps scan it instead of recomputing it.

    `order`: lookup key. Ranges of it go to files of their own, sorted, so a lookup reads the files and row groups
    whose statistics hold the key.
    """
    path = f"{root.rstrip('/')}/{name}"
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def relation_lines(df: DataFrame, path: str) -> None:
    """Line-delimited relations; a malformed row fails the write."""
    problem = row_problem(df)
    good = F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))
    json_lines(df.filter(good), path)


def name_list(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def named(entities: DataFrame) -> DataFrame:
    """Entities that can be written: those with a name."""
    return entities.filter(F.col("name") != "")


def replace_state(df: DataFrame, root: str, name: str) -> None:
    """A new version of a state that may be computed from the one before.

    Versions are folders of their own; one counts when its job has finished, the one before stays for its readers
    and older ones are removed. One writer at a time.
    """
    spark, folder = df.sparkSession, f"{root.rstrip('/')}/{name}"
    system, versions = _versions(spark, folder)
    number = 1 + max([int(v[1:]) for v in versions], default=0)
    df.write.mode("overwrite").parquet(f"{folder}/v{number:08d}")
    for old in versions[:-1]:
        system.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{old}"), True)


def state(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The last finished version of a state, or an empty one before the first run."""
    folder = f"{root.rstrip('/')}/{name}"
    versions = _versions(spark, folder)[1]
    return spark.read.schema(schema).parquet(f"{folder}/{versions[-1]}") if versions else spark.createDataFrame([], schema)


def _versions(spark: SparkSession, folder: str):
    """(file system, names of finished versions in order)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []
    return system, [n for n in names if system.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]


def read_or_empty(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A written table, or an empty one before the first run (cached parts)."""
    from scriptloom.sources.lines import exists

    path = f"{root.rstrip('/')}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
