"""Line-oriented files: alias lists, id lists and line-delimited JSON with bad-row capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scriptloom.functions import text as tx
from scriptloom.operators.entities import ENTITY_TYPES

LINE_SCHEMA = "line_no bigint, line string"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of one hand-kept file; numbering needs the file whole, so it is read whole."""
    if not exists(spark, path):
        return spark.createDataFrame([], LINE_SCHEMA)
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.posexplode(tx.lines("value")).alias("pos", "line"))
    return rows.select((F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def alias_rows(lines: DataFrame) -> DataFrame:
    """`canonical;alias;…` lines -> (canonical, alias, ord), repeated canonicals merged, aliases once."""
    names = F.filter(F.transform(F.split("line", ";", -1), lambda n: tx.strip(n)), lambda n: n != "")
    parts = lines.select("line_no", names.alias("n")).filter(F.size("n") > 0)
    rows = parts.select(
        F.element_at("n", 1).alias("canonical"), "line_no",
        F.posexplode(F.slice("n", 2, F.size("n"))).alias("pos", "alias"),
    )
    return rows.groupBy("canonical", "alias").agg(
        F.min(F.struct("line_no", "pos")).alias("ord")
    )


def alias_map(lines: DataFrame) -> DataFrame:
    """Every name of a line -> its canonical; the last line wins."""
    names = F.filter(F.transform(F.split("line", ";", -1), lambda n: tx.strip(n)), lambda n: n != "")
    parts = lines.select("line_no", names.alias("n")).filter(F.size("n") > 0)
    rows = parts.select("line_no", F.element_at("n", 1).alias("canonical"), F.explode("n").alias("alias"))
    return rows.groupBy("alias").agg(F.max_by("canonical", "line_no").alias("canonical"))


def names_beside(lines: DataFrame, name: str) -> DataFrame:
    """Names of the first line that holds `name`, with whether it is the canonical of that line."""
    split = F.filter(F.split("line", ";", -1), lambda n: tx.strip(n) != "")
    rows = lines.select("line_no", split.alias("names")).filter(F.array_contains("names", name))
    first = rows.orderBy("line_no").limit(1)
    return first.select("names", (F.element_at("names", 1) == name).alias("is_canonical"))


def id_list(spark: SparkSession, path: str, out: str = "item_id") -> DataFrame:
    """One id per line; blank lines and a missing file give nothing."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{out} string")
    return spark.read.text(path).select(tx.strip("value").alias(out)).filter(F.col(out) != "")


def _is_other_value(text: str):
    """True for a well-formed JSON value that is not an object."""
    wrapped = F.concat(F.lit('{"v":'), F.col(text), F.lit("}"))
    return ~F.col(text).startswith("{") & (F.size(F.json_object_keys(wrapped)) == 1)


def json_rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Parsed non-blank, non-comment lines: line_no, raw, p (struct), keys, problem."""
    trimmed = tx.strip("line")
    used = lines.filter((trimmed != "") & ~trimmed.startswith("#"))
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    rows = used.select("line_no", F.col("line").alias("raw"), trimmed.alias("t"))
    rows = rows.withColumns({"p": F.from_json("t", full, options), "keys": F.json_object_keys("t")})
    problem = F.when(F.coalesce(_is_other_value("t"), F.lit(False)), "not a JSON object").when(
        F.col("keys").isNull() | F.col("p._bad").isNotNull(), "invalid JSON"
    )
    return rows.withColumn("problem", problem).drop("t")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


ENTITY_LINE = T.StructType(
    [*_strings("name", "entity_type", "id", "appellation", "notes"), T.StructField("aliases", T.ArrayType(T.StringType()))]
)
RELATION_LINE = T.StructType([
    *_strings("head", "type", "tail", "tail_name", "notes"),
    T.StructField("ambiguous_candidates", T.ArrayType(T.StringType())),
])


def curated_entity_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, errors) of a curated entity file; the first entity type is reserved."""
    rows = json_rows(lines, ENTITY_LINE)
    kind = F.coalesce("p.entity_type", F.lit("unknown"))
    reason = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.coalesce(tx.strip("p.name"), F.lit("")) == "", "missing/empty `name`")
        .when(~kind.isin(*ENTITY_TYPES[1:]), F.concat(F.lit("entity_type not allowed: "), kind))
    )
    marked = rows.withColumn("reason", reason)
    errors = marked.filter("reason is not null").select("line_no", "raw", "reason")
    good = marked.filter("reason is null").select(
        "line_no", tx.strip("p.name").alias("name"), kind.alias("entity_type"), "p.id", "p.aliases",
        "p.appellation", "p.notes",
    )
    return good, errors


def curated_relation_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, errors) of a curated relation file, each row checked."""
    from scriptloom.operators.relations import row_problem

    rows = json_rows(lines, RELATION_LINE).select(
        "line_no", "raw", "problem", "p.*", F.array_contains("keys", "tail").alias("has_tail")
    )
    marked = rows.withColumn("reason", F.coalesce("problem", row_problem(rows)))
    errors = marked.filter("reason is not null").select("line_no", "raw", "reason")
    good = marked.filter("reason is null").select(
        "head", "type", "tail", "tail_name", "notes", "ambiguous_candidates", F.col("line_no").alias("seq")
    )
    return good, errors


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-delimited JSON that must be well formed; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
