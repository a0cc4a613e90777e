"""Line search over chunk texts, entity sections and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scriptloom.functions import text as tx

SCOPES = ("events", "chars", "summaries", "all")
OUT = ["container_id", "stage_idx", "entity_id", "section", "line", "line_no", "snippet", "source"]


def grep(df: DataFrame, pattern: str, keys: list[str], body: str = "body", regex: bool = False) -> DataFrame:
    """Matching lines with their 1-based number. The whole text is tested before it is split."""
    hit = (lambda c: c.rlike(pattern)) if regex else (lambda c: c.contains(pattern))
    found = df.filter(hit(F.col(body)))
    rows = found.select(*keys, F.posexplode(tx.lines(body)).alias("_pos", "line"))
    kept = rows.filter(hit(F.col("line")))
    return kept.select(*keys, "line", (F.col("_pos") + 1).cast("bigint").alias("line_no"), tx.snippet("line").alias("snippet"))


def grep_text(
    pattern: str,
    scope: str = "all",
    regex: bool = False,
    chunks: DataFrame | None = None,
    sections: DataFrame | None = None,
    summaries: DataFrame | None = None,
) -> DataFrame:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, got {scope!r}")
    plan = [
        ("events", chunks, ["container_id", "stage_idx"], "body", "chunk"),
        ("chars", sections, ["entity_id", "section"], "text", "char_section"),
        ("summaries", summaries, ["container_id"], "text", "event_summary"),
    ]
    found = [
        grep(df, pattern, keys, body, regex).withColumn("source", F.lit(label))
        for name, df, keys, body, label in plan
        if df is not None and scope in (name, "all")
    ]
    if not found:
        raise ValueError(f"no table given for scope {scope!r}")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    kinds = {"stage_idx": "bigint"}
    for name in OUT:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kinds.get(name, "string")))
    return rows.select(*OUT)
