"""Tabular and JSON-lines sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.fixes import plain_scene_code, reindent_code
from sievework.functions.text import PENDING, strip, strip_fence
from sievework.operators.store import joined_unevenly, positioned, stored
from sievework.sources.registry import REGISTRY

CONVERSATION = "conversations array<struct<`from`: string, value: string>>, source string, metadata struct<day: string, version: string>, _corrupt_record string"


def filled(column: str) -> Column:
    """Neither null, nor empty, nor the text of a missing value."""
    c = F.col(f"`{column}`")
    return c.isNotNull() & (strip(c) != "") & (strip(c) != "nan")


@REGISTRY.source("reviewed_table", priority=4, title="Reviewed table", settings=("path",))
def reviewed_table(spark: SparkSession, path: str, description: str = "Reviewed Description", code: str = "Code") -> DataFrame:
    """Parquet with reviewed descriptions; rows without either text drop out."""
    t = spark.read.parquet(path).where(filled(description) & filled(code))
    others = [F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in t.columns if c not in (description, code)]
    return t.select(F.col(f"`{description}`").alias("description"), F.col(f"`{code}`").alias("code"), *others)


@REGISTRY.source("question_table", priority=3, title="Question table", settings=("path",))
def question_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet of question, python_code, transcript, video_id; the code may stand in a fence."""
    t = spark.read.parquet(path).where(filled("question") & filled("python_code"))
    return t.select(F.col("question").alias("description"), strip_fence(F.col("python_code")).alias("code"), *(c for c in ("transcript", "video_id") if c in t.columns))


@REGISTRY.source("code_table", priority=1, title="Code-only table", settings=("path",), code_only=True)
def code_table(spark: SparkSession, path: str, least: int = 50) -> DataFrame:
    """Parquet of codes without descriptions: too short ones drop out, then repeats of the raw text, then fences; syntax is repaired."""
    t = spark.read.parquet(path).select(strip(F.col("output")).alias("raw")).where(F.length("raw") >= least)
    t = positioned(t, [], "code-table", "seq").groupBy("raw").agg(F.min("seq").alias("seq"))
    code = reindent_code(F.regexp_replace(strip_fence(F.col("raw")), r"^(\\n)+", ""))
    return t.select("seq", F.lit(f"{PENDING} - code-only sample").alias("description"), code.alias("code"), F.lit(True).alias("needs_description"))


@REGISTRY.source("conversation_lines", priority=2, title="Conversation lines", settings=("path",))
def conversation_lines(spark: SparkSession, path: str, rename: bool = True) -> DataFrame:
    """JSON lines of conversations with three turns or more; bad lines drop out; the answer's fence goes."""
    t = spark.read.schema(CONVERSATION).json(path).where("_corrupt_record is null and size(conversations) >= 3")
    t = positioned(t, [], "conversation-lines", "seq")
    out = t.select("seq", F.expr("conversations[1].value").alias("description"), strip_fence(F.expr("conversations[2].value"), "between").alias("code"), F.col("metadata.day").alias("day"), F.col("metadata.version").alias("version"))
    return unique_scene_names(out) if rename else out


@REGISTRY.source("voiceover_lines", priority=2, title="Voice-over conversation lines", default=False, settings=("path",))
def voiceover_lines(spark: SparkSession, path: str) -> DataFrame:
    """As `conversation_lines`, with voice-over scenes turned into plain ones."""
    out = conversation_lines(spark, path, rename=False).withColumn("_f", plain_scene_code(F.col("code")))
    return out.withColumns({"code": F.col("_f.code"), "voiceover_blocks": F.col("_f.blocks")}).drop("_f")


def unique_scene_names(samples: DataFrame) -> DataFrame:
    """The n-th scene class of one name (n > 1) becomes nameVn, or the next number whose name no sample has.

    Numbers are dense positions within a name after one range sort of (name, seq), so a hot name's rows never meet
    in one task. A taken number pushes the later ones up by one; a row carries its name's taken numbers, not a
    sequence up to its own.
    """
    name = F.regexp_extract("code", r"class\s+(\w+)\s*\([^)]*Scene[^)]*\)", 1)
    named = samples.select("seq", name.alias("_name"))
    ranked = positioned(named.where("_name <> ''"), ["_name", "seq"], "scene-names", "_at")
    ends = r"V(\d+)$"
    taken = ranked.where(F.col("_name").rlike(ends)).select(F.regexp_replace("_name", ends, "").alias("_name"), F.regexp_extract("_name", ends, 1).cast("long").alias("_v")).where("_v >= 2")
    taken = taken.groupBy("_name").agg(F.array_sort(F.collect_set("_v")).alias("_taken"))
    first = ranked.groupBy("_name").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")).where("_rows > 1").join(taken, "_name", "left")
    met = joined_unevenly(ranked, stored(first, "scene-first"), "_name", "_rows").withColumn("_n", F.col("_at") - F.col("_first") + 1).where("_n > 1")
    free = F.aggregate(F.coalesce("_taken", F.array().cast("array<long>")), F.col("_n"), lambda n, v: F.when(v <= n, n + 1).otherwise(n))
    out = samples.join(met.select("seq", F.col("_name"), free.alias("_version")), "seq", "left")
    renamed = F.expr(r"regexp_replace(code, concat('class\\s+', _name, '\\s*\\('), concat('class ', _name, 'V', _version, '('))")
    return out.withColumn("code", F.when(F.col("_version").isNull(), F.col("code")).otherwise(renamed)).drop("_name", "_version")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Any JSON lines under a schema; bad lines drop out."""
    return spark.read.option("mode", "DROPMALFORMED").schema(schema).json(path)
