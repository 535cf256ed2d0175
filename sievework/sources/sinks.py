"""What a run writes: training files, reports, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(records: DataFrame, path: str) -> None:
    """JSON lines; the folder's earlier content goes."""
    records.write.mode("overwrite").json(path)


def write_table(samples: DataFrame, path: str) -> None:
    """Parquet, partitioned by split where there is one; lists of fixes as comma-joined text."""
    if "fixes_applied" in samples.columns:
        samples = samples.withColumn("fixes_applied", F.array_join("fixes_applied", ","))
    writer = samples.write.mode("overwrite")
    (writer.partitionBy("split") if "split" in samples.columns else writer).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def hand_off(samples: DataFrame, path: str) -> None:
    """What a description generator is given, and counts by source."""
    samples.select("code", "metadata", F.lit("generate_description").alias("task")).write.mode("overwrite").json(f"{path}/samples_for_llm")
    samples.write.mode("overwrite").json(f"{path}/raw_samples")
    write_report(samples.groupBy("source").agg(F.count("*").alias("n")), f"{path}/extraction_metadata")


def cache_get(spark: SparkSession, cache_path: str | None) -> DataFrame:
    """The cache's rows (key, description); none where there is no table yet."""
    try:
        if cache_path:
            return spark.read.parquet(cache_path).select("key", "description")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], "key string, description string")


def cache_put(cache_path: str, rows: DataFrame) -> None:
    """Append keys that the cache does not hold yet."""
    new = rows.dropDuplicates(["key"]).join(cache_get(rows.sparkSession, cache_path).select("key"), "key", "left_anti")
    new.write.mode("append").parquet(cache_path)


def write_tree(samples: DataFrame, path: str, name: str = "class_name") -> None:
    """Converted code as one Python file a sample below its source's folder, as text partitioned by source and name."""
    samples.select(F.col("code").alias("value"), "source", F.coalesce(F.col(name), F.col("seq").cast("string")).alias("name")).write.mode("overwrite").partitionBy("source", "name").text(path)


def write_examples(samples: DataFrame, path: str) -> None:
    """Scraped examples as conversation lines; the class name stays in the metadata."""
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    turns = F.array(turn("system", F.lit("")), turn("user", F.col("description")), turn("assistant", F.concat(F.lit("```python\n"), "code", F.lit("\n```"))))
    samples.select(turns.alias("conversations"), F.struct("category", "example_name", "original_url").alias("metadata")).write.mode("overwrite").json(path)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """What `write_examples` wrote, or flat lines of description and code, as samples; fences go by their lines."""
    from sievework.functions.text import strip_fence

    schema = "conversations array<struct<`from`: string, value: string>>, description string, code string, metadata struct<category: string, example_name: string, original_url: string>, _corrupt_record string"
    t = spark.read.schema(schema).json(path).where("_corrupt_record is null")
    description = F.coalesce(F.expr("conversations[1].value"), "description")
    code = strip_fence(F.coalesce(F.expr("conversations[2].value"), "code"), "regex")
    return t.select(description.alias("description"), code.alias("code"), "metadata.category", "metadata.example_name", "metadata.original_url").where("code is not null")
