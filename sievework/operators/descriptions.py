"""Descriptions from an injected generator, behind a key-value cache."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import cache_key, code_features, description_key, needs_description

FAILED = "[GENERATION_FAILED]"


def keyed(samples: DataFrame) -> DataFrame:
    """Add `cache_key` from code, source and what the metadata tells of the video, where there are metadata."""
    if "metadata" in samples.columns:
        return samples.withColumn("cache_key", description_key(F.col("code"), F.col("metadata")))
    return samples.withColumn("cache_key", cache_key(F.col("code"), F.col("source")))


def fill(samples: DataFrame, cache: DataFrame, generate: Callable[[list[str]], list[str]], batch: int = 5) -> tuple[DataFrame, DataFrame]:
    """Samples with every placeholder description filled, and the new cache rows (key, description).

    What the cache holds is joined in; the rest goes to `generate` in batches of codes. A batch that fails,
    or answers with another number of texts, gets the failure mark and is not cached.
    """

    def run(frames):
        for pdf in frames:
            texts: list[str] = []
            for a in range(0, len(pdf), batch):
                codes = pdf["code"].iloc[a : a + batch].tolist()
                try:
                    answers = list(generate(codes))
                except Exception:
                    answers = []
                texts += answers if len(answers) == len(codes) else [FAILED] * len(codes)
            yield pd.DataFrame({"cache_key": pdf["cache_key"], "new_description": texts})

    rows = keyed(samples)
    asked = needs_description(F.col("description"))
    missing = rows.where(asked).select("cache_key", "code").dropDuplicates(["cache_key"]).join(cache.select(F.col("key").alias("cache_key")), "cache_key", "left_anti")
    made = missing.mapInPandas(run, "cache_key string, new_description string")
    known = cache.select(F.col("key").alias("cache_key"), F.col("description").alias("new_description")).unionByName(made)
    filled = rows.join(known, "cache_key", "left").withColumn("description", F.when(asked & F.col("new_description").isNotNull(), F.col("new_description")).otherwise(F.col("description")))
    return filled.drop("cache_key", "new_description"), made.where(F.col("new_description") != FAILED).select(F.col("cache_key").alias("key"), F.col("new_description").alias("description"))


def prompts(samples: DataFrame, batch: int = 5, shown: int = 500) -> DataFrame:
    """One prompt for each `batch` samples of a source, in order: numbered code previews and what to answer."""
    from sievework.operators.split import dense_index

    numbered = dense_index(samples).withColumn("batch", F.floor(F.col("idx") / batch))
    part = F.concat(F.lit("["), F.col("idx").cast("string"), F.lit("]\n"), F.left("code", F.lit(shown)))
    listed = numbered.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("idx", part.alias("p")))).alias("ps"))
    return listed.select("batch", F.concat(F.lit("Describe each animation in one sentence. Answer with a JSON array of strings.\n\n"), F.array_join(F.transform("ps", lambda x: x["p"]), "\n\n")).alias("prompt"))


def parse_answers(answers: DataFrame) -> DataFrame:
    """(batch, pos, description) from answers that hold a JSON array of strings; others give the failure mark."""
    found = F.from_json(F.regexp_extract("answer", r"(?s)\[.*\]", 0), "array<string>")
    return answers.select("batch", F.posexplode(F.coalesce(found, F.array(F.lit(FAILED)))).alias("pos", "description"))


def cache_stats(cache: DataFrame) -> DataFrame:
    return cache.agg(F.count("*").alias("entries"), F.coalesce(F.sum(F.octet_length("description")), F.lit(0)).alias("bytes"))


def with_features(samples: DataFrame) -> DataFrame:
    return samples.withColumn("code_features", code_features(F.col("code")))
