"""The curation run: extract, validate, de-duplicate, repair, render, split, augment, write, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.fixes import fix_code
from sievework.functions.text import needs_description
from sievework.operators import dedup, descriptions, quality, split, statistics
from sievework.operators.store import scratch, stored
from sievework.sources import sinks
from sievework.sources.registry import REGISTRY, Registry


@dataclass
class Config:
    """Settings of a run; validation is on only where it is asked for."""

    output: str = "output"
    sources: dict[str, dict] = field(default_factory=dict)
    wanted: list[str] | None = None
    excluded: list[str] = field(default_factory=list)
    validate: bool = True
    strict: bool = False
    quality: Mapping[str, Any] = field(default_factory=dict)
    deduplicate: bool = True
    fix_code: bool = False
    fill_descriptions: bool = False
    describe: Callable[[list[str]], list[str]] | None = None
    description_cache: str | None = None
    render: Callable[[str], tuple[bool, str]] | None = None
    render_fixes: bool = True
    augment: bool = False
    test_ratio: float = 0.1
    seed: int = 42
    code_only: list[str] = field(default_factory=list)


def _described(rows: DataFrame, config: Config) -> DataFrame:
    """Placeholder descriptions filled from the cache and by config.describe; the new ones go to the cache."""
    rows = rows.withColumn("needs_description", needs_description(F.col("description")))
    if config.describe is None:
        return rows
    spark = rows.sparkSession
    cache = sinks.cache_get(spark, config.description_cache)
    filled, made = descriptions.fill(rows, cache, config.describe)
    if config.description_cache:
        made = stored(made, "curate-descriptions")
        sinks.cache_put(config.description_cache, made)
        filled, _ = descriptions.fill(rows, cache.unionByName(made), config.describe)
    return filled.withColumn("needs_description", needs_description(F.col("description")))


def stages(samples: DataFrame, priorities: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Every stage's rows by name, each written before the next begins; `removed`, `fixed` and `rendered` for the reports."""
    out = {"initial_extraction": stored(samples, "curate-extracted")}
    rows = out["initial_extraction"].where(quality.usable(config.code_only))
    if config.validate:
        rows = quality.validate_by_source(rows, config.quality, config.strict).where("is_valid").drop("issues", "issue_texts", "is_valid")
    rows = out["after_quality"] = stored(rows, "curate-valid")
    if config.deduplicate:
        out["removed"] = stored(dedup.greedy_removed(rows, priorities), "curate-removed")
        rows = stored(rows.join(out["removed"].select("seq"), "seq", "left_anti"), "curate-unique")
    out["after_deduplication"] = rows
    if config.fill_descriptions:
        rows = _described(rows, config)
    if config.fix_code:
        rows = rows.withColumn("_f", fix_code(F.col("code")))
        rows = rows.withColumns({"original_code": F.when(F.size("_f.fixes") > 0, F.col("code")), "fixes_applied": F.col("_f.fixes"), "auto_fixed": F.size("_f.fixes") > 0, "code": F.col("_f.code")}).drop("_f")
    if config.fill_descriptions or config.fix_code:
        rows = stored(rows, "curate-fixed")
    out["after_code_fixing"] = rows
    if config.render:
        out["rendered"] = stored(quality.render(rows.drop("original_code", "fixes_applied", "auto_fixed"), config.render, config.render_fixes), "curate-rendered")
        rows = out["rendered"].where("rendering_validated")
    out["after_rendering"] = rows
    return out


def curate(spark: SparkSession, config: Config, registry: Registry = REGISTRY) -> dict[str, DataFrame]:
    """Run all stages and write samples, train and test records and the reports below config.output; returns the stages.

    Reports: tracking (rows by source and stage), dataset_stats and stats, and with their stages deduplication_report,
    removed_duplicates, code_fixing and rendering_validation_report.
    """
    registry.discover()
    config.code_only = config.code_only or [n for n in registry.names() if registry.get(n).code_only]
    samples = registry.load(spark, config.sources, config.wanted, config.excluded)
    done = stages(samples, registry.dimension(spark), config)
    done["after_rendering"].write.mode("overwrite").parquet(f"{config.output}/samples")
    kept = spark.read.parquet(f"{config.output}/samples")
    parted = stored(split.exact_split(kept, config.test_ratio, config.seed), "curate-split")
    train, test = parted.where("split = 'train'"), parted.where("split = 'test'")
    done |= {"final_train": split.augmented(train, config.seed) if config.augment else train, "final_test": test}
    sinks.write_records(split.to_records(done["final_train"]), f"{config.output}/train")
    sinks.write_records(split.to_records(test), f"{config.output}/test")
    counts = stored(statistics.stage_counts({name: done[name] for name in statistics.STAGES}), "curate-counts")
    sinks.write_report(statistics.with_totals(counts, "initial_extraction", "after_rendering"), f"{config.output}/tracking")
    sinks.write_report(statistics.length_stats(kept, F.length("code")), f"{config.output}/stats")
    sinks.write_report(statistics.split_statistics(train, done["final_train"], test), f"{config.output}/dataset_stats")
    if "removed" in done:
        sinks.write_report(statistics.dedup_report(done["after_quality"], done["removed"]), f"{config.output}/deduplication_report")
        sinks.write_report(dedup.removed_examples(done["removed"], done["after_quality"]), f"{config.output}/removed_duplicates")
    if config.fix_code:
        sinks.write_report(statistics.fix_statistics(done["after_code_fixing"]), f"{config.output}/code_fixing")
    if "rendered" in done:
        sinks.write_report(statistics.render_statistics(done["rendered"]), f"{config.output}/rendering_validation_report")
    return done


def run(spark: SparkSession, config: Config, registry: Registry = REGISTRY) -> None:
    """`curate` for its files alone: the tables between its stages are deleted at the end."""
    with scratch(spark):
        curate(spark, config, registry)
