"""Counts, ranks and distributions over samples and stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = (500, 1000, 1500, 2000, 2500, 3000, 5000)
STAGES = ("initial_extraction", "after_quality", "after_deduplication", "after_code_fixing", "after_rendering", "final_train", "final_test")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """A row for each source and a column for each stage, zero where a stage has none."""
    long = None
    for name, df in stages.items():
        part = df.groupBy("source").count().select("source", F.lit(name).alias("stage"), "count")
        long = part if long is None else long.unionByName(part)
    return long.groupBy("source").pivot("stage", list(stages)).agg(F.sum("count")).na.fill(0)


def with_totals(counts: DataFrame, first: str, last: str) -> DataFrame:
    """Rows by source and their total (source null), with the share lost between two stages."""
    columns = [c for c in counts.columns if c != "source"]
    rolled = counts.rollup("source").agg(*(F.sum(c).alias(c) for c in columns))
    return rolled.withColumn("reduction_pct", F.coalesce((F.col(first) - F.col(last)) * 100.0 / F.nullif(F.col(first), F.lit(0)), F.lit(0.0)))


def source_distribution(samples: DataFrame, sources: DataFrame) -> DataFrame:
    """Samples by source, zero for sources without any."""
    counted = samples.groupBy("source").agg(F.count("*").alias("n"))
    return sources.select(F.col("source_id").alias("source")).join(counted, "source", "left").na.fill(0, ["n"])


def top_sources(samples: DataFrame, n: int = 5) -> DataFrame:
    return samples.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(n)


def length_stats(samples: DataFrame, length: Column) -> DataFrame:
    """Count, median, mean, least, most and population deviation."""
    return samples.select(length.alias("x")).agg(F.count("x").alias("n"), F.median("x").alias("median"), F.avg("x").alias("mean"), F.min("x").alias("least"), F.max("x").alias("most"), F.stddev_pop("x").alias("deviation"))


def length_stats_by_source(samples: DataFrame, length: Column) -> DataFrame:
    return samples.select("source", length.alias("x")).groupBy("source").agg(F.count("x").alias("n"), F.sum("x").alias("total"), F.median("x").alias("median"), F.avg("x").alias("mean"))


def quartiles_by_source(samples: DataFrame, length: Column) -> DataFrame:
    """Quartiles; sources with nothing but zeros drop out."""
    q = samples.select("source", length.alias("x")).groupBy("source").agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max("x").alias("most")).where("most > 0")
    return q.select("source", *(F.get("q", F.lit(i)).alias(f"q{i + 1}") for i in range(3)))


def bucket(length: Column) -> Column:
    """Number of the length bucket, 0 to 7."""
    out = None
    for i, edge in enumerate(BUCKETS):
        out = F.when(length < edge, i) if out is None else out.when(length < edge, i)
    return out.otherwise(len(BUCKETS))


def length_buckets(samples: DataFrame, length: Column) -> DataFrame:
    counted = samples.groupBy(bucket(length).alias("bucket")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(total), how="cross").select("bucket", "n", (F.col("n") * 100.0 / F.col("total")).alias("pct"))  # eight rows and one


def source_by_bucket(samples: DataFrame, length: Column) -> DataFrame:
    """Cross table: a row for each source, columns b0 to b7."""
    counted = samples.select("source", bucket(length).alias("bucket")).groupBy("source").pivot("bucket", list(range(len(BUCKETS) + 1))).count().na.fill(0)
    return counted.select("source", *(F.col(str(i)).alias(f"b{i}") for i in range(len(BUCKETS) + 1)))


def length_cdf(samples: DataFrame, length: Column) -> DataFrame:
    """Empirical distribution by source: for each length the share of rows up to it, counted over distinct lengths.

    Rows of one length take the steps from `low` to `share`; a source's rows never meet in one task, only its
    distinct lengths do.
    """
    counted = samples.select("source", length.alias("x")).groupBy("source", "x").agg(F.count("*").alias("n"))
    below = Window.partitionBy("source").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy("source"))
    upto = F.sum("n").over(below)
    return counted.select("source", "x", "n", ((upto - F.col("n") + 1) / total).alias("low"), (upto / total).alias("share"))


def first_n(samples: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first n rows of each key in order; every partition drops what cannot be among them before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return samples.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def tag_counts(samples: DataFrame, tags: str = "fixes_applied", n: int | None = None) -> DataFrame:
    """Tags by how often they occur, most first."""
    counted = samples.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "tag").limit(n) if n else counted


def duplicate_analysis(samples: DataFrame) -> DataFrame:
    """Total rows, distinct codes, repeated (code, description) pairs, codes with several descriptions."""
    pairs = samples.groupBy("code", "description").agg(F.count("*").alias("n"))
    codes = pairs.groupBy("code").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("again"), F.count("*").alias("descriptions"))
    return codes.agg(F.sum("n").alias("total"), F.count("*").alias("unique_codes"), F.sum("again").alias("exact_pair_duplicates"), F.count_if(F.col("descriptions") > 1).alias("conflicting_codes"))


def voiceover_stats(files: DataFrame, code: str = "code") -> DataFrame:
    """Voice-over blocks, their words and bookmarks by file."""
    blocks = F.regexp_extract_all(F.col(code), F.lit(r"voiceover\(\s*(?:text\s*=\s*)?\"([^\"]*)\""), F.lit(1))
    words = F.transform(blocks, lambda b: F.size(F.filter(F.split(b, r"\s+"), lambda w: w != "")))
    return files.select("*", F.size(blocks).alias("blocks"), F.aggregate(words, F.lit(0), lambda a, w: a + w).alias("words"), F.array_max(words).alias("longest"), F.regexp_count(F.col(code), F.lit(r"<bookmark")).alias("bookmarks"))


def fix_statistics(fixed: DataFrame) -> DataFrame:
    """Samples processed and fixed, the rate, and counts of fixes by kind and of fixed samples by source, in one row."""
    whole = fixed.agg(F.count("*").alias("samples_processed"), F.count_if("auto_fixed").alias("samples_fixed"))
    kinds = tag_counts(fixed).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "n")))).alias("fixes_by_type"))
    sources = fixed.where("auto_fixed").groupBy("source").count().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "count")))).alias("fixes_by_source"))
    rate = F.coalesce(F.col("samples_fixed") * 100 / F.nullif(F.col("samples_processed"), F.lit(0)), F.lit(0.0))
    return whole.withColumn("fix_rate", rate).join(kinds, how="cross").join(sources, how="cross")  # one row each


def render_statistics(rendered: DataFrame) -> DataFrame:
    """Rendered samples: totals, passed, failed, repaired, failures by source and by kind of error, in one row."""
    from sievework.functions.text import error_bucket

    whole = rendered.agg(F.count("*").alias("total_samples"), F.count_if("rendering_validated").alias("valid_samples"), F.count_if("rendering_failed").alias("invalid_samples"), F.count_if(F.col("auto_fixed") & F.col("rendering_validated")).alias("fixed_and_rendered"))
    failed = rendered.where("rendering_failed")
    counted = lambda key, name: failed.groupBy(key.alias("k")).count().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "count")))).alias(name))
    rate = F.coalesce(F.col("valid_samples") * 100 / F.nullif(F.col("total_samples"), F.lit(0)), F.lit(0.0))
    return whole.withColumn("pass_rate", rate).join(counted(F.col("source"), "failures_by_source"), how="cross").join(counted(error_bucket(F.col("render_error")), "failures_by_error"), how="cross")


def dedup_report(before: DataFrame, removed: DataFrame) -> DataFrame:
    """Raw, unique and removed samples, removals by reason and source, kept by source, and removals by similarity."""
    total = before.groupBy("source").count()
    gone = removed.join(before.select("seq", "source"), "seq")
    reasons = gone.agg(F.count("*").alias("duplicates_removed"), F.count_if(F.col("reason") == "exact_code_match").alias("exact_code_duplicates"), F.count_if(F.col("reason") == "high_similarity").alias("high_similarity_duplicates"))
    by = gone.groupBy("source").count().withColumnRenamed("count", "gone")
    kept = total.join(by, "source", "left").select("source", (F.col("count") - F.coalesce("gone", F.lit(0))).alias("kept"), F.coalesce("gone", F.lit(0)).alias("gone"), "count")
    maps = kept.agg(F.sum("count").alias("total_raw_samples"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "gone")))).alias("duplicates_by_source"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "kept")))).alias("kept_by_source"))
    shown = gone.groupBy(F.round("code_sim", 1).cast("string").alias("bucket")).count().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("bucket", "count")))).alias("similarity_distribution"))
    one = maps.join(reasons, how="cross").join(shown, how="cross")
    unique = F.col("total_raw_samples") - F.col("duplicates_removed")
    return one.withColumns({"unique_samples": unique, "reduction_percentage": F.coalesce(F.col("duplicates_removed") * 100 / F.nullif(F.col("total_raw_samples"), F.lit(0)), F.lit(0.0))})


def split_statistics(train: DataFrame, final_train: DataFrame, test: DataFrame) -> DataFrame:
    """Sizes before and after augmentation, the factor between, and the train rows by source, in one row."""
    sizes = train.agg(F.count("*").alias("train_before_augmentation")).join(test.agg(F.count("*").alias("test")), how="cross")
    by = final_train.groupBy("source").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("train_after_augmentation"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "count")))).alias("source_distribution"))
    return sizes.join(by, how="cross").withColumn("augmentation_factor", F.coalesce(F.col("train_after_augmentation") / F.nullif(F.col("train_before_augmentation"), F.lit(0)), F.lit(0.0)))


def converter_counts(converted: DataFrame) -> DataFrame:
    """Of `plain_scene_code`'s rows (struct `f`): files, blocks, bookmarks and classes converted."""
    return converted.agg(F.count("*").alias("files"), *(F.coalesce(F.sum(f"f.{c}"), F.lit(0)).alias(c) for c in ("blocks", "bookmarks", "classes")))


def distinct_days(samples: DataFrame) -> DataFrame:
    """Number of distinct days in the metadata (`day`, or `aoc_day`) by source."""
    day = F.coalesce(F.get_json_object("metadata", "$.day"), F.get_json_object("metadata", "$.aoc_day"))
    return samples.groupBy("source").agg(F.count_distinct(day).alias("days"))


def class_usage(files: DataFrame, code: str = "code") -> DataFrame:
    """Base lists of classes and calls of capitalised names, by how many files and times they occur."""
    bases = files.select(F.explode(F.regexp_extract_all(F.col(code), F.lit(r"(?m)^class\s+\w+\s*\(([^)]*)\)"), F.lit(1))).alias("name"), F.lit("inheritance").alias("kind"))
    calls = files.select(F.explode(F.regexp_extract_all(F.col(code), F.lit(r"\b([A-Z]\w*)\("), F.lit(1))).alias("name"), F.lit("call").alias("kind"))
    return bases.unionByName(calls).groupBy("kind", "name").agg(F.count("*").alias("n"))
