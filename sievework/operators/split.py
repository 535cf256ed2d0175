"""Train/test splits, prompt variants, conversations and side-table joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import augment_prompt, ensure_scene
from sievework.operators.store import dropped, positioned, stored

SYSTEM = "You write Manim Community scenes that run as they are. Answer with one fenced block of Python."


def draw(seed: int, key: str = "seq") -> Column:
    """A number of 32 bits for each row, by MD5 of key and seed, which any engine can repeat."""
    return F.conv(F.left(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.lit(8)), 16, 10).cast("long")


def exact_split(samples: DataFrame, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """Add `split`: exactly int(n * ratio) rows are test, the first in order of MD5 of (seq, seed).

    The cut is found from counts of hash prefixes, so no global sort runs: all prefixes below the cut's are
    test whole, and only the rows of the one prefix that holds the cut are ranked.
    """
    hashed = samples.withColumn("_h", F.md5(F.concat_ws(":", F.col("seq").cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("_b", F.conv(F.left("_h", F.lit(4)), 16, 10).cast("int"))
    counts = sorted((r["_b"], r["count"]) for r in hashed.groupBy("_b").count().collect())  # at most 65,536 rows
    left, edge = int(sum(n for _, n in counts) * ratio), -1
    for b, n in counts:
        edge = b
        if n >= left:
            break
        left -= n
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", "seq"))
    inside = hashed.where(F.col("_b") == edge).withColumn("split", F.when(rank <= left, "test").otherwise("train"))
    others = hashed.where(F.col("_b") != edge).withColumn("split", F.when(F.col("_b") < edge, "test").otherwise("train"))
    return others.unionByName(inside).drop("_h", "_b")


def dense_index(samples: DataFrame, order: str = "seq") -> DataFrame:
    """Add `idx`, the row's place from 0 in `order`; every row and column comes through, whatever the shuffle settings."""
    return positioned(samples, [order], "dense-index", "idx")


def modulo_split(samples: DataFrame, every: int = 10) -> DataFrame:
    """Add `split`: each tenth row in order, from index 9, is test."""
    return dense_index(samples).withColumn("split", F.when(F.col("idx") % every == every - 1, "test").otherwise("train")).drop("idx")


def augmented(train: DataFrame, seed: int = 42) -> DataFrame:
    """Every row and one or two prompt variants of it, the number drawn by hash; variants drop the repair flags."""
    n = draw(seed) % 2 + 1
    out = train.withColumn("variant", F.explode(F.sequence(F.lit(0).cast("long"), n)))
    out = out.withColumn("description", augment_prompt(F.col("description"), F.col("variant")))
    for name in ("auto_fixed", "fixes_applied"):
        if name in train.columns:
            out = out.withColumn(name, F.when(F.col("variant") == 0, F.col(name)))
    return out


def conversation(description: Column, code: Column, system: str = SYSTEM) -> Column:
    """Three turns (`from`, value): system, user, and the fenced code as assistant."""
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    return F.array(turn("system", F.lit(system)), turn("user", description), turn("assistant", F.concat(F.lit("```python\n"), ensure_scene(code), F.lit("\n```"))))


def to_records(samples: DataFrame) -> DataFrame:
    """What the training files hold: conversations, source, and the flags there are."""
    flags = [c for c in ("rendering_validated", "auto_fixed", "fixes_applied") if c in samples.columns]
    return samples.select(conversation(F.col("description"), F.col("code")).alias("conversations"), "source", *flags)


def from_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to one row a conversation with its turns in order."""
    own = F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("from"), F.col("text").alias("value"))))
    return turns.groupBy("conv_id").agg(F.transform(own, lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value"))).alias("conversations"))


def question_answer(conversations: DataFrame) -> DataFrame:
    """User and assistant texts of conversations with three turns or more."""
    turn = lambda i: F.get("conversations", F.lit(i))["value"]
    return conversations.where(F.size("conversations") >= 3).select("*", turn(1).alias("description"), turn(2).alias("code"))


def keep_listed(samples: DataFrame, listed: DataFrame, key: str = "seq") -> DataFrame:
    return samples.join(listed.select(key), key, "left_semi")


def curriculum(samples: DataFrame, length: Column, levels: int = 4) -> DataFrame:
    """Add `level` by length, from easy to hard, along exact quantiles (the least length that has the share up to it).

    Lengths are counted first: only the distinct ones are put in order, not the rows. A null length has no level.
    """
    counts = stored(samples.groupBy(length.alias("x")).count().where("x is not null"), "curriculum-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    upto = counts.select("x", F.sum("count").over(Window.orderBy("x")).alias("u"))
    cuts = upto.agg(*(F.min(F.when(F.col("u") * levels >= i * total, F.col("x"))).alias(f"c{i}") for i in range(1, levels))).first() if levels > 1 else ()
    dropped(counts)
    level = F.lit(0)
    for c in cuts:
        level = level + (length > c).cast("int")
    return samples.withColumn("level", F.when(length.isNotNull(), level))


def weighted_sample(samples: DataFrame, weights: dict[str, float], seed: int = 42) -> DataFrame:
    """A sample by source, repeatable: a row stays if its hash falls below the source's weight."""
    share = draw(seed) % 1_000_000 / 1_000_000
    weight = F.create_map(*(x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w))))) if weights else F.create_map().cast("map<string,double>")
    return samples.where(share < F.coalesce(F.try_element_at(weight, F.col("source")), F.lit(1.0)))
