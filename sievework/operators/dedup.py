"""De-duplication of samples: exact classes, near-duplicate edges, and the greedy priority rule.

Rows are taken in order of `seq`. A pair is a duplicate if the codes' similarity is 1, or if both the
descriptions' and the codes' similarity pass the threshold. The earlier row of a pair stays unless the later
one's source has the higher priority. The rule never looks beyond a connected component of the duplicate
pairs, so components are resolved apart from each other.
"""

from __future__ import annotations

import bisect
import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.similarity import jaccard_floor, similarity
from sievework.functions.text import normalize_code, normalize_description, token_set
from sievework.operators.store import dropped, joined_unevenly, settled, stored

THRESHOLD = 0.95


def with_keys(samples: DataFrame) -> DataFrame:
    """Add normal forms, token sets and the exact class key; null where the code is empty."""
    out = samples.withColumns({"n_desc": normalize_description(F.coalesce("description", F.lit(""))), "n_code": normalize_code(F.coalesce("code", F.lit("")))})
    out = out.withColumns({"t_desc": token_set(F.col("n_desc")), "t_code": token_set(F.col("n_code"))})
    key = F.sha2(F.concat_ws(" ", F.length("n_code").cast("string"), F.array_join("t_code", " ")), 256)
    return out.withColumn("code_key", F.when(F.col("n_code") != "", key))


def with_priority(samples: DataFrame, priorities: DataFrame) -> DataFrame:
    """Add `priority` by source from (source_id, priority); 0 for unknown sources. The dimension is small; Spark sizes the join."""
    named = priorities.select(F.col("source_id").alias("source"), F.col("priority").alias("_p"))
    return samples.join(named, "source", "left").withColumn("priority", F.coalesce("_p", F.lit(0))).drop("_p")


def distinct_by(samples: DataFrame, *keys: str | Column, order: str = "seq") -> DataFrame:
    """The first row of each key in `order`: a map-side combined minimum and a semi join, so no key's rows meet in one task."""
    first = samples.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return samples.join(first, order, "left_semi")


def exact_survivors(samples: DataFrame) -> DataFrame:
    """Of each exact class the row of highest priority, of these the earliest; rows without code all stay.

    Takes the columns of `with_keys` and `with_priority`. The keys are made once and written; one combined
    aggregate a class, no window over it.
    """
    keys = stored(samples.select("seq", "code_key", "priority"), "dedup-classes")
    best = keys.where("code_key is not null").groupBy("code_key").agg(F.min(F.struct((-F.col("priority")).alias("p"), "seq")).alias("b")).select(F.col("b.seq").alias("seq"))
    return samples.join(best.unionByName(keys.where("code_key is null").select("seq")), "seq", "left_semi")


def sketched(tokens: Column, threshold: float = THRESHOLD) -> Column:
    """Struct (own, up, bits) of a token set: what `_text_edges` joins on in place of its tokens.

    Sets whose Jaccard index passes the floor J differ in under (1 - J) / (1 + J) of both sizes' sum. Tokens are dealt
    by hash into one part more than such sets can differ in, so some part is the same in both, and it holds ten tokens
    or more on average. `own` has a number for each part as dealt at the level of the set's size, `up` as at the
    next level; sizes that can pass lie at most a level apart. `bits`: 128 parities, each token flips one.
    """
    import numpy as np
    import pyarrow as pa

    floor = jaccard_floor(threshold)
    step, apart = -math.log(floor), 2 * (1 - floor) / (1 + floor)

    def mixed(x: np.ndarray) -> np.ndarray:
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(33))

    def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.LargeListArray.from_arrays(np.concatenate([[0], ends]), values.view(np.int64)).cast(pa.list_(pa.int64()))

    def run(column: pa.Array) -> pa.Array:
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        level = np.floor(np.log(np.maximum(sizes, 1)) / step).astype(np.int64)
        out = []
        for at in (level, level + 1):
            parts = np.floor(apart * np.exp(step * (at + 1)) + 1e-6).astype(np.int64) + 1
            ends = np.cumsum(parts)
            part = np.arange(parts.sum()) - np.repeat(ends - parts, parts)
            sums = mixed((np.repeat(at, parts).astype(np.uint64) << np.uint64(32)) + part.astype(np.uint64) + np.uint64(1))
            np.add.at(sums, (ends - parts)[row] + (values % parts[row].astype(np.uint64)).astype(np.int64), mixed(values))
            out.append(lists(mixed(sums), ends))
        bit = mixed(values + np.uint64(1))
        bits = np.zeros(2 * len(sizes), np.uint64)
        np.bitwise_xor.at(bits, 2 * row + (bit >> np.uint64(6) & np.uint64(1)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        return pa.StructArray.from_arrays([*out, lists(bits, np.arange(2, 2 * len(sizes) + 2, 2))], names=["own", "up", "bits"])

    # Annotated with the module's types, which are strings here; Spark needs the types themselves.
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<own: array<long>, up: array<long>, bits: array<long>>")(F.transform(tokens, lambda t: F.xxhash64(t)))


def _same_text() -> Column:
    return F.unhex(F.sha2(F.concat_ws("\0", "n_code", "n_desc"), 256))


def _measures(threshold: float) -> list[Column]:
    """What stands for a text of `with_keys` in the search for pairs: sizes and sketch."""
    return [F.size("t_code").alias("n"), F.length("n_code").alias("len"), sketched(F.col("t_code"), threshold).alias("sketch")]


def prefix_edges(keyed: DataFrame, threshold: float = THRESHOLD, code_only: bool = False) -> DataFrame:
    """Pairs i < j above the threshold, by a join on parts of the token sets.

    One representative of each distinct (code, description) carries the join, so a hot text does not square. It is
    found, and joined, by hash, sizes and sketch; only texts that meet a partner are read for the similarity.
    """
    rows = keyed.where("n_code <> ''").select("seq", _same_text().alias("text"), *_measures(threshold))
    first = rows.groupBy("text").agg(F.min(F.struct("seq", "n", "len", "sketch")).alias("r")).select("r.*").where("n > 0")
    return _text_edges(stored(first, "dedup-texts"), keyed, threshold, code_only)


def _text_edges(reps: DataFrame, keyed: DataFrame, threshold: float, code_only: bool) -> DataFrame:
    """`prefix_edges` of a stored table of distinct texts (seq, n, len, sketch), whose texts `keyed` has by seq.

    A pair above the threshold has the same number for some part (`sketched`), at the level of the larger set.
    Its lengths differ by at most the ratio that leaves, and its parities in no more bits than its sets in tokens.
    """
    floor = jaccard_floor(threshold)
    dealt = lambda name, up: F.transform(f"sketch.{name}", lambda k: F.struct(k.alias("k"), F.lit(up).alias("up")))
    bits = [F.get("sketch.bits", F.lit(i)).alias(f"b{i}") for i in (0, 1)]
    spread = reps.select("seq", "n", "len", *bits, F.explode(F.concat(dealt("own", False), dealt("up", True))).alias("p"))
    spread = spread.select("p.k", "p.up", "seq", "n", "len", "b0", "b1")
    a, b = spread.alias("a"), spread.alias("b")
    ratio = (threshold - 0.8) / 0.2
    near = (F.least("a.len", "b.len") >= F.greatest("a.len", "b.len") * ratio) & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * floor)
    flips = sum((F.bit_count(F.col(f"a.b{i}").bitwiseXOR(F.col(f"b.b{i}"))) for i in (0, 1)), F.lit(0))
    near = near & ~(F.col("a.up") & F.col("b.up")) & (flips <= (F.col("a.n") + F.col("b.n")) * ((1 - floor) / (1 + floor)) + 1e-6)
    pairs = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.seq") < F.col("b.seq")) & near)
    pairs = stored(pairs.select(F.col("a.seq").alias("i"), F.col("b.seq").alias("j")).distinct(), "dedup-pairs")
    names = ["n_code"] if code_only else ["n_code", "n_desc"]
    met = stored(keyed.select("seq", *names).join(pairs.select(F.explode(F.array("i", "j")).alias("seq")).distinct(), "seq", "left_semi"), "dedup-met")
    left, right = (met.select([F.col(c).alias(f"{side}_{c}") for c in met.columns]) for side in "ij")
    both = pairs.join(left, F.col("i") == F.col("i_seq")).join(right, F.col("j") == F.col("j_seq"))
    both = both.withColumns({f"{side}_t{n[1:]}": token_set(F.col(f"{side}_{n}")) for side in "ij" for n in names})
    sim = lambda what: similarity(F.col(f"i_n_{what}"), F.col(f"j_n_{what}"), F.col(f"i_t_{what}"), F.col(f"j_t_{what}"))
    if code_only:
        return both.select("i", "j", sim("code").alias("code_sim")).where(F.col("code_sim") > threshold)
    edges = both.select("i", "j", sim("desc").alias("desc_sim"), sim("code").alias("code_sim")).where(F.col("code_sim") > threshold)
    return edges.where((F.col("desc_sim") > threshold) | (F.col("code_sim") == 1.0))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) by alternating large-star and small-star steps, each written, until they settle."""
    edges = stored(edges.select(F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).where("u <> v").distinct(), "dedup-links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, stored(small.union(low.select("u", "m")).distinct(), "dedup-links")
        dropped(old)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def resolve(rows: pd.DataFrame) -> pd.DataFrame:
    """The greedy rule inside one component: seq, kept_seq, reason, desc_sim, code_sim of the removed rows.

    Rows of one text form a group; a row's partners are the later rows of its own and of linked groups. Each
    step of a scan removes a row or ends the scan, so the work grows with the rows and links, not their square.
    """
    seq, gid, priority = (rows[c].tolist() for c in ("seq", "gid", "priority"))
    key = dict(zip(gid, rows["code_key"], strict=True))
    linked: dict[int, dict[int, tuple[float, float]]] = {g: {g: (1.0, 1.0)} for g in key}
    classes: dict[str, list[int]] = {}
    for g, k in key.items():
        classes.setdefault(k, []).append(g)
    for g, own in zip(gid, rows["edges"], strict=True):
        for e in own:
            linked[g][e["j"]] = linked[e["j"]][g] = (e["desc_sim"], e["code_sim"])
    members: dict[int, list[int]] = {}
    rank = dict(zip(seq, priority, strict=True))
    group = dict(zip(seq, gid, strict=True))
    for s in sorted(seq):
        members.setdefault(group[s], []).append(s)
    follows = {g: list(range(len(m) + 1)) for g, m in members.items()}
    place = {s: i for m in members.values() for i, s in enumerate(m)}

    def alive(g: int, i: int) -> int:
        """Index of the first row left in the group from i on."""
        skip, root = follows[g], i
        while skip[root] != root:
            root = skip[root]
        while skip[i] != root:
            skip[i], i = root, skip[i]
        return root

    out = []
    for s in sorted(seq):
        g = group[s]
        if alive(g, place[s]) != place[s]:
            continue
        heap = []
        for h in {*linked[g], *classes[key[g]]}:
            i = alive(h, bisect.bisect_right(members[h], s))
            if i < len(members[h]):
                heap.append((members[h][i], h))
        heapq.heapify(heap)
        while heap:
            t, h = heap[0]
            exact = key[g] == key[h]
            lost, kept = (t, s) if rank[s] >= rank[t] else (s, t)
            desc, code = linked[g].get(h, (float("nan"), 1.0))
            out.append((lost, kept, "exact_code_match" if exact else "high_similarity", desc, 1.0 if exact else code))
            follows[group[lost]][place[lost]] = place[lost] + 1
            if lost == s:
                break
            i = alive(h, place[t])
            if i < len(members[h]):
                heapq.heapreplace(heap, (members[h][i], h))
            else:
                heapq.heappop(heap)
    return pd.DataFrame(out, columns=["seq", "kept_seq", "reason", "desc_sim", "code_sim"])


REMOVED = "seq long, kept_seq long, reason string, desc_sim double, code_sim double"


def _classes_removed(rows: DataFrame) -> DataFrame:
    """The greedy rule inside exact classes that nothing else links to: no row needs more than its class's record holders.

    A class's holder is the first row, then each first row of a priority above all before it; a row loses to
    the holder of its time, a holder to the next one. There are at most as many holders as priorities.
    """
    firsts = rows.groupBy("code_key", "priority").agg(F.min(F.struct("seq", "text")).alias("f"), F.count("*").alias("n"))
    firsts = firsts.select("code_key", F.struct(F.col("f.seq").alias("seq"), "priority", F.col("f.text").alias("text")).alias("f"), "n")
    classes = firsts.groupBy("code_key").agg(F.array_sort(F.collect_list("f")).alias("firsts"), F.sum("n").alias("rows"))
    start = F.array().cast("array<struct<seq: long, priority: int, text: binary>>")
    last = lambda held: F.get(held, F.size(held) - 1)
    holders = F.aggregate("firsts", start, lambda held, f: F.when((F.size(held) == 0) | (last(held)["priority"] < f["priority"]), F.array_append(held, f)).otherwise(held))
    classes = stored(classes.where("rows > 1").select("code_key", "rows", holders.alias("holders")), "dedup-holders")
    met = joined_unevenly(rows.select("seq", "code_key", "text"), classes, "code_key", "rows")
    before = F.filter("holders", lambda h: h["seq"] <= F.col("seq"))
    kept = F.when(last(before)["seq"] == F.col("seq"), F.get("holders", F.size(before))).otherwise(last(before))
    out = met.select("seq", "text", kept.alias("k")).where("k is not null")
    desc = F.when(F.col("text") == F.col("k.text"), 1.0)
    return out.select("seq", F.col("k.seq").alias("kept_seq"), F.lit("exact_code_match").alias("reason"), desc.alias("desc_sim"), F.lit(1.0).alias("code_sim"))


def greedy_removed(samples: DataFrame, priorities: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every removed row, what it lost to, and why; desc_sim is null where only the codes were compared (equal texts: 1).

    Hashes, sizes and sketches of the normal forms are written, the texts only where two may be near. Links and
    components are found between groups of equal normal forms. A component that is one exact class is settled by joins; where near links tie texts
    together the rule goes row by row (a row that loses later may have removed others before), so such a
    component's rows meet in one task, as a few numbers each; texts stay behind.
    """
    texts = with_keys(samples).where("code_key is not null")
    measured = with_priority(texts.select("seq", "source", "code_key", _same_text().alias("text"), *_measures(threshold)), priorities)
    measured = stored(measured.withColumn("priority", F.col("priority").cast("int")).drop("source"), "dedup-keyed")
    keyed = measured.select("seq", "priority", "code_key", "text")
    groups = stored(keyed.groupBy("text", "code_key").agg(F.min("seq").alias("gid"), F.count("*").alias("rows")), "dedup-groups")
    reps = measured.where("n > 0").select("seq", "n", "len", "sketch").join(groups.select(F.col("gid").alias("seq")), "seq", "left_semi")
    near = settled(samples.sparkSession, lambda: _text_edges(stored(reps, "dedup-texts"), texts, threshold, False), "dedup-near")

    # Classes that a near link touches, with all their groups; their components are told apart by the links.
    ends = near.where("code_sim < 1").select(F.explode(F.array("i", "j")).alias("gid")).distinct()
    tied = stored(groups.join(ends, "gid", "left_semi").groupBy("code_key").count().select("code_key"), "dedup-tied")
    own = groups.join(tied, "code_key", "left_semi")
    firsts = own.groupBy("code_key").agg(F.min("gid").alias("i"))
    stars = own.select("code_key", F.col("gid").alias("j")).join(firsts, "code_key").where("i < j").select("i", "j")
    roots = stored(components(stars.unionByName(near.select("i", "j"))), "dedup-roots")
    placed = roots.select(F.col("node").alias("gid"), "root").unionByName(roots.select(F.col("root").alias("gid"), "root")).distinct()
    table = stored(own.join(placed, "gid").select("text", "gid", "root", "rows"), "dedup-placed")
    rows = joined_unevenly(keyed.select("seq", "priority", "code_key", "text"), table, "text", "rows")
    edges = near.groupBy(F.col("i").alias("g")).agg(F.collect_list(F.struct("j", "desc_sim", "code_sim")).alias("edges"))
    members = rows.join(edges, (F.col("gid") == F.col("g")) & (F.col("seq") == F.col("g")), "left").drop("g", "text")
    members = members.withColumn("edges", F.coalesce("edges", F.array().cast("array<struct<j: long, desc_sim: double, code_sim: double>>")))
    linked = members.groupBy("root").applyInPandas(resolve, REMOVED).withColumn("desc_sim", F.nanvl("desc_sim", F.lit(None).cast("double")))

    alone = _classes_removed(stored(keyed.select("seq", "priority", "code_key", "text").join(tied, "code_key", "left_anti"), "dedup-alone"))
    return linked.unionByName(alone)


def greedy_survivors(samples: DataFrame, priorities: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return samples.join(greedy_removed(samples, priorities, threshold).select("seq"), "seq", "left_anti")


def removed_examples(removed: DataFrame, samples: DataFrame, n: int = 100) -> DataFrame:
    """The report's first n removed rows, with previews and rounded similarities."""
    kept = samples.select(F.col("seq").alias("kept_seq"), F.col("source").alias("kept_source"))
    first = removed.orderBy("seq").limit(n)
    return first.join(samples, "seq").join(kept, "kept_seq").select("seq", "description", F.left("code", F.lit(200)).alias("code_preview"), "source", "kept_source", "reason", F.round("desc_sim", 3).alias("desc_similarity"), F.round("code_sim", 3).alias("code_similarity"))


def conflicting_descriptions_dropped(samples: DataFrame) -> DataFrame:
    """Rows whose code has one description only."""
    one = samples.groupBy("code").agg(F.min("description").alias("a"), F.max("description").alias("b")).where("a <=> b").select("code")
    return samples.join(one, "code", "left_semi")


def similarity_histogram(pairs: DataFrame) -> DataFrame:
    """Pairs by code similarity, one decimal."""
    return pairs.groupBy(F.round("code_sim", 1).alias("bucket")).agg(F.count("*").alias("pairs"))

