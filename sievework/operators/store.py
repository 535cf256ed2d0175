"""Tables between the steps of a plan, as Parquet in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_PATHS: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as `spark.checkpoint.dir` names it.

    Where it is unset a temporary folder serves, but only for a local master: on a cluster the
    executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "root" not in _OWN:
        _OWN["root"] = tempfile.mkdtemp(prefix="sievework-")
        atexit.register(shutil.rmtree, _OWN["root"], True)
    return _OWN["root"]


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: cuts lineage, survives lost executors.

    Shuffle files that only one query needed go at its end, unless the session says otherwise. The table stays
    until `released` or the end of the session.
    """
    spark = df.sparkSession
    if spark.conf.get(_CLEANUP, None) in (None, "false"):
        spark.conf.set(_CLEANUP, "true")
    path = f"{shared_root(spark)}/sievework/{tag}-{uuid.uuid4().hex}"
    if not _PATHS:
        atexit.register(released, spark)
    _PATHS.append(path)
    df.write.option("compression", "zstd").parquet(path)
    trimmed_driver(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def trimmed_driver(spark: SparkSession) -> str:
    """Have the driver's JVM give freed native memory back to the system; its answer, empty where it has no such command.

    Planning and compiling many queries leaves hundreds of MB there that are free but stay allocated.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    try:
        kinds, values = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, values) or ""
    except Py4JError:  # another JVM, or one before 17.0.9
        return ""


def dropped(table: DataFrame) -> None:
    """Delete a table that `stored` gave and nothing will read again."""
    path = table._stored_at
    if path in _PATHS:
        _PATHS.remove(path)
        deleted(table.sparkSession, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """What `make` gives, stored; the tables that it stored on the way go at once."""
    since = len(_PATHS)
    out = stored(make(), tag)
    kept = _PATHS.pop()
    released(spark, since)
    _PATHS.append(kept)
    return out


def released(spark: SparkSession, since: int = 0) -> None:
    """Delete the stored tables from the given one on; results that still read them must have been written."""
    old, _PATHS[since:] = _PATHS[since:], []
    try:
        for path in old:
            deleted(spark, path)
    except Exception:  # the session is gone; a job's own folder is the cluster's to sweep
        pass


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end: for plans whose result is written inside too."""
    since = len(_PATHS)
    try:
        yield
    finally:
        released(spark, since)


def positioned(df: DataFrame, order: list, tag: str, name: str = "pos") -> DataFrame:
    """df sorted by `order` over range partitions, with its dense global position (from 0) as column `name`.

    Without an order the rows are numbered as they come.

    Rows are written with the number of their partition before anything else looks at it: a range exchange
    planned twice may be cut in two ways. Only one count per partition passes through a single task. Rows
    equal in all order columns get neighbouring positions in any order.
    """
    row = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    pid, idx, base = (f"_{name}_{part}" for part in ("pid", "idx", "base"))
    kept = stored(ordered.withColumns({pid: F.shiftright(row, 33), idx: row.bitwiseAND((1 << 33) - 1)}), tag)
    ends = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    bases = kept.groupBy(pid).count().select(pid, F.coalesce(F.sum("count").over(ends), F.lit(0)).alias(base))
    return kept.join(F.broadcast(bases), pid).withColumn(name, F.col(base) + F.col(idx)).drop(pid, idx, base)


def joined_unevenly(rows: DataFrame, table: DataFrame, key: str | list[str], weight: str, how: str = "inner", most: int = 1000) -> DataFrame:
    """rows joined to a table of unique keys, where a few keys may hold most rows.

    `weight` is the table's column of how many rows have the key. Fewer than `most` keys can have over one in
    `most` of all rows: these are broadcast and their rows stay where they are, the rest meet by shuffle. Both
    sides should be stored tables. `weight` is not in the result.
    """
    seen = table.agg(F.sum(weight).alias("total"), F.max(weight).alias("top")).first()
    bound = max(10_000, (seen["total"] or 0) // most)
    if (seen["top"] or 0) <= bound:
        return rows.join(table.drop(weight), key, how)
    heavy = table.where(F.col(weight) > bound).drop(weight)
    light = table.where(F.col(weight) <= bound).drop(weight)
    keys = [key] if isinstance(key, str) else key
    apart = rows.join(F.broadcast(heavy.select(*keys)), key, "left_anti").join(light, key, how)
    return rows.join(F.broadcast(heavy), key, "inner").unionByName(apart)
