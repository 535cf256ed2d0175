"""Hold queries against their SQL in DuckDB: python tests/oracle.py SF [NAME...]; counts and sorted values must agree."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        path = Path(f"{sf_dir}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return db


def rows(frame: pd.DataFrame) -> list[str]:
    shown = lambda v: "null" if v is None or v != v else repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)
    return sorted("|".join(map(shown, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


def differ(spark, db, f, sql: str, sf_dir: str) -> str:
    """Empty if the query and its SQL agree."""
    ours, theirs = f(spark, sf_dir).toPandas(), db.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    a, b = rows(ours), rows(theirs)
    return "" if a == b else f"{len(a)} and {len(b)} rows; ours {[x for x in a if x not in set(b)][:2]}, SQL's {[x for x in b if x not in set(a)][:2]}"


if __name__ == "__main__":
    import __spark_entry__
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    db, sql = connect(sf_dir), __spark_entry__.oracle_sql()
    bad = 0
    for name, f in __spark_entry__.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        if not sys.argv[2:] and (name.startswith("op") or name == "pipeline"):
            continue
        t = time.time()
        try:
            said = differ(spark, db, f, sql[name], sf_dir) if name in sql else f"{f(spark, sf_dir).count()} rows"
        except Exception as e:
            said = f"FAILED {str(e)[:600]}"
        bad += bool(said) and name in sql
        print(f"{name}: {said[:900] or 'equal'} ({time.time() - t:.1f} s)", flush=True)
    print(f"{bad} differ")
