"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle_harness.py [sf_dir] [key ...]

Compares row count, column names (sorted) and the multiset of rows, with
columns sorted by name; values are compared exactly (doubles that need it
are rounded inside both queries).
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from voxlens.sources.tables import BASE_TABLES  # noqa: E402


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT"}


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return int(v)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pd.notna(pdf[cols]), None)
    rows = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, key: str, root: str, con=None, builder=None, sql=None) -> dict:
    sys_path_entry = ROOT
    if sys_path_entry not in sys.path:
        sys.path.insert(0, sys_path_entry)
    import __spark_entry__ as entry

    builder = builder or entry.queries()[key]
    sql = sql if sql is not None else entry.oracle_sql().get(key)
    t0 = time.time()
    sdf = builder(spark, root)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"key": key, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:  # what the driver would do with it: unique names, a real write, the rows written
        out = os.path.join(tempfile.mkdtemp(prefix="voxlens-rows-"), key)
        sdf.write.parquet(out)
        written = spark.read.parquet(out).count()
        unique = len({c.lower() for c in sdf.columns}) == len(sdf.columns)
        res["status"] = "rows-only" if unique and written == len(spdf) > 0 else "ROWS"
        return res
    con = con or duck(root)
    rel = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    dpdf = rel.df()
    res["duck_rows"] = len(dpdf)
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    bad_types = {c: (spark_types[c], duck_types.get(c)) for c in spark_types
                 if TYPE_MAP.get(spark_types[c]) != duck_types.get(c)}
    if bad_types:
        res["types"] = bad_types
    if sorted(spdf.columns) != sorted(dpdf.columns):
        res["status"] = "COLUMNS"
        res["detail"] = f"spark={sorted(spdf.columns)} duck={sorted(dpdf.columns)}"
        return res
    a, b = _rows(spdf), _rows(dpdf)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        res["status"] = "VALUES"
        res["detail"] = f"{len(diff)} differ; first: spark={diff[0][0]} duck={diff[0][1]}; cols={sorted(spdf.columns)}"
        return res
    res["status"] = "OK" if "types" not in res else "TYPES"
    return res


def main(argv: list[str]) -> int:
    from voxlens.session import local_session

    root = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session(8)
    import __spark_entry__ as entry

    keys = keys or list(entry.queries())
    con = duck(root)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, root, con)
        except Exception as exc:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": repr(exc)[:600]}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
