"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from qaspark.session import build_session

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (datetime, date)):
        return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime) else value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def kind(type_name: str) -> str:
    t = type_name.lower()
    for group, names in {
        "huge": ("hugeint",), "long": ("bigint",), "int": ("int",), "float": ("double", "float", "decimal"), "str": ("varchar", "string"),
        "bool": ("bool",), "time": ("timestamp", "date"),
    }.items():
        if any(n in t for n in names):
            return group
    return t


def compare(spark, con, folder: str, name: str) -> str | None:
    """What differs, or None."""
    return difference(QUERIES[name](spark, folder), con, name)


def difference(df, con, name: str) -> str | None:
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return None if ours else "no rows"
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    kinds = {c[0]: kind(str(c[1])) for c in result.description}
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if kind(t) != kinds[c]]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    if ours != theirs:
        different = [(x, y) for x, y in zip(ours, theirs) if x != y]
        return f"{len(different)} of {len(ours)} rows differ, first {str(different[0])[:900]}"
    if wrong:
        return f"types {wrong}"
    return None if ours else "no rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001 - a report, not a handler
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {'' if name in ORACLE else '(rows only) '}{problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
