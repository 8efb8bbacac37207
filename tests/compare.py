"""Run a query and its SQL twin and compare names, types and all values.

``python tests/compare.py <table folder> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import re
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(base: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}.parquet')")
    return con


def sql_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return re.sub(r"\s", "", spark_type.upper())
    return SQL_TYPES.get(spark_type, spark_type)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty when equal."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    have_types = {f.name: sql_type(f.dataType.simpleString()) for f in df.schema}
    found = []
    if sorted(want_types) != sorted(have_types):
        return [f"columns {sorted(have_types)} instead of {sorted(want_types)}"]
    for name, kind in want_types.items():
        if have_types[name] != kind:
            found.append(f"{name} is {have_types[name]} instead of {kind}")
    names = sorted(want_types)
    have = Counter(tuple(row[n] for n in names) for row in df.collect())
    at = [relation.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in at) for row in relation.fetchall())
    if have != want:
        found.append(
            f"{sum((have - want).values())} of {sum(have.values())} rows not expected, "
            f"{sum((want - have).values())} of {sum(want.values())} rows missing; "
            f"e.g. {next(iter(have - want), None)} / {next(iter(want - have), None)}"
        )
    return found


def main() -> int:
    import __spark_entry__ as contract
    from tillforge.session import create_session

    base, *names = sys.argv[1:]
    spark = create_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(base), contract.queries(), contract.oracle_sql()
    bad = []
    for name in names or queries:
        start = time.time()
        if name not in oracles:
            print(f"{name:32} no twin, {queries[name](spark, base).count()} rows", flush=True)
            continue
        try:
            found = differences(queries[name](spark, base), con, oracles[name])
        except Exception as error:  # a broken query must not hide the others
            found = [f"{type(error).__name__}: {str(error)[:300]}"]
        print(f"{name:32} {'ok' if not found else found} {time.time() - start:.1f}s", flush=True)
        if found:
            bad.append(name)
    print("differ:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
