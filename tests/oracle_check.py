"""Compare named queries with their SQL, row by row.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events".split()
_KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def database(path: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when equal."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: _KINDS.get(str(c[1]), str(c[1])) for c in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = dict(df.dtypes)
    for n in names:
        if types[n] != kinds[n]:
            problems.append(f"type of {n}: {types[n]} != {kinds[n]}")
    got = [tuple(r) for r in df.collect()]
    a, b = _rows(df.columns, got), _rows(names, expected)
    if a != b:
        problems.append(f"{len(got)} rows against {len(expected)}")
        problems.append(f"only Spark: {list((a - b).items())[:2]}")
        problems.append(f"only SQL:   {list((b - a).items())[:2]}")
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from weektide.plans.catalog import ORACLES, QUERIES

    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:] or list(ORACLES)
    connection, bad = database(folder), 0
    for key in chosen:
        began = time.time()
        try:
            found = compare(QUERIES[key](session, folder), connection, ORACLES[key])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - began:.1f}s", flush=True)
        for line in found:
            print("      ", line)
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
