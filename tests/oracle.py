"""Compare registered queries with their SQL over the same files.

Run as a script: python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type names and the Spark ones that hold the same values.
SAME_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "VARCHAR[]": "array<string>", "FLOAT": "float",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return repr(value)


def digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted(repr([canonical(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(con, result, sql: str) -> str | None:
    """None if the frame and the SQL agree, or what differs."""
    relation = con.sql(sql)
    theirs = {n: SAME_TYPES.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    ours = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    if ours != theirs:
        return f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    left = [tuple(r) for r in result.collect()]
    right = relation.fetchall()
    if len(left) != len(right):
        return f"rows: {len(left)} here, {len(right)} in SQL"
    (a, here), (b, there) = digest(result.columns, left), digest(relation.columns, right)
    if a != b:
        gone = [(x, y) for x, y in zip(here, there) if x != y][:3]
        return f"values: {sum(x != y for x, y in zip(here, there))} rows differ, e.g. {gone}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from tripflow.session import build_session

    spark = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    con, oracles = connect(sf_dir), contract.oracle_sql()
    failed = 0
    for name, fn in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(con, fn(spark, sf_dir), oracles[name])
                state = problem or "ok"
            else:
                problem, state = None, f"{fn(spark, sf_dir).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = state = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{failed} failed")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
