"""Compare registered queries with their SQL twins by schema, row count and values.

Run as a script: ``python tests/compare.py <sf_dir> [query …]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def compare(df, con, sql: str) -> list[str]:
    """Differences found; empty if the two results are equal."""
    described = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if described != types:
        odd = {k: (types.get(k), described.get(k)) for k in {*types, *described} if types.get(k) != described.get(k)}
        problems.append(f"schema (spark, sql): {odd}")
        if set(described) != set(types):
            return problems
    names = sorted(types)
    mine = sorted(tuple(normal(r[n]) for n in names) for r in df.collect())
    rows = con.execute("select " + ", ".join(f'"{n}"' for n in names) + f" from ({sql})").fetchall()
    theirs = sorted(tuple(normal(v) for v in r) for r in rows)
    if len(mine) != len(theirs):
        problems.append(f"rows: spark {len(mine)}, sql {len(theirs)}")
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(mine)][:2]
        problems.append(f"values {names}: spark only {extra}, sql only {missing}")
    if not mine:
        problems.append("empty")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from martloom.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in chosen or queries:
        began = time.time()
        try:
            found = compare(queries[name](spark, sf_dir), con, oracles[name]) if name in oracles else ["no oracle"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s", *found, sep="\n     ", flush=True)
    print(f"{bad} differ; without query: {sorted(set(oracles) - set(queries))}")


if __name__ == "__main__":
    main()
