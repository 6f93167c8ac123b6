"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL result; empty when they agree."""
    result = connection.execute(sql)
    want_types = {d[0]: str(d[1]) for d in result.description}
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    got_names, got = _rows(df.columns, [tuple(row) for row in df.collect()])
    problems = []
    if want_names != got_names:
        return [f"columns {got_names}, expected {want_names}"]
    for name, kind in df.dtypes:
        if _TYPES.get(kind, kind) != want_types[name]:
            problems.append(f"type of {name}: {kind}, expected {want_types[name]}")
    if want != got:
        missing, extra = want - got, got - want
        problems.append(
            f"rows {sum(got.values())}, expected {sum(want.values())}; {sum(missing.values())} missing such as "
            f"{list(missing)[:2]}; extra such as {list(extra)[:2]}"
        )
    return problems


def main() -> None:
    import __spark_entry__ as entry

    from farekit import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark__driver__memory="8g", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, make in entry.queries().items():
        if only and not any(name.startswith(prefix) for prefix in only):
            continue
        start = time.time()
        try:
            df = make(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problems = compare(df, connection, sql) if sql else []
            note = "" if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:30s} {time.time() - start:6.2f}s {note}", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print(f"{bad} failures", flush=True)


if __name__ == "__main__":
    main()
