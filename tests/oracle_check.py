"""Compare every registered query with its SQL twin. Run: python tests/oracle_check.py [sf_dir] [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


DUCK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def difference(df, con, sql: str) -> str | None:
    """None when names, types and values agree exactly; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    types = dict(
        (n, DUCK_TYPES.get(t, t)) for n, t in con.execute(f"DESCRIBE {sql}").fetchall() and
        [(x[0], x[1]) for x in con.execute(f"DESCRIBE {sql}").fetchall()]
    )
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got_types = dict(df.dtypes)
    wrong = {n: (got_types[n], types[n]) for n in names if got_types[n] != types[n]}
    if wrong:
        return f"types (spark, sql): {wrong}"
    got = rows_of(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            n = sum(x != y for x, y in zip(got, want))
            return f"{n} rows differ, first {sorted(names)}:\n  spark {a}\n  sql   {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from opsloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con, sql = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                verdict = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, verdict = None, f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            problem = verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - began:6.2f}s  {verdict}", flush=True)
    print(f"{bad} bad; without query: {sorted(set(sql) - set(entry.queries()))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
