"""Runs every query and its SQL twin side by side: python tests/check_oracles.py [folder] [name ...]."""

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Spark type names and the DuckDB types that must stand against them.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, folder, build, sql):
    """None when both give the same columns and rows, else what differs."""
    frame = build(spark, folder)
    ours = rows_of(frame.columns, frame.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = rows_of(names, answer.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    kinds = {f.name: TYPES.get(f.dataType.simpleString()) for f in frame.schema.fields}
    if kinds != {d[0]: str(d[1]) for d in answer.description}:
        return f"types {kinds} against {[(d[0], str(d[1])) for d in answer.description]}"
    if ours == theirs:
        return None
    odd = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
    return f"{len(ours)} rows against {len(theirs)}; {str(odd)[:600]}"


def main():
    import __spark_entry__ as entry
    from logsieve.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, oracles = local_session("oracles"), database(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, build, oracles[name])
            else:
                problem = None if build(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001  report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f} {name} {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
