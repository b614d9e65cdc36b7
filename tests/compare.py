"""Run registered queries and their SQL twins on the same parquet files and compare rows and types.

    python tests/compare.py [sf] [name prefix ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(table) -> tuple[dict[str, str], Counter]:
    names = sorted(table.column_names)
    types = {n: str(table.schema.field(n).type).replace("large_", "").replace("[ns]", "[us]")
                .replace("l: ", "element: ").replace("item: ", "element: ") for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    return types, Counter(tuple(plain(v) for v in row) for row in zip(*columns))


def compare(spark_table, duck_table) -> str:
    """Empty when equal, otherwise the first difference."""
    types, rows = rows_of(spark_table)
    expected_types, expected = rows_of(duck_table)
    if list(types) != list(expected_types):
        return f"columns {list(types)} != {list(expected_types)}"
    wrong = {n: (types[n], expected_types[n]) for n in types if types[n] != expected_types[n]}
    if sum(rows.values()) != sum(expected.values()):
        return f"rows {sum(rows.values())} != {sum(expected.values())}"
    if rows != expected:
        extra, missing = list((rows - expected).items())[:2], list((expected - rows).items())[:2]
        return f"values differ: {sum((rows - expected).values())} rows, e.g. {extra} != {missing}"
    return f"types {wrong}" if wrong else ""


def duck_result(con, sql: str):
    return con.execute(sql).to_arrow_table()


def main() -> int:
    sys.path.insert(0, str(ROOT))
    import bench
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    folder = f"/root/testdata/sf{sf}"
    spark, con = bench.session(), connect(folder)
    oracles, failed = oracle_sql(), 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            table = build(spark, folder).toArrow()
            middle = time.time()
            if name in oracles:
                note = compare(table, duck_result(con, oracles[name])) or "equal"
            else:
                note = "rows only"
        except Exception as error:  # report and go on with the next query
            middle, note, table = time.time(), f"ERROR {str(error)[:600]}", None
        ok = note in ("equal", "rows only") and (table is None or table.num_rows > 0)
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {middle - start:7.2f}s rows={table.num_rows if table else 0:8d} "
              f"{note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
