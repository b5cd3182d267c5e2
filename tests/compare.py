"""Runs queries next to their SQL twins in DuckDB. Usable as a script: compare.py FOLDER [NAME…]"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
        return v

    return sorted(
        (tuple(cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), v) for v in r),
    )


def difference(spark_df, db, sql: str) -> str | None:
    """What differs, or None."""
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    twin = canonical(result.fetchall(), columns)
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if names.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    ours = canonical([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if len(ours) != len(twin):
        return f"{len(ours)} rows against {len(twin)}"
    wrong = [(a, b) for a, b in zip(ours, twin) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]} ({sorted(columns)})"
    return None if ours else "no rows"


def main() -> None:
    from firnline.catalog import QUERIES, TWINS
    from firnline.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, db = local_session(8), database(folder)
    bad = 0
    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            if name in TWINS:
                found = difference(df, db, TWINS[name])
            else:
                n = len(df.collect())
                found = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
            if wanted:
                traceback.print_exc()
        bad += found is not None
        kind = "twin" if name in TWINS else "rows"
        print(f"{time.time() - began:6.1f}s {kind} {name}: {found or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
