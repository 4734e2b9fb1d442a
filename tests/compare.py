"""Side-by-side run of registered queries in Spark and DuckDB. Not a test module by itself."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SAME = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def differences(spark, con, name, f, sql, sf_dir) -> list[str]:
    df = f(spark, sf_dir)
    names, rows = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return [] if rows else ["no rows"]
    cur = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cur.description}
    names2, rows2 = _sorted_rows(list(described), cur.fetchall())
    out = []
    if names != names2:
        return [f"columns {names} != {names2}"]
    for c, t in df.dtypes:
        d = described[c]
        if SAME.get(t, t) != d:
            out.append(f"type of {c}: {t} / {d}")
    if len(rows) != len(rows2):
        out.append(f"rows {len(rows)} != {len(rows2)}")
    if rows != rows2:
        a, b = set(rows), set(rows2)
        out.append(f"values: only spark {sorted(a - b)[:2]} only duckdb {sorted(b - a)[:2]} ({len(a - b)}/{len(b - a)})")
    if not rows:
        out.append("no rows")
    return out


if __name__ == "__main__":
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from brinewave.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    session = local_session()
    connection = duck(sf)
    bad = 0
    for key, fn in entry.queries().items():
        if wanted and not any(w in key for w in wanted):
            continue
        start = time.time()
        try:
            found = differences(session, connection, key, fn, entry.oracle_sql().get(key), sf)
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - start:.2f}s", *found, sep="\n     ", flush=True)
    print("failed:", bad)
