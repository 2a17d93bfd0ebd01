"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

SF_ROOT = os.environ.get("TEST_SF_ROOT", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    types = {}
    for n in names:
        t = str(table.schema.field(n).type)
        types[n] = {"large_string": "string"}.get(t, t)
    rows = list(zip(*[table.column(n).to_pylist() for n in names])) if names else []
    rows.sort(key=lambda r: tuple((v is not None, str(v)) for v in r))
    return types, rows


def problems(spark, name: str, sf_dir: str, con=None) -> list[str]:
    from sunledger.plans import CATALOG, runner

    con = con or connect(sf_dir)
    got_types, got = canonical(runner(name)(spark, sf_dir).toArrow())
    sql = CATALOG[name].sql
    if sql is None:
        return [] if got else [f"{name}: no rows"]
    want_types, want = canonical(con.sql(sql).to_arrow_table())
    out = []
    if got_types != want_types:
        diff = {k: (got_types.get(k), want_types.get(k)) for k in {*got_types, *want_types} if got_types.get(k) != want_types.get(k)}
        out.append(f"{name}: types (spark, sql) {diff}")
    if len(got) != len(want):
        out.append(f"{name}: rows {len(got)} vs {len(want)}")
    elif got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        out.append(f"{name}: {len(bad)} of {len(got)} rows differ, {sorted(got_types)} e.g. {bad[:2]}")
    if not want and sf_dir.endswith("sf0.01"):
        out.append(f"{name}: the SQL gives no rows")
    return out


if __name__ == "__main__":
    from sunledger.plans import CATALOG
    from sunledger.session import local_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    sf_dir = f"{SF_ROOT}/{sf}"
    con = connect(sf_dir)
    names = [n for n in CATALOG if not wanted or any(w in n for w in wanted)]
    bad = 0
    for n in names:
        t = time.time()
        try:
            msg = problems(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            msg = [f"{n}: {type(e).__name__} {str(e)[:600]}"]
        bad += bool(msg)
        kind = "sql" if CATALOG[n].sql else "rows"
        print(f"{'BAD' if msg else 'ok '} {time.time() - t:5.1f}s {kind:4} {n}", *msg, sep="\n      " if msg else " ", flush=True)
    print(f"{len(names)} queries, {bad} bad")
