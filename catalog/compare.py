"""Run registered queries against their SQL in DuckDB: python -m catalog.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from catalog.oracles import ORACLES
from catalog.queries import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return db


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp",
}


def difference(spark, db, name: str, sf_dir: str) -> str | None:
    """None if both sides agree in columns, types and rows, else what differs."""
    df = REGISTRY[name](spark, sf_dir)
    db.register("got", df.toArrow())
    db.execute(f"create or replace temp table want as {ORACLES[name]}")
    described = db.execute("select * from want limit 0").description
    kinds = {d[0]: str(d[1]) for d in described}
    if sorted(df.columns) != sorted(kinds):
        return f"columns {sorted(df.columns)} / {sorted(kinds)}"
    odd = [f"{f.name}: {f.dataType.simpleString()} / {kinds[f.name]}" for f in df.schema
           if KINDS.get(kinds[f.name]) != f.dataType.simpleString()]
    if odd:
        return f"types {odd}"
    shown = ", ".join(f"round({n}, 6) + 0.0 {n}" if k == "DOUBLE" else f"{n}::timestamp {n}" if k == "TIMESTAMP" else n
                      for n, k in kinds.items())
    counts = [db.execute(f"select count(*) from {side}").fetchone()[0] for side in ("got", "want")]
    if counts[0] != counts[1]:
        return f"{counts[0]} rows / {counts[1]} rows"
    db.execute("set timezone = 'UTC'")
    off = db.execute(f"select {shown} from got except all select {shown} from want").fetchall()
    if off:
        missed = db.execute(f"select {shown} from want except all select {shown} from got limit 1").fetchall()
        return f"{len(off)} rows differ, for one {off[0]} / {missed}"
    return None


def main() -> int:
    from stockcast.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            if name in ORACLES:
                found = difference(spark, db, name, sf_dir)
                state = "equal" if found is None else found
            else:
                state, found = f"{REGISTRY[name](spark, sf_dir).count()} rows, no SQL", None
        except Exception as problem:
            found = state = f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - begin:6.1f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} with a difference")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
