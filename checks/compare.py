"""Run registered queries on Spark and DuckDB and compare rows, as a command or from tests."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, statement: str, con) -> list[str]:
    """What differs between a Spark frame and a DuckDB statement; empty if nothing."""
    got_columns = spark_df.columns
    got = _rows(got_columns, [tuple(r) for r in spark_df.collect()])
    relation = con.execute(statement)
    want_columns = [d[0] for d in relation.description]
    want = _rows(want_columns, relation.fetchall())
    found = []
    if sorted(got_columns) != sorted(want_columns):
        found.append(f"columns {sorted(got_columns)} != {sorted(want_columns)}")
    if got != want:
        found.append(f"{sum(got.values())} rows against {sum(want.values())}")
        found += [f"  only in Spark:  {r}" for r in list((got - want))[:3]]
        found += [f"  only in DuckDB: {r}" for r in list((want - got))[:3]]
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from checks.queries import ORACLES, QUERIES
    from checks.session import local_session

    spark, con, bad = local_session(), duck(sf_dir), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            found = differences(frame, ORACLES[name], con) if name in ORACLES else ["no SQL"] * (frame.count() < 0)
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            found = [str(error)[:1500]]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name}", *found, sep="\n     " if found else "")
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
