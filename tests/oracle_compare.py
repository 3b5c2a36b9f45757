"""Run registered queries beside their SQL oracles and compare the results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from creditweave.session import local_session  # noqa: E402

SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
TABLES = "region nation customer supplier part orders lineitem documents benchmark conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def normalised(names, rows):
    """Rows with columns in name order, every value as its exact text, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, db, folder: str, name: str) -> list[str]:
    """What differs between the query and its oracle; empty when equal."""
    got = spark_entry.queries()[name](spark, folder)
    want = db.execute(spark_entry.oracle_sql()[name])
    want_names = [c[0] for c in want.description]
    if sorted(got.columns) != sorted(want_names):
        return [f"columns {sorted(got.columns)} != {sorted(want_names)}"]
    kinds = {c[0]: SPARK_TYPE.get(str(c[1]), str(c[1])) for c in want.description}
    typed = [(n, t, kinds[n]) for n, t in got.dtypes if t != kinds[n]]
    if typed:
        return [f"types {typed}"]
    mine, theirs = normalised(got.columns, got.collect()), normalised(want_names, want.fetchall())
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} != {len(theirs)}", *map(str, (mine[:2], theirs[:2]))]
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return [f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}"] if wrong else []


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark, db = local_session("8"), connect(folder)
    oracle = spark_entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                bad = differences(spark, db, folder, name)
                verdict = "; ".join(bad) if bad else "equal"
            else:
                rows = spark_entry.queries()[name](spark, folder).count()
                verdict = f"rows only: {rows}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict[:900]}", flush=True)


if __name__ == "__main__":
    main()
