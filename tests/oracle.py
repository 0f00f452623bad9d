"""Run queries in Spark and their SQL twins in DuckDB, and compare the results exactly."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _kinds(types: dict[str, str]) -> dict[str, str]:
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "boolean": "BOOLEAN",
    }
    return {k: same.get(v, v) for k, v in types.items()}


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v != v:
            return None
        return v + 0.0 if isinstance(v, float) else v

    rows = [
        tuple(map(plain, r)) for r in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, name: str, folder: str) -> list[str]:
    """Differences found, as text; empty when schema, rows and values agree."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, folder)
    spark_types = _kinds(dict(df.dtypes))
    arrow = df.toArrow().to_pydict()
    rel = con.sql(entry.oracle_sql()[name])
    types = dict(zip(rel.columns, map(str, rel.types)))
    want = dict(zip(rel.columns, zip(*rows))) if (rows := rel.fetchall()) else {c: [] for c in rel.columns}
    problems = []
    if spark_types != types:
        odd = {
            k: (spark_types.get(k), types.get(k))
            for k in set(spark_types) | set(types)
            if spark_types.get(k) != types.get(k)
        }
        problems.append(f"types differ (spark, sql): {odd}")
    if set(want) != set(arrow):
        return problems
    got_rows = _canonical(pd.DataFrame(arrow, dtype=object))
    want_rows = _canonical(pd.DataFrame({k: list(v) for k, v in want.items()}, dtype=object))
    if len(got_rows) != len(want_rows):
        problems.append(f"row counts differ: spark {len(got_rows)}, sql {len(want_rows)}")
    if not got_rows:
        problems.append("no rows")
    wrong = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, columns {sorted(arrow)}, first: {str(wrong[0])[:600]}")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from parcelsight.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        **{"spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or list(entry.queries()):
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problems = compare(spark, con, name, folder)
            else:
                problems = [] if entry.queries()[name](spark, folder).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
