"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def expected(sql: str, sf_dir: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection.sql(sql).df()


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(
        (tuple(None if v is None else v if isinstance(v, str) else int(v) for v in row)
         for row in plain.itertuples(index=False)),
        key=repr,
    )


def difference(actual: pd.DataFrame, wanted: pd.DataFrame) -> str:
    """Empty if both have the same columns and rows."""
    if sorted(actual.columns) != sorted(wanted.columns):
        return f"columns {sorted(actual.columns)} != {sorted(wanted.columns)}"
    a, b = _rows(actual), _rows(wanted)
    if a == b:
        return ""
    extra, absent = set(a) - set(b), set(b) - set(a)
    return f"rows {len(a)} != {len(b)}; extra {list(extra)[:2]}; absent {list(absent)[:2]}"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as driver
    from tests.conftest import make_session

    spark = make_session()
    sf_dir = f"/root/testdata/sf{sf}"
    bad = 0
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            actual = query(spark, sf_dir).toPandas()
            took = time.time() - start
            wrong = difference(actual, expected(driver.oracle_sql()[name], sf_dir))
        except Exception as error:
            took, wrong = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(wrong)
        print(f"{name:28} {took:6.1f}s {wrong or f'ok {len(actual)} rows'}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
