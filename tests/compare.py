"""Run registered queries next to their SQL twins and compare every value.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(field: pa.Field) -> str:
    """Type class: values of one class print alike."""
    t = field.type
    tests = {
        "int": pa.types.is_integer,
        "float": pa.types.is_floating,
        "decimal": pa.types.is_decimal,
        "bool": pa.types.is_boolean,
        "date": pa.types.is_date,
        "time": pa.types.is_timestamp,
    }
    return next((name for name, test in tests.items() if test(t)), str(t).replace("large_", ""))


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    got = df.toArrow()
    expected = con.sql(sql).to_arrow_table()
    names = sorted(got.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} / {sorted(expected.column_names)}"
    kinds = {f.name: kind(f) for f in got.schema}
    wrong = [f.name for f in expected.schema if kind(f) != kinds[f.name]]
    if wrong:
        return f"types of {wrong}: {got.schema} / {expected.schema}"
    if got.num_rows != expected.num_rows:
        return f"rows {got.num_rows} / {expected.num_rows}"
    con.register("_got", got.select(names))
    con.register("_expected", expected.select(names))
    only_got = con.sql("SELECT * FROM _got EXCEPT ALL SELECT * FROM _expected").fetchall()
    only_expected = con.sql("SELECT * FROM _expected EXCEPT ALL SELECT * FROM _got").fetchall()
    con.unregister("_got")
    con.unregister("_expected")
    if only_got or only_expected:
        return (
            f"{len(only_got)} of {got.num_rows} rows differ {names}: "
            f"{str(only_got[:2])[:400]} / {str(only_expected[:2])[:400]}"
        )
    return None


def main() -> int:
    import __spark_entry__ as entry
    from aislecast.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark = local_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and not any(name == w or name.startswith(w + "_") for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = difference(build(spark, sf_dir), con, sqls[name])
            else:
                problem = None if build(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
