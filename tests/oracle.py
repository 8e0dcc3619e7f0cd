"""Compare registered queries with their SQL in DuckDB: names, types, row counts and values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
         "FLOAT": "float", "VARCHAR[]": "array<string>", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if not isinstance(value, dt.datetime) else value.isoformat()


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    result = con.execute(sql)
    want_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    want_rows = result.fetchall()
    have_types = dict(spark_df.dtypes)
    if have_types != want_types:
        return [f"columns: {sorted(set(have_types.items()) ^ set(want_types.items()))}"]
    names = sorted(have_types)
    at = [list(want_types).index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in at) for r in want_rows)
    have = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    if want == have:
        return []
    missing, extra = list((want - have).elements()), list((have - want).elements())
    return [f"rows: {sum(have.values())} vs {sum(want.values())}; columns {names}", f"only SQL: {missing[:4]}", f"only Spark: {extra[:4]}"]


def main(sf_dir: str, wanted: list[str]) -> None:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from casemill.plans.registry import all_oracles, all_queries
    from casemill.session import local_session

    spark, con, sql = local_session(), connect(sf_dir), all_oracles()
    for name, fn in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not problems else 'DIFF'} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
