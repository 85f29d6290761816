"""Compare registered queries with their SQL: ``python tests/check_oracle.py [sf] [query ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(con, df, sql):
    """None if equal, else what differs."""
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    wanted = _rows(wanted_columns, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns {sorted(df.columns)} instead of {sorted(wanted_columns)}"
    other = [(c, t, types[c]) for c, t in df.dtypes if SAME_TYPE.get(t) != types[c]]
    if other:
        return f"types differ: {other}"
    if len(got) != len(wanted):
        return f"{len(got)} rows instead of {len(wanted)}"
    different = [(g, w) for g, w in zip(got, wanted) if g != w]
    return f"{len(different)} rows differ, e.g. {different[0]}" if different else None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from riskloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, oracles, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = compare(con, df, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {kind:4s} {time.time() - start:6.2f}s  {problem or ''}", flush=True)
    print("failed:", failed, "| not registered:", set(oracles) - set(contract.queries()))
    sys.exit(bool(failed))
