"""Compare catalogue queries with their SQL on DuckDB: python tools/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sievework.catalogue import ORACLES, QUERIES  # noqa: E402
from sievework.session import create_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return round(value, 9) if isinstance(value, float) else value


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    mine = rows(frame.columns, frame.collect())
    if name not in ORACLES:
        return None if mine else "no rows"
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    types = dict(zip(columns, (str(d[1]) for d in result.description)))
    mine_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in frame.schema.fields}
    if types != mine_types:
        return f"types {mine_types} != {types}"
    theirs = rows(columns, result.fetchall())
    if mine != theirs:
        return f"only Spark {list((mine - theirs).items())[:3]}, only SQL {list((theirs - mine).items())[:3]}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1].rstrip("/"), sys.argv[2:] or list(QUERIES)
    spark = create_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                           spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name)
        except Exception as error:  # a failing query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        verdict = "ok  " if problem is None else "FAIL"
        print(f"{verdict} {name} {time.time() - start:.2f}s", problem or "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
