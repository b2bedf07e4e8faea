"""Run registered queries against their SQL in DuckDB and compare types and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        [tuple(row[i] for i in order) for row in rows],
        key=lambda row: tuple((v is None, v) if v is not None else (True, 0) for v in row),
    )


def difference(df, con, sql: str, digits: int | None = None) -> str | None:
    """None if the results agree, else what differs first. ``digits`` rounds floats."""
    expected = con.sql(sql)
    want_types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    have_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if want_types != have_types:
        return f"types: {sorted(want_types.items() ^ have_types.items())}"
    want = _sorted(expected.fetchall(), expected.columns)
    have = _sorted([tuple(r) for r in df.collect()], df.columns)
    if len(want) != len(have):
        return f"{len(have)} rows instead of {len(want)}"

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else (v if digits is None else round(v, digits))
        return v

    unequal = [
        (a, b)
        for a, b in zip(have, want, strict=True)
        if any(plain(x) != plain(y) for x, y in zip(a, b, strict=True))
    ]
    return f"{len(unequal)} rows differ, e.g. {unequal[0]}" if unequal else None


def local_session(name: str = "compare") -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as registered

    spark, con = local_session(), connect(sf_dir)
    sqls, bad = registered.oracle_sql(), 0
    unpaired = registered.queries().keys() ^ sqls.keys()
    for name, query in registered.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        found = difference(query(spark, sf_dir), con, sqls[name])
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {time.time() - start:6.2f} {name} {found or ''}")
    print(f"{bad} differ; without a partner: {sorted(unpaired)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
