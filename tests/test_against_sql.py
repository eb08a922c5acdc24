"""Queries against their own SQL in DuckDB, on small tables made for what once differed."""

from datetime import datetime

import duckdb
import pytest

from kalendria.operators import catalogue, coverage  # noqa: F401 - coverage registers its queries


def differs(spark, folder, name, **tables):
    """Rows that the query and its SQL do not share, floats to six places."""
    db = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = catalogue.queries()[name](spark, str(folder))
    plain = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = [plain(r) for r in db.execute(f"SELECT {columns} FROM ({catalogue.oracle_sql()[name]})").fetchall()]
    return sorted(map(repr, want)), sorted(repr(plain(r)) for r in got.collect())


def test_queue_order_of_one_millisecond_and_of_nulls(spark, tmp_path):
    at = [172_400, 172_499, 172_500, 172_600, 172_999, 173_001, 173_499, 173_500]
    rows = [(i, datetime(2024, 1, 1, 0, 0, 11, at[i % 8]), i % 5, "ab"[i % 2]) for i in range(80)]
    rows += [(100, None, 1, "a"), (101, datetime(2024, 1, 2), None, "b"), (102, datetime(1969, 12, 31, 23, 59, 59, 999_400), 0, "a"), (103, datetime(1969, 12, 31, 23, 59, 59, 998_600), 0, "a")]
    want, got = differs(spark, tmp_path, "queue_pop_order", events=(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string"))
    assert got == want
