"""Every query of the driver entry against its SQL, on the smallest tables; and the entry without the optional parts."""

from __future__ import annotations

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from quillon.plans import driver_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    base = duckdb.connect()
    for name in NAMES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return base


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver_queries.ORACLES))
def test_query(spark, sql, name):
    got = driver_queries.QUERIES[name](spark, DATA)
    want = sql.execute(driver_queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(want.fetchall(), columns)


def test_score_display_of_odd_balances(spark, tmp_path):
    odd = [-0.0, 0.0, -0.01, 0.29, -5e-324, 699.99, 700.0, 9999.99, 1e20, -1e20, math.nan, math.inf, -math.inf, None]
    rows = spark.createDataFrame([(9 * i + 1, x) for i, x in enumerate(odd)] + [(9, -0.0)], "c_custkey long, c_acctbal double")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = driver_queries.QUERIES["score_display"](spark, str(tmp_path))
    with duckdb.connect() as own:
        own.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
        want = own.execute(driver_queries.ORACLES["score_display"])
        columns = [c[0] for c in want.description]
        assert canonical([tuple(r) for r in got.select(columns).collect()], columns) == canonical(want.fetchall(), columns)
    assert got.where("c_custkey = 1").first().shown == "-0.00"


def test_every_query_has_sql():
    assert set(driver_queries.QUERIES) == set(driver_queries.ORACLES)


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() == 5 and "core_average" in out.columns


def test_entry_without_optional_parts(tmp_path):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "quillon", tmp_path / "quillon", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']; assert len(e.oracle_sql()) > 50"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
