"""The queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from lakeshore.llm.queries import ORACLES, QUERIES
from lakeshore.sources.tables import TABLES
from tools.check_oracles import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and digest(got) == digest(want)


def test_all_are_registered():
    names = set(queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}
    assert set(ORACLES) <= set(oracle_sql())
