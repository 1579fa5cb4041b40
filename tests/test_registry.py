"""Every registered query against its DuckDB oracle at sf0.001 (rows, column
names, order-insensitive value hash), as the driver checks at sf0.01."""

import duckdb
import pytest

from __spark_entry__ import entry
from lakeshore.plans.queries import ORACLES, QUERIES
from lakeshore.sources.tables import TABLES
from tools.check_oracles import digest

from conftest import SF001

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert "__END_AT" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_a_missing_optional_package_leaves_the_core(tmp_path):
    """Without what the optional part imports, its queries are left out, no others."""
    import subprocess
    import sys

    from lakeshore.plans.queries import QUERIES

    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['tokenizers'] = None; sys.modules['zstandard'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=__file__.rsplit("/", 2)[0])
    n, optional = out.stdout.split()
    assert int(n) >= len(QUERIES) and (optional == "False") == (int(n) == len(QUERIES)), out.stderr[-500:]
