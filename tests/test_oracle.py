"""Every registered query against its DuckDB oracle, on the smallest scale factor.

Also checks that the final plan keeps row-wise operators inside whole-stage codegen.
"""

import re

import duckdb
import pytest

from rowmill.plans.fixtures import TABLES
from rowmill.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import digest




@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    assert not interpreted_operators(df), interpreted_operators(df)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


CODEGEN_OPS = ("Project", "Filter", "HashAggregate", "Generate", "Expand")


def interpreted_operators(df):
    """Row-wise operators of the final plan that run outside whole-stage codegen."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    bad = []
    for line in plan.splitlines():
        m = re.search(r"[+:-]- (\S+) ", line) or re.match(r"^(\S+) ", line.strip())
        if m and m.group(1) in CODEGEN_OPS and "*(" not in line:
            bad.append(line.strip()[:120])
    return bad
