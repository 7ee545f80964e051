"""Every query of the folder that has SQL against DuckDB, and a run of all of them."""

import os
import sys

import pytest

from paddock.llm.queries import ORACLES, QUERIES
from tests.oracle_harness import duck, rows_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    sf = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(sf).execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
