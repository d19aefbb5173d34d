"""Registered training-data queries against their SQL twins."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from caseweave.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_twin(spark, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    assert len(mine) and compare(mine, connect(SF).execute(entry.oracle_sql()[name]).df()) == "ok"


def test_all_registered():
    assert [n.split("_")[0] for n in Q.queries()] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
    assert set(Q.queries()) <= set(entry.queries())
