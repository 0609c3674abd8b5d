"""The registered queries on the smallest tables: oracles and row counts."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from oracle_check import compare, connect  # noqa: E402
from vigil.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered_with_the_entry_point():
    import __spark_entry__
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLE:
        assert compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF) is None
    else:
        assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
