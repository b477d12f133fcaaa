"""The operators that SQL can express give the rows of their SQL twins."""

import pytest

import __spark_entry__ as entry
from tools.check_sql import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name",
    [
        "op2_cell_vector_dedup", "op4_chat_format", "op5_minmax_near_dup", "op11_mtree_top_k", "op12_min_plus_audit",
        "op13_four_russians_negatives",
    ],
)
def test_query(spark, name):
    rows = entry.queries()[name](spark, SF).toPandas()
    assert compare(rows, duck(SF).execute(entry.oracle_sql()[name]).df()) is None
