import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["n_name", "o_orderkey", "o_totalprice", "rn"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


@pytest.mark.parametrize("name", ["w2_top_n_per_group", "j6_reconcile", "a4_string_agg_distinct",
                                  "d2_update_from", "x1_inspect_documents", "t7_sustained",
                                  "t2_stream_align_600s", "q1_dq_scan", "s9_refresh",
                                  "a9_array_agg", "a10_array_agg_distinct", "a11_pick_one", "j7_cross_param",
                                  "x8_redact_csv_files", "x8_redact_files"])
def test_oracle_small(spark, name):
    status = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert status[0] == "ok", status
