"""Plan-shape checks: the properties the design relies on at scale."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan metadata
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_cuts_before_the_shuffle(spark):
    p = plan(E.queries()["w2_top_n_per_group"](spark, SF))
    assert "WindowGroupLimit" in p


def test_rank_limited_string_agg_cuts_before_the_shuffle(spark):
    p = plan(E.queries()["a4_string_agg_distinct"](spark, SF))
    assert "WindowGroupLimit" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["p4_where_eq"](spark, SF))
    assert "EqualTo(l_returnflag,R)" in p and "EqualTo(l_linenumber,1)" in p
    assert "l_extendedprice" not in p  # pruned from the read schema


def test_family_suffix_is_a_partition_filter(spark):
    p = plan(E.queries()["s4_scan_family"](spark, SF))
    assert "PartitionFilters: [isnotnull(suffix" in p and "(suffix" in p


def test_inspection_is_map_only(spark):
    p = plan(E.queries()["x1_inspect_documents"](spark, SF))
    # no hash shuffle: at most a round-robin spread of a small input
    assert "hashpartitioning" not in p


def test_update_source_check_adds_no_extra_shuffle_of_target(spark):
    p = plan(E.queries()["d2_update_from"](spark, SF))
    assert p.count("Exchange hashpartitioning(c_custkey") <= 2
