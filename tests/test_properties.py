from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from quarry.operators import relational as R
from quarry.operators import tables as D

keys = st.one_of(st.none(), st.integers(0, 6))
pairs = st.lists(st.tuples(keys, st.integers(0, 100)), max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(left=pairs, right=pairs)
def test_reconcile_is_both_anti_joins(spark, left, right):
    a = spark.createDataFrame(left, "k int, v int").select("k").distinct()
    b = spark.createDataFrame(right, "k2 int, w int").select("k2").distinct()
    rec = sorted(str((r.k, r.k2)) for r in R.reconcile(a, b, "k", "k2").collect())
    expect = [str((r.k, None)) for r in a.join(b, a.k == b.k2, "left_anti").collect()] + \
             [str((None, r.k2)) for r in b.join(a, a.k == b.k2, "left_anti").collect()]
    assert rec == sorted(expect)


@SETTINGS
@given(left=pairs, right=pairs)
def test_left_only_plus_matched_is_left(spark, left, right):
    a = spark.createDataFrame(left, "k int, v int")
    b = spark.createDataFrame(right, "k2 int, w int")
    lo = R.left_only(a, b, {"k": "k2"}).count()
    matched = a.join(b, a.k == b.k2, "left_semi").count()
    assert lo + matched == len(left)


@SETTINGS
@given(target=pairs, source=st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9)), max_size=6))
def test_update_from_keeps_rows_and_takes_matched_values(spark, target, source):
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, nv int")
    out = D.update_from(t, s, "k", {"v": "nv"}).collect()
    assert len(out) == len(target)
    expect = [(k, source[k] if k in source else v) for k, v in target]
    assert sorted(((r.k, r.v) for r in out), key=str) == sorted(expect, key=str)
