"""Properties that hold for any data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill.operators.duplicates import duplicate_groups
from waybill.operators.joins import first_match_join
from waybill.operators.sequences import consecutive_repeats

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEY = st.one_of(st.none(), st.integers(0, 3))
ROUTE = st.tuples(st.integers(0, 2), st.integers(0, 6), st.one_of(st.none(), st.integers(0, 2)))


@QUICK
@given(rows=st.lists(st.tuples(KEY, KEY), max_size=12), lookup=st.lists(st.tuples(KEY, KEY, KEY), max_size=12))
def test_first_match(spark, rows, lookup):
    """Each row once at most, with the value of the first equal key, missing keys being equal."""
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a int, b int")
    right = spark.createDataFrame([(i, *r) for i, r in enumerate(lookup)], "rec_no int, x int, y int, v int")
    found = first_match_join(left, right, [("a", "x"), ("b", "y")], ["v"])
    expected = {}
    for i, row in enumerate(rows):
        match = next((e for e in lookup if e[:2] == row and e != (None, None, None)), None)
        if match is not None:
            expected[i] = match[2]
    got = [(r.id, r.v) for r in found.collect()]
    assert len(got) == len({i for i, _ in got}) and dict(got) == expected


@QUICK
@given(rows=st.lists(ROUTE, max_size=25), seed=st.integers(0, 5))
def test_repeats_do_not_depend_on_row_order(spark, rows, seed):
    data = [(*r, i) for i, r in enumerate(rows)]
    schema = "g int, seq int, code int, rec_no int"
    one = spark.createDataFrame(data, schema)
    two = spark.createDataFrame(data, schema).orderBy(F.rand(seed)).repartition(3)
    find = lambda df: sorted(r.rec_no for r in consecutive_repeats(df, ["g"], ["seq", "rec_no"], "seq", "code").collect())
    assert find(one) == find(two)


@QUICK
@given(names=st.lists(st.sampled_from(["a", "b", "c", None]), max_size=10), extra=st.sampled_from(["a", "b", "c"]))
def test_a_new_row_leaves_other_keys_alone(spark, names, extra):
    def groups(values):
        df = spark.createDataFrame([("z", n, i) for i, n in enumerate(values)], "archive_id string, name string, rec_no long")
        return {r.name: r.findings for r in duplicate_groups(df, ["archive_id", "name"]).collect()}

    before, after = groups(names), groups([*names, extra])
    assert {k: v for k, v in before.items() if k != extra} == {k: v for k, v in after.items() if k != extra}
    assert after.get(extra, 0) >= before.get(extra, 0)
