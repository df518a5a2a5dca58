"""Property tests on generated inputs (few examples: each is a Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import merge as M
from tessera.operators.index import row_index

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=0, max_size=60),
       st.sets(st.integers(-50, 50), max_size=30))
def test_star_merge_keeps_rows_with_unique_keys(spark, main_keys, res_keys):
    main = spark.createDataFrame([(k, i) for i, k in enumerate(main_keys)], "k int, i int")
    res = spark.createDataFrame([(k, f"v{k}") for k in sorted(res_keys)], "k int, v string")
    out = M.star_merge(main, [M.Relation("r", res, "k", "k")])
    rows = out.collect()
    assert len(rows) == len(main_keys)
    assert all((r["v"] is None) == (r["k"] not in res_keys) for r in rows)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", max_size=3)), min_size=0, max_size=80),
       st.integers(1, 9))
def test_row_index_permutation_in_order(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b string")
    got = row_index(df, ["a", "b"], num_partitions=parts).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(len(rows)))
    keys = [(r["a"], r["b"]) for r in got]
    assert keys == sorted(keys)
