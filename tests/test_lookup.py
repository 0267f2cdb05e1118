import pytest

from cinderline.operators.lookup import left_lookup


@pytest.mark.parametrize("more", [{}, {"broadcast_rows": 0, "salts": 3}])
def test_left_lookup_keeps_every_row(spark, more):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (9, "z")], "k int, w string")
    assert sorted(map(tuple, left_lookup(left, right, "k", **more).collect()), key=str) == sorted([(1, "a", "x"), (1, "a", "x"), (2, "b", "y"), (3, "d", None), (None, "c", None)], key=str)
    assert left_lookup(left, right.limit(0), "k", **more).count() == 5
    assert left_lookup(left.limit(0), right, "k", **more).count() == 0
