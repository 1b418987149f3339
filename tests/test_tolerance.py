"""Tolerance matching (J17, D90) against all pairs."""

from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from itinera import operators as O

PCT = D("0.03")


def rows(rnd, n, keys, first):
    """Amounts in cents around each other, with zeros, negatives, nulls and exact bounds."""
    base = [D(0), D("100"), D("97"), D("103"), D("-100"), D("-97"), D("0.01"), D("0.03"), D("999999999.99"), None]
    out = []
    for i in range(n):
        a = base[rnd.integers(len(base))] if rnd.random() < 0.4 else D(int(rnd.integers(8_000, 13_000))) / 100
        out.append((None if rnd.random() < 0.03 else int(rnd.integers(keys)), a, first + i))
    return out


def fits(l, r):
    return None not in (l[0], l[1], r[1]) and l[0] == r[0] and abs(l[1] - r[1]) <= abs(r[1]) * PCT


@pytest.mark.parametrize("keys", [1, 7])
def test_all_pairs_and_nearest(spark, keys):
    rnd = np.random.default_rng(keys)
    left, right = rows(rnd, 300, keys, 0), rows(rnd, 200, keys, 1000)
    l = spark.createDataFrame(left, "k int, amount decimal(19,4), id int")
    r = spark.createDataFrame(right, "k int, amount decimal(19,4), id int").select(F.col("k").alias("rk"), F.col("amount").alias("ra"), F.col("id").alias("rid"))
    got = sorted((x.id, x.rid) for x in O.match_within(l, r, [("k", "rk")], "amount", "ra", PCT).collect())
    assert got == sorted((a[2], b[2]) for a in left for b in right if fits(a, b))
    want = {a[2]: min(((abs(a[1] - b[1]), -b[2]) for b in right if fits(a, b)), default=(None, None))[1] for a in left}
    near = O.match_nearest(l, r, [("k", "rk")], "amount", "ra", PCT, ["-rid"], ["rid"]).collect()
    assert len(near) == len(left) and {x.id: x.rid and -x.rid for x in near} == want


def test_repeated_rows_stay_and_do_not_pair_up(spark):
    """A hot key: equal amounts are paired once."""
    l = spark.createDataFrame([(1, D("100.00"))] * 400 + [(1, D("101.00"))] * 400, "k int, amount decimal(19,4)")
    r = spark.createDataFrame([(1, D("100.50"), i) for i in range(500)], "k int, ra decimal(19,4), rid int").withColumnRenamed("k", "rk")
    out = O.match_nearest(l, r, [("k", "rk")], "amount", "ra", PCT, ["rid"], ["rid", "ra"])
    assert out.groupBy("amount", "rid").count().orderBy("amount").collect() == [(D("100.0000"), 0, 400), (D("101.0000"), 0, 400)]


def test_odd_tolerances(spark):
    l = spark.createDataFrame([(1, D("5"))], "k int, amount decimal(19,4)")
    r = spark.createDataFrame([(1, D("5")), (1, D("4.9999"))], "rk int, ra decimal(19,4)")
    assert [x.ra for x in O.match_within(l, r, [("k", "rk")], "amount", "ra", 0).collect()] == [D("5.0000")]
    with pytest.raises(ValueError):
        O.match_within(l, r, [("k", "rk")], "amount", "ra", 1)
