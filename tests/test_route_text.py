"""The memory of q_route_text's tasks: partitions that follow the lines, legs sorted once."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from itinera.plans import driver_queries as Q


@pytest.fixture
def tables(spark, tmp_path):
    """400 orders of 0 to 6 lines; supplier 1 has most lines, one line and one order have no
    partner, some keys are null, one line comes twice."""
    day = dt.datetime(1995, 1, 1)
    lines = [(o if o != 7 else None, o % 13, 1 if o % 3 else (n + o) % 5 + 1, n % 3, float(n), 10.0 * o + n)
             for o in range(400) for n in range(o % 7)]
    lines += [(5, 1, 99, 0, 1.0, 1.0), (5, 1, None, 0, 1.0, 1.0), (9999, 1, 1, 0, 1.0, 1.0), lines[-1]]
    orders = [(o, o % 11 if o != 8 else None, day) for o in range(400)]
    customers = [(k, k % 4) for k in range(10)]
    suppliers = [(k, k % 3) for k in range(1, 6)]
    for name, rows, schema in (
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
            ("customer", customers, "c_custkey long, c_nationkey int"),
            ("supplier", suppliers, "s_suppkey long, s_nationkey int")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path), lines, dict((o[0], o[1]) for o in orders), dict(customers), dict(suppliers)


def routes(lines, orders, customers, suppliers):
    legs = {}
    for o, part, s, n, q, price in lines:
        c = customers.get(orders.get(o)) if o is not None else None
        if c is not None and s in suppliers:
            legs.setdefault(o, []).append(((n, part, s, q, price), f"N{suppliers[s]}", f"N{c}"))
    out = {}
    for o, own in legs.items():
        own.sort()
        text, to, turn, before = f"{own[0][1]}/{own[0][2]}", own[-1][2], None, own[0]
        for leg in own[1:]:
            text += f"/{leg[2]}" if before[2] == leg[1] else f"_{leg[1]}/{leg[2]}"
            if turn is None and ((leg[1], leg[2]) == (before[2], before[1]) or leg[1] != before[2]):
                turn = before[2]
            before = leg
        out[o] = (text[:150], own[0][1], turn or to, len(own), 1)
    return out


@pytest.mark.parametrize("rows", [50, 10**6])
def test_tasks_follow_the_lines(spark, tables, monkeypatch, request, rows):
    at, lines, *dims = tables
    monkeypatch.setattr(Q, "ROWS_PER_TASK", rows, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # tables of a size that no join broadcasts
    r = Q.q_route_text(spark, at)
    got = {x[0]: tuple(x[1:]) for x in r.collect()}
    assert got == routes(lines, *dims) and len(got) > 250
    j = Q._line_nations(spark, at)
    if rows == 50:
        assert len(lines) > 1000 and j.rdd.getNumPartitions() == -(-len(lines) // 50)
        dealt = j.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert dealt < 4 * rows
    else:
        assert j.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_legs_are_sorted_once(spark, tables, capsys):
    Q.q_route_text(spark, tables[0]).explain()
    plan = capsys.readouterr().out
    assert len(re.findall(r"\bSort \[[^\]]*record_key#", plan)) == 1 and "segment_nbr#" in plan


def test_shares_of_a_frequent_supplier(spark, tables, monkeypatch, capsys):
    """Above the bound, supplier 1's lines go to several tasks when they meet the supplier."""
    monkeypatch.setattr(Q, "ROWS_PER_TASK", 50, raising=False)
    Q._line_nations(spark, tables[0]).explain()
    assert re.search(r"hashpartitioning\(l_suppkey#\d+L, _share#\d+", capsys.readouterr().out)
