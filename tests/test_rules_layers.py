"""Layers before the rule table, bounds, classes."""

import datetime as dt

from pyspark.sql import functions as F

from itinera import operators as O
from itinera.plans.extract_job import FIRST_TABLE_RULE, fare_type_layers

DAY = dt.date(2024, 6, 1)
ON = (dt.date(2000, 1, 1), dt.date(2100, 1, 1))
OFF = (dt.date(2000, 1, 1), dt.date(2001, 1, 1))
RULE = "rule_id int, column_name string, comparison string, value string, effective_start date, effective_end date"
SWITCHES = [(100, "Meta_ID", "LIKE", "MA%"), (200, "Service_Group", "=", "6"), (250, "Service_Group", "<>", "1"),
            (250, "Resource_Type", "<>", "0")]
FACT = ("id int, meta_id string, service_group int, resource_type int, business_sub_category int, fare_type_id int, code string")


def run(spark, rules):
    facts = spark.createDataFrame([
        (1, "MA77", 1, 0, 0, 0, "a1"), (2, "MA77", 6, 0, 0, 0, "a1"), (3, "M1", 6, 0, 12, 5, "a1"), (4, "MA1", 1, 0, 12, 5, "a1"),
        (5, "M1", 2, 0, 0, 0, "a1"), (6, "M1", 1, 1, 0, 0, "a1"), (7, "M1", 1, 0, 12, 0, "x1"), (8, "M1", 1, 0, 0, 0, "z1"),
        (9, None, None, None, None, None, None)], FACT)
    df = spark.createDataFrame([(*r, *(ON if len(r) == 4 else r[4:])) if len(r) == 4 else r for r in rules], RULE)
    out = O.apply_layered_rules(facts, ["code"], df, DAY, fare_type_layers(facts), FIRST_TABLE_RULE)
    assert set(out.columns) == {*facts.columns, "rule_id"}
    return {r.id: r.rule_id for r in out.collect()}


def test_layers_in_order(spark):
    table = [(260, "code", "=", "z1"), (262, "code", "LIKE", "[a-x]1"), (261, "code", "MATCH", "<v>[^a-w]1</v>")]
    # 200 overrides -1 and 100; -1 holds against 100; a rule at the bound is not searched; 261 before 262
    assert run(spark, SWITCHES + table) == {1: 100, 2: 200, 3: 200, 4: -1, 5: -2, 6: -2, 7: 261, 8: 261, 9: None}


def test_layers_need_their_active_conditions(spark):
    off = [(*r, *OFF) for r in SWITCHES]
    table = [(262, "code", "LIKE", "[a-x]1")]
    assert run(spark, off + table) == {1: 262, 2: 262, 3: -1, 4: -1, 5: 262, 6: 262, 7: 262, 8: None, 9: None}
    half = [(250, "Service_Group", "<>", "1")]                    # -2 needs both of its conditions
    assert run(spark, half + table)[5] == 262


def test_no_rules_at_all(spark):
    assert run(spark, SWITCHES[:0] + [(300, "code", "=", "none")]) == {1: None, 2: None, 3: -1, 4: -1, 5: None, 6: None, 7: None, 8: None, 9: None}
