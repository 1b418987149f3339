"""Set-based fare-type rules engine.

Rules are rows (rule_id, column_name, comparison, value, effective_start,
effective_end).  A rule matches a fact row when all of these hold:

* if it has direct conditions (=, <>, LIKE, NOT LIKE): at least one passes
  and none fails;
* if it has IN conditions: at least one value equals;
* if it has MATCH conditions: at least one pattern is LIKE-true.

A condition on a null attribute neither passes nor fails.  Rules are tried
in ascending id and the first match wins — which is simply the smallest
matching id, so no loop is needed: attributes are unpivoted, joined to the
active conditions once, counted per (row, rule), filtered, and the minimum
rule id is taken.  The work runs over the distinct attribute combinations of
the facts (pre-aggregated map-side), then joins back null-safely.
IN / MATCH values are stored as an XML list ``<v>a</v><v>b</v>``.  LIKE and
MATCH patterns may hold character classes; they become regular expressions
once per condition.

Some rules are decided by a predicate on the row before any other
(``Layer``); ``apply_layered_rules`` puts them in front of the rules above a
given id, which then see only the rows that are still open.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from itinera.functions.text import like_regex

DIRECT = ("=", "<>", "LIKE", "NOT LIKE")
LISTS = ("IN", "MATCH")
ALLOWED = DIRECT + LISTS


def _norm(c: Column) -> Column:
    # text compares ignore case and trailing blanks
    return F.upper(F.rtrim(c))


def active_conditions(rules: DataFrame, as_of) -> DataFrame:
    """Active conditions, list values exploded to one row each."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    act = rules.where((F.col("effective_start") <= as_of) & (F.col("effective_end") >= as_of))
    lists = act.where(F.col("comparison").isin(*LISTS)).select(
        "rule_id", "column_name", "comparison",
        F.explode(F.xpath(F.concat(F.lit("<r>"), F.col("value"), F.lit("</r>")),
                          F.lit("r/v/text()"))).alias("value"))
    direct = act.where(F.col("comparison").isin(*DIRECT)).select(
        "rule_id", "column_name", "comparison", "value")
    both = direct.unionByName(lists).select(
        "rule_id", _norm(F.col("column_name")).alias("column_name"), "comparison",
        _norm(F.col("value")).alias("value"))
    pattern = F.col("comparison").isin("LIKE", "NOT LIKE", "MATCH")
    return both.withColumn("value", F.when(pattern, like_regex(F.col("value"))).otherwise(F.col("value")))


def validate(rules: DataFrame) -> None:
    """Unknown comparison operators abort the run (rules are a small
    configuration table; this reads at most one row)."""
    bad = rules.where(~F.col("comparison").isin(*ALLOWED)).select("comparison").limit(1).collect()
    if bad:
        raise ValueError(f"unknown rule comparison {bad[0][0]!r}")


def apply_rules(facts: DataFrame, attrs: Sequence[str], rules: DataFrame, as_of,
                out: str = "rule_id", check: bool = True, only: Column | None = None) -> DataFrame:
    """Add ``out`` = the smallest matching active rule id (null if none), in
    the type of the rule ids, by one plan whatever the size of the rule table.
    Rows outside ``only`` are not tried; their ``out`` means nothing."""
    if check:
        validate(rules)
    conds = active_conditions(rules, as_of)
    flags = (conds.groupBy("rule_id").agg(
        F.max(F.col("comparison").isin(*DIRECT).cast("int")).alias("_has_d"),
        F.max((F.col("comparison") == "IN").cast("int")).alias("_has_in"),
        F.max((F.col("comparison") == "MATCH").cast("int")).alias("_has_m")))
    attrs = list(attrs)
    # distinct combinations of the rule attributes, as text
    tried = facts if only is None else facts.where(only)
    combos = tried.select(*[F.col(a).cast("string").alias(a) for a in attrs]).distinct()
    long = combos.select(*attrs, F.explode(F.array(*[
        F.struct(F.lit(a.upper()).alias("_name"), _norm(F.col(a)).alias("_val")) for a in attrs
    ])).alias("_kv")).where(F.col("_kv._val").isNotNull())
    j = long.join(conds, long["_kv._name"] == conds["column_name"], "inner")
    v, p, cmp = F.col("_kv._val"), F.col("value"), F.col("comparison")
    holds = (F.when(cmp == "=", v == p).when(cmp == "<>", v != p)
             .when(cmp == "NOT LIKE", ~F.regexp_like(v, p)).when(cmp.isin("LIKE", "MATCH"), F.regexp_like(v, p))
             .when(cmp == "IN", v == p))
    per = j.select(*attrs, "rule_id",
                   (cmp.isin(*DIRECT) & holds).cast("int").alias("_dp"),
                   (cmp.isin(*DIRECT) & ~holds).cast("int").alias("_df"),
                   ((cmp == "IN") & holds).cast("int").alias("_ip"),
                   ((cmp == "MATCH") & holds).cast("int").alias("_mp"))
    cnt = per.groupBy(*attrs, "rule_id").agg(
        F.sum("_dp").alias("_dp"), F.sum("_df").alias("_df"),
        F.sum("_ip").alias("_ip"), F.sum("_mp").alias("_mp"))
    ok = cnt.join(flags, "rule_id").where(
        ((F.col("_has_d") == 0) | ((F.col("_dp") > 0) & (F.col("_df") == 0)))
        & ((F.col("_has_in") == 0) | (F.col("_ip") > 0))
        & ((F.col("_has_m") == 0) | (F.col("_mp") > 0)))
    best = ok.groupBy(*attrs).agg(F.min("rule_id").alias(out))
    best = best.select(*[F.col(a).alias(f"_k_{a}") for a in attrs], out)
    cond = reduce(lambda a, b: a & b,
                  [facts[a].cast("string").eqNullSafe(best[f"_k_{a}"]) for a in attrs])
    res = facts.join(best, cond, "left")
    return res.drop(*[f"_k_{a}" for a in attrs])


class Layer(NamedTuple):
    """A rule that is a predicate on the row, tried in the order of the layers.  It holds only
    while the rule table has all of ``needs`` (column, comparison, value) active, and fills
    rows that are still open, or all of its rows with ``override``."""

    rule_id: int
    when: Column
    needs: Sequence[tuple[str, str, str]] = ()
    override: bool = False


def apply_layered_rules(facts: DataFrame, attrs: Sequence[str], rules: DataFrame, as_of, layers: Sequence[Layer],
                        above: int, out: str = "rule_id") -> DataFrame:
    """Layers first, then the smallest matching rule with an id greater than ``above`` for the
    rows that no layer took.  Whether the layers' conditions are active is one row read from
    the rule table; the layers themselves are one expression."""
    validate(rules)
    needed = sorted({n for layer in layers for n in layer.needs})
    active = {n: True for n in needed}
    if needed:
        day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
        on = (F.col("effective_start") <= day) & (F.col("effective_end") >= day)
        has = [F.coalesce(F.bool_or(on & (_norm(F.col("column_name")) == c.upper()) & (F.col("comparison") == op)
                                    & (_norm(F.col("value")) == v.upper())), F.lit(False)) for c, op, v in needed]
        active = dict(zip(needed, rules.agg(*[h.alias(f"n{i}") for i, h in enumerate(has)]).first()))
    kind = rules.schema["rule_id"].dataType
    taken = F.lit(None).cast(kind)
    for layer in layers:
        if all(active[n] for n in layer.needs):
            hit = F.coalesce(layer.when, F.lit(False))
            taken = F.when(hit if layer.override else hit & taken.isNull(), F.lit(layer.rule_id).cast(kind)).otherwise(taken)
    layered = facts.withColumn("_layer", taken)
    done = apply_rules(layered, attrs, rules.where(F.col("rule_id") > above), as_of, out="_rule", check=False,
                       only=F.col("_layer").isNull())
    return done.withColumn(out, F.coalesce("_layer", "_rule")).drop("_layer", "_rule")


def apply_rule_groups(facts: DataFrame, rule_groups: DataFrame, rule_col: str = "rule_id",
                      target: str = "fare_type_id") -> DataFrame:
    """Fill ``target`` from the matched rule's group where still null."""
    g = rule_groups.select(F.col("rule_id").alias("_rg"), F.col(target).alias("_ft"))
    j = facts.join(g, facts[rule_col] == g["_rg"], "left")
    if target in facts.columns:
        j = j.withColumn(target, F.coalesce(F.col(target), F.col("_ft")))
    else:
        j = j.withColumn(target, F.col("_ft"))
    return j.drop("_rg", "_ft")
