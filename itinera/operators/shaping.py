"""Aggregation and reshaping operators."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from itinera.operators.lookups import first_per_key


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- aggregate expressions -------------------------------------------------

def strict_sum(x) -> Column:
    """Sum that is null when any member is null (count(*) vs count(x))."""
    c = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def guarded_sum(x, limit: int = 32767) -> Column:
    """Sum nulled when its magnitude exceeds ``limit`` (smallint target)."""
    s = F.sum(_c(x))
    return F.when(F.abs(s) <= limit, s)


def has_amount(x) -> Column:
    """1 when the sum is non-zero, else 0 (null sum counts as 0)."""
    return F.when(F.coalesce(F.sum(_c(x)), F.lit(0)) != 0, 1).otherwise(0)


def concat_ordered(value: str, order: Sequence[str], sep: str) -> Column:
    """Ordered string concatenation (``listagg ... WITHIN GROUP``).  Plain
    text, no XML escaping.  The group must be bounded by the domain (the
    legs of one ticket); the aggregate buffers the group's values."""
    ob = ", ".join(f"`{o[1:]}` DESC" if o.startswith("-") else f"`{o}`" for o in order)
    sep_sql = sep.replace("'", "''")
    return F.expr(f"listagg(`{value}`, '{sep_sql}') WITHIN GROUP (ORDER BY {ob})")


# ---- frame operators -------------------------------------------------------

def pivot_sum(df: DataFrame, keys: Sequence[str], name: str, value: str,
              names: Sequence[str], prefix: str = "") -> DataFrame:
    """Type -> amount columns.  ``names`` is the fixed list, so Spark does not
    run a job to discover the pivot values."""
    out = df.groupBy(*keys).pivot(name, list(names)).agg(F.sum(value))
    for n in names:
        out = out.withColumnRenamed(n, f"{prefix}{n}")
    return out


def unpivot_nonnull(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str,
                    value: str, value_type: str | None = None) -> DataFrame:
    """Columns -> (name, value) rows with null values dropped."""
    src = df if value_type is None else df.select(
        *ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return (src.unpivot(list(ids), list(cols), name, value)
            .where(F.col(value).isNotNull()))


def mode_with_priority(df: DataFrame, keys: Sequence[str], value: str,
                       priority: Mapping[str, int], out: str = "mode",
                       default_priority: int = 1 << 30) -> DataFrame:
    """Most frequent ``value`` per key; ties go to the lowest priority, then
    the smallest value.  Two partial aggregates, no per-key sort."""
    pairs = []
    for k, v in priority.items():
        pairs += [F.lit(k), F.lit(v)]
    pr = F.coalesce(F.create_map(*pairs)[F.col(value)], F.lit(default_priority))
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("_n")).withColumn("_pr", pr))
    best = counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("_a"), F.col("_pr").alias("_b"),
                       F.col(value).alias("_v"))).alias("_m"))
    return best.select(*keys, F.col("_m._v").alias(out), (-F.col("_m._a")).alias(f"{out}_cnt"))


def mode_by_levels(df: DataFrame, levels: Sequence[Sequence[str]], value: str,
                   priority: Mapping[str, int], out: str = "mode",
                   default_priority: int = 1 << 30) -> DataFrame:
    """``mode_with_priority`` for several key sets in one pass (like
    GROUPING SETS): every row is expanded once per level into
    (level, key columns of that level, others null), counted in one
    aggregate and reduced to the mode per (level, keys).  The input is read
    once whatever the number of fallback levels.  Output: level (1-based),
    the union of key columns, ``out``."""
    all_keys = []
    for lv in levels:
        for k in lv:
            if k not in all_keys:
                all_keys.append(k)
    items = [F.struct(F.lit(i + 1).alias("_lvl"),
                      *[(F.col(k) if k in lv else F.lit(None).cast(df.schema[k].dataType)).alias(k)
                        for k in all_keys]) for i, lv in enumerate(levels)]
    x = (df.where(F.col(value).isNotNull())
         .select(F.explode(F.array(*items)).alias("_g"), F.col(value))
         .select("_g.*", value))
    pairs = []
    for k, v in priority.items():
        pairs += [F.lit(k), F.lit(v)]
    pr = F.coalesce(F.create_map(*pairs)[F.col(value)], F.lit(default_priority)) if pairs else F.lit(default_priority)
    counts = x.groupBy("_lvl", *all_keys, value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_pr", pr)
    best = counts.groupBy("_lvl", *all_keys).agg(
        F.min(F.struct((-F.col("_n")).alias("_a"), F.col("_pr").alias("_b"), F.col(value).alias("_v"))).alias("_m"))
    return best.select(F.col("_lvl").alias("level"), *all_keys, F.col("_m._v").alias(out))


def first_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               cols: Sequence[str], first_prefix: str = "first_",
               last_prefix: str = "last_", extra: Sequence[Column] = ()) -> DataFrame:
    """Attributes of the first and last row of each group (partial aggregates
    over (order, payload) structs); ``extra`` aggregates (aliased) are
    computed in the same pass."""
    st = F.struct(*[F.col(o) for o in order], F.struct(*[F.col(c) for c in cols]).alias("_p"))
    g = df.groupBy(*keys).agg(F.min(st).alias("_f"), F.max(st).alias("_l"), *extra)
    extra_names = [c for c in g.columns if c not in set(keys) | {"_f", "_l"}]
    return g.select(*keys, *[F.col(f"_f._p.{c}").alias(f"{first_prefix}{c}") for c in cols],
                    *[F.col(f"_l._p.{c}").alias(f"{last_prefix}{c}") for c in cols], *extra_names)


def geometry_type(n_legs, n_fares) -> Column:
    """0 NA, 1 OW, 2 RT (or 2OW when the two legs are two fares), else MD."""
    n, f = _c(n_legs), _c(n_fares)
    return (F.when(n == 0, "NA").when(n == 1, "OW")
            .when((n == 2) & (f == 2), "2OW").when(n == 2, "RT").otherwise("MD"))


def dedupe_two_pass(df: DataFrame, equal_cols: Sequence[str], newest: str,
                    group_keys: Sequence[str], amount: str, out: str) -> DataFrame:
    """Among rows equal on ``equal_cols`` keep those of the newest ``newest``
    value, then sum ``amount`` per ``group_keys``.  A row with a null in an
    equal column or in ``newest`` equals no other row and is kept."""
    m = df.groupBy(*equal_cols).agg(F.max(newest).alias(newest))
    alone = F.lit(False)
    for c in [*equal_cols, newest]:
        alone = alone | F.col(c).isNull()
    kept = df.join(m, list(equal_cols) + [newest], "left_semi").unionByName(df.where(alone))
    return kept.groupBy(*group_keys).agg(F.sum(amount).alias(out),
                                         F.count(F.lit(1)).alias(f"{out}_rows"))


def prorate(df: DataFrame, keys: Sequence[str], weight: str, amount: str, out: str) -> DataFrame:
    """``weight / sum(weight) * amount`` per key; null when any weight of the
    key is missing, the total is 0 or the key is null."""
    tot = df.groupBy(*keys).agg(strict_sum(weight).alias("_tw"))
    return (df.join(tot, list(keys), "left")
            .withColumn(out, F.when(F.coalesce(F.col("_tw"), F.lit(0)) != 0,
                                    F.col(weight) * F.col(amount) / F.col("_tw")))
            .drop("_tw"))


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def groups_to_rows(df: DataFrame, ids: Sequence[str],
                   groups: Mapping[str, tuple[Mapping[str, Column], Column]],
                   label: str = "group") -> DataFrame:
    """Column groups -> rows, each group with its own keep-if filter, in one
    scan (an array of structs exploded), instead of one UNION branch per
    group."""
    names = None
    items = []
    for g, (cols, keep) in groups.items():
        if names is None:
            names = list(cols)
        items.append(F.struct(F.lit(g).alias(label), keep.alias("_keep"),
                              *[cols[n].alias(n) for n in names]))
    out = df.select(*ids, F.explode(F.array(*items)).alias("_g"))
    return out.where("_g._keep").select(*ids, F.col(f"_g.{label}").alias(label),
                                        *[F.col(f"_g.{n}").alias(n) for n in names])


def min_by_priority(df: DataFrame, keys: Sequence[str], priority: Column,
                    then: Sequence[str]) -> DataFrame:
    """Dominance: the row no other row of the key beats on (priority, then)."""
    d = df.withColumn("_prio", priority)
    return first_per_key(d, keys, ["_prio", *then]).drop("_prio")
