"""Lookup and join operators.

Design rules (see README "Scale"):

* "first row per key" is an aggregate (``min`` over a struct that holds the
  sort key and then the whole row), so Spark combines map-side and a hot key
  never lands as one unsorted group in one task.  The row payload after the
  sort key makes the result total: ties resolve the same way on every run.
* Only literal or domain-bounded tables are broadcast explicitly; every other
  join is left to AQE, which switches to a broadcast from the measured size.
* Inequality-only joins are never built against fact-sized inputs.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from itinera.functions.dates import epoch_micros, minute_index as _minute_index

_ORDERABLE_NEGATE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                     T.DoubleType, T.DecimalType)


def _order_spec(order: Sequence[str]) -> list[tuple[str, bool]]:
    """'col' ascending, '-col' descending."""
    return [(o[1:], False) if o.startswith("-") else (o, True) for o in order]


def _desc_key(df: DataFrame, name: str) -> Column | None:
    """A column whose ascending order is the descending order of ``name``."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, _ORDERABLE_NEGATE):
        return -c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -epoch_micros(c)
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.BooleanType):
        return ~c
    return None


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  method: str = "auto") -> DataFrame:
    """One row per key: the first by ``order`` ('col' asc nulls first,
    '-col' desc nulls last), remaining columns break ties.

    ``method='agg'`` (default when every sort key can be expressed
    ascending) uses a partial aggregate; ``'window'`` uses ``row_number``.
    """
    keys = list(keys)
    spec = _order_spec(order)
    payload = [c for c in df.columns if c not in keys]
    sort_fields = []
    agg_ok = True
    for i, (name, asc) in enumerate(spec):
        if asc:
            sort_fields.append(F.col(name).alias(f"_s{i}"))
        else:
            k = _desc_key(df, name)
            if k is None:
                agg_ok = False
                break
            sort_fields.append(F.col(name).isNull().alias(f"_n{i}"))
            sort_fields.append(k.alias(f"_s{i}"))
    if method == "window" or (method == "auto" and not agg_ok):
        ob = [F.col(n).asc_nulls_first() if a else F.col(n).desc_nulls_last() for n, a in spec]
        ob += [F.col(c).asc_nulls_first() for c in payload if c not in {n for n, _ in spec}]
        w = Window.partitionBy(*keys).orderBy(*ob)
        return (df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))
    if not agg_ok:
        raise ValueError("order cannot be expressed ascending; use method='window'")
    best = F.min(F.struct(*sort_fields, F.struct(*[F.col(c) for c in payload]).alias("_p")))
    out = df.groupBy(*keys).agg(best.alias("_b"))
    return out.select(*keys, *[F.col(f"_b._p.{c}").alias(c) for c in payload])


def latest_lookup(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key (``newest`` are the recency columns, newest first)."""
    return first_per_key(df, keys, [f"-{c}" for c in newest])


def latest_all(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Every row that has the maximum ``col`` of its key (ties kept).

    The maximum is a partial aggregate joined back on (keys, col); a hot key
    is split by AQE's skew-join handling instead of being one window task.
    """
    m = df.groupBy(*keys).agg(F.max(col).alias(col))
    return df.join(m, list(keys) + [col], "left_semi")


def band_join(df: DataFrame, bands: DataFrame, value: str, lo: str, hi: str,
              how: str = "left") -> DataFrame:
    """Join each row to the band whose inclusive [lo, hi] holds ``value``.

    ``bands`` is a literal dimension: it is broadcast, so the range test runs
    as a broadcast nested loop over a handful of rows per input row.
    """
    b = F.broadcast(bands)
    return df.join(b, (F.col(value) >= b[lo]) & (F.col(value) <= b[hi]), how)


def dated_join(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], date: str,
               begin: str, end: str, how: str = "left", broadcast: bool = False) -> DataFrame:
    """Equi join on ``on`` pairs (left col, dim col) plus
    ``dim.begin <= date <= dim.end`` as a residual."""
    d = F.broadcast(dim) if broadcast else dim
    cond = [df[lc] == d[rc] for lc, rc in on]
    cond.append((df[date] >= d[begin]) & (df[date] <= d[end]))
    return df.join(d, reduce(lambda a, b: a & b, cond), how)


def _amount_buckets(amount: Column, pct: Decimal, spread: bool) -> Column:
    """Geometric buckets of an amount, by sign: as wide as the span of all amounts that match
    one (``1 - pct`` to ``1 + pct`` times it), so an amount lies in one bucket and what it may
    match in two neighbours (three where rounding of the logarithm could tell).  Zero only
    matches zero and has a bucket of its own."""
    low, high = math.log1p(-float(pct)), math.log1p(float(pct))
    width, slack = max(high - low, 1e-4), 1e-9
    at = F.ln(F.abs(amount).cast("double"))
    first = F.floor((at + low) / width - slack) if spread else F.floor(at / width)
    last = F.floor((at + high) / width + slack) if spread else first
    # sign and bucket in one number: buckets of amounts stay far below 2**20
    code = lambda b: F.when(amount > 0, b).otherwise(b + F.lit(1 << 21)).cast("int")
    return F.when(amount == 0, F.array(F.lit(1 << 22))).otherwise(F.transform(F.sequence(first, last), code))


def match_within(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                 left_amount: str, right_amount: str, pct) -> DataFrame:
    """Tolerance match: equal keys and |l - r| <= pct * |r|, all pairs; ``pct`` is an exact
    decimal below 1.

    Amounts get geometric buckets, so this is an equi join on (keys, bucket) that compares a
    row with the rows of its own price range only, and a hot key is spread over its buckets.
    The exact test on the decimals follows.  Null keys and amounts match nothing.
    """
    pct = Decimal(str(pct))
    if not 0 <= pct < 1:
        raise ValueError("pct must be at least 0 and below 1")
    # a pair meets in the one bucket of the left amount only, so it comes up once
    l = left.withColumn("_bucket", _amount_buckets(F.col(left_amount), pct, False)[0])
    r = right.withColumn("_bucket", F.explode(_amount_buckets(F.col(right_amount), pct, True)))
    la, ra = l[left_amount], r[right_amount]
    cond = [l[lc] == r[rc] for lc, rc in on] + [l["_bucket"] == r["_bucket"],
                                                F.abs(la - ra) <= F.abs(ra) * F.lit(pct)]
    return l.join(r, reduce(lambda a, b: a & b, cond), "inner").drop("_bucket")


def match_nearest(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_amount: str,
                  right_amount: str, pct, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``left`` with the ``keep`` columns of one right row inside the tolerance: that of the
    smallest difference, then the first by ``order``; null where there is none.

    Only distinct amounts are paired: equal amounts of a key are reduced to their first right
    row and to one left row beforehand, both combined map-side, so a bucket of a hot key holds
    no more rows than there are amounts in its price range, however many rows share the key.
    """
    rk = [rc for _, rc in on]
    offers = first_per_key(right.select(*dict.fromkeys([*rk, right_amount, *_names(order), *keep])), [*rk, right_amount],
                           order).select(*[F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*rk, right_amount, *_names(order), *keep])])
    asked = left.select(*[F.col(lc).alias(f"_l_{lc}") for lc, _ in on], F.col(left_amount).alias("_amount")).distinct()
    pairs = match_within(asked, offers, [(f"_l_{lc}", f"_r_{rc}") for lc, rc in on], "_amount", f"_r_{right_amount}", pct)
    keys = [*[f"_l_{lc}" for lc, _ in on], "_amount"]
    prefixed = [("-_r_" + o[1:]) if o.startswith("-") else "_r_" + o for o in order]
    best = first_per_key(pairs.withColumn("_difference", F.abs(F.col("_amount") - F.col(f"_r_{right_amount}"))),
                         keys, ["_difference", *prefixed])
    best = best.select(*keys, *[F.col(f"_r_{c}").alias(c) for c in keep])
    cond = [left[lc] == best[f"_l_{lc}"] for lc, _ in on] + [left[left_amount] == best["_amount"]]
    return left.join(best, reduce(lambda a, b: a & b, cond), "left").drop(*keys)


def _names(order: Sequence[str]) -> list[str]:
    return [name for name, _ in _order_spec(order)]


def minute_index(ts) -> Column:
    return _minute_index(F.col(ts) if isinstance(ts, str) else ts)


def near_in_time(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                 right_ts: str, minutes: int = 2) -> DataFrame:
    """Pairs with equal keys where right is not before left and fewer than
    ``minutes`` minute boundaries lie between them.

    The time condition becomes an equi-join on a time bucket of width
    ``minutes``: a left row can only reach its own bucket and the next, so it
    is repeated twice and joined on (keys, bucket) with the exact test as a
    residual.  A hot key stays linear in its rows instead of pairing all of
    them.  Right-side key columns are dropped from the output.
    """
    lm = minute_index(left_ts)
    lb = left.withColumn("_mb", F.explode(F.array(F.floor(lm / minutes), F.floor(lm / minutes) + 1)))
    rb = right.withColumn("_mb", F.floor(minute_index(right_ts) / minutes))
    md = minute_index(F.col(right_ts)) - minute_index(F.col(left_ts))
    cond = [lb[k] == rb[k] for k in keys] + [lb["_mb"] == rb["_mb"], rb[right_ts] >= lb[left_ts]]
    j = lb.join(rb, reduce(lambda a, b: a & b, cond), "inner").where(md < minutes)
    j = j.drop(lb["_mb"]).drop(rb["_mb"])
    for k in keys:
        j = j.drop(rb[k])
    return j


def contains_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  text, token, how: str = "inner") -> DataFrame:
    """Equi join plus a containment residual (``charindex(token, text) <> 0``):
    the residual is checked only inside equal keys, never as a cross join."""
    cond = [left[lc] == right[rc] for lc, rc in on]
    cond.append(F.instr(text, token) > 0)
    return left.join(right, reduce(lambda a, b: a & b, cond), how)


def first_match(branches: Iterable[tuple[str, DataFrame]], keys: Sequence[str],
                order: Sequence[str], label: str = "branch") -> DataFrame:
    """Top-1 per key for each branch, then the union of the branches."""
    parts = [first_per_key(d, keys, order).withColumn(label, F.lit(name)) for name, d in branches]
    return reduce(lambda a, b: a.unionByName(b), parts)


def theta_or(left: DataFrame, right: DataFrame, branches: Sequence[Sequence[tuple[str, str]]],
             label: str = "branch") -> DataFrame:
    """``left JOIN right ON (b1) OR (b2) ...`` where each branch is a list of
    equalities.  One equi join per branch; a pair is kept in the first branch
    that matches it, so the union equals the OR join without a nested loop."""
    parts = []
    for i, br in enumerate(branches):
        cond = reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in br])
        for prev in branches[:i]:
            prev_hit = reduce(lambda a, b: a & b,
                              [F.coalesce(left[lc] == right[rc], F.lit(False)) for lc, rc in prev])
            cond = cond & ~prev_hit
        parts.append(left.join(right, cond, "inner").withColumn(label, F.lit(i + 1)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def join_role(df: DataFrame, dim: DataFrame, left_col: str, dim_key: str, prefix: str,
              cols: Sequence[str], how: str = "left", broadcast: bool = False) -> DataFrame:
    """Join a role-playing dimension and prefix its columns."""
    d = dim.select(F.col(dim_key).alias(f"_{prefix}key"),
                   *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    d = F.broadcast(d) if broadcast else d
    return df.join(d, df[left_col] == d[f"_{prefix}key"], how).drop(f"_{prefix}key")


def with_group_total(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Group total beside each row (aggregate + join back, skew-split by AQE)."""
    t = df.groupBy(*keys).agg(F.sum(col).alias(out))
    return df.join(t, list(keys), "left")


def keep_if_exists(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def keep_if_absent(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """``col NOT IN (SELECT other_col FROM other)`` with SQL null semantics
    (a null in ``other`` removes every row; a null ``col`` is removed unless
    ``other`` is empty): an equi anti join, so neither side need be broadcast,
    and two scalar tests of ``other``."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{df}} AS d WHERE NOT EXISTS (SELECT 1 FROM {{other}} AS o WHERE o.`{other_col}` = d.`{col}`) "
        f"AND NOT EXISTS (SELECT 1 FROM {{other}} WHERE `{other_col}` IS NULL) "
        f"AND (d.`{col}` IS NOT NULL OR NOT EXISTS (SELECT 1 FROM {{other}}))",
        df=df, other=other)


def delete_not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """``DELETE FROM df WHERE col NOT IN (SELECT other_col FROM other)``:
    the rows that survive.  A row goes only when the predicate is TRUE, so a
    null ``col`` stays (unless ``other`` is empty) and a null in ``other``
    keeps every row.  Planned as semi / existence joins, no nested loop."""
    spark = df.sparkSession
    return spark.sql(
        f"SELECT * FROM {{df}} WHERE `{col}` IN (SELECT `{other_col}` FROM {{other}}) "
        f"OR (`{col}` IS NULL AND EXISTS (SELECT 1 FROM {{other}})) "
        f"OR EXISTS (SELECT 1 FROM {{other}} WHERE `{other_col}` IS NULL)",
        df=df, other=other)


def link_first(df: DataFrame, children: DataFrame, keys: Sequence[str],
               order: Sequence[str]) -> DataFrame:
    """Attach the first child per key (deduplicated before the join)."""
    return df.join(first_per_key(children, keys, order), list(keys), "left")
