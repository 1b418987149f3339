"""DuckDB oracle SQL for every driver-table query (same column names)."""

from __future__ import annotations

import datetime as dt

from itinera.plans import literals as L

M = "DECIMAL(18,2)"
LID = "l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey"


def _v(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    if isinstance(x, dt.datetime):
        return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"
    if isinstance(x, dt.date):
        return f"DATE '{x:%Y-%m-%d}'"
    return repr(x)


def values(rows, cols, casts=None) -> str:
    casts = casts or {}
    out = []
    for r in rows:
        out.append("(" + ", ".join(
            f"CAST({_v(v)} AS {casts[c]})" if c in casts else _v(v) for v, c in zip(r, cols)) + ")")
    return f"(SELECT * FROM (VALUES {', '.join(out)}) t({', '.join(cols)}))"


def _case(col, mapping, default="NULL") -> str:
    whens = " ".join(f"WHEN {_v(k)} THEN {_v(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


NC = values(L.nation_currency(), ["n_nationkey", "currency"])
FX = values(L.fx_rates(), ["time_id", "from_currency", "to_currency", "rate"],
            {"rate": "DECIMAL(19,8)"})
BANDS = values(L.ADVANCE_BANDS, ["band_id", "start_day", "end_day"])
YEAR_TID = "CAST(strftime(date_trunc('year', o.o_orderdate), '%Y%m%d') AS INTEGER)"


def _fx(join):
    return f"""
SELECT o.o_orderkey, nc.currency, fx.rate AS fx_rate,
       CAST(CAST(o.o_totalprice AS {M}) * coalesce(fx.rate, CAST(0 AS DECIMAL(19,8))) AS {M}) AS amount_eur
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN {NC} nc ON c.c_nationkey = nc.n_nationkey
{join} {FX} fx ON fx.time_id = {YEAR_TID} AND fx.from_currency = nc.currency AND fx.to_currency = 'EUR'
"""


ADV = """CASE
  WHEN bt = 1 AND (date_diff('day', coalesce(bd, idt), ts) < -365 OR date_diff('day', coalesce(bd, idt), ts) > 365) THEN 0
  WHEN bt = 1 AND date_diff('day', bd, idt) < 0 THEN date_diff('day', idt, ts)
  WHEN bt = 1 THEN date_diff('day', coalesce(bd, idt), ts)
  WHEN bt = 5 AND date_diff('day', bd, idt) < 0 AND date_diff('day', idt, ts) < 0 THEN -1
  WHEN bt = 5 AND date_diff('day', bd, idt) < 0 THEN date_diff('day', idt, ts)
  WHEN bt = 5 THEN date_diff('day', coalesce(bd, idt), ts)
  ELSE NULL END"""

ADV_SRC = f"""SELECT {LID}, l.l_returnflag, l.l_extendedprice, o.o_custkey, o.o_orderdate,
       CASE l.l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 5 END AS bt,
       l.l_shipdate AS bd, o.o_orderdate AS idt,
       CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity * 7 AS INTEGER) AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

LINE_NATIONS = """lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

SESSIONS = """
e AS (SELECT user_id, event_id, ts, event_type, value,
             lag(ts) OVER w AS pts, lag(event_type) OVER w AS ptype
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT *, CASE WHEN pts IS NULL THEN 1
                     WHEN epoch_us(ts) - epoch_us(pts) > 21600000000 THEN 1
                     WHEN epoch_us(ts) - epoch_us(pts) > 14400000000 AND event_type <> 'error' AND ptype <> 'error' THEN 1
                     ELSE 0 END AS brk FROM e),
s AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_nbr FROM f)"""

GEO_SINGLE = values([(n, t, L.GEO_PRIORITY[t]) for n, t in L.geo_country()],
                    ["g_nation", "g_type", "g_prio"])
GEO_PAIRS = values([(a, b, 6) for a, b in L.GEO_PAIRS], ["p_from", "p_to", "p_type"])
JT, JP = L.GEO_DEFAULT, L.GEO_PRIORITY[L.GEO_DEFAULT]
GEO = f"""
SELECT {LID}, CAST(CASE
  WHEN p.p_type IS NOT NULL THEN p.p_type
  WHEN f.g_prio IS NOT NULL AND h.g_prio IS NOT NULL THEN CASE WHEN f.g_prio < h.g_prio THEN f.g_type ELSE h.g_type END
  WHEN f.g_prio IS NULL AND h.g_prio IS NOT NULL THEN CASE WHEN {JP} < h.g_prio THEN {JT} ELSE h.g_type END
  WHEN f.g_prio IS NOT NULL AND h.g_prio IS NULL THEN CASE WHEN {JP} < f.g_prio THEN {JT} ELSE f.g_type END
  ELSE {JT} END AS INTEGER) AS geography_type_id
FROM {LINE_NATIONS}
LEFT JOIN {GEO_SINGLE} f ON c.c_nationkey = f.g_nation
LEFT JOIN {GEO_SINGLE} h ON s.s_nationkey = h.g_nation
LEFT JOIN {GEO_PAIRS} p ON s.s_nationkey = p.p_from AND c.c_nationkey = p.p_to"""

RULES = values(L.RULES, ["rule_id", "column_name", "comparison", "value", "effective_start", "effective_end"])
RULE_GROUPS = values(L.RULE_GROUPS, ["rule_id", "fare_type_id"])
RULE_ATTRS = ["l_returnflag", "l_linestatus", "p_brand", "p_type", "p_size", "disc_flag"]

MODE = """(SELECT {keys}, l_returnflag AS {out} FROM (
   SELECT {keys}, l_returnflag, row_number() OVER (PARTITION BY {keys}
          ORDER BY count(*) DESC, """ + _case("l_returnflag", L.FLAG_PRIORITY, str(1 << 30)) + """, l_returnflag) AS rn
   FROM hist GROUP BY {keys}, l_returnflag) WHERE rn = 1)"""

OFFS = values(L.nation_utc_offset(), ["n", "std_offset"])
DST = values(L.daylight_saving(), ["d_n", "dst_begin", "dst_end", "dst_offset"])
UTC = f"""
u0 AS (SELECT {LID}, l.l_returnflag,
        o.o_orderdate - to_minutes(dep.std_offset + coalesce(d1.dst_offset, 0)) AS dep_utc,
        l.l_shipdate - to_minutes(arr.std_offset + coalesce(d2.dst_offset, 0)) AS arr_utc,
        dep.std_offset + coalesce(d1.dst_offset, 0) AS dep_offset_min,
        arr.std_offset + coalesce(d2.dst_offset, 0) AS arr_offset_min
  FROM {LINE_NATIONS}
  JOIN {OFFS} dep ON c.c_nationkey = dep.n JOIN {OFFS} arr ON s.s_nationkey = arr.n
  LEFT JOIN {DST} d1 ON c.c_nationkey = d1.d_n AND o.o_orderdate BETWEEN d1.dst_begin AND d1.dst_end
  LEFT JOIN {DST} d2 ON s.s_nationkey = d2.d_n AND l.l_shipdate BETWEEN d2.dst_begin AND d2.dst_end),
u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(dep_offset_min AS INTEGER) AS dep_offset_min, CAST(arr_offset_min AS INTEGER) AS arr_offset_min,
        CAST(CASE WHEN abs(date_diff('day', dep_utc, arr_utc)) < 22 THEN date_diff('minute', dep_utc, arr_utc) END
             * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS BIGINT) AS duration_min
  FROM u0)"""

COORDS = values(L.nation_coords(), ["n", "lat", "lon"])
R2 = 2 * 3958.8

SQL = {
"q_seed_fact": f"""
SELECT record_key, booking_type_id, o_orderstatus FROM (
  SELECT o_orderkey AS record_key,
         CAST(coalesce({_case('o_orderpriority', L.PRIORITY_BOOKING_TYPE)}, 0) AS INTEGER) AS booking_type_id,
         o_orderstatus
  FROM orders WHERE o_orderstatus IN ('P', 'O')) s
WHERE NOT coalesce(booking_type_id NOT IN (SELECT booking_type_id FROM {values([(b,) for b in L.BOOKING_TYPES], ['booking_type_id'])} b), false)""",

"q_not_in": """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",

"q_fx_convert": _fx("LEFT JOIN"),
"q_fx_inner": _fx("JOIN"),

"q_band_join": f"""
WITH j AS (SELECT {LID}, CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS advance_days
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT j.l_orderkey, j.l_linenumber, j.l_partkey, j.l_suppkey, j.advance_days,
       CAST(CASE WHEN j.advance_days IS NULL THEN -1 WHEN j.advance_days < 0 THEN 99
                 ELSE coalesce(b.band_id, -1) END AS INTEGER) AS band_id
FROM j LEFT JOIN {BANDS} b ON j.advance_days BETWEEN b.start_day AND b.end_day""",

"q_advance_days": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(bt AS INTEGER) AS booking_type_id,
       CAST({ADV} AS INTEGER) AS advance_days
FROM ({ADV_SRC}) x""",

"q_dated_join": f"""
SELECT o.o_orderkey, coalesce(t.tier_id, 0) AS tier_id
FROM orders o LEFT JOIN {values(L.priority_tiers(), ['tier_key', 'effective_begin', 'effective_end', 'tier_id'])} t
  ON o.o_orderpriority = t.tier_key AND CAST(o.o_orderdate AS DATE) BETWEEN t.effective_begin AND t.effective_end""",

"q_asof": """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
c AS (SELECT event_id AS click_id, user_id, ts AS click_ts, value AS click_value FROM events WHERE event_type = 'click'),
m AS (SELECT p.event_id, c.click_id, c.click_value,
             row_number() OVER (PARTITION BY p.event_id ORDER BY c.click_ts DESC, c.click_id DESC) AS rn
      FROM p JOIN c ON p.user_id = c.user_id AND c.click_ts <= p.ts)
SELECT p.event_id AS purchase_id, p.user_id, m.click_id, m.click_value
FROM p LEFT JOIN m ON m.event_id = p.event_id AND m.rn = 1""",

"q_latest_lookup": f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT c.c_custkey, r.o_orderkey AS latest_orderkey, CAST(r.o_orderdate AS DATE) AS latest_order_date,
       CAST(r.o_totalprice AS {M}) AS latest_total
FROM customer c LEFT JOIN r ON r.o_custkey = c.c_custkey AND r.rn = 1""",

"q_latest_all": """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM (
  SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS mx FROM orders) WHERE o_orderdate = mx""",

"q_first_match": """
SELECT user_id, branch, event_id, value FROM (
  SELECT user_id, event_type AS branch, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type IN ('purchase', 'signup')) WHERE rn = 1""",

"q_first_per_key": """
SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_orderkey, l_linenumber,
      l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
      l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",

"q_capped_seq": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       least(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
             l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate), 5) AS seq
FROM lineitem""",

"q_anti": """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""",

"q_semi": """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)""",

"q_exists_flags": """
SELECT user_id, has_purchase, has_error, has_signup,
       CAST(CASE WHEN has_purchase AND NOT has_error THEN 1 WHEN has_error THEN 2 ELSE 3 END AS INTEGER) AS channel
FROM (SELECT user_id, bool_or(event_type = 'purchase') AS has_purchase, bool_or(event_type = 'error') AS has_error,
             bool_or(event_type = 'signup') AS has_signup FROM events GROUP BY user_id)""",

"q_self_next": """
SELECT event_id, user_id, lead(event_id) OVER w AS next_event_id, lead(event_type) OVER w AS next_type,
       epoch_us(lead(ts) OVER w) - epoch_us(ts) AS gap_us
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",

"q_theta_or": f"""
SELECT {LID}, o.o_orderkey, o.o_custkey, CASE WHEN o.o_orderkey = l.l_orderkey THEN 1 ELSE 2 END AS branch
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey OR o.o_orderkey = l.l_partkey""",

"q_role_join": f"""
SELECT {LID}, cn.n_name AS cust_nation, sn.n_name AS supp_nation
FROM {LINE_NATIONS} JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey""",

"q_match_within": f"""
WITH j AS (SELECT {LID}, CAST(l.l_extendedprice AS {M}) AS paid,
                  CAST(p.p_retailprice AS {M}) * CAST(l.l_quantity AS {M}) AS ref
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, paid, CAST(ref AS {M}) AS reference,
       CAST(paid - ref AS {M}) AS difference
FROM j WHERE abs(paid - ref) <= ref * CAST({L.SAVINGS_PCT} AS DECIMAL(4,2))""",

"q_match_nearest": f"""
WITH l AS (SELECT {LID}, l.l_returnflag, CAST(l.l_extendedprice AS {M}) AS paid FROM lineitem l),
j AS (SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.paid, f.l_orderkey AS match_orderkey,
             f.l_linenumber AS match_linenumber, f.l_partkey AS match_partkey, f.paid AS match_amount,
             row_number() OVER (PARTITION BY t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey
                                ORDER BY abs(t.paid - f.paid), f.paid, f.l_orderkey, f.l_linenumber, f.l_partkey) AS rn
      FROM l t LEFT JOIN l f ON f.l_suppkey = t.l_suppkey AND f.l_returnflag = 'R'
           AND abs(t.paid - f.paid) <= abs(f.paid) * CAST({L.SAVINGS_PCT} AS DECIMAL(4,2))
      WHERE t.l_returnflag <> 'R')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, paid, match_orderkey, match_linenumber, match_partkey, match_amount
FROM j WHERE rn = 1""",

"q_near_in_time": """
SELECT c.event_id AS click_id, e.event_id AS error_id, c.user_id, date_diff('minute', c.ts, e.ts) AS minutes_apart
FROM events c JOIN events e ON c.user_id = e.user_id AND e.ts >= c.ts AND date_diff('minute', c.ts, e.ts) < 120
WHERE c.event_type = 'click' AND e.event_type = 'error'""",

"q_strict_sum": f"""
SELECT l_orderkey,
       CAST(CASE WHEN count(*) = count(t) THEN sum(t) END AS {M}) AS tax_sum, count(*) AS n_lines
FROM (SELECT l_orderkey, CAST(nullif(l_tax, 0.0) AS {M}) AS t FROM lineitem) GROUP BY l_orderkey""",

"q_prorate": f"""
WITH j AS (SELECT {LID}, o.o_totalprice, CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_quantity END AS weight
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
t AS (SELECT l_orderkey, CASE WHEN count(*) = count(weight) THEN sum(weight) END AS tw FROM j GROUP BY l_orderkey)
SELECT j.l_orderkey, j.l_linenumber, j.l_partkey, j.l_suppkey,
       CASE WHEN coalesce(t.tw, 0) <> 0 THEN j.weight * j.o_totalprice / t.tw END AS line_value
FROM j JOIN t ON j.l_orderkey = t.l_orderkey""",

"q_pivot_sum": "SELECT user_id, " + ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{t}' THEN CAST(value AS {M}) END) AS {M}) AS amt_{t}"
    for t in L.EVENT_TYPES) + " FROM events GROUP BY user_id",

"q_has_amount": "SELECT user_id, " + ", ".join(
    f"CASE WHEN coalesce(sum(CASE WHEN event_type = '{t}' THEN CAST(value AS {M}) END), 0) <> 0 THEN 1 ELSE 0 END AS has_{t}"
    for t in L.EVENT_TYPES) + " FROM events GROUP BY user_id",

"q_unpivot": f"""
SELECT {LID}, 'qty' AS measure, CAST(l_quantity AS {M}) AS amount FROM lineitem l
UNION ALL SELECT {LID}, 'discount', CAST(nullif(l_discount, 0.0) AS {M}) FROM lineitem l WHERE l_discount <> 0
UNION ALL SELECT {LID}, 'tax', CAST(nullif(l_tax, 0.0) AS {M}) FROM lineitem l WHERE l_tax <> 0""",

"q_mode_priority": f"""
WITH l AS (SELECT l_suppkey, l_returnflag, l_quantity, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem),
hist AS (SELECT l.*, s.s_nationkey FROM l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
tg AS (SELECT s.s_suppkey AS l_suppkey, CAST(y.y AS INTEGER) AS ship_year, s.s_nationkey
       FROM supplier s, range({L.MODE_YEARS[0]}, {L.MODE_YEARS[1]} + 1) y(y)),
m1 AS {MODE.format(keys='l_suppkey, ship_year', out='m1')},
m2 AS {MODE.format(keys='l_suppkey', out='m2')},
m3 AS {MODE.format(keys='s_nationkey', out='m3')}
SELECT tg.l_suppkey, tg.ship_year, coalesce(m1.m1, m2.m2, m3.m3, 'N') AS return_flag,
       CAST(CASE WHEN m1.m1 IS NOT NULL THEN 1 WHEN m2.m2 IS NOT NULL THEN 2 WHEN m3.m3 IS NOT NULL THEN 3 ELSE 0 END AS INTEGER) AS level
FROM tg LEFT JOIN m1 ON tg.l_suppkey = m1.l_suppkey AND tg.ship_year = m1.ship_year
LEFT JOIN m2 ON tg.l_suppkey = m2.l_suppkey LEFT JOIN m3 ON tg.s_nationkey = m3.s_nationkey""",

"q_concat_ordered": """
SELECT l_orderkey, string_agg(l_returnflag, '/' ORDER BY l_linenumber, l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey""",

"q_first_last": """
SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event_id, arg_min(event_type, (ts, event_id)) AS first_event_type,
       arg_max(event_id, (ts, event_id)) AS last_event_id, arg_max(event_type, (ts, event_id)) AS last_event_type,
       count(*) AS n_events
FROM events GROUP BY user_id""",

"q_shape_class": """
SELECT l_orderkey, n_lines, n_suppliers,
       CASE WHEN n_lines = 0 THEN 'NA' WHEN n_lines = 1 THEN 'OW' WHEN n_lines = 2 AND n_suppliers = 2 THEN '2OW'
            WHEN n_lines = 2 THEN 'RT' ELSE 'MD' END AS shape
FROM (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY l_orderkey)""",

"q_dedupe_two_pass": f"""
SELECT user_id, event_type, CAST(sum(CAST(value AS {M})) AS {M}) AS total, count(*) AS n_kept FROM (
  SELECT *, max(ts) OVER (PARTITION BY user_id, event_type, props) AS mx FROM events) WHERE ts = mx
GROUP BY user_id, event_type""",

"q_split_by_gap": f"""
WITH {SESSIONS}
SELECT user_id, session_nbr, arg_min(event_id, (ts, event_id)) AS first_event_id,
       arg_max(event_id, (ts, event_id)) AS last_event_id, count(*) AS n_events,
       CAST(sum(CAST(value AS {M})) AS {M}) AS total_value, bool_and(event_type <> 'error') AS error_free
FROM s GROUP BY user_id, session_nbr""",

"q_sequence": f"""
WITH {SESSIONS}
SELECT event_id, user_id, session_nbr,
       row_number() OVER (PARTITION BY user_id, session_nbr ORDER BY ts, event_id) AS seq_in_session FROM s""",

"q_group_total": f"""
SELECT {LID}, CAST(l.l_extendedprice AS {M}) AS amount,
       CAST(sum(CAST(l.l_extendedprice AS {M})) OVER (PARTITION BY l.l_orderkey) AS {M}) AS order_total
FROM lineitem l""",

"q_dominance": f"""
SELECT l_orderkey, cabin AS best_cabin, l_linenumber AS best_linenumber, l_partkey AS best_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_case('cabin', L.CABIN_PRIORITY, '99')},
                               l_linenumber, l_partkey, l_suppkey) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_discount * 100) AS INTEGER) AS cabin
        FROM lineitem)) WHERE rn = 1""",

"q_priority_cascade": GEO,

"q_geo_rollup": f"""
WITH g AS ({GEO})
SELECT l_orderkey, geography_type_id FROM (
  SELECT l_orderkey, geography_type_id, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY {_case('geography_type_id', L.GEO_PRIORITY)}, geography_type_id) AS rn FROM g) WHERE rn = 1""",

"q_route_dim": f"""
WITH cand AS (SELECT DISTINCT upper(trim(fn.n_name)) || ':' || upper(trim(tn.n_name)) AS route_code,
                     upper(trim(fn.n_name)) AS route_from, upper(trim(tn.n_name)) AS route_to
              FROM {LINE_NATIONS} JOIN nation fn ON s.s_nationkey = fn.n_nationkey
              JOIN nation tn ON c.c_nationkey = tn.n_nationkey),
seed AS {values(L.ROUTE_SEED, ['route_id', 'route_code', 'route_from', 'route_to'])},
new AS (SELECT * FROM cand WHERE NOT EXISTS (SELECT 1 FROM seed WHERE seed.route_code = cand.route_code
        AND seed.route_from = cand.route_from AND seed.route_to = cand.route_to)),
full_dim AS (SELECT route_id, route_code, route_from, route_to FROM seed
        UNION ALL
        SELECT CAST((SELECT max(route_id) FROM seed) + row_number() OVER (ORDER BY route_code, route_from, route_to) AS INTEGER),
               route_code, route_from, route_to FROM new)
SELECT route_id, route_code, route_from, route_to,
       least(route_from, route_to) || ':' || greatest(route_from, route_to) AS bidirectional_code FROM full_dim""",

"q_rules_engine": f"""
WITH f AS (SELECT {LID}, l.l_returnflag, l.l_linestatus, p.p_brand, p.p_type, CAST(p.p_size AS VARCHAR) AS p_size,
                  CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_returnflag || l.l_linestatus END AS disc_flag,
                  row_number() OVER () AS rid
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
act AS (SELECT * FROM {RULES} r WHERE DATE '{L.RULES_AS_OF:%Y-%m-%d}' BETWEEN effective_start AND effective_end),
conds AS (SELECT rule_id, upper(rtrim(column_name)) AS column_name, comparison, upper(rtrim(value)) AS value
          FROM act WHERE comparison IN ('=', '<>', 'LIKE', 'NOT LIKE')
          UNION ALL
          SELECT rule_id, upper(rtrim(column_name)), comparison, upper(rtrim(v))
          FROM (SELECT rule_id, column_name, comparison,
                       unnest(string_split(regexp_replace(regexp_replace(value, '^<v>', ''), '</v>$', ''), '</v><v>')) AS v
                FROM act WHERE comparison IN ('IN', 'MATCH'))),
flags AS (SELECT rule_id, max(CASE WHEN comparison IN ('=', '<>', 'LIKE', 'NOT LIKE') THEN 1 ELSE 0 END) AS has_d,
                 max(CASE WHEN comparison = 'IN' THEN 1 ELSE 0 END) AS has_in,
                 max(CASE WHEN comparison = 'MATCH' THEN 1 ELSE 0 END) AS has_m FROM conds GROUP BY rule_id),
lng AS ({' UNION ALL '.join(f"SELECT rid, '{a.upper()}' AS name, upper(rtrim({a})) AS val FROM f WHERE {a} IS NOT NULL" for a in RULE_ATTRS)}),
ev AS (SELECT lng.rid, c.rule_id, c.comparison,
              CASE c.comparison WHEN '=' THEN lng.val = c.value WHEN '<>' THEN lng.val <> c.value
                   WHEN 'LIKE' THEN lng.val LIKE c.value WHEN 'NOT LIKE' THEN NOT (lng.val LIKE c.value)
                   WHEN 'IN' THEN lng.val = c.value WHEN 'MATCH' THEN lng.val LIKE c.value END AS holds
       FROM lng JOIN conds c ON lng.name = c.column_name),
cnt AS (SELECT rid, rule_id,
               sum(CASE WHEN comparison IN ('=', '<>', 'LIKE', 'NOT LIKE') AND holds THEN 1 ELSE 0 END) AS dp,
               sum(CASE WHEN comparison IN ('=', '<>', 'LIKE', 'NOT LIKE') AND NOT holds THEN 1 ELSE 0 END) AS df,
               sum(CASE WHEN comparison = 'IN' AND holds THEN 1 ELSE 0 END) AS ip,
               sum(CASE WHEN comparison = 'MATCH' AND holds THEN 1 ELSE 0 END) AS mp
        FROM ev GROUP BY rid, rule_id),
best AS (SELECT cnt.rid, min(cnt.rule_id) AS rule_id FROM cnt JOIN flags USING (rule_id)
         WHERE (has_d = 0 OR (dp > 0 AND df = 0)) AND (has_in = 0 OR ip > 0) AND (has_m = 0 OR mp > 0)
         GROUP BY cnt.rid)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, best.rule_id, g.fare_type_id
FROM f LEFT JOIN best ON f.rid = best.rid LEFT JOIN {RULE_GROUPS} g ON g.rule_id = best.rule_id""",

"q_code_map": f"""
SELECT o_orderkey, CAST({_case('o_orderpriority', L.PRIORITY_ID, '-1')} AS INTEGER) AS priority_id FROM orders""",

"q_int_guard": """
WITH d AS (SELECT c_custkey, regexp_extract(c_name, '#([0-9]+)$', 1) AS x FROM customer)
SELECT c_custkey,
  CASE WHEN regexp_full_match(x, '[0-9]+') AND TRY_CAST(x AS DECIMAL(38,0)) <= 2147483647 THEN TRY_CAST(x AS INTEGER) END AS name_number,
  CASE WHEN regexp_full_match(x || x, '[0-9]+') AND TRY_CAST(x || x AS DECIMAL(38,0)) <= 2147483647 THEN TRY_CAST(x || x AS INTEGER) END AS doubled_number
FROM d""",

"q_hhmm": """
WITH t AS (SELECT event_id, strftime(ts, '%H%M') AS a, lpad(regexp_extract(props, '([0-9]+)', 1), 4, '0') AS b FROM events)
SELECT event_id,
  CAST(CASE WHEN regexp_full_match(a, '([01][0-9]|2[0-3])[0-5][0-9]') THEN CAST(substr(a, 1, 2) AS INTEGER) * 60 + CAST(substr(a, 3, 2) AS INTEGER) ELSE -1 END AS INTEGER) AS ts_minutes,
  CAST(CASE WHEN regexp_full_match(b, '([01][0-9]|2[0-3])[0-5][0-9]') THEN CAST(substr(b, 1, 2) AS INTEGER) * 60 + CAST(substr(b, 3, 2) AS INTEGER) ELSE -1 END AS INTEGER) AS k_minutes
FROM t""",

"q_last_token": """
SELECT c.c_custkey, regexp_extract(c.c_name, '([^#]*)$', 1) AS name_token,
       regexp_extract(n.n_name, '([^_]*)$', 1) AS nation_token
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",

"q_mask": """
SELECT c_custkey, left(trim(c_name), 6) AS card_first6, right(trim(c_name), 4) AS card_last4 FROM customer""",

"q_remark_parse": f"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, unnest(p) AS line, unnest(range(1, len(p) + 1)) AS line_nbr FROM parts),
r AS (SELECT doc_id, CAST(line_nbr AS BIGINT) AS line_nbr, line,
             CAST(CASE WHEN contains(line, 'License') THEN 1 WHEN contains(line, 'token') THEN 3
                       WHEN contains(line, '@') THEN 4 END AS INTEGER) AS remark_rank FROM lines),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY remark_rank, line_nbr) AS rn
      FROM r WHERE remark_rank IS NOT NULL)
SELECT doc_id, remark_rank, line_nbr, regexp_extract(trim(line), '([^ ]*)$', 1) AS last_token,
       CASE WHEN regexp_extract(line, '([0-9]+[.,][0-9]{{2}})', 1) <> ''
            THEN TRY_CAST(replace(regexp_extract(line, '([0-9]+[.,][0-9]{{2}})', 1), ',', '.') AS {M}) END AS amount
FROM f WHERE rn = 1""",

"q_text_amounts": """
SELECT doc_id, count(amt) AS n_amounts, CAST(sum(amt) AS DECIMAL(38,2)) AS total FROM (
  SELECT doc_id, TRY_CAST(replace(unnest(regexp_extract_all(text, '[0-9]+[.,][0-9]{2}')), ',', '.') AS DECIMAL(38,2)) AS amt
  FROM documents) GROUP BY doc_id""",

"q_signed_amounts": f"""
SELECT {LID}, CASE WHEN l_returnflag = 'R' THEN -abs(CAST(l_extendedprice AS {M})) ELSE abs(CAST(l_extendedprice AS {M})) END AS signed_amount
FROM lineitem l""",

"q_link_first": f"""
WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS {M}) AS penalty,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_extendedprice AS {M})) AS rn
           FROM lineitem WHERE l_returnflag = 'R')
SELECT o.o_orderkey, p.l_linenumber AS penalty_linenumber, p.penalty,
       CAST(CAST(o.o_totalprice AS {M}) + coalesce(p.penalty, 0) AS {M}) AS gross
FROM orders o LEFT JOIN p ON p.l_orderkey = o.o_orderkey AND p.rn = 1""",

"q_union_shape": f"""
SELECT {LID}, 'EXT' AS kind, CAST(CAST(l_extendedprice AS {M}) AS {M}) AS amount FROM lineitem l WHERE l_extendedprice > 0
UNION ALL SELECT {LID}, 'DISC', CAST(CAST(l_extendedprice AS {M}) * CAST(l_discount AS {M}) AS {M}) FROM lineitem l WHERE l_discount > 0
UNION ALL SELECT {LID}, 'TAX', CAST(CAST(l_extendedprice AS {M}) * CAST(l_tax AS {M}) AS {M}) FROM lineitem l WHERE l_tax > 0""",

"q_union_distinct": """
SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier""",

"q_consultant": """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type AS consultant, count(*) AS n
               FROM events WHERE event_type <> 'purchase' GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY n DESC, consultant) AS rn
        FROM daily) WHERE rn = 1),
p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS issue_day FROM events WHERE event_type = 'purchase'),
m AS (SELECT p.event_id, t.day, t.consultant, t.n, row_number() OVER (PARTITION BY p.event_id ORDER BY t.day DESC) AS rn
      FROM p JOIN top t ON t.user_id = p.user_id AND t.day <= p.issue_day)
SELECT p.event_id, p.user_id, m.consultant, m.day AS consult_day, m.n AS n_events
FROM p LEFT JOIN m ON m.event_id = p.event_id AND m.rn = 1""",

"q_lineage": """
WITH refs AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
c AS (SELECT r.l_orderkey, r.l_partkey, o.o_orderkey, o.o_orderdate,
             CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS orig_rank,
             CASE WHEN o.o_orderkey = r.l_orderkey THEN 2 ELSE 1 END AS prior_rank
      FROM refs r JOIN orders o ON o.o_orderkey = r.l_orderkey OR o.o_orderkey = r.l_partkey),
og AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY orig_rank, o_orderdate, o_orderkey) AS rn FROM c) WHERE rn = 1),
pr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY prior_rank, o_orderdate DESC, o_orderkey DESC) AS rn FROM c) WHERE rn = 1)
SELECT r.l_orderkey, r.l_partkey, coalesce(og.o_orderkey, r.l_orderkey) AS original_orderkey,
       coalesce(pr.o_orderkey, r.l_orderkey) AS prior_orderkey
FROM refs r LEFT JOIN og ON og.l_orderkey = r.l_orderkey AND og.l_partkey = r.l_partkey
LEFT JOIN pr ON pr.l_orderkey = r.l_orderkey AND pr.l_partkey = r.l_partkey""",

"q_haversine": f"""
WITH j AS (SELECT {LID}, l.l_returnflag, f.lat AS flat, f.lon AS flon, t.lat AS tlat, t.lon AS tlon
           FROM {LINE_NATIONS} JOIN {COORDS} f ON s.s_nationkey = f.n JOIN {COORDS} t ON c.c_nationkey = t.n),
m AS (SELECT *, {R2} * asin(sqrt(least(pow(sin((radians(tlat) - radians(flat)) / 2), 2)
          + cos(radians(flat)) * cos(radians(tlat)) * pow(sin((radians(tlon) - radians(flon)) / 2), 2), 1.0))) AS d FROM j)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_returnflag = 'R' THEN -abs(d) ELSE abs(d) END AS DECIMAL(12,2)) AS miles FROM m""",

"q_utc_offset": f"WITH {UTC} SELECT * FROM u",

"q_duration_rollup": f"""
WITH {UTC}
SELECT l_orderkey, CAST(CASE WHEN abs(sum(duration_min)) <= 32767 THEN sum(duration_min) END AS BIGINT) AS travel_minutes,
       count(duration_min) AS n_timed FROM u GROUP BY l_orderkey""",

"q_saturday": """
WITH d AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem),
g AS (SELECT l_orderkey, arg_min(ship_day, (l_linenumber, ship_day)) AS travel_start,
             arg_max(ship_day, (l_linenumber, ship_day)) AS travel_end FROM d GROUP BY l_orderkey)
SELECT l_orderkey, travel_start, travel_end,
       CAST(CASE WHEN dayofweek(travel_start) + 1 + date_diff('day', travel_start, travel_end) >= 8 THEN 1 ELSE 0 END AS INTEGER) AS saturday_stay
FROM g""",

"q_negate": f"""
WITH low AS (SELECT l_orderkey, min(CAST(l_extendedprice AS {M})) AS lowest FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_orderkey),
j AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS {M}) AS paid, low.lowest, CASE WHEN low.lowest IS NOT NULL THEN 1 END AS rule
      FROM orders o LEFT JOIN low ON o.o_orderkey = low.l_orderkey)
SELECT o_orderkey, CASE WHEN lowest IS NULL OR lowest > paid THEN paid ELSE lowest END AS lowest_fare,
       CAST(CASE WHEN lowest IS NULL OR lowest > paid THEN 4 ELSE rule END AS INTEGER) AS rule_id,
       CAST(paid - lowest AS {M}) AS saving FROM j""",

"q_idempotent_overwrite": f"""
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(o_totalprice AS {M}) AS total
FROM orders""",

"q_latest_extract": """
SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM (
  SELECT *, max(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS mx FROM events) WHERE CAST(ts AS DATE) = mx""",

"q_expand_lines": f"""
WITH x AS (SELECT a.*, coalesce(a.bt0, 7) AS bt FROM (SELECT {LID}, l.l_returnflag, l.l_extendedprice, o.o_custkey, o.o_orderdate,
       CASE l.l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 5 END AS bt0,
       l.l_shipdate AS bd, o.o_orderdate AS idt, CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity * 7 AS INTEGER) AS ts
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) a),
y AS (SELECT x.*, CAST({ADV} AS INTEGER) AS advance_days, nc.currency,
             CASE WHEN bt = 7 THEN -abs(CAST(l_extendedprice AS {M})) ELSE abs(CAST(l_extendedprice AS {M})) END AS amount
      FROM x JOIN customer c ON x.o_custkey = c.c_custkey JOIN {NC} nc ON c.c_nationkey = nc.n_nationkey)
SELECT y.l_orderkey, y.l_linenumber, y.l_partkey, y.l_suppkey, CAST(y.bt AS INTEGER) AS booking_type_id,
       CAST(CASE WHEN bt = 1 THEN 1 WHEN bt = 5 THEN 0 WHEN bt = 7 THEN -1 END AS INTEGER) AS increment_cnt,
       y.advance_days,
       CAST(CASE WHEN y.advance_days IS NULL THEN -1 WHEN y.advance_days < 0 THEN 99 ELSE coalesce(b.band_id, -1) END AS INTEGER) AS band_id,
       CAST(y.amount * coalesce(fx.rate, CAST(0 AS DECIMAL(19,8))) AS {M}) AS amount_eur
FROM y LEFT JOIN {FX} fx ON fx.time_id = CAST(strftime(date_trunc('year', y.o_orderdate), '%Y%m%d') AS INTEGER)
        AND fx.from_currency = y.currency AND fx.to_currency = 'EUR'
LEFT JOIN {BANDS} b ON y.advance_days BETWEEN b.start_day AND b.end_day""",

"q_invoice_type": f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 3 ELSE 1 END AS tt,
                  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS ex,
                  CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS {M}) ELSE -CAST(l_extendedprice AS {M}) END AS amt
           FROM lineitem),
g AS (SELECT l_orderkey, l_partkey, sum(CASE WHEN tt = 1 THEN amt END) AS issued,
             sum(CASE WHEN tt IN (2, 3) THEN abs(amt) END) AS refunded FROM x GROUP BY l_orderkey, l_partkey)
SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey,
       CAST(CASE WHEN tt = 1 AND ex = 1 THEN 5 WHEN tt = 1 OR amt >= 0 THEN 1 WHEN tt = 4 THEN 10 WHEN tt = 3 THEN 4
                 WHEN g.issued = g.refunded THEN 7 ELSE 8 END AS INTEGER) AS booking_type_id
FROM x JOIN g ON x.l_orderkey = g.l_orderkey AND x.l_partkey = g.l_partkey""",

"q_route_text": f"""
WITH legs AS (SELECT l.l_orderkey AS record_key, 'N' || CAST(s.s_nationkey AS VARCHAR) AS airport_from,
                     'N' || CAST(c.c_nationkey AS VARCHAR) AS airport_to,
                     row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                        l.l_quantity, l.l_extendedprice) AS segment_nbr
              FROM {LINE_NATIONS}),
s AS (SELECT *, lag(airport_from) OVER w AS pf, lag(airport_to) OVER w AS pt FROM legs
      WINDOW w AS (PARTITION BY record_key ORDER BY segment_nbr)),
p AS (SELECT *, CASE WHEN pt IS NULL THEN airport_from || '/' || airport_to
                     WHEN pt = airport_from THEN '/' || airport_to
                     ELSE '_' || airport_from || '/' || airport_to END AS piece,
                CASE WHEN pt IS NOT NULL AND airport_from = pt AND airport_to = pf THEN pt
                     WHEN pt IS NOT NULL AND airport_from <> pt THEN pt END AS turn FROM s),
g AS (SELECT record_key, left(string_agg(piece, '' ORDER BY segment_nbr), 150) AS route_txt,
             arg_min(airport_from, segment_nbr) AS org,
             arg_min(turn, segment_nbr) FILTER (WHERE turn IS NOT NULL) AS first_turn,
             arg_max(airport_to, segment_nbr) AS last_to,
             count(*) AS segment_cnt, CAST(1 AS BIGINT) AS flight_cnt FROM p GROUP BY record_key)
SELECT record_key AS l_orderkey, route_txt, org AS airport_from, coalesce(first_turn, last_to) AS airport_to,
       segment_cnt, flight_cnt
FROM g""",

"q_contains": """
SELECT o.o_orderkey, c.c_custkey, c.c_name FROM orders o JOIN customer c
  ON o.o_custkey = c.c_custkey AND instr(c.c_name, substr(o.o_orderpriority, 1, 1)) > 0""",
}
SQL["q_rules_engine_setbased"] = SQL["q_rules_engine"]
SQL["q_rules_layers"] = f"""
WITH f AS (SELECT {LID}, l.l_returnflag, l.l_linestatus, upper(p.p_brand) AS brand, p.p_type, CAST(p.p_size AS VARCHAR) AS size,
                  l.l_discount = 0 AS no_flag
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE
         WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 200
         WHEN size IN ('1', '2', '3') THEN -1
         WHEN p_type LIKE 'SMALL%' THEN 100
         WHEN no_flag THEN -2
         WHEN regexp_matches(brand, '^BRAND#[12]') AND l_returnflag = 'A' THEN 262
         WHEN regexp_matches(size, '^[12][^0-4]$') OR length(size) = 1 THEN 263
         WHEN NOT regexp_matches(brand, '[^3-5]$') THEN 264 END AS INTEGER) AS rule_id
FROM f"""
SQL["q_fare_summary"] = f"""
WITH legs AS (SELECT l.l_orderkey AS o_orderkey, l.l_linenumber AS leg_number,
                     'S' || CAST(s.s_nationkey AS VARCHAR) AS carrier, l.l_linestatus AS booking_class,
                     CAST(round(l.l_discount * 100) AS INTEGER) AS cabin, l.l_returnflag AS basis,
                     'N' || CAST(s.s_nationkey AS VARCHAR) || '-' || 'N' || CAST(c.c_nationkey AS VARCHAR) AS leg,
                     row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                        l.l_quantity, l.l_extendedprice) AS segment_rank
              FROM {LINE_NATIONS}),
seg AS (SELECT o_orderkey, count(*) AS segment_cnt, count(DISTINCT leg_number) AS leg_cnt,
               arg_min(carrier, segment_rank) AS first_carrier, arg_min(booking_class, segment_rank) AS first_booking_class,
               arg_min(cabin, segment_rank) AS first_cabin_class_id, arg_min(basis, segment_rank) AS first_fare_basis,
               string_agg(leg, '/' ORDER BY segment_rank) AS route_txt,
               string_agg(carrier, '/' ORDER BY segment_rank) AS marketing_carrier
        FROM legs GROUP BY o_orderkey),
amt AS (SELECT l_orderkey AS o_orderkey,
               sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS {M}) END) AS amt_base,
               CAST(NULL AS {M}) AS amt_tax,
               sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS {M}) END) AS amt_total,
               sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS {M}) END) AS amt_ancillary
        FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, CAST(a.amt_base AS {M}) AS amt_base, CAST(a.amt_tax AS {M}) AS amt_tax,
       CAST(a.amt_total AS {M}) AS amt_total, CAST(a.amt_ancillary AS {M}) AS amt_ancillary,
       g.segment_cnt,
       CASE WHEN coalesce(g.leg_cnt, 0) = 0 THEN 'NA' WHEN g.leg_cnt = 1 THEN 'OW' WHEN g.leg_cnt = 2 THEN 'RT' ELSE 'MD' END
           AS geometry_type,
       g.first_carrier, g.first_booking_class, g.first_cabin_class_id, g.first_fare_basis, g.route_txt,
       g.marketing_carrier,
       CASE WHEN coalesce(a.amt_ancillary, 0) <> 0 THEN 1 ELSE 0 END AS has_ancillaries,
       CAST(coalesce(a.amt_total, 0) AS {M}) AS total_amount
FROM orders o LEFT JOIN amt a ON a.o_orderkey = o.o_orderkey LEFT JOIN seg g ON g.o_orderkey = o.o_orderkey"""

SQL["q_name_resolution"] = """
WITH offers AS (
  SELECT o.o_orderkey, 1 AS src, c.c_mktsegment AS first_name, CASE WHEN c.c_acctbal >= 0 THEN c.c_name ELSE '' END AS last_name
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE c.c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT o_orderkey, 2, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT o.o_orderkey, 3, '', s.s_name FROM orders o JOIN supplier s ON s.s_suppkey = o.o_custkey % 10 WHERE s.s_acctbal > 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY
           (first_name = '')::INT + (last_name = '')::INT, src) AS rn FROM offers) WHERE rn = 1),
asked AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 END AS approver_id, o_custkey % 25 AS company FROM orders)
SELECT a.o_orderkey, CAST(b.src AS INTEGER) AS name_source, b.first_name, b.last_name, a.approver_id,
       CASE WHEN a.approver_id IS NOT NULL THEN CASE WHEN n.n_name IS NOT NULL THEN 'ANON' ELSE coalesce(c.c_mktsegment, '') END END
           AS approver_first_name,
       CASE WHEN a.approver_id IS NOT NULL THEN CASE WHEN n.n_name IS NOT NULL THEN n.n_name
            WHEN c.c_acctbal >= 0 THEN c.c_name ELSE '' END END AS approver_last_name,
       CASE WHEN b.last_name IS NULL THEN 9 ELSE 0 END AS record_status_id
FROM asked a LEFT JOIN best b ON b.o_orderkey = a.o_orderkey
LEFT JOIN customer c ON c.c_custkey = a.approver_id
LEFT JOIN nation n ON n.n_nationkey = a.company AND n.n_nationkey < 5"""
