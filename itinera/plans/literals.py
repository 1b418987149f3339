"""Literal lookup tables used by the driver-table queries.

Each table is defined once here; the Spark plans build a broadcast
DataFrame from it and the DuckDB oracle renders the same rows as VALUES.
Tables with more than a few dozen rows are generated from a rule.
"""

from __future__ import annotations

import datetime as dt

# fixed values: booking types present in the booking-type dimension
BOOKING_TYPES = [0, 1, 2, 3]
# fixed values: order priority -> booking type ('4-NOT SPECIFIED' unmapped)
PRIORITY_BOOKING_TYPE = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 9}
# fixed values: order priority -> priority id ('4-NOT SPECIFIED' unmapped)
PRIORITY_ID = {"1-URGENT": 10, "2-HIGH": 20, "3-MEDIUM": 30, "5-LOW": 50}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# fixed values: storage currencies, assigned to nation n as CURRENCIES[n % 7]
CURRENCIES = ["USD", "GBP", "CHF", "SEK", "NOK", "DKK", "PLN"]
YEARS = list(range(1995, 2002))


def nation_currency() -> list[tuple[int, str]]:
    return [(n, CURRENCIES[n % len(CURRENCIES)]) for n in range(25)]


def fx_rates() -> list[tuple[int, str, str, str]]:
    """Yearly rates to EUR keyed by the first day's time id; the pair
    (year, currency) is missing when (year + index) % 4 == 0."""
    out = []
    for y in YEARS:
        for i, c in enumerate(CURRENCIES):
            if (y + i) % 4 == 0:
                continue
            rate = 0.5 + 0.125 * i + 0.01 * (y - 1995)
            out.append((y * 10000 + 101, c, "EUR", f"{rate:.8f}"))
    return out


# fixed values: advance-purchase bands (band id, first day, last day)
ADVANCE_BANDS = [(1, 0, 6), (2, 7, 13), (3, 14, 20), (4, 21, 44), (5, 45, 89),
                 (6, 90, 179), (7, 180, 364)]


def priority_tiers() -> list[tuple[str, dt.date, dt.date, int]]:
    """Yearly effective-dated tiers per priority; a year is absent when
    (priority index + year) % 3 == 0."""
    out = []
    for i, p in enumerate(PRIORITIES):
        for y in YEARS:
            if (i + y) % 3 == 0:
                continue
            out.append((p, dt.date(y, 1, 1), dt.date(y, 12, 31), i * 10 + (y - 1994)))
    return out


# fixed values: return-flag priority for mode tie-breaks (lower wins)
FLAG_PRIORITY = {"R": 1, "A": 2, "N": 3}
# fixed values: cabin priority order 4, 1, 2, 5, 3, 0 (first is best)
CABIN_ORDER = [4, 1, 2, 5, 3, 0]
CABIN_PRIORITY = {c: i + 1 for i, c in enumerate(CABIN_ORDER)}

# fixed values: geography types and their priority (lower wins)
GEO_PRIORITY = {1: 30, 2: 20, 3: 40, 4: 10, 5: 50, 6: 5}
GEO_DEFAULT = 5
# fixed values: nations without a single-country geography row
GEO_MISSING = [3, 11, 19]
# fixed values: country pairs (from nation, to nation) with geography type 6
GEO_PAIRS = [(0, 1), (1, 0), (2, 5), (5, 2), (7, 7), (10, 20), (20, 10), (12, 13)]


def geo_country() -> list[tuple[int, int]]:
    """Single-country geography: nation n -> type 1 + n % 4."""
    return [(n, 1 + n % 4) for n in range(25) if n not in GEO_MISSING]


# fixed values: routes already in the route dimension
ROUTE_SEED = [(1, "NATION_0:NATION_1", "NATION_0", "NATION_1"),
              (2, "NATION_1:NATION_0", "NATION_1", "NATION_0"),
              (3, "NATION_5:NATION_9", "NATION_5", "NATION_9")]

# fixed values: fare-type rules (rule id, attribute, comparison, value,
# effective start, effective end); as-of date of the run
RULES_AS_OF = dt.date(2024, 6, 30)
_ON = (dt.date(2020, 1, 1), dt.date(2099, 12, 31))
_OFF = (dt.date(2010, 1, 1), dt.date(2020, 12, 31))
RULES = [
    (261, "p_type", "=", "PROMO", *_ON),
    (261, "l_returnflag", "=", "R", *_ON),
    (262, "p_brand", "LIKE", "Brand#1%", *_ON),
    (262, "l_linestatus", "<>", "F", *_ON),
    (263, "p_size", "IN", "<v>1</v><v>2</v><v>3</v><v>4</v><v>5</v>", *_ON),
    (264, "p_type", "MATCH", "<v>SMALL%</v><v>LARGE%</v>", *_ON),
    (264, "l_returnflag", "=", "A", *_ON),
    (265, "l_returnflag", "NOT LIKE", "N%", *_ON),
    (265, "disc_flag", "=", "AF", *_ON),
    (266, "p_type", "=", "ECONOMY", *_OFF),
    (267, "disc_flag", "LIKE", "N%", *_ON),
    (268, "p_brand", "=", "Brand#2", *_ON),
    (268, "p_size", "IN", "<v>11</v><v>28</v>", *_ON),
]
# fixed values: rule -> fare type
RULE_GROUPS = [(261, 1), (262, 2), (263, 3), (264, 4), (265, 5), (266, 6), (267, 7), (268, 8)]


def nation_coords() -> list[tuple[int, float, float]]:
    """Nation n at latitude -50 + 4n, longitude -160 + 13n."""
    return [(n, -50.0 + 4 * n, -160.0 + 13 * n) for n in range(25)]


def nation_utc_offset() -> list[tuple[int, int]]:
    """Nation n -> standard UTC offset (n - 12) * 30 minutes."""
    return [(n, (n - 12) * 30) for n in range(25)]


def _last_sunday(y: int, m: int) -> dt.date:
    d = dt.date(y, m + 1, 1) - dt.timedelta(days=1) if m < 12 else dt.date(y, 12, 31)
    return d - dt.timedelta(days=(d.weekday() + 1) % 7)


def daylight_saving() -> list[tuple[int, dt.datetime, dt.datetime, int]]:
    """Nations 0-12 add 60 minutes from the last Sunday of March 01:00 to the
    last Sunday of October 01:00."""
    out = []
    for n in range(13):
        for y in YEARS:
            b = dt.datetime.combine(_last_sunday(y, 3), dt.time(1))
            e = dt.datetime.combine(_last_sunday(y, 10), dt.time(1))
            out.append((n, b, e, 60))
    return out


SAVINGS_PCT = "0.03"
ACTIVATION_DATE = dt.date(1998, 1, 1)

# rules with character classes, and the conditions that switch layers on
LAYER_RULES = [
    (100, "p_type", "LIKE", "SMALL%", *_ON),
    (200, "l_linestatus", "=", "O", *_ON),
    (201, "l_returnflag", "=", "A", *_OFF),
    (262, "p_brand", "LIKE", "brand#[1-2]%", *_ON),
    (262, "l_returnflag", "=", "A", *_ON),
    (263, "p_size", "MATCH", "<v>[1-2][^0-4]</v><v>_</v>", *_ON),
    (264, "p_brand", "NOT LIKE", "%[^3-5]", *_ON),
]
LAYERS_ABOVE = 260

# first and last year that the mode query asks for; the lines cover some of them
MODE_YEARS = (1993, 2003)
