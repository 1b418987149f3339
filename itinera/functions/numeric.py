"""Code maps, classification chains and signed amounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# fixed values: booking type ids of the booking-type dimension
BT_PURCHASE, BT_RESERVE, BT_VOID, BT_EXCHANGE = 1, 3, 4, 5
BT_REFUND, BT_PARTIAL_REFUND, BT_UTT, BT_VOID_REFUND = 7, 8, 9, 10
NEGATIVE_TYPES = (BT_VOID, BT_REFUND, BT_PARTIAL_REFUND)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x, scale: int = 2, precision: int = 18) -> Column:
    """Amounts are exact decimals; doubles are converted before any sum."""
    return _c(x).cast(f"decimal({precision},{scale})")


def map_code(x, mapping: dict, default=None) -> Column:
    """Code -> id through a literal map (a JVM map lookup, no join)."""
    if not mapping:
        return F.lit(default)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.create_map(*pairs)[_c(x)]
    return F.coalesce(looked, F.lit(default)) if default is not None else looked


def classify(branches: list[tuple[Column, object]], default=None) -> Column:
    """CASE chain, first match wins."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d) if out is not None else d


def signed(amount, booking_type, negative_types=NEGATIVE_TYPES) -> Column:
    """abs(amount), negated for void / refund / partial-refund types."""
    a = F.abs(_c(amount))
    return F.when(_c(booking_type).isin(*negative_types), -a).otherwise(a)


def increment_count(booking_type, purchase=BT_PURCHASE, exchange=BT_EXCHANGE, void=BT_VOID,
                    refund=BT_REFUND, partial_refund=BT_PARTIAL_REFUND,
                    void_refund=BT_VOID_REFUND) -> Column:
    """+1 purchase / void-refund, 0 exchange / partial refund, -1 void / refund."""
    bt = _c(booking_type)
    return (F.when(bt == purchase, 1).when(bt == exchange, 0).when(bt == void, -1)
            .when(bt == refund, -1).when(bt == partial_refund, 0)
            .when(bt == void_refund, 1))


def net_priced(fare_type, net_types=(2, 3)) -> Column:
    return F.when(_c(fare_type).isin(*net_types), 1).otherwise(0)


def sign_factor(booking_type, negative_types=NEGATIVE_TYPES) -> Column:
    """-1 for void / refund / partial refund, else 1."""
    return F.when(_c(booking_type).isin(*negative_types), -1).otherwise(1)
