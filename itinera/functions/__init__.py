"""Column expressions: every function maps Columns to a Column and stays
inside whole-stage codegen (no Python UDF)."""

from itinera.functions.text import (
    clean, fit, is_int32_text, int32_or_null, last_token, mask_card, like_class, like_regex,
    tsql_substring, hhmm_minutes, to_money, is_numeric_text, clean_department_name,
)
from itinera.functions.dates import (
    time_id, epoch_micros, minute_index, minute_diff, day_diff, plausible_date, advance_days, saturday_stay,
    to_utc, duration_minutes,
)
from itinera.functions.numeric import (
    map_code, classify, signed, increment_count, net_priced, money, sign_factor,
    BT_PURCHASE, BT_RESERVE, BT_VOID, BT_EXCHANGE, BT_REFUND, BT_PARTIAL_REFUND, BT_UTT,
    BT_VOID_REFUND, NEGATIVE_TYPES,
)
from itinera.functions.geo import great_circle_miles

__all__ = [n for n in dir() if not n.startswith("_")]
