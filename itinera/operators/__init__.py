"""Reusable relational operators (DataFrame in, DataFrame out)."""

from itinera.operators.lookups import (
    first_per_key, latest_lookup, latest_all, band_join, dated_join, match_within, match_nearest,
    near_in_time, contains_join, first_match, theta_or, join_role, with_group_total, keep_if_exists,
    keep_if_absent, not_in, delete_not_in, link_first,
)
from itinera.operators.scans import (
    time_bucket, value_bucket, range_bucket, sequence_number, running_sum, with_next, with_prev,
    asof_join, asof_within, split_by_gap, split_and_number,
)
from itinera.operators.shaping import (
    strict_sum, guarded_sum, has_amount, concat_ordered, pivot_sum, unpivot_nonnull,
    mode_with_priority, mode_by_levels, first_last, geometry_type, dedupe_two_pass, prorate, union_all,
    union_distinct, groups_to_rows, min_by_priority,
)
from itinera.operators.rules import Layer, apply_layered_rules, apply_rules, apply_rule_groups, active_conditions
from itinera.operators.fx import fx_convert

__all__ = [n for n in dir() if not n.startswith("_")]
