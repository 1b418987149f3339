"""itinera — a PySpark-native engine for travel-fact batch loads.

Staged bookings (air, hotel, train files and ERP invoice extracts) become
fact and dimension tables through DataFrame plans that Catalyst optimises.

Sub-packages
------------
functions   column expressions (text, dates, numbers, geography)
operators   reusable relational operators: lookups, ordered scans, shaping,
            rules engine, currency conversion
sources     batch-slice readers and idempotent sinks
plans       the domain jobs and the driver-table query set
streaming   nothing: the batch loads have no streaming construct
"""

from itinera.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
