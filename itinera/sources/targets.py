"""Target tables: what a stored table takes, declared once and applied at the write.

Texts keep their whole length until here, so none is cut before it serves as a key or is
compared; the write cuts them to the column's width, pads fixed-width columns with blanks and
stamps the row with its time and its writer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Target:
    """``widths``: most characters of a text column; ``padded``: exact characters of a
    fixed-width one.  Columns that a row set lacks are skipped, nulls stay null."""
    widths: Mapping[str, int] = field(default_factory=dict)
    padded: Mapping[str, int] = field(default_factory=dict)

    def shape(self, df: DataFrame, by: str, at: dt.datetime) -> DataFrame:
        cut = {c: F.substring(F.col(c), 1, n) for c, n in self.widths.items() if c in df.columns}
        cut |= {c: F.rpad(F.col(c), n, " ") for c, n in self.padded.items() if c in df.columns}
        return df.withColumns(cut | {"update_date": F.lit(at).cast("timestamp_ntz"), "last_updated_by": F.lit(by[:50])})


# fixed values: column widths of the fact tables
KEYS = {"record_key": 30}
NAMES = {"title": 20, "first_name": 60, "middle_name": 60, "last_name": 60, "approver_title": 20, "approver_first_name": 60,
         "approver_middle_name": 60, "approver_last_name": 60}
AIR_TICKET = Target({**KEYS, **NAMES, "route_txt": 150, "tour_code": 150, "pricing_entry": 100, "savings_rule": 50})
TRAIN_TICKET = Target({**KEYS, **NAMES, "route_txt": 500})
DETAIL = Target(KEYS)
HOTEL_FACT = Target({"record_key": 110, "record_key_prior": 110, "record_key_original": 110, "meta_dossier_id": 20,
                     "sales_document_code": 20, "sales_document_code_prior": 20, "itinerary_txt": 13, "hotel_name": 255,
                     "hotel_city_name": 20, "hotel_province_name": 30, "confirmation_nbr": 30, "custom_data_txt": 2000,
                     "approval_txt": 255, "invoice_source": 10, **NAMES}, {"hotel_country_code": 3, "currency_code": 3})
HOTEL_COMPARISON = Target({"record_key": 110, "description": 255}, {"currency_code": 3})
