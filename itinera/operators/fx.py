"""Currency conversion."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from itinera.functions.dates import time_id


def fx_convert(df: DataFrame, rates: DataFrame, date: str, from_ccy: str, to_ccy: str,
               amounts: Sequence[str], how: str = "left", rate_col: str = "rate",
               missing_rate=0, out_suffix: str = "", keep_rate: str | None = "fx_rate") -> DataFrame:
    """amount * rate(time_id(date), from, to).

    ``rates`` has (time_id, from_currency, to_currency, rate).  With
    ``how='left'`` a missing rate gives amount * ``missing_rate`` (0); with
    ``how='inner'`` the row is dropped.  The rate table is keyed by day and
    currency pair, so it stays small; AQE broadcasts it from its size.
    """
    r = rates.select(F.col("time_id").alias("_tid"), F.col("from_currency").alias("_from"),
                     F.col("to_currency").alias("_to"), F.col(rate_col).alias("_rate"))
    d = df.withColumn("_tid", time_id(F.col(date)))
    j = d.join(r, (d["_tid"] == r["_tid"]) & (d[from_ccy] == r["_from"]) & (d[to_ccy] == r["_to"]), how)
    rate = F.coalesce(F.col("_rate"), F.lit(missing_rate).cast(r.schema["_rate"].dataType))
    for a in amounts:
        j = j.withColumn(a + out_suffix, F.col(a) * rate)
    if keep_rate:
        j = j.withColumn(keep_rate, F.col("_rate"))
    return j.drop(d["_tid"]).drop(r["_tid"]).drop("_from", "_to", "_rate")
