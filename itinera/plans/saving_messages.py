"""Savings messages, from their raw tables to the four summaries the savings rules read.

A message holds booked fares, a booked fare holds fares and comparison options, an option
holds comparison fares; amounts and segments hang on the finest level.  Both detail tables
of a side are read once: their rows are one stream of events, one aggregate reduces them to
the finest level, and the coarser level is merged from those partial results.

Raw tables (all with ``extract_id``, ``message_unique_id``):

* ``saving_message``: xml_generated_at
* ``saving_booked_fare``: booked_fare_number, percode
* ``saving_fare``: booked_fare_number, fare_number, pnr, fare_type
* ``saving_fare_amount`` / ``saving_segment``: a fare's amounts (type, amount) and segments
* ``saving_option``: booked_fare_number, comparison_option_number, is_lowest_recommended_fare
* ``saving_comparison_fare``: + comparison_fare_number, fare_type
* ``saving_comparison_amount`` / ``saving_comparison_segment``: as above

Segments: segment_number, segment_rank, is_connection, marketing_carrier_is_lowcost,
from_date, to_date, from_airport_code, to_airport_code, marketing_carrier_code,
flexibility_level, cabin_class, booking_class, farebasis.

Nulls: rows whose extract or message is null belong to no message.  A type without amounts
has a null sum; ``has_ancillaries`` is null without such rows (such a fare matches no ticket).
A segment without a rank counts and opens the route text, but is neither first nor last.
Segments of one rank follow each other by number, then by their other values; repeated rows
count as often as they stand.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O
from itinera.plans.savings import BF, MSG, PCT

# fixed values: amount types, kinds of first purchase, cabins and fare types of messages
AMOUNT_TYPES = ["total_amount", "fare_amount", "obfees", "ancillaries"]
FIRST_PURCHASE = "ORIGINAL_PURCHASE"
CABIN_ID = {"ECONOMY": 3, "PREMIUM_ECO": 5, "BUSINESS": 2, "FIRST": 1}
FARE_TYPE_ID = {"PUBLISHED": 1, "EGENCIA": 2, "CORPORATE": 9, "SUBSCRIPTION": 2, "DISCOUNT": 2, "YOUNG": 2, "ELDER": 2,
                "RESIDENT": 2, "TPC": 101, "TPU": 104, "TMU": 105, "TMP": 103, "TPP": 102}

FARE = BF + ["fare_number"]
OPTION = BF + ["comparison_option_number"]
OPTION_FARE = OPTION + ["comparison_fare_number"]
SEGMENT = ["segment_rank", "segment_number", "is_connection", "marketing_carrier_is_lowcost", "from_date", "to_date",
           "from_airport_code", "to_airport_code", "marketing_carrier_code", "flexibility_level", "cabin_class",
           "booking_class", "farebasis"]


def message_keys(messages: DataFrame, fares: DataFrame, tickets: DataFrame) -> DataFrame:
    """(extract, message) of each first-purchase message with a fare of a purchased
    ticket's locator, in the newest extract that has both."""
    bought = tickets.where(F.col("booking_type_id") == X.BT_PURCHASE).select(F.col("pnr_code").alias("pnr")).distinct()
    first = messages.where(F.col("xml_generated_at") == FIRST_PURCHASE).select(*MSG)
    return (fares.join(first, MSG, "left_semi").join(bought, "pnr", "left_semi")
            .groupBy("message_unique_id").agg(F.max("extract_id").alias("extract_id")).select(*MSG))


def matched_keys(matches: DataFrame) -> DataFrame:
    """The matched messages, each in its newest extract."""
    return matches.groupBy("message_unique_id").agg(F.max("extract_id").alias("extract_id")).select(*MSG)


def events(amounts: DataFrame, segments: DataFrame, keys: Sequence[str], messages: DataFrame) -> DataFrame:
    """Amount rows and segment rows of the given messages as one stream."""
    a = amounts.select(*keys, "type", "amount")
    s = segments.select(*keys, F.lit(True).alias("_segment"), *SEGMENT)
    return a.unionByName(s, allowMissingColumns=True).join(messages, MSG, "left_semi")


def finest(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per fare: sums by type, counts, first and last segment, the path in order."""
    is_segment, ranked = F.col("_segment"), F.col("segment_rank").isNotNull()
    leg = F.concat(F.coalesce("from_airport_code", F.lit("")), F.lit("-"), F.coalesce("to_airport_code", F.lit("")))
    at = F.struct("segment_rank", "segment_number", *[c for c in SEGMENT[2:]])
    step = F.struct("segment_rank", "segment_number", leg.alias("leg"),
                    F.coalesce("marketing_carrier_code", F.lit("")).alias("carrier"))
    flown = F.col("is_connection") == 0
    return stream.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("type") == t, F.col("amount"))).alias(t) for t in AMOUNT_TYPES],
        F.count(F.when(F.col("type") == "ancillaries", 1)).alias("_anc"),
        F.count("segment_number").alias("_segments"), F.count(is_segment).alias("_segment_rows"),
        F.count(F.when(flown, F.col("segment_number"))).alias("_legs"), F.count(F.when(flown, 1)).alias("_leg_rows"),
        F.max(F.col("marketing_carrier_is_lowcost").cast("int")).alias("is_lowcost"),
        F.min(F.when(is_segment & ranked, at)).alias("_first"), F.max(F.when(is_segment & ranked, at)).alias("_last"),
        F.collect_list(F.when(is_segment, step)).alias("_path"))


def coarser(fine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same columns on fewer keys, merged from the finest level."""
    return fine.groupBy(*keys).agg(
        *[F.sum(t).alias(t) for t in AMOUNT_TYPES],
        *[F.sum(c).alias(c) for c in ("_anc", "_segments", "_segment_rows", "_legs", "_leg_rows")],
        F.max("is_lowcost").alias("is_lowcost"), F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.flatten(F.collect_list("_path")).alias("_path"), F.count(F.when(F.col("_leg_rows") > 0, 1)).alias("_fares"))


def described(level: DataFrame, keys: Sequence[str], fares: Column | None = None) -> DataFrame:
    """The summary columns of a level; ``fares`` counts the fares with legs where two of
    them make two one-way trips."""
    path = F.array_sort("_path")
    text = lambda part: F.when(F.col("_segment_rows") > 0, F.array_join(F.transform(path, lambda p: p[part]), "/"))
    first = lambda c: F.col(f"_first.{c}")
    regular = F.col("is_lowcost") == 0
    return level.select(
        *keys, *AMOUNT_TYPES,
        F.when(F.col("_anc") > 0, F.when(F.coalesce("ancillaries", F.lit(0)) != 0, 1).otherwise(0)).alias("has_ancillaries"),
        F.when(F.col("_leg_rows") > 0, O.geometry_type("_legs", F.lit(1) if fares is None else fares)).alias("geometry_type"),
        F.when(F.col("_segment_rows") > 0, F.col("_segments")).alias("segment_cnt"), "is_lowcost",
        first("from_date").alias("from_date"), F.col("_last.to_date").alias("to_date"),
        text("leg").alias("route_txt"), text("carrier").alias("marketing_carrier"),
        F.when(F.col("is_lowcost") == 1, "LOWCOST").otherwise(F.coalesce(first("flexibility_level"), F.lit("UNKNOWN")))
        .alias("flexibility_level"),
        first("marketing_carrier_code").alias("first_carrier"), first("cabin_class").alias("first_cabin_class"),
        X.map_code(first("cabin_class"), CABIN_ID, 0).alias("first_cabin_class_id"),
        F.when(regular, F.left(first("booking_class"), F.lit(1))).alias("first_booking_class"),
        F.when(regular, F.left(first("farebasis"), F.lit(15))).alias("first_fare_basis"))


def booked_levels(t: dict[str, DataFrame], messages: DataFrame) -> DataFrame:
    """The finest level of the booked side; store it before both summaries read it."""
    return finest(events(t["saving_fare_amount"], t["saving_segment"], FARE, messages), FARE)


def booked_fares(t: dict[str, DataFrame], messages: DataFrame, fine: DataFrame) -> DataFrame:
    """One row per booked fare."""
    own = t["saving_booked_fare"].join(messages, MSG, "left_semi").select(*BF, "percode")
    out = own.join(described(coarser(fine, BF), BF), BF, "left")
    return out.withColumn("flexibility_level", F.coalesce("flexibility_level", F.lit("UNKNOWN")))


def fares(t: dict[str, DataFrame], messages: DataFrame, fine: DataFrame, pct=PCT) -> DataFrame:
    """One row per fare, with the traveller of its booked fare and exact bounds of the total."""
    own = t["saving_fare"].join(messages, MSG, "left_semi").select(*FARE, "pnr", "fare_type")
    who = t["saving_booked_fare"].join(messages, MSG, "left_semi").select(*BF, "percode")
    out = own.join(who, BF, "inner").join(described(fine, FARE), FARE, "left")
    total = F.col("total_amount")
    return (out.withColumn("flexibility_level", F.coalesce("flexibility_level", F.lit("UNKNOWN")))
            .withColumn("total_amount_down", total * F.lit(1 - pct)).withColumn("total_amount_up", total * F.lit(1 + pct)))


def option_levels(t: dict[str, DataFrame], matched: DataFrame) -> DataFrame:
    """The finest level of the comparison side, of the matched messages only."""
    return finest(events(t["saving_comparison_amount"], t["saving_comparison_segment"], OPTION_FARE, matched), OPTION_FARE)


def options(t: dict[str, DataFrame], matched: DataFrame, fine: DataFrame, booked: DataFrame) -> DataFrame:
    """One row per comparison option that has a fare; ``is_booked_fare`` is 1 where fare
    amount, dates and route all equal the booked fare's (a missing one equals nothing)."""
    kinds = (t["saving_comparison_fare"].join(matched, MSG, "left_semi").groupBy(*OPTION)
             .agg(F.min("fare_type").alias("fare_type")))
    own = t["saving_option"].select(*OPTION, "is_lowest_recommended_fare").join(kinds, OPTION, "inner")
    # a shape of two legs is a return trip only where one fare covers both
    many = F.when(F.col("_fares") == 1, F.lit(1)).otherwise(F.lit(2))
    out = own.join(described(coarser(fine, OPTION), OPTION, many), OPTION, "left")
    like = ["fare_amount", "from_date", "to_date", "route_txt"]
    b = booked.select(*BF, *[F.col(c).alias(f"_b_{c}") for c in like])
    same = F.lit(True)
    for c in like:
        same = same & (F.col(c) == F.col(f"_b_{c}"))
    return _typed(out.join(b, BF, "left").withColumn("is_booked_fare", F.when(same, 1).otherwise(0))
                  .drop(*[f"_b_{c}" for c in like]))


def comparison_fares(t: dict[str, DataFrame], matched: DataFrame, fine: DataFrame) -> DataFrame:
    """One row per comparison fare, with its option's recommendation."""
    own = t["saving_comparison_fare"].join(matched, MSG, "left_semi").select(*OPTION_FARE, "fare_type")
    rec = t["saving_option"].select(*OPTION, "is_lowest_recommended_fare")
    return _typed(own.join(rec, OPTION, "left").join(described(fine, OPTION_FARE), OPTION_FARE, "left"))


def _typed(df: DataFrame) -> DataFrame:
    return (df.withColumn("flexibility_level", F.coalesce("flexibility_level", F.lit("UNKNOWN")))
            .withColumn("first_cabin_class_id", F.coalesce("first_cabin_class_id", F.lit(0)))
            .withColumn("fare_type_id", X.map_code(F.col("fare_type"), FARE_TYPE_ID, 0)))
