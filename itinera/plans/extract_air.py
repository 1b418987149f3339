"""Internal-extract (ERP) air load: classification, legs, segments, trips,
routes and ticket roll-ups for one extract id.

Correlated sub-selects of the source become one aggregate joined back;
recursive CTEs become lag + running sums / ordered concatenation; per-row
TOP 1 lookups become aggregates over (order, payload) structs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from itinera import functions as X
from itinera import operators as O

SEG_KEY = ["extract_id", "record_key", "booking_type_id"]
TICKET_GROUP = ["extract_id", "product_id", "document_no", "id_2", "ticket"]


# ---- D3 / D5 / D6 classification ---------------------------------------------------------

def invoice_booking_type(lines: DataFrame) -> DataFrame:
    """D3: booking type of each invoice line: issued exchange 5; issued or
    non-negative amount 1; type 4 -> 10; type 3 -> 4; issued sum equals the
    refunded absolute sum -> 7; else 8.  The two correlated sums are one
    aggregate per ticket group (primary resources only)."""
    prim = lines.where(F.col("resource_type") == 0)
    sums = prim.groupBy(*TICKET_GROUP).agg(
        F.sum(F.when(F.col("ticket_type") == 1, F.col("amount_incl_vat"))).alias("_issued"),
        F.sum(F.when(F.col("ticket_type").isin(2, 3), F.abs("amount_incl_vat"))).alias("_refunded"))
    j = lines.join(sums, TICKET_GROUP, "left")
    tt = F.col("ticket_type")
    bt = (F.when((tt == 1) & (F.col("exchange_ticket") == 1), 5)
          .when((tt == 1) | (F.col("amount_incl_vat") >= 0), 1)
          .when(tt == 4, 10).when(tt == 3, 4)
          .when(F.col("_issued") == F.col("_refunded"), 7).otherwise(8))
    return j.withColumn("booking_type_id", bt).drop("_issued", "_refunded")


def credit_booking_type(cr_lines: DataFrame, cr_headers: DataFrame, inv_lines: DataFrame) -> DataFrame:
    """Types 1/3 -> 4; type 2 whose refunded sum equals the issued sum
    of the invoice it reverses -> 7; type 2 -> 8; else 99."""
    g = ["extract_id", "product_id", "id_2", "ticket"]
    issued = (inv_lines.where((F.col("resource_type") == 0) & (F.col("ticket_type") == 1))
              .groupBy(F.col("document_no").alias("issued_to_doc"), *g)
              .agg(F.sum("amount_incl_vat").alias("_issued")))
    refunded = (cr_lines.where((F.col("resource_type") == 0) & F.col("ticket_type").isin(2, 3))
                .groupBy("document_no", *g).agg(F.sum("amount_incl_vat").alias("_refunded")))
    h = cr_headers.select("extract_id", "product_id", F.col("no").alias("document_no"), "issued_to_doc")
    j = (cr_lines.join(h, ["extract_id", "product_id", "document_no"], "inner")
         .join(refunded, ["document_no"] + g, "left").join(issued, ["issued_to_doc"] + g, "left"))
    tt = F.col("ticket_type")
    bt = (F.when(tt.isin(1, 3), 4).when((tt == 2) & (F.col("_issued") == F.col("_refunded")), 7)
          .when(tt == 2, 8).otherwise(99))
    return j.withColumn("booking_type_id", bt).drop("_issued", "_refunded", "issued_to_doc")


def record_key(lines: DataFrame) -> DataFrame:
    """Record key = 'document-line'; lines of a conjunction ticket use the
    smallest line of their principal ticket."""
    g = ["extract_id", "product_id", "document_no", "principal_ticket"]
    m = (lines.where(F.col("principal_ticket").isNotNull() & (X.clean("principal_ticket") != ""))
         .groupBy(*g).agg(F.min("line_no").alias("_first_line")))
    j = lines.join(m, g, "left")
    return j.withColumn("record_key", F.concat_ws(
        "-", X.clean("document_no"), F.coalesce("_first_line", "line_no").cast("string"))).drop("_first_line")


# ---- D7 lineage ---------------------------------------------------------------------------

def lineage_keys(fact: DataFrame, lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Original and prior record key of each line, from the service ledger; its own key
    where nothing is found.

    Ledger entries of the same product, customer, traveller and locator (air, primary, entry
    type 3 or 4, amount not 0) are looked up by the line's ticket and by its original ticket,
    one equi join over both.  A candidate is the line's own entry for an invoice without an
    original ticket, another line's entry of the original ticket, or for a credit of the
    ticket as well; posted no later than the line.  No candidate lies behind the newest entry
    of the line's ticket (of the original one for exchanges).  Original: the issue of an
    exchange's original ticket first, then the own ticket, then the oldest; prior: the own
    ticket first, then an exchange's original ticket, then the newest.  The newest entry and
    both ranked choices are aggregates, so a hot customer is combined before the shuffle.
    """
    k = ["extract_id", "product_id", "document_no", "line_no"]
    same = ["product_id", "sell_to_customer_no", "traveller_code", "id_2"]
    l = lines.select(*k, *same[1:], "doc_kind", "ticket", "original_ticket", "exchange_ticket", "business_category",
                     "posting_date").withColumn(
        "token", F.explode(F.array_distinct(F.array_compact(F.array("ticket", "original_ticket")))))
    e = (ledger.where(F.col("service_group").isin(1, 6) & F.col("entry_type").isin(3, 4) & (F.col("resource_type") == 0)
                      & (F.col("amount_lcy_incl_vat") != 0))
         .select(*same, F.col("ticket_no").alias("token"), F.col("extract_id").alias("e_extract"), "entry_no", "entry_type",
                 F.col("document_no").alias("e_document"), F.col("line_no").alias("e_line"),
                 F.col("posting_date").alias("e_posting")))
    j = l.join(e, same + ["token"], "inner")
    own_ticket, original = F.col("token") == F.col("ticket"), F.col("token") == F.col("original_ticket")
    exchange = F.col("exchange_ticket") == 1
    at_limit = F.when(exchange, original).otherwise(own_ticket & (F.col("e_document") == F.col("document_no")))
    limit = (j.where(at_limit).groupBy(*k).agg(F.max(F.struct("e_extract", "entry_no")).alias("_m"))
             .select(*k, F.col("_m.entry_no").alias("_limit")))
    other = ~((F.col("e_document") == F.col("document_no")) & (F.col("e_line") == F.col("line_no")))
    own = ~other & F.col("original_ticket").isNull() & own_ticket
    fits = (F.when(F.col("doc_kind") == "I", own | (original & other)).otherwise((own_ticket | original) & other)
            & (F.col("e_posting") <= F.col("posting_date")))
    c = j.where(fits).join(limit, k, "inner").where(F.col("entry_no") <= F.col("_limit"))
    c = c.withColumn("_key", F.concat_ws("-", X.clean("e_document"), F.col("e_line").cast("string")))
    flag = lambda x: F.when(x, 0).otherwise(1)
    best = c.groupBy(*k).agg(
        F.min(F.struct(flag(exchange & (F.col("doc_kind") == "I") & original & (F.col("entry_type") == 3)).alias("a"),
                       flag(own_ticket).alias("b"), F.col("entry_no").alias("c"), F.col("_key"))).alias("_o"),
        F.min(F.struct(flag(own_ticket).alias("a"), flag((F.col("business_category") == 3) & original).alias("b"),
                       (-F.col("entry_no")).alias("c"), F.col("_key"))).alias("_p"))
    j = fact.join(best.select(*k, F.col("_o._key").alias("_ok"), F.col("_p._key").alias("_pk")), k, "left")
    return (j.withColumn("record_key_original", F.coalesce("_ok", "record_key"))
            .withColumn("record_key_prior", F.coalesce("_pk", "record_key")).drop("_ok", "_pk"))


# ---- D44 legs -------------------------------------------------------------------------------

def clean_legs(legs: DataFrame, as_of) -> DataFrame:
    """departure = plausible date (departure, else issue; +-5 years of
    ``as_of``) + HHMM time (default 12:00); codes longer than 3 -> '---';
    arrival = arrival day-month in the departure year + HHMM (default
    departure + 1 h), rolled a year forward when the flight crosses New
    Year; flight minutes from HHMM duration."""
    day = X.plausible_date(F.to_date("departure_date"), F.to_date("issued_date"), as_of)
    dep_min = X.hhmm_minutes("departure_time", 12 * 60)
    dep = F.to_timestamp_ntz(day) + F.make_dt_interval(F.lit(0), F.lit(0), dep_min)
    d = legs.withColumn("departure_ts", dep)
    for side in ("from", "to"):
        c = X.clean(f"city_{side}")
        d = d.withColumn(f"airport_{side}", F.when(F.length(c) > 3, F.lit("---")).otherwise(c))
    arr_day = F.try_to_timestamp(F.concat(X.clean("arrival_day_month"), F.lit("/"),
                                          F.year("departure_ts").cast("string")), F.lit("dd/MM/yyyy"))
    arr_day = F.coalesce(arr_day.cast("timestamp_ntz"), F.col("departure_ts"))
    arr_ok = X.hhmm_minutes("arrival_time", None)
    arr = F.when(arr_ok.isNotNull(), F.date_trunc("day", arr_day).cast("timestamp_ntz")
                 + F.make_dt_interval(F.lit(0), F.lit(0), arr_ok)) \
        .otherwise(F.col("departure_ts") + F.expr("INTERVAL 1 HOUR"))
    d = d.withColumn("flight_minutes", X.hhmm_minutes("fly_duration", None))
    d = d.withColumn("arrival_ts", arr)
    crosses = (F.col("arrival_ts") <= F.col("departure_ts")) & (
        F.year("departure_ts") < F.year(F.col("departure_ts") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.coalesce("flight_minutes", F.lit(0)))))
    return d.withColumn("arrival_ts", F.when(crosses, F.col("arrival_ts") + F.expr("INTERVAL 1 YEAR"))
                        .otherwise(F.col("arrival_ts")))


# fixed values: flexibility id -> tie-break priority (lower wins):
# 100 TravelFusion -1, 0 Unknown 0, 1 Non-flexible 1, 4 Changeable 2,
# 2 Refundable 3, 3 Fully-flexible 4
FLEX_PRIORITY = {"100": -1, "0": 0, "1": 1, "4": 2, "2": 3, "3": 4}


def fare_flexibility(segments: DataFrame, rules: DataFrame) -> DataFrame:
    """Most frequent flexibility (null counts as 0) for (product,
    airline, basis), else (airline, basis), else (airline, class); ties go
    to the flexibility priority; low-cost carriers 100; default 0.  The
    three levels are counted in one pass over the rule table."""
    r = rules.withColumn("_f", F.coalesce(F.col("flexibility_id"), F.lit(0)).cast("string"))
    modes = O.mode_by_levels(r, [["product_id", "airline", "basis"], ["airline", "basis"],
                                 ["airline", "class_code"]], "_f", FLEX_PRIORITY, "f")
    l1 = modes.where("level = 1").select("product_id", "airline", "basis", F.col("f").alias("f1"))
    l2 = modes.where("level = 2").select("airline", "basis", F.col("f").alias("f2"))
    l3 = modes.where("level = 3").select("airline", "class_code", F.col("f").alias("f3"))
    j = (segments.join(l1, ["product_id", "airline", "basis"], "left")
         .join(l2, ["airline", "basis"], "left")
         .join(l3, ["airline", "class_code"], "left"))
    flex = F.when(F.col("low_cost") == 1, F.lit(100)).otherwise(
        F.coalesce(F.coalesce("f1", "f2", "f3").cast("int"), F.lit(0)))
    return j.withColumn("fare_flexibility_id", flex).drop("f1", "f2", "f3")


def number_legs(segments: DataFrame, keys: Sequence[str] = SEG_KEY) -> DataFrame:
    """The two numbers of a segment within its ticket, side by side: ``segment_nbr``
    in (sales line, ledger entry, leg) order, and ``segment_nbr_adj`` in the order of the
    itinerary's own segment number first.  Trips are split along the first, everything told of
    a ticket or flight as a whole follows the second.  Both are uncapped, as they are order
    keys of later steps (``stored_numbers`` caps them)."""
    entry = [c for c in ("line_no", "entry_no", "leg_no") if c in segments.columns]
    own = ["segment_no"] if "segment_no" in segments.columns else []
    s = O.sequence_number(segments, list(keys), entry, "segment_nbr")
    return O.sequence_number(s, list(keys), own + entry, "segment_nbr_adj")


def stored_numbers(segments: DataFrame, cap: int = 255) -> DataFrame:
    """W2 at the sink: the numbers capped as stored; ``segment_order`` is the uncapped
    number, which still tells the segments of a ticket apart."""
    out = segments.withColumn("segment_order", F.col("segment_nbr"))
    for c in ("segment_nbr", "segment_nbr_adj"):
        if c in segments.columns:
            out = out.withColumn(c, F.least(c, F.lit(cap).cast("long")))
    return out


def in_itinerary_order(segments: DataFrame) -> DataFrame:
    """Segments whose order key ``segment_nbr`` is the itinerary's, where both are there."""
    return (segments.withColumn("segment_nbr", F.col("segment_nbr_adj")) if "segment_nbr_adj" in segments.columns
            else segments)


# ---- D55-D59 trips ------------------------------------------------------------------------

def split_trips(segments: DataFrame, keys: Sequence[str] = SEG_KEY, domestic_geo: int = 2,
                bucket=None) -> DataFrame:
    """A new trip starts after a gap > 4 h when neither segment is of
    the domestic geography type, or after any gap > 6 h.  Gap minutes
    count minute boundaries (end of previous -> start of this)."""
    def brk(prev: Column) -> Column:
        gap_h = X.minute_diff(prev["segment_end"], F.col("segment_start")) / 60.0
        return (((gap_h > 4.0) & (F.col("geography_type_id") != domestic_geo)
                 & (prev["geography_type_id"] != domestic_geo)) | (gap_h > 6.0))
    s = O.split_by_gap(segments, list(keys), ["segment_nbr"], ["segment_end", "geography_type_id"],
                       brk, out="trip_nbr", bucket=bucket)
    order = "segment_nbr_adj" if "segment_nbr_adj" in s.columns else "segment_nbr"
    return O.sequence_number(s, list(keys) + ["trip_nbr"], [order], "sequence_in_trip")


def build_flights(segments: DataFrame, geo_priority: DataFrame, keys: Sequence[str] = SEG_KEY) -> DataFrame:
    """Per trip: start, end, segment count, all-domestic flag,
    GDS miles; the geography with the smallest priority (argmin, no encoded
    key); class/cabin/airline of the first segment with that geography;
    first origin and the last destination differing from it."""
    gp = geo_priority.select("geography_type_id", "priority")
    s = in_itinerary_order(segments).join(gp, "geography_type_id", "left")
    g = list(keys) + ["trip_nbr"]
    agg = s.groupBy(*g).agg(
        F.min("segment_start").alias("travel_start"), F.max("segment_end").alias("travel_end"),
        F.count(F.lit(1)).alias("segment_cnt"), F.bool_and(F.col("within_country") == 1).alias("within_country"),
        F.sum("mileage_gds").alias("mileage_gds"),
        F.min(F.struct("priority", "geography_type_id")).alias("_g"),
        F.min(F.struct("segment_nbr", "airport_from")).alias("_o"))
    agg = agg.withColumn("geography_type_id", F.col("_g.geography_type_id")).withColumn(
        "airport_from", F.col("_o.airport_from"))
    first_geo = (s.join(agg.select(*g, "geography_type_id"), g + ["geography_type_id"], "left_semi")
                 .groupBy(*g).agg(F.min(F.struct("segment_nbr", "class_code", "cabin_class_id", "airline"))
                                  .alias("_f")))
    last_dest = (s.join(agg.select(*g, F.col("airport_from").alias("_af")), g)
                 .where(F.col("airport_to") != F.col("_af"))
                 .groupBy(*g).agg(F.max(F.struct("segment_nbr", "airport_to")).alias("_d")))
    out = agg.join(first_geo, g, "left").join(last_dest, g, "left")
    return out.select(*g, "travel_start", "travel_end", "segment_cnt", "within_country", "mileage_gds",
                      "geography_type_id", "airport_from", F.col("_d.airport_to").alias("airport_to"),
                      F.col("_f.class_code").alias("class_code"), F.col("_f.cabin_class_id").alias("cabin_class_id"),
                      F.col("_f.airline").alias("airline"))


# ---- D62 route text ---------------------------------------------------------------------

def route_text(segments: DataFrame, keys: Sequence[str] = ("extract_id", "record_key"),
               max_len: int = 150, order: Sequence[str] = ("segment_nbr",)) -> DataFrame:
    """D62: 'A/B/C' with '_X/Y' where a leg does not start where the previous
    ended.  Destination: the first return or open-leg point in segment order;
    else, from the last segment: its arrival on a one-trip ticket, otherwise
    its flight origin (the previous segment's departure when in the same
    trip, else its own) unless that is the route origin, then its arrival.
    Flight count = the last segment's trip number.  One window pass over a
    ticket's legs (a bounded group) and one aggregate replace the recursive
    CTE.  ``order``: the columns that ``segment_nbr`` was numbered by, when that
    was just done; the legs then stay as sorted and are not sorted again."""
    k = list(keys)
    w = Window.partitionBy(*k).orderBy(*order)
    s = (in_itinerary_order(segments).withColumn("_pf", F.lag("airport_from").over(w)).withColumn("_pt", F.lag("airport_to").over(w))
         .withColumn("_ptrip", F.lag("trip_nbr").over(w)))
    piece = (F.when(F.col("_pt").isNull(), F.concat_ws("/", "airport_from", "airport_to"))
             .when(F.col("_pt") == F.col("airport_from"), F.concat(F.lit("/"), F.col("airport_to")))
             .otherwise(F.concat(F.lit("_"), F.col("airport_from"), F.lit("/"), F.col("airport_to"))))
    turn = (F.when(F.col("_pt").isNotNull() & (F.col("airport_from") == F.col("_pt"))
                   & (F.col("airport_to") == F.col("_pf")), F.col("_pt"))
            .when(F.col("_pt").isNotNull() & (F.col("airport_from") != F.col("_pt")), F.col("_pt")))
    flight_from = F.when(F.col("_ptrip") == F.col("trip_nbr"), F.col("_pf")).otherwise(F.col("airport_from"))
    s = s.withColumn("_piece", piece).withColumn("_turn", turn).withColumn("_ff", flight_from)
    g = s.groupBy(*k).agg(
        O.concat_ordered("_piece", ["segment_nbr"], "").alias("route_txt"),
        F.min(F.struct("segment_nbr", "airport_from")).alias("_o"),
        F.min(F.when(F.col("_turn").isNotNull(), F.struct("segment_nbr", "_turn"))).alias("_t"),
        F.max(F.struct("segment_nbr", "trip_nbr", "airport_to", "_ff")).alias("_l"),
        F.count(F.lit(1)).alias("segment_cnt"))
    org, last = F.col("_o.airport_from"), F.col("_l")
    fallback = (F.when(last["trip_nbr"] == 1, last["airport_to"])
                .when(last["trip_nbr"] >= 2, F.when(org != last["_ff"], last["_ff"]).otherwise(last["airport_to"])))
    return g.select(*k, (X.fit("route_txt", max_len) if max_len else F.col("route_txt")).alias("route_txt"), org.alias("airport_from"),
                    F.coalesce(F.col("_t._turn"), fallback).alias("airport_to"), "segment_cnt",
                    last["trip_nbr"].cast("long").alias("flight_cnt"))


# ---- D66-D71 ticket roll-ups ------------------------------------------------------------

# fixed values: cabin priority 4, 1, 2, 5, 3, 0 (first is best)
CABIN_PRIORITY = {4: 1, 1: 2, 2: 3, 5: 4, 3: 5, 0: 6}


def ticket_rollups(segments: DataFrame, keys: Sequence[str] = ("extract_id", "record_key"),
                   flex_priority: dict = FLEX_PRIORITY) -> DataFrame:
    """D66 travel start/end (first/last segment), D67 Saturday-night stay,
    D68 segment count / distinct trips / all-domestic, D69 first fare basis
    and, where segments have one, the worst flexibility (least priority; none
    counts as 0, one without priority does not count),
    D70 trip type (1 one way, 2 round trip, 3 other), D71 best cabin by
    priority then trip."""
    k = list(keys)
    prio = X.map_code("cabin_class_id", CABIN_PRIORITY, 99)
    s = in_itinerary_order(segments).withColumn("_cp", prio)
    flexible = "fare_flexibility_id" in s.columns
    flex = F.coalesce(F.col("fare_flexibility_id"), F.lit(0)).cast("string") if flexible else F.lit(None).cast("string")
    g = s.groupBy(*k).agg(
        F.min(X.map_code(flex, flex_priority)).alias("_flex"),
        F.min(F.struct("segment_nbr", "segment_start", "basis")).alias("_first"),
        F.max(F.struct("segment_nbr", "segment_end")).alias("_last"),
        F.count(F.lit(1)).alias("segment_cnt"), F.count_distinct("trip_nbr").alias("trip_cnt"),
        F.bool_and(F.col("within_country") == 1).alias("within_country"),
        F.min(F.struct("_cp", "trip_nbr", "segment_nbr", "cabin_class_id", "class_code")).alias("_cab"),
        F.min(F.struct("segment_nbr", "airport_from")).alias("_o"),
        F.max(F.struct("segment_nbr", "airport_to")).alias("_d"))
    start, end = F.col("_first.segment_start"), F.col("_last.segment_end")
    trip_type = (F.when(F.col("trip_cnt") == 1, 1)
                 .when((F.col("trip_cnt") == 2) & (F.col("_o.airport_from") == F.col("_d.airport_to")), 2)
                 .otherwise(3))
    return g.select(*k, start.alias("travel_start"), end.alias("travel_end"),
                    X.saturday_stay(start, end).alias("saturday_night_stay"),
                    "segment_cnt", "trip_cnt", "within_country",
                    F.col("_first.basis").alias("first_basis"), trip_type.alias("trip_type_id"),
                    F.col("_cab.cabin_class_id").alias("cabin_class_id"),
                    F.col("_cab.class_code").alias("class_code"),
                    *([X.map_code("_flex", {p: int(f) for f, p in flex_priority.items()}).alias("fare_flexibility_id")]
                      if flexible else []))


def mark_incomplete(fact: DataFrame, segments: DataFrame, keys=("extract_id", "record_key")) -> tuple[DataFrame, DataFrame]:
    """Tickets with a segment lacking an airport get status 10; those
    segments are dropped."""
    k = list(keys)
    bad = segments.where(F.col("airport_from").isNull() | F.col("airport_to").isNull())
    f = fact.join(bad.select(*k).distinct().withColumn("_bad", F.lit(True)), k, "left")
    f = f.withColumn("record_status_id", F.when(F.col("_bad"), F.lit(10)).otherwise(F.col("record_status_id")))
    keep = segments.where(F.col("airport_from").isNotNull() & F.col("airport_to").isNotNull())
    return f.drop("_bad"), keep


# ---- D31 remarks ------------------------------------------------------------------------

def parse_remarks(tagged: DataFrame, patterns: Sequence[tuple[str, int]]) -> DataFrame:
    """Rank remark lines by the first matching pattern (rank order),
    keep the first per file; login = last blank-separated token; amount with
    ',' as decimal separator."""
    rank = None
    for pat, r in patterns:
        rank = F.when(F.col("text1").rlike(pat), r) if rank is None else rank.when(F.col("text1").rlike(pat), r)
    t = tagged.withColumn("remark_rank", rank).where(F.col("remark_rank").isNotNull())
    first = O.first_per_key(t.select("extract_id", "file_name", "remark_rank", "line_id", "text1"),
                            ["extract_id", "file_name"], ["remark_rank", "line_id"])
    amt = F.regexp_extract("text1", "([0-9]+[.,][0-9]+)", 1)
    return first.select("extract_id", "file_name", "remark_rank",
                        X.last_token(F.trim("text1"), " ").alias("login"),
                        F.when(amt != "", X.to_money(amt)).alias("amount"))


# ---- D53 / D54 offsets and durations -------------------------------------------------------

def with_utc_offset(segments: DataFrame, locations: DataFrame, zones: DataFrame, dst: DataFrame) -> DataFrame:
    """Offset of each end from the location's zone, daylight table by
    effective date; D54 duration minutes (null beyond 22 days, signed)."""
    loc = locations.select(F.col("location_code").alias("_lc"), "tz_id")
    z = zones.select("tz_id", F.col("offset_min").alias("_std"))
    d = dst.select(F.col("tz_id").alias("_dz"), F.col("offset_min").alias("_dst"), "begin_ts", "end_ts")
    out = segments
    for side, ts in (("from", "segment_start"), ("to", "segment_end")):
        out = (out.join(loc, out[f"airport_{side}"] == loc["_lc"], "inner").drop("_lc")
               .join(z, "tz_id", "inner"))
        out = O.dated_join(out, d, [("tz_id", "_dz")], ts, "begin_ts", "end_ts", "left")
        out = (out.withColumn(f"{side}_offset_min", F.coalesce("_dst", "_std"))
               .drop("tz_id", "_std", "_dz", "_dst", "begin_ts", "end_ts"))
    start_utc = X.to_utc(F.col("segment_start"), F.col("from_offset_min"))
    end_utc = X.to_utc(F.col("segment_end"), F.col("to_offset_min"))
    return out.withColumn("duration_minutes", X.duration_minutes(start_utc, end_utc,
                                                                 X.sign_factor("booking_type_id")))


# ---- D35 record status --------------------------------------------------------------------

# fixed values: fact record statuses
STATUS_SUBSCRIPTION, STATUS_EXCHANGE_PENALTY, STATUS_ANCILLARY = 12, 11, 13
# fixed values: products treated as ancillary regardless of the invoice date
ANCILLARY_PRODUCTS = (60010, 60013, 60083, 60035)
ANCILLARY_FROM = "2014-01-01"


def record_status(fact: DataFrame, invoice_lines: DataFrame, credit_lines: DataFrame) -> DataFrame:
    """Subscription (category 4 or subscription flag) 12; category 6
    with subcategory 1-3 (for the listed products or invoices from 2014)
    exchange penalty 11; other category 6 under the same condition
    ancillary 13; category 7 subcategory 1-2 -> 11; else unchanged.  The
    invoice-or-credit line of each fact row is one union joined once."""
    k = ["extract_id", "product_id", "document_no", "line_no"]
    cols = k + ["business_category", "business_sub_category", "subscription"]
    lines = invoice_lines.select(*cols).unionByName(credit_lines.select(*cols))
    j = fact.join(lines, k, "left")
    cat, sub = F.col("business_category"), F.col("business_sub_category")
    anc_scope = F.col("product_id").isin(*ANCILLARY_PRODUCTS) | (F.col("invoice_date") >= F.lit(ANCILLARY_FROM))
    st = (F.when((cat == 4) | (F.col("subscription") == 1), STATUS_SUBSCRIPTION)
          .when((cat == 6) & sub.isin(1, 2, 3) & anc_scope, STATUS_EXCHANGE_PENALTY)
          .when((cat == 6) & ~F.coalesce(sub, F.lit(0)).isin(1, 2, 3) & anc_scope, STATUS_ANCILLARY)
          .when((cat == 7) & sub.isin(1, 2), STATUS_EXCHANGE_PENALTY)
          .otherwise(F.col("record_status_id")))
    return j.withColumn("record_status_id", st).drop("business_category", "business_sub_category", "subscription")


# ---- D20 / D84 / D85 amounts ------------------------------------------------------------

def link_penalty_by_time(exchanges: DataFrame, penalties: DataFrame, minutes: int = 2) -> DataFrame:
    """An exchange takes the gross of the single penalty of its
    (dossier, traveller, locator) posted fewer than ``minutes`` minute
    boundaries after it (not before).  Groups with several penalties are
    ignored (HAVING count = 1)."""
    g = ["meta_dossier_id", "traveler_id", "pnr_code"]
    single = penalties.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"),
                                       F.max("posting_date").alias("penalty_posting"),
                                       F.max("gross_amt").alias("penalty_gross")).where("_n = 1").drop("_n")
    pairs = O.near_in_time(exchanges.select("record_key", "booking_type_id", *g, "posting_date"),
                           single, g, "posting_date", "penalty_posting", minutes)
    add = pairs.select("record_key", "booking_type_id", "penalty_gross")
    j = exchanges.join(add, ["record_key", "booking_type_id"], "left")
    return j.withColumn("gross_amt", F.col("gross_amt") + F.coalesce("penalty_gross", F.lit(0)))


def sign_refunds(fact: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Void / refund / partial-refund amounts negative, others as they are."""
    negative = F.col("booking_type_id").isin(*X.NEGATIVE_TYPES)
    return fact.withColumns({a: F.when(negative, -F.abs(a)).otherwise(F.col(a)) for a in amounts})


def composite_key(fact: DataFrame, segments: DataFrame) -> DataFrame:
    """Purchases get 'FROM-TO/FROM-TO...' over their segments in
    order, online fees defaulted to 0 and the dossier as int when it is a
    number that fits (dashes removed)."""
    legs = (in_itinerary_order(segments).where(F.col("booking_type_id") != 99)
            .withColumn("_codes", F.concat_ws("-", "airport_from", "airport_to"))
            .groupBy("record_key").agg(O.concat_ordered("_codes", ["segment_nbr"], "/").alias("composite_key")))
    dossier = F.regexp_replace(X.clean("meta_dossier_id"), "-", "")
    ok = (F.col("booking_type_id") == X.BT_PURCHASE) & X.is_int32_text(dossier)
    j = fact.join(legs, "record_key", "left")
    return (j.withColumn("composite_key", F.when(ok, F.col("composite_key")))
            .withColumn("ob_fees_amt", F.coalesce("ob_fees_amt", F.lit(0)))
            .withColumn("md_code", F.when(ok, dossier.cast("int"))))


# ---- D2 / D4 candidate lines ----------------------------------------------------------------

def _eligible(headers: DataFrame, lines: DataFrame, legs: DataFrame, extract_id) -> DataFrame:
    h = headers.where(F.col("extract_id") == F.lit(extract_id)).select(
        "extract_id", "product_id", F.col("no").alias("document_no"), "sell_to_customer_no",
        *[c for c in ("issued_to_doc",) if c in headers.columns])
    j = lines.drop("sell_to_customer_no").join(h, ["extract_id", "product_id", "document_no"], "inner")
    j = j.where((F.col("resource_type") == 0) & F.col("service_group").isin(1, 6)
                & F.col("ticket_type").isin(1, 2, 3) & X.is_numeric_text("sell_to_customer_no"))
    has_leg = legs.select("extract_id", "product_id", "document_no", F.col("ticket_no").alias("ticket"))
    j = j.join(has_leg, ["extract_id", "product_id", "document_no", "ticket"], "left_semi")
    return j.withColumn("record_key", X.fit(F.concat_ws("-", "document_no", F.col("line_no").cast("string")), 30))


def invoice_candidates(headers: DataFrame, lines: DataFrame, legs: DataFrame, extract_id) -> DataFrame:
    """Primary-resource air / low-cost invoice lines of ticket type 1-3,
    numeric customer, line type 3, not a group event, with a travel leg of
    the same ticket.  Non-exchange lines (document type 1, booking type
    decided later) and issued exchanges (document type 2, booking type 5,
    agent-assisted).  The cancel-repaid branch cannot fire (Q1) and is left
    out."""
    j = _eligible(headers, lines, legs, extract_id).where((F.col("type") == 3) & (F.col("group") != 1))
    agent = F.when(F.col("reservation_mode") == 2, 0).otherwise(1)
    no_principal = F.coalesce(X.clean("principal_ticket"), F.lit("")) == ""
    base = ["extract_id", "document_no", "line_no", "record_key", "ticket", "original_ticket", "product_id"]
    plain = j.where((F.col("exchange_ticket") == 0) & no_principal).select(
        *base, F.lit(1).alias("sales_document_type_id"), F.lit(None).cast("int").alias("booking_type_id"),
        agent.alias("agent_assisted"))
    exch = j.where((F.col("exchange_ticket") == 1) & (F.col("ticket_type") == 1) & no_principal).select(
        *base, F.lit(2).alias("sales_document_type_id"), F.lit(X.BT_EXCHANGE).alias("booking_type_id"),
        F.lit(1).alias("agent_assisted"))
    return plain.unionByName(exch)


def credit_candidates(headers: DataFrame, lines: DataFrame, legs: DataFrame, extract_id) -> DataFrame:
    """Eligible credit lines of business category 1, 3 or 10; kept when
    they have no principal ticket, or the principal ticket's summed amount
    on the document is non-zero (one aggregate joined back)."""
    j = _eligible(headers, lines, legs, extract_id).where(F.col("business_category").isin(1, 3, 10))
    sums = (lines.where((F.col("extract_id") == F.lit(extract_id)) & (F.col("resource_type") == 0))
            .groupBy("product_id", "document_no", F.col("ticket").alias("principal_ticket"))
            .agg(F.sum("amount_incl_vat").alias("_principal_sum")))
    j = j.join(sums, ["product_id", "document_no", "principal_ticket"], "left")
    no_principal = F.coalesce(X.clean("principal_ticket"), F.lit("")) == ""
    keep = no_principal | (F.coalesce(F.col("_principal_sum") != 0, F.lit(False)))
    return j.where(keep).select("extract_id", "document_no", "line_no", "record_key", "ticket", "original_ticket",
                                "product_id", F.lit(2).alias("sales_document_type_id"),
                                F.lit(None).cast("int").alias("booking_type_id"), F.lit(1).alias("agent_assisted"),
                                F.col("issued_to_doc").alias("sales_document_prior"))


# ---- D47 cabin override -----------------------------------------------------------------

# fixed values: cabin of the special class codes
SPECIAL_CLASS_CABIN = {"-B": 2, "-E": 3, "-F": 1, "-P": 5}
# fixed values: countries whose flights to or from France count as economy
# for the AF class rule
AF_SHORT_HAUL = ["ALB", "AND", "ARM", "AUT", "AZE", "BLR", "BEL", "BIH", "BGR", "HRV", "CZE", "DNK",
                 "EST", "FRO", "FIN", "GEO", "DEU", "GIB", "GRC", "HUN", "ISL", "IRL", "ITA", "LVA",
                 "LIE", "LTU", "LUX", "MLT", "MDA", "MCO", "NLD", "NOR", "POL", "PRT", "MKD", "ROU",
                 "RUS", "SMR", "SCG", "SVK", "SVN", "ESP", "SJM", "SWE", "CHE", "TUR", "UKR", "GBR",
                 "MNE", "SRB", "VAT", "GRL", "CYP", "ISR", "DZA", "MAR", "TUN"]


def cabin_class(legs: DataFrame, class_dim: DataFrame) -> DataFrame:
    """Cabin of a leg.  Special class codes map directly; for AF a
    domestic French leg is economy, classes A/S/W/P/F between France and a
    listed country are economy, otherwise A/S/W premium economy and P/F
    first; anything else comes from the class-of-service dimension
    (airline, first class letter), default 0.  Also the stored class code
    ('-' for the special codes) and the within-country flag."""
    classe = X.clean("class_code_raw")
    c1 = F.substring(classe, 1, 1)
    cf = F.coalesce(F.col("from_country_code"), F.lit("---"))
    ct = F.coalesce(F.col("to_country_code"), F.lit("---"))
    domestic_fr = F.concat(cf, ct) == "FRAFRA"
    short = ((cf == "FRA") & ct.isin(*AF_SHORT_HAUL)) | ((ct == "FRA") & cf.isin(*AF_SHORT_HAUL))
    dim = O.first_per_key(class_dim.select("airline_code", "class_code", "cabin_class_id"),
                          ["airline_code", "class_code"], ["cabin_class_id"])
    d = dim.select(F.col("airline_code").alias("_al"), F.col("class_code").alias("_cc"),
                   F.col("cabin_class_id").alias("_dim_cabin"))
    j = legs.join(d, (F.col("airline") == d["_al"]) & (c1 == d["_cc"]), "left")
    af = F.col("airline") == "AF"
    cabin = (F.when(classe.isin(*SPECIAL_CLASS_CABIN), X.map_code(classe, SPECIAL_CLASS_CABIN))
             .when(af & domestic_fr, 3)
             .when(af & c1.isin("A", "S", "W", "P", "F") & short, 3)
             .when(af & c1.isin("A", "S", "W") & ~domestic_fr, 5)
             .when(af & c1.isin("P", "F") & ~domestic_fr, 1)
             .otherwise(F.coalesce(F.col("_dim_cabin"), F.lit(0))))
    return (j.withColumn("cabin_class_id", cabin)
            .withColumn("class_code", F.when(classe.isin(*SPECIAL_CLASS_CABIN), F.lit("-")).otherwise(c1))
            .withColumn("within_country", F.when(F.col("from_country_code") == F.col("to_country_code"), 1)
                        .otherwise(0))
            .drop("_al", "_cc", "_dim_cabin"))


# ---- D8 / D43 seeds --------------------------------------------------------------------------

UNKNOWN_BOOKING_TYPE = 199


def write_seeds(working: DataFrame, path: str | None = None) -> DataFrame:
    """The classified working rows become fact seeds (null booking type
    -> 199, status 0).  With ``path`` the extract's partition is replaced
    (a re-run does not append twice, M8)."""
    out = working.select(
        "extract_id", "document_no", "line_no", "sales_document_type_id",
        F.coalesce(F.col("booking_type_id"), F.lit(UNKNOWN_BOOKING_TYPE)).alias("booking_type_id"),
        "product_id", "record_key",
        *[F.col(c) for c in ("record_key_prior", "record_key_original", "sales_document_prior", "ticket",
                             "original_ticket", "agent_assisted") if c in working.columns],
        F.lit(0).alias("record_status_id"))
    if path:
        from itinera.sources import replace_slice
        replace_slice(out, path, ["extract_id"])
    return out


def _principal_lines(headers: DataFrame, lines: DataFrame, legs: DataFrame, extract_id) -> DataFrame:
    """Eligible lines with their principal ticket's summed amount, whether it has a leg on the
    document, and the record key: the line's own, or that of the principal ticket's first
    primary line of the same ticket type (null where there is none)."""
    g = ["extract_id", "product_id", "document_no"]
    own = lines.where((F.col("extract_id") == F.lit(extract_id)) & (F.col("resource_type") == 0))
    principal = F.col("ticket").alias("principal_ticket")
    sums = own.groupBy(*g, principal).agg(F.sum("amount_incl_vat").alias("_sum"))
    firsts = own.where(F.col("service_group").isin(1, 6)).groupBy(*g, principal, "ticket_type").agg(
        F.min("line_no").alias("_first_line"))
    flown = legs.select(*g, F.col("ticket_no").alias("principal_ticket")).distinct().withColumn("_flown", F.lit(True))
    alone = F.coalesce(X.clean("principal_ticket"), F.lit("")) == ""
    j = (_eligible(headers, lines, legs, extract_id).join(sums, [*g, "principal_ticket"], "left")
         .join(firsts, [*g, "principal_ticket", "ticket_type"], "left").join(flown, [*g, "principal_ticket"], "left"))
    number = F.when(alone, F.col("line_no")).otherwise(F.col("_first_line"))
    return j.withColumns({"_alone": alone, "_paid": alone | F.coalesce(F.col("_sum") != 0, F.lit(False)),
                          "_flown": F.coalesce("_flown", F.lit(False)),
                          "record_key": F.when(number.isNotNull(), F.concat_ws("-", X.clean("document_no"), number.cast("string")))})


def segment_lines(fact: DataFrame, invoices: tuple[DataFrame, DataFrame], credits: tuple[DataFrame, DataFrame],
                  legs: DataFrame, extract_id) -> DataFrame:
    """The sales lines whose legs become segments, as one relation of three branches:
    invoices that are no exchange (conjunction tickets too, where the principal ticket was paid
    and has a leg), issued exchanges (type 5), and credits.  Conjunction lines carry the record
    key of their principal line, so their legs join that ticket.  A line without a type takes
    the ticket's (the smallest of several); lines of no loaded ticket are left out.

    ``invoices`` and ``credits`` are (headers, lines)."""
    inv = _principal_lines(*invoices, legs, extract_id).where((F.col("type") == 3) & (F.col("group") != 1))
    cols = ["extract_id", "product_id", "document_no", "line_no", "ticket", "record_key"]
    untyped = F.lit(None).cast("int").alias("booking_type_id")
    plain = inv.where((F.col("exchange_ticket") == 0) & (F.col("_alone") | (F.col("_paid") & F.col("_flown")))).select(*cols, untyped)
    exchanged = inv.where((F.col("exchange_ticket") == 1) & (F.col("ticket_type") == 1) & F.col("_paid")).select(
        *cols, F.lit(X.BT_EXCHANGE).alias("booking_type_id"))
    cr = _principal_lines(*credits, legs, extract_id).where(F.col("business_category").isin(1, 3, 10) & F.col("_paid"))
    lines = plain.unionByName(exchanged).unionByName(cr.select(*cols, untyped))
    key = ["extract_id", "product_id", "record_key"]
    kinds = fact.groupBy(*key).agg(F.min("booking_type_id").alias("_type"))
    typed = lines.join(kinds, key, "inner").withColumn("booking_type_id", F.coalesce("booking_type_id", "_type")).drop("_type")
    return typed.join(fact.select(*key, "booking_type_id"), [*key, "booking_type_id"], "left_semi")


def segment_seeds(fact: DataFrame, legs: DataFrame) -> DataFrame:
    """The travel legs of the loaded tickets (same extract, product,
    document and ticket), each with its ticket's record key and booking
    type, so segments inherit the classification of the fact."""
    f = fact.select("extract_id", "product_id", "document_no", F.col("ticket").alias("ticket_no"),
                    "record_key", "booking_type_id", "line_no").dropDuplicates(
        ["extract_id", "product_id", "document_no", "ticket_no", "record_key", "booking_type_id"])
    return legs.join(f.drop("line_no"), ["extract_id", "product_id", "document_no", "ticket_no"], "inner")
