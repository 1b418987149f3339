"""Air savings: fare summaries, ticket-to-fare matching, lowest fare and
negation.  Message tables are first reduced to the keys in play (explicit
semi joins), then summarised with aggregates (no per-row sub-selects)."""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O

MSG = ["extract_id", "message_unique_id"]
BF = MSG + ["booked_fare_number"]
PCT = Decimal("0.03")
# fixed values: geometry pairs of rule 1 (booked, comparison)
RULE1_SHAPES = [("OW", "OW"), ("RT", "RT"), ("OW", "2OW")]


def savings_keys(messages: DataFrame, tickets: DataFrame) -> DataFrame:
    """Newest extract per message, original purchases only, and only
    messages whose locator appears on a ticket of the batch."""
    newest = messages.groupBy("message_unique_id").agg(F.max("extract_id").alias("extract_id"))
    m = messages.join(newest, MSG, "left_semi").where(F.col("type") == "ORIGINAL")
    return m.join(tickets.select(F.col("pnr_code").alias("pnr")).distinct(), "pnr", "left_semi")


def fare_summary(fares: DataFrame, amounts: DataFrame, segments: DataFrame,
                 keys: Sequence[str], amount_types: Sequence[str] = ("BASE", "TAX", "TOTAL", "ANCILLARY"),
                 pct: Decimal = PCT) -> DataFrame:
    """Per fare key: amounts pivoted by type, geometry type
    (legs and fares), first / last segment attributes, route text
    ('FROM-TO/FROM-TO' in segment order) and marketing carriers ('C1/C2'),
    ancillary flag, +-pct bounds."""
    k = list(keys)
    piv = O.pivot_sum(amounts.select(*k, "amount_type", "amount"), k, "amount_type", "amount",
                      list(amount_types), prefix="amt_")
    # route text 'FROM-TO/FROM-TO' in segment order (the ticket composite key's
    # format) and the carriers joined by '/'; missing codes count as ''
    segments = (segments.withColumn("_leg", F.concat(F.coalesce("airport_from", F.lit("")), F.lit("-"),
                                                    F.coalesce("airport_to", F.lit(""))))
                .withColumn("_carrier", F.coalesce("marketing_carrier", F.lit(""))))
    seg = segments.groupBy(*k).agg(
        F.count(F.lit(1)).alias("segment_cnt"),
        F.count_distinct("leg_number").alias("leg_cnt"),
        F.min(F.struct("segment_rank", "departure_date", "marketing_carrier", "booking_class",
                       "cabin_class_id", "fare_basis", "airport_from")).alias("_first"),
        F.max(F.struct("segment_rank", "arrival_date", "airport_to")).alias("_last"),
        O.concat_ordered("_leg", ["segment_rank"], "/").alias("route_txt"),
        O.concat_ordered("_carrier", ["segment_rank"], "/").alias("marketing_carrier"))
    out = fares.join(piv, k, "left").join(seg, k, "left")
    total = F.coalesce(F.col("amt_TOTAL"), F.lit(0))
    return out.select(
        *[c for c in fares.columns], *[f"amt_{t}" for t in amount_types], "segment_cnt",
        O.geometry_type(F.coalesce("leg_cnt", F.lit(0)), F.col("fare_cnt") if "fare_cnt" in fares.columns
                        else F.lit(1)).alias("geometry_type"),
        F.col("_first.departure_date").alias("from_date"), F.col("_last.arrival_date").alias("to_date"),
        F.col("_first.marketing_carrier").alias("first_carrier"),
        F.col("_first.booking_class").alias("first_booking_class"),
        F.col("_first.cabin_class_id").alias("first_cabin_class_id"),
        F.col("_first.fare_basis").alias("first_fare_basis"),
        "route_txt", "marketing_carrier",
        F.when(F.coalesce(F.col("amt_ANCILLARY"), F.lit(0)) != 0, 1).otherwise(0).alias("has_ancillaries"),
        total.alias("total_amount"),
        (total * F.lit(1 - pct)).alias("total_amount_down"), (total * F.lit(1 + pct)).alias("total_amount_up"))


MATCH_KEYS = [("composite_key", "route_txt"), ("segment_cnt", "segment_cnt"), ("travel_start", "from_date"),
              ("travel_end", "to_date"), ("traveler_id", "percode"), ("pnr_code", "pnr")]


def match_savings(tickets: DataFrame, fares: DataFrame, pct: Decimal = PCT) -> DataFrame:
    """A purchase matches a fare on route key, segment count, start and end date,
    traveller and locator, with the paid amount (less online fees) within ``pct`` of the fare's
    total; no ancillaries; numeric dossier; no negative totals.  One row per matched ticket:
    the fare with the smallest difference, then the newest extract, then the smallest message,
    booked fare and fare number.  Percentage difference: 100 when equal or the fare is 0."""
    t = tickets.where((F.col("booking_type_id") == X.BT_PURCHASE)
                      & X.is_int32_text(X.clean("meta_dossier_id"))).withColumn("_paid", F.col("ticket_amt") - F.col("ob_fees_amt"))
    f = (fares.where((F.col("has_ancillaries") == 0) & (F.col("total_amount") >= 0))
         .withColumn("_extract", F.col("extract_id")))
    j = O.match_nearest(t.select("extract_id", "record_key", "booking_type_id", "_paid", *[l for l, _ in MATCH_KEYS]), f,
                        MATCH_KEYS, "_paid", "total_amount", pct,
                        ["-_extract", "message_unique_id", "booked_fare_number", "fare_number"],
                        ["message_unique_id", "booked_fare_number", "fare_number", "total_amount"])
    diff = (F.when((F.col("_paid") == F.col("total_amount")) | (F.col("total_amount") == 0), F.lit(100.0))
            .otherwise(F.col("_paid").cast("double") * 100.0 / F.col("total_amount").cast("double")))
    return j.where(F.col("message_unique_id").isNotNull()).select(
        "extract_id", "record_key", "booking_type_id", "message_unique_id", "booked_fare_number", "fare_number",
        diff.alias("amt_percentage_diff"))


def matched_total(matches: DataFrame, flights: DataFrame) -> DataFrame:
    """Total flight amount per matched booked fare beside each row."""
    j = matches.join(flights.select("record_key", "booking_type_id", "flight_value"),
                     ["record_key", "booking_type_id"], "inner")
    return O.with_group_total(j, BF, "flight_value", "booked_fare_total")


def paid_total(matches: DataFrame, tickets: DataFrame) -> DataFrame:
    """What all tickets matched to a booked fare paid (less online fees), beside each
    matched ticket."""
    k = ["record_key", "booking_type_id"]
    j = matches.select(*k, *BF).join(tickets.select(*k, "ticket_amt", "ob_fees_amt"), k, "inner")
    total = j.groupBy(*BF).agg((F.sum("ticket_amt") - F.sum("ob_fees_amt")).alias("savings_total_flight_amount"))
    return j.join(total, BF, "inner").select(*k, "savings_total_flight_amount")


def lowest_recommended(options: DataFrame) -> DataFrame:
    """Cheapest lowest-recommended comparison option per booked fare."""
    rec = options.where(F.col("is_lowest_recommended_fare") == 1)
    return O.first_per_key(rec, BF, ["total_amount", "comparison_option_number"])


def _cases(matches: DataFrame, fares: DataFrame, chosen: DataFrame, extra=()) -> DataFrame:
    m = matches.select("record_key", "booking_type_id", *BF, "fare_number")
    f = fares.select(*BF, "fare_number", F.col("geometry_type").alias("booked_geometry_type"))
    c = chosen.select(*BF, "comparison_option_number", F.col("geometry_type").alias("comparison_geometry_type"),
                      *extra)
    return m.join(f, BF + ["fare_number"]).join(c, BF)


def lrf_cases(matches: DataFrame, fares: DataFrame, options: DataFrame) -> DataFrame:
    """Each matched ticket with its booked fare's shape and the shape of
    the cheapest lowest-recommended option."""
    return _cases(matches, fares, lowest_recommended(options))


def pub_cases(matches: DataFrame, fares: DataFrame, options: DataFrame) -> DataFrame:
    """Each matched ticket with the cheapest published option of every
    flexibility level."""
    return _cases(matches, fares, published_options(options), extra=("flexibility_level",))


def lowest_fare_rule1(tickets: DataFrame, cases: DataFrame, comp_fares: DataFrame,
                      options: DataFrame, booked: DataFrame, fares: DataFrame) -> DataFrame:
    """D95 rule 1 (same shape: OW/OW, RT/RT, OW/2OW): lowest fare in policy
    is the paid amount when the lowest option is the booked fare; otherwise
    the comparison total, plus online fees when both are regular carriers
    with the same marketing carrier."""
    shapes = None
    for b, c in RULE1_SHAPES:
        cond = (F.col("booked_geometry_type") == b) & (F.col("comparison_geometry_type") == c)
        shapes = cond if shapes is None else shapes | cond
    opt_k = BF + ["comparison_option_number"]
    j = (cases.where(shapes)
         .join(tickets.select("record_key", "booking_type_id", "ticket_amt", "ob_fees_amt"),
               ["record_key", "booking_type_id"])
         .join(comp_fares.select(*opt_k, F.col("comparison_fare_number").alias("fare_number"),
                                 F.col("total_amount").alias("cmp_total"),
                                 F.col("is_lowcost").alias("cmp_lowcost"), "first_carrier"), opt_k + ["fare_number"])
         .join(options.select(*opt_k, "is_booked_fare", F.col("marketing_carrier").alias("opt_carrier")), opt_k)
         .join(booked.select(*BF, F.col("marketing_carrier").alias("booked_carrier")), BF)
         .join(fares.select(*BF, "fare_number", F.col("is_lowcost").alias("fare_lowcost")), BF + ["fare_number"]))
    same_regular = (F.col("cmp_lowcost") == 0) & (F.col("booked_carrier") == F.col("opt_carrier"))
    low = (F.when(F.col("is_booked_fare") == 1, F.col("ticket_amt"))
           .when((F.col("fare_lowcost") == 0) & same_regular, F.col("cmp_total") + F.col("ob_fees_amt"))
           .otherwise(F.col("cmp_total")))
    return j.select("record_key", "booking_type_id",
                    F.concat(F.lit("1. || "), F.col("booked_geometry_type"), F.lit(" vs "),
                             F.col("comparison_geometry_type")).alias("savings_rule"),
                    F.when(F.col("is_booked_fare") == 1, 1).otherwise(0).alias("low_fare_chosen"),
                    low.alias("fare_amt_lowest"), F.col("first_carrier").alias("airline_lowest"))


def negate_savings(savings: DataFrame) -> DataFrame:
    """No lowest fare, or a lowest fare above the paid fare -> the paid
    fare with rule 4.  Every value reads the row before the change."""
    neg = F.col("fare_amt_lowest").isNull() | (F.col("fare_amt_lowest") > F.col("ticket_amt"))
    return savings.select(
        *[c for c in savings.columns if c not in ("fare_amt_lowest", "savings_rule")],
        F.when(neg, F.col("ticket_amt")).otherwise(F.col("fare_amt_lowest")).alias("fare_amt_lowest"),
        F.when(neg, F.lit("4")).otherwise(F.col("savings_rule")).alias("savings_rule"))


def finish_savings(fact: DataFrame, legacy: DataFrame, engine: DataFrame, activation_date) -> DataFrame:
    """Invoices before the activation date keep the legacy savings,
    later ones take the engine's."""
    k = ["record_key", "booking_type_id"]
    l = legacy.select(*k, F.col("fare_amt_lowest").alias("_legacy"))
    e = engine.select(*k, F.col("fare_amt_lowest").alias("_engine"))
    j = fact.join(l, k, "left").join(e, k, "left")
    use_legacy = F.to_date("invoice_date") < F.lit(activation_date).cast("date")
    return j.withColumn("fare_amt_lowest", F.when(use_legacy, F.col("_legacy")).otherwise(F.col("_engine"))) \
        .drop("_legacy", "_engine")


def _rule_frame(tickets, cases, options, booked, fares, shapes):
    cond = None
    for b, c in shapes:
        x = (F.col("booked_geometry_type") == b) & (F.col("comparison_geometry_type") == c)
        cond = x if cond is None else cond | x
    opt_k = BF + ["comparison_option_number"]
    return (cases.where(cond)
            .join(tickets.select("record_key", "booking_type_id", "ticket_amt", "ob_fees_amt",
                                 *[c for c in ("savings_total_flight_amount",) if c in tickets.columns]),
                  ["record_key", "booking_type_id"])
            .join(options.select(*opt_k, "is_booked_fare", F.col("marketing_carrier").alias("opt_carrier"),
                                 F.col("total_amount").alias("opt_total"), F.col("is_lowcost").alias("opt_lowcost"),
                                 F.col("first_carrier").alias("opt_first_carrier")), opt_k)
            .join(booked.select(*BF, F.col("marketing_carrier").alias("booked_carrier")), BF)
            .join(fares.select(*BF, "fare_number", F.col("is_lowcost").alias("fare_lowcost"),
                               F.col("total_amount").alias("fare_total")), BF + ["fare_number"]))


def lowest_fare_rules23(tickets: DataFrame, cases: DataFrame, comp_fares: DataFrame, options: DataFrame,
                        booked: DataFrame, fares: DataFrame) -> DataFrame:
    """D95 rules 2 and 3.  Rule 2 (OW booked vs RT offered): the offered
    fare pro-rated by the booked fare's share of the flight total (the first
    comparison fare of the option stands in: the source join is not
    restricted).  Rule 3 (RT vs 2OW): the option total.  Both add online
    fees when the regular offered carrier equals the booked one; the paid
    amount when the lowest option is the booked fare."""
    opt_k = BF + ["comparison_option_number"]
    first_cf = O.first_per_key(
        comp_fares.select(*opt_k, "comparison_fare_number", F.col("total_amount").alias("cmp_total"),
                          F.col("is_lowcost").alias("cmp_lowcost"), F.col("first_carrier").alias("cmp_first_carrier")),
        opt_k, ["comparison_fare_number"])
    r2 = _rule_frame(tickets, cases, options, booked, fares, [("OW", "RT")]).join(first_cf, opt_k)
    share = F.col("fare_total") / F.col("savings_total_flight_amount") * F.col("cmp_total")
    same2 = (F.col("cmp_lowcost") == 0) & (F.col("booked_carrier") == F.col("opt_carrier"))
    low2 = (F.when(F.col("is_booked_fare") == 1, F.col("ticket_amt"))
            .when((F.col("fare_lowcost") == 0) & same2, share + F.col("ob_fees_amt")).otherwise(share))
    out2 = r2.select("record_key", "booking_type_id", F.lit(2).alias("_rule"), low2.alias("fare_amt_lowest"),
                     F.col("cmp_first_carrier").alias("airline_lowest"), "is_booked_fare",
                     "booked_geometry_type", "comparison_geometry_type")
    r3 = _rule_frame(tickets, cases, options, booked, fares, [("RT", "2OW")])
    same3 = (F.col("opt_lowcost") == 0) & (F.col("booked_carrier") == F.col("opt_carrier"))
    low3 = (F.when(F.col("is_booked_fare") == 1, F.col("ticket_amt"))
            .when((F.col("fare_lowcost") == 0) & same3, F.col("opt_total") + F.col("ob_fees_amt"))
            .otherwise(F.col("opt_total")))
    out3 = r3.select("record_key", "booking_type_id", F.lit(3).alias("_rule"), low3.alias("fare_amt_lowest"),
                     F.col("opt_first_carrier").alias("airline_lowest"), "is_booked_fare",
                     "booked_geometry_type", "comparison_geometry_type")
    u = out2.unionByName(out3)
    return u.select("record_key", "booking_type_id",
                    F.concat(F.col("_rule").cast("string"), F.lit(". || "), F.col("booked_geometry_type"),
                             F.lit(" vs "), F.col("comparison_geometry_type")).alias("savings_rule"),
                    F.when(F.col("is_booked_fare") == 1, 1).otherwise(0).alias("low_fare_chosen"),
                    "fare_amt_lowest", "airline_lowest")


def published_options(options: DataFrame) -> DataFrame:
    """Cheapest published option per booked fare and flexibility level
    (lowest recommended options excluded; a missing fare type counts as
    UNKNOWN)."""
    pub = options.where((F.col("is_lowest_recommended_fare") == 0)
                        & (F.coalesce(F.col("fare_type"), F.lit("UNKNOWN")) == "PUBLISHED"))
    return O.first_per_key(pub, BF + ["flexibility_level"], ["total_amount", "comparison_option_number"])


def _flex_ok(a: str, b: str, exclude_unknown: bool):
    """Equal flexibility levels.  The source also tests both against a
    misspelt 'UNKNONW', which only drops nulls (quirk Q3, kept by default);
    ``exclude_unknown`` drops 'UNKNOWN' levels as intended."""
    ok = F.col(a) == F.col(b)
    if exclude_unknown:
        ok = ok & (F.col(a) != "UNKNOWN") & (F.col(b) != "UNKNOWN")
    return F.coalesce(ok, F.lit(False))


def published_fare_rule1(tickets: DataFrame, pub_cases: DataFrame, comp_fares: DataFrame,
                         fares: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """D97 (same-shape cases): published fare = the paid amount for a
    low-cost booked fare, else the published comparison fare of the same
    flexibility scaled by the match percentage, plus online fees; basis and
    class only for regular fares.  Money is computed exactly and stored at
    4 decimals (M5)."""
    shapes = None
    for b, c in RULE1_SHAPES:
        x = (F.col("booked_geometry_type") == b) & (F.col("comparison_geometry_type") == c)
        shapes = x if shapes is None else shapes | x
    opt_k = BF + ["comparison_option_number"]
    j = (pub_cases.where(shapes)
         .join(tickets.select("record_key", "booking_type_id", "ticket_amt", "ob_fees_amt", "amt_percentage_diff"),
               ["record_key", "booking_type_id"])
         .join(comp_fares.select(*opt_k, F.col("comparison_fare_number").alias("fare_number"),
                                 F.col("total_amount").alias("cmp_total"), "first_fare_basis",
                                 "first_booking_class", "first_cabin_class_id",
                                 F.col("flexibility_level").alias("cmp_flex")), opt_k + ["fare_number"])
         .join(fares.select(*BF, "fare_number", F.col("is_lowcost").alias("fare_lowcost"),
                            F.col("flexibility_level").alias("fare_flex")), BF + ["fare_number"])
         .where(_flex_ok("fare_flex", "cmp_flex", exclude_unknown)))
    regular = F.col("fare_lowcost") != 1
    amt = (F.col("cmp_total") * F.col("amt_percentage_diff").cast("decimal(19,4)") / F.lit(100)
           + F.col("ob_fees_amt"))
    return j.select("record_key", "booking_type_id",
                    F.when(regular, amt).otherwise(F.col("ticket_amt")).cast("decimal(19,4)").alias("fare_amt_published"),
                    F.when(regular, F.col("first_fare_basis")).alias("fare_basis_published"),
                    F.when(regular, F.col("first_booking_class")).alias("class_published"),
                    F.col("first_cabin_class_id").alias("cabin_class_published"))


# fixed values: legacy fare type -> fare type id
LEGACY_FARE_TYPE = {1: 1, 2: 9, 3: 10, 4: 0, 5: 2, 6: 1, 7: 1, 8: 1, 9: 1}
# fixed values: legacy cabin letter -> cabin class id (text)
LEGACY_CABIN = {"Y": "3", "C": "2", "F": "1", "W": "5"}


def _cabin(col):
    return X.map_code(F.substring(F.upper(col), 1, 1), LEGACY_CABIN, "0")


def legacy_savings(fact: DataFrame, fare_infos: DataFrame, fields: DataFrame) -> DataFrame:
    """Savings from the newest fare-info rows of (dossier code,
    composite key) — all rows of the newest extract, ties kept — with prices
    per traveller (newest numeric NB_TRAVELLER of the dossier), low fare
    chosen (1 accepted A01, 2 other, 0 when the booked fare differs, null
    without a low fare), fare type and cabin codes mapped."""
    newest = O.latest_all(fare_infos, ["md_code", "composite_key"], "extract_id")
    nb = fields.where((F.col("fld_key") == "NB_TRAVELLER") & X.is_int32_text(X.clean("fld_value"))).select(
        F.col("metaid").alias("meta_dossier_id"), "product_id", "extract_id",
        X.clean("fld_value").cast("int").alias("nb_traveller"))
    nb = O.latest_lookup(nb, ["meta_dossier_id", "product_id"], ["extract_id", "nb_traveller"]).drop("extract_id")
    f = fact.where(X.is_numeric_text("meta_dossier_id")).select(
        "record_key", "booking_type_id", "md_code", "composite_key", "meta_dossier_id", "product_id")
    j = f.join(newest, ["md_code", "composite_key"], "inner").join(nb, ["meta_dossier_id", "product_id"], "left")
    has_low = F.col("low_farebasis").isNotNull()
    def eq_text(a, b):   # text compares ignore case and trailing blanks (M3)
        return X.clean(a, upper=True) == X.clean(b, upper=True)
    same = ((F.col("book_price") == F.col("low_price")) & eq_text("book_airline", "low_airline")
            & eq_text("book_farebasis", "low_farebasis") & (F.col("book_faretype") == F.col("low_faretype"))
            & eq_text("book_cabinclass", "low_cabinclass"))
    chosen = F.when(~has_low, F.lit(None)).when(F.coalesce(same, F.lit(False)),
                                                 F.when(F.col("accepted_code") == "A01", 1).otherwise(2)).otherwise(0)
    per = lambda c: F.try_divide(F.col(c), F.col("nb_traveller"))
    nego = F.col("ref_faretype") == 2
    return j.select(
        "record_key", "booking_type_id",
        F.substring(F.coalesce("refusal_code", "accepted_code"), 1, 3).alias("saving_reason_code"),
        chosen.alias("low_fare_chosen"), per("low_price").alias("low_price"),
        F.substring("low_airline", 1, 3).alias("low_airline"),
        F.substring(F.upper("low_farebasis"), 1, 15).alias("low_farebasis"),
        F.substring(F.upper("low_farebasis"), 1, 1).alias("low_class_of_service"),
        F.when(has_low, X.map_code("low_faretype", LEGACY_FARE_TYPE, 0)).alias("low_fare_type_id"),
        F.when(has_low, _cabin(F.col("low_cabinclass"))).alias("low_cabin_class"),
        per("iata_price").alias("iata_price"),
        F.substring(F.upper("iata_farebasis"), 1, 15).alias("iata_farebasis"),
        F.when(F.col("iata_farebasis").isNotNull(), _cabin(F.col("iata_cabinclass"))).alias("iata_cabin_class"),
        F.when(nego, per("ref_price")).alias("nego_price"),
        F.when(nego, F.substring(F.upper("ref_farebasis"), 1, 15)).alias("nego_farebasis"),
        F.when(nego, _cabin(F.col("ref_cabinclass"))).alias("nego_cabin_class"))


def published_fare_rules23(tickets: DataFrame, pub_cases: DataFrame, comp_fares: DataFrame,
                           options: DataFrame, booked: DataFrame, fares: DataFrame,
                           exclude_unknown: bool = False) -> DataFrame:
    """D97 for the other shapes.  OW booked vs RT published: the paid amount
    when the option is the booked fare, else the booked fare's share of the
    flight total times the published comparison fare scaled by the match
    percentage (+ online fees for the same regular carrier).  RT vs 2OW:
    the option total scaled by the match percentage + online fees, or the
    paid amount for a low-cost booked fare."""
    opt_k = BF + ["comparison_option_number"]
    base = (pub_cases.join(tickets.select("record_key", "booking_type_id", "ticket_amt", "ob_fees_amt",
                                          "amt_percentage_diff", "savings_total_flight_amount"),
                           ["record_key", "booking_type_id"])
            .join(fares.select(*BF, "fare_number", F.col("is_lowcost").alias("fare_lowcost"),
                               F.col("total_amount").alias("fare_total"),
                               F.col("flexibility_level").alias("fare_flex")), BF + ["fare_number"])
            .join(options.select(*opt_k, "is_booked_fare", F.col("marketing_carrier").alias("opt_carrier"),
                                 F.col("total_amount").alias("opt_total"), F.col("first_fare_basis").alias("opt_basis"),
                                 F.col("first_booking_class").alias("opt_class"),
                                 F.col("first_cabin_class_id").alias("opt_cabin"),
                                 F.col("flexibility_level").alias("opt_flex")), opt_k)
            .join(booked.select(*BF, F.col("marketing_carrier").alias("booked_carrier"),
                                F.col("flexibility_level").alias("booked_flex")), BF))
    pct = F.col("amt_percentage_diff").cast("decimal(19,4)") / F.lit(100)
    regular = F.col("fare_lowcost") != 1
    cf = comp_fares.select(*opt_k, "comparison_fare_number", F.col("total_amount").alias("cmp_total"),
                           F.col("is_lowcost").alias("cmp_lowcost"), "first_fare_basis", "first_booking_class",
                           "first_cabin_class_id", F.col("flexibility_level").alias("cmp_flex"))
    r2 = (base.where((F.col("booked_geometry_type") == "OW") & (F.col("comparison_geometry_type") == "RT"))
          .join(cf, opt_k).where(_flex_ok("fare_flex", "cmp_flex", exclude_unknown)))
    # the source join is not restricted to one comparison fare: the first by number stands in
    r2 = O.first_per_key(r2, ["record_key", "booking_type_id"], ["comparison_fare_number"])
    share = F.col("fare_total") / F.col("savings_total_flight_amount") * (F.col("cmp_total") * pct)
    same = (F.col("cmp_lowcost") == 0) & (F.col("booked_carrier") == F.col("opt_carrier"))
    amt2 = (F.when(F.col("is_booked_fare") == 1, F.col("ticket_amt"))
            .when(regular & same, share + F.col("ob_fees_amt")).otherwise(share))
    out2 = r2.select("record_key", "booking_type_id", amt2.cast("decimal(19,4)").alias("fare_amt_published"),
                     F.when(regular, F.col("first_fare_basis")).alias("fare_basis_published"),
                     F.when(regular, F.col("first_booking_class")).alias("class_published"),
                     F.col("first_cabin_class_id").alias("cabin_class_published"))
    r3 = (base.where((F.col("booked_geometry_type") == "RT") & (F.col("comparison_geometry_type") == "2OW"))
          .where(_flex_ok("booked_flex", "opt_flex", exclude_unknown)))
    amt3 = F.when(regular, F.col("opt_total") * pct + F.col("ob_fees_amt")).otherwise(F.col("ticket_amt"))
    out3 = r3.select("record_key", "booking_type_id", amt3.cast("decimal(19,4)").alias("fare_amt_published"),
                     F.when(regular, F.col("opt_basis")).alias("fare_basis_published"),
                     F.when(regular, F.col("opt_class")).alias("class_published"),
                     F.col("opt_cabin").alias("cabin_class_published"))
    return out2.unionByName(out3)


def run_savings(tickets: DataFrame, booked: DataFrame, fares: DataFrame, options: DataFrame,
                comp_fares: DataFrame, exclude_unknown: bool = False,
                flights: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """D90-D98 chained over the summarised savings tables: match each
    purchase to a fare, build the lowest-recommended and published cases,
    apply the lowest-fare rules (1-3) and the published-fare rules, then the
    negation.  One row per ticket; unmatched tickets keep nulls.  ``matches`` takes the rows of
    ``match_savings`` where they are stored.  A booked fare's flight amount is what its tickets
    paid, unless ``flights`` gives the value of their flights or the tickets carry it."""
    k = ["record_key", "booking_type_id"]
    matches = match_savings(tickets, fares) if matches is None else matches
    t = tickets.join(matches.select(*k, "amt_percentage_diff"), k, "left")
    if flights is not None:
        # Total flight amount of all tickets matched to the same booked fare
        tot = (matched_total(matches.select(*k, *BF), flights)
               .select(*k, F.col("booked_fare_total").alias("_tot")))
        t = t.drop("savings_total_flight_amount") if "savings_total_flight_amount" in t.columns else t
        t = t.join(tot, k, "left").withColumnRenamed("_tot", "savings_total_flight_amount")
    elif "savings_total_flight_amount" not in t.columns:
        t = t.join(paid_total(matches, tickets), k, "left")
    lrf = lrf_cases(matches, fares, options)
    low = lowest_fare_rule1(t, lrf, comp_fares, options, booked, fares).unionByName(
        lowest_fare_rules23(t, lrf, comp_fares, options, booked, fares))
    low = O.first_per_key(low, k, ["savings_rule"])     # shapes are disjoint; stated tie-break anyway
    pc = pub_cases(matches, fares, options)
    pub = published_fare_rule1(t, pc, comp_fares, fares, exclude_unknown).unionByName(
        published_fare_rules23(t, pc, comp_fares, options, booked, fares, exclude_unknown))
    pub = O.first_per_key(pub, k, ["fare_amt_published"])
    out = (tickets.select(*k, "ticket_amt").join(matches.select(*k, "amt_percentage_diff"), k, "left")
           .join(low, k, "left").join(pub, k, "left"))
    return negate_savings(out)
