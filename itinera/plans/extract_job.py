"""L4: the ERP extract of one batch, from raw tables to written facts, as a restartable job.

Steps: seeds, attributes, segments, flights, rollups, routes, amounts, values, savings,
names, fact.  Each is committed before the next one reads it (``itinera.jobs``).  A step that needs
a table which is not given is left out; its columns are then missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from itinera import functions as X
from itinera import operators as O
from itinera.jobs import Job
from itinera.operators.rules import Layer, apply_layered_rules, apply_rule_groups
from itinera.plans import amounts as AM
from itinera.plans import extract_air as EA
from itinera.plans import extract_attrs as XA
from itinera.plans import file_loads as FL
from itinera.plans import names as NM
from itinera.plans import saving_messages as SM
from itinera.plans import savings as SV
from itinera.session import work_path
from itinera.sources import register_keys
from itinera.sources.targets import AIR_TICKET, DETAIL

Tables = dict[str, DataFrame]
LINE = ["extract_id", "product_id", "document_no", "line_no"]
TICKET = ["record_key", "booking_type_id"]
# fixed values: amounts that are negative on refunds (those of fares follow from the savings)
SIGNED_AMOUNTS = ["ticket_amt", "ticket_amt_base", "ticket_amt_tax", "ticket_amt_gross", "markup_amt", "markup_gds_amt",
                  "markup_pub_amt", "ob_fees_amt", "ticket_amt_tax_fee", "fsf_amt_savings"]
ROUTE_COLS = ("route_id int, route_code string, airport_from string, airport_to string, route_code_bidirectional string, "
              "airport_from_bidirectional string, airport_to_bidirectional string")
# fixed value: key-table type of air extracts
KEY_TYPE = 28


# fixed value: the rule table is searched above this rule id
FIRST_TABLE_RULE = 260


def fare_type_layers(fact: DataFrame) -> list[Layer]:
    """The rules that are decided before the table is searched (fixed ids and
    conditions): a fare type given by the sub-category, billback dossiers, low-cost lines
    whatever was decided before, and lines that are no primary air resource."""
    meta, group, resource = F.col("meta_id"), F.col("service_group"), F.col("resource_type")
    given = [Layer(-1, F.col("business_sub_category").between(12, 16) & (F.col("fare_type_id") > 0))] \
        if "fare_type_id" in fact.columns else []
    return given + [
        Layer(100, F.upper(F.left(meta, F.lit(2))) == "MA", [("Meta_ID", "LIKE", "MA%")]),
        Layer(200, group == 6, [("Service_Group", "=", "6")], override=True),
        Layer(-2, (resource != 0) | (group != 1), [("Service_Group", "<>", "1"), ("Resource_Type", "<>", "0")])]


def seeds(t: Tables, extract_id: int, as_of) -> DataFrame:
    """Candidate lines with booking type and record key, lineage keys and fare type."""
    mine = lambda name: t[name].where(F.col("extract_id") == F.lit(extract_id))
    inv, cr = mine("invoice_line"), mine("credit_line")
    lines_i = EA.record_key(EA.invoice_booking_type(inv)).withColumn("doc_kind", F.lit("I"))
    lines_c = EA.record_key(EA.credit_booking_type(cr, t["credit_header"], inv)).withColumn("doc_kind", F.lit("C"))
    if "invoice_header" in t:
        legs, own = mine("travel_leg"), ["sales_document_type_id", "agent_assisted"]
        pick = EA.invoice_candidates(t["invoice_header"], inv, legs, extract_id)
        lines_i = lines_i.join(pick.select(*LINE, *own), LINE, "inner")
        pick = EA.credit_candidates(t["credit_header"], cr, legs, extract_id)
        lines_c = lines_c.join(pick.select(*LINE, *own, "sales_document_prior"), LINE, "inner")
    fact = lines_i.unionByName(lines_c, allowMissingColumns=True)
    if "service_ledger" in t:
        fact = EA.lineage_keys(fact, fact, t["service_ledger"])
    if "fare_rules" in t:
        fact = apply_layered_rules(fact, t.get("fare_rule_attrs", ["ticket", "doc_kind"]), t["fare_rules"], as_of,
                                   fare_type_layers(fact), FIRST_TABLE_RULE, out="fare_rule_id")
        fact = apply_rule_groups(fact, t["fare_rule_groups"], rule_col="fare_rule_id")
    return fact


def attributes(t: Tables, fact: DataFrame) -> DataFrame:
    """One row per line: its ticket attributes, and what the dossier, the customer and the
    payment tables say of it."""
    lines = fact
    narrow = [*LINE, *TICKET, *[c for c in ("record_key_original", "record_key_prior", "sales_document_type_id",
                                            "fare_type_id") if c in fact.columns]]
    tagged = t["tagged_text"]
    pnr = F.col("pnr") if "pnr" in tagged.columns else F.lit(None).cast("string")
    out = XA.flatten_sales_line(fact.select(*narrow), lines, tagged.select(
        "product_id", "file_name", pnr.alias("code_pnr"), "extract_id", "tag", "text1"))
    inv, cr = lines.where("doc_kind = 'I'"), lines.where("doc_kind = 'C'")
    headers = (t["invoice_header"].unionByName(t["credit_header"], allowMissingColumns=True)
               if "invoice_header" in t else None)
    steps: list[tuple[tuple[str, ...], Callable[[DataFrame], DataFrame]]] = [
        (("travel_product",), lambda f: XA.storage_currency(f, t["travel_product"])),
        (("dossier_field", "invoice_header"), lambda f: XA.booking_dates(f, headers, t["dossier_field"])),
        (("dossier_field", "invoice_header"), lambda f: XA.booking_channel(f, lines, t["dossier_field"])),
        (("dossier_field", "traveller", "traveler_account"),
         lambda f: XA.arranger_logon(f, t["dossier_field"], t["traveller"], t["traveler_account"])),
        (("dossier_field",), lambda f: XA.approval_info(f, t["dossier_field"])),
        (("dossier_field", "policy_reason"), lambda f: XA.policy_info(f, t["policy_reason"], t["dossier_field"])),
        (("traveller",), lambda f: XA.service_level(f, inv, cr, t["traveller"])),
        (("payment_card", "payment_card_history", "payment_data", "invoice_header"),
         lambda f: XA.payment_card(f, headers, lines, t["payment_card"], t["payment_card_history"], t["payment_data"])),
        (("agent_login",), lambda f: XA.service_fee_flag(f, lines, EA.parse_remarks(tagged, t["remark_patterns"]),
                                                         t["agent_login"])),
    ]
    for needs, step in steps:
        if all(n in t for n in needs):
            out = step(out)
    if headers is not None and "group_account" in t and "analytical_code_1" in lines.columns:
        out = XA.account_department(out, headers, lines, t["group_account"], t["department"])
        if "traveler_group_policy" in t and "traveler_account" in t:
            out = XA.policy_group(out, t["traveler_account"], t["traveler_group_policy"])
    out = out.withColumn("record_status_id", F.lit(0))
    if "invoice_date" in out.columns and "subscription" in lines.columns:
        out = EA.record_status(out, inv, cr)
    return out.withColumn("traveler_id", F.col("traveler_code").try_cast("int"))


def segment_lines(t: Tables, fact: DataFrame, extract_id: int) -> DataFrame:
    """The sales lines whose legs become segments (D43), from the extract's raw lines."""
    own = lambda name: t[name].where(F.col("extract_id") == F.lit(extract_id))
    return EA.segment_lines(fact, (t["invoice_header"], own("invoice_line")), (t["credit_header"], own("credit_line")),
                            own("travel_leg"), extract_id)


def segments(t: Tables, fact: DataFrame, extract_id: int, as_of, lines: DataFrame) -> DataFrame:
    """Cleaned legs of the loaded tickets with cabin, flexibility, both numbers, trips and
    offsets.  ``complete`` is false where an airport is missing; such rows end here."""
    legs = EA.clean_legs(t["travel_leg"].where(F.col("extract_id") == F.lit(extract_id)), as_of)
    if "class_of_service" in t:
        legs = EA.cabin_class(legs.drop("class_code", "cabin_class_id", "within_country"), t["class_of_service"])
    if "ticket_no" in legs.columns:
        segs = EA.segment_seeds(lines, legs)
    else:
        segs = legs.join(fact.select("extract_id", "document_no", "line_no", *TICKET),
                         ["extract_id", "document_no", "line_no"], "inner")
    segs = segs.withColumnRenamed("departure_ts", "segment_start").withColumnRenamed("arrival_ts", "segment_end")
    whole = F.col("airport_from").isNotNull() & F.col("airport_to").isNotNull()
    lost = segs.where(~whole).select("extract_id", *TICKET).distinct()
    segs = EA.split_trips(EA.number_legs(segs.where(whole)))
    if "flexibility_rule" in t:
        segs = EA.fare_flexibility(segs, t["flexibility_rule"])
    if "time_zone" in t:
        segs = EA.with_utc_offset(segs, t["location"], t["time_zone"], t["daylight"])
    return segs.withColumn("complete", F.lit(True)).unionByName(
        lost.withColumn("complete", F.lit(False)), allowMissingColumns=True)


def line_amounts(t: Tables, fact: DataFrame, attrs: DataFrame | None, extract_id: int) -> DataFrame:
    """Amounts of every line, with the original ticket's on exchanges."""
    la = AM.line_amounts(fact)
    tagged = t["tagged_text"].where(F.col("extract_id") <= F.lit(extract_id))
    sur, said = AM.surcharges(tagged, la), AM.remark_savings(tagged, la)
    f = fact if "fare_type_id" in fact.columns else fact.withColumn("fare_type_id", F.lit(None).cast("int"))
    amt = AM.apply_amounts(f.drop("amount", "amount_incl_vat", "business_category", "business_sub_category",
                                  "public_price", "airport_tax", "commission_excl_vat", "ob_fees_amt",
                                  "markup_total", "markup_gds", "markup_pub", "id_1", "crs"), la, sur, said)
    if attrs is not None:
        keep = [c for c in ("traveler_id", "pnr_code", "meta_dossier_id", "ticket_code", "ticket_code_prior",
                            "record_status_id", "invoice_date")
                if c in attrs.columns and c not in amt.columns]
        amt = amt.join(attrs.select(*LINE, *keep), LINE, "inner")
        if "service_ledger" in t:
            lines = fact.where("doc_kind = 'I'")
            origin = AM.exchange_origin(amt.drop("sell_to_customer_no").withColumn("ticket_prior", F.col("ticket_code_prior")),
                                        lines, t["service_ledger"])
            amt = AM.add_exchange_origin(amt, origin)
    return amt


def ticket_amounts(amt: DataFrame) -> DataFrame:
    """Signed amounts of every line, the linked penalties in the gross of exchanges."""
    if {"invoice_date", "record_status_id"} <= set(amt.columns):
        amt = AM.exchange_penalties(amt)
    return EA.sign_refunds(amt, SIGNED_AMOUNTS)


def ticket_totals(amounts: DataFrame) -> DataFrame:
    """The lines of a conjunction ticket share a record key (D6): a ticket's amounts are the
    sums over its lines, in the lines' own types."""
    types = amounts.schema
    return amounts.groupBy(*TICKET).agg(*[F.sum(c).cast(types[c].dataType).alias(c) for c in (
        "ticket_amt", "ticket_amt_base", "ob_fees_amt")])


def one_per_ticket(attrs: DataFrame) -> DataFrame:
    """The attributes of a ticket's smallest line."""
    return O.first_per_key(attrs, ["extract_id", *TICKET], ["product_id", "document_no", "line_no"])


def savings_tickets(attrs: DataFrame, totals: DataFrame, rollups: DataFrame, segs: DataFrame) -> DataFrame:
    """One row per ticket, with what the savings messages are matched by."""
    tickets = (one_per_ticket(attrs).select("extract_id", *TICKET, "product_id", "meta_dossier_id", "pnr_code", "traveler_id")
               .join(totals.select(*TICKET, "ticket_amt", "ob_fees_amt"), TICKET, "inner")
               .join(rollups.select("record_key", "travel_start", "travel_end", "segment_cnt"), "record_key", "left"))
    return EA.composite_key(tickets, segs)


def summaries(job: Job, t: Tables, tickets: DataFrame) -> tuple[Tables, DataFrame]:
    """The four savings summaries and the matches (D87-D93): from the raw message tables, the
    comparison side for matched messages only, or from the summaries that ``savings`` holds."""
    if "saving_message" not in t:
        sv = t["savings"]
        return sv, job.step("savings matches", lambda: SV.match_savings(tickets, sv["fares"]))
    keys = job.step("savings messages", lambda: SM.message_keys(t["saving_message"], t["saving_fare"], tickets))
    fine = job.step("savings fare details", lambda: SM.booked_levels(t, keys))
    sv = {"booked": job.step("savings booked fares", lambda: SM.booked_fares(t, keys, fine)),
          "fares": job.step("savings fares", lambda: SM.fares(t, keys, fine))}
    matches = job.step("savings matches", lambda: SV.match_savings(tickets, sv["fares"]))
    hit = SM.matched_keys(matches)
    fine_options = job.step("savings option details", lambda: SM.option_levels(t, hit))
    sv["options"] = job.step("savings options", lambda: SM.options(t, hit, fine_options, sv["booked"]))
    sv["comp_fares"] = job.step("savings comparison fares", lambda: SM.comparison_fares(t, hit, fine_options))
    return sv, matches


def savings(t: Tables, attrs: DataFrame, tickets: DataFrame, sv: Tables, matches: DataFrame) -> DataFrame:
    """The rules over the matched purchases; with ``legacy_fare_info`` the legacy savings
    hold for invoices before ``savings_from``."""
    out = SV.run_savings(tickets, sv["booked"], sv["fares"], sv["options"], sv["comp_fares"], matches=matches)
    if "legacy_fare_info" in t:
        legacy = SV.legacy_savings(tickets, t["legacy_fare_info"], t["dossier_field"])
        legacy = O.first_per_key(legacy.select(*TICKET, F.col("low_price").alias("fare_amt_lowest")), TICKET, ["fare_amt_lowest"])
        dates = one_per_ticket(attrs).select(*TICKET, "invoice_date")
        out = SV.finish_savings(out.drop("fare_amt_lowest").join(dates, TICKET, "left"), legacy, out, t["savings_from"])
    return out


def run_extract_air(spark: SparkSession, t: Tables, extract_id: int, as_of, out_root: str | None = None,
                    job: Job | None = None) -> Tables:
    """All steps of one extract; run again after an interruption it goes on behind the last
    committed step, run again after its end it replaces the batch."""
    job = job or Job(spark, out_root or work_path(spark, "facts"), "extract_air", extract_id)
    with_text = "tagged_text" in t
    fact = job.step("seeds", lambda: seeds(t, extract_id, as_of))
    attrs = job.step("attributes", lambda: attributes(t, fact)) if with_text else None
    flown = fact
    if "invoice_header" in t and "ticket_no" in t["travel_leg"].columns:
        flown = job.step("segment lines", lambda: segment_lines(t, fact, extract_id))
    all_segs = job.step("segments", lambda: segments(t, fact, extract_id, as_of, flown))
    segs = all_segs.where("complete").drop("complete")
    flights = job.step("flights", lambda: EA.build_flights(segs, t["geography_priority"]))
    rollups = job.step("rollups", lambda: EA.ticket_rollups(segs))
    routes = job.step("routes", lambda: EA.route_text(segs, max_len=None))

    # routes are members before facts refer to them (K5, D60), then ids go onto all three
    seed = t.get("route", spark.createDataFrame([], ROUTE_COLS))
    ends = lambda: FL.route_candidates(routes, "airport_from", "airport_to").unionByName(
        FL.route_candidates(flights, "airport_from", "airport_to")).unionByName(
        FL.route_candidates(segs, "airport_from", "airport_to"))
    route_dim = job.members("air_route", ends, ["route_code", "airport_from", "airport_to"], "route_id", seed, FL.with_both_ways)
    with_route = lambda df: FL.add_route_id(df, route_dim, "airport_from", "airport_to")

    out = {"fact": fact, "rollups": rollups, "routes": with_route(routes), "route_dim": route_dim}
    if with_text:
        out["attributes"] = attrs
        lines = job.step("line amounts", lambda: line_amounts(t, fact, attrs, extract_id))
        out["amounts"] = job.step("amounts", lambda: ticket_amounts(lines))
        totals = ticket_totals(out["amounts"])
        # Segment value = GDS miles share of the ticket base;
        # flight value = null-strict sum of its segments
        values = job.step("segment values", lambda: O.prorate(
            segs.join(totals.select(*TICKET, "ticket_amt_base"), TICKET, "inner"), EA.SEG_KEY, "mileage_gds",
            "ticket_amt_base", "segment_value"))
        order = [c for c in ("segment_nbr", "segment_nbr_adj", "trip_nbr") if c in values.columns]
        out["segment_values"] = EA.stored_numbers(values.select(*EA.SEG_KEY, *order, "segment_value"))
        flights = job.step("flight values", lambda: flights.join(
            values.groupBy(*EA.SEG_KEY, "trip_nbr").agg(O.strict_sum("segment_value").alias("flight_value")),
            [*EA.SEG_KEY, "trip_nbr"], "left"))
        segs = values.drop("ticket_amt_base")
        if "savings" in t or "saving_message" in t:
            asked = job.step("savings tickets", lambda: savings_tickets(attrs, totals, rollups, segs))
            sv, matches = summaries(job, t, asked)
            out["savings"] = job.step("savings", lambda: savings(t, attrs, asked, sv, matches))

    names = None
    if with_text and "traveler_name" in t and "traveller" in t:
        aliases = fact if "traveller_alias" in fact.columns else None
        keep = [c for c in ("approver_id", "group_account_id") if c in attrs.columns]
        named = job.step("names", lambda: NM.resolve_names(
            one_per_ticket(attrs).select(*LINE, *TICKET, "traveler_id", "traveler_code", "meta_dossier_id", *keep), extract_id,
            t["traveller"], aliases, t.get("dossier_field"), t.get("traveler_anonymous")))
        names = job.members("traveler_name", lambda: NM.name_members(named, t["traveler_name"]), FL.NAME_KEY, "name_id",
                            t["traveler_name"])

    def tickets() -> DataFrame:
        base = one_per_ticket(attrs) if with_text else fact.select("extract_id", *TICKET).distinct()
        lost = all_segs.where(~F.col("complete")).select(*TICKET, F.lit(True).alias("_lost"))
        r = out["routes"].select("extract_id", "record_key", "route_txt", "airport_from", "airport_to", "flight_cnt", "route_id")
        f = (base.join(rollups, ["extract_id", "record_key"], "left").join(r, ["extract_id", "record_key"], "left")
             .join(lost, TICKET, "left"))
        status = F.col("record_status_id") if "record_status_id" in f.columns else F.lit(0)
        f = f.withColumn("record_status_id", F.when(F.col("_lost"), F.lit(10)).otherwise(status)).drop("_lost")   # D65
        if names is not None:
            n = NM.add_name_ids(named, names).select(*TICKET, "name_source", "traveler_name_id", "approver_name_id",
                                                     F.col("approver_id").alias("_approver"))
            f = f.join(n, TICKET, "left")
            f = f.withColumn("record_status_id", NM.mark_missing_name(
                F.col("record_status_id"), F.col("traveler_name_id"), F.col("_approver"), F.col("approver_name_id"))).drop("_approver")
        if with_text:
            f = f.join(totals, TICKET, "left")
        if "savings" in out:
            f = f.join(out["savings"].drop("ticket_amt", "extract_id", "invoice_date"), TICKET, "left")
        return f

    job.step("tickets", tickets)
    job.step("keys", lambda: register_keys(fact, ["extract_id", *TICKET], KEY_TYPE))
    out["segments"] = job.publish("air_segment_fact", "segments", "extract_id", with_route(EA.stored_numbers(segs)), DETAIL)
    out["flights"] = job.publish("air_flight_fact", "flights", "extract_id", with_route(flights), DETAIL)
    out["tickets"] = job.publish("air_fact", "tickets", "extract_id", target=AIR_TICKET)
    out["keys"] = job.publish("air_fact_key", "keys", "extract_id")
    job.finish()
    return out
