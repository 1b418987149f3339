"""Batch jobs over external files.  Each step is a DataFrame function whose rows
are committed before the next step reads them (``itinera.jobs``), so later
steps do not recompute its lineage; a re-run replaces the batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from itinera.jobs import Job
from itinera.plans import file_loads as FL
from itinera.plans import hotel_train as HT
from itinera.plans.extract_job import run_extract_air  # noqa: F401
from itinera.plans.hotel_job import run_file_hotel  # noqa: F401
from itinera.session import work_path
from itinera.sources import register_keys
from itinera.sources.targets import AIR_TICKET, DETAIL, TRAIN_TICKET

# fixed values: key-table type per source
TRAIN = 5                    # line of business of train tickets
KEY_TYPE = {"air_file": 18, "hotel_file": 19, "train_file": 17, "air_extract": 28}


def run_file_air(spark: SparkSession, t: dict[str, DataFrame], file_id: int,
                 out_root: str | None = None, job: Job | None = None) -> dict[str, DataFrame]:
    """L1: seed -> expand -> segments -> flights -> routes -> names -> keys
    -> custom fields -> ticket geography, for one file, as a restartable job.
    Routes and names are stored members before the facts that refer to them
    are written; route ids go onto tickets, flights and segments."""
    job = job or Job(spark, out_root or work_path(spark, "facts"), "file_air", file_id)
    mine = lambda name: t[name].where(F.col("file_id") == F.lit(file_id))

    def expand():
        stage = mine("air_ticket")
        f = FL.expand_ticket(FL.seed_file_fact(stage, t["booking_type"], file_id), stage, t["travel_product"], t["fx_rate"])
        if {"business_category", "ticket_code"} <= set(stage.columns):
            f = FL.link_penalty(f, FL.stage_penalties(stage, t["travel_product"], t["fx_rate"]))
        f = FL.add_department(FL.add_account(FL.add_advance_band(f, t["advance_purchase"]), t["group_account"]), t["department"])
        return FL.add_policy_group(f, t["traveler_group_policy"])
    fact = job.step("expand", expand)

    def segments():
        s = FL.segment_values(FL.load_segments(fact, mine("air_ticket_segment"), t["airport"]))
        s = s.join(fact.select(*FL.KEY, "travel_product_id"), FL.KEY, "inner")
        return FL.segment_geography(s, t["geography_country"], t["geography_priority"])
    segs = job.step("segments", segments)

    def build_flights():
        f = FL.flight_values(FL.load_flights(fact, mine("air_ticket_flight"), t["airport"], t["fx_rate"]), segs)
        geo = FL.rollup_geography(segs, FL.KEY + ["trip_nbr"], t["geography_priority"])
        return f.join(geo, FL.KEY + ["trip_nbr"], "left")
    flights = job.step("flights", build_flights)

    ends = lambda: reduce(DataFrame.unionByName, [
        FL.route_candidates(df, "airport_from", "airport_to") for df in (fact, flights, segs)])
    routes = job.members("air_route", ends, ["route_code", "airport_from", "airport_to"], "route_id", t["route"], FL.with_both_ways)
    with_route = lambda df: FL.add_route_id(df.drop("route_id"), routes, "airport_from", "airport_to")

    named = job.step("names", lambda: FL.traveler_names(fact, t["traveler_stage_name"], t.get("traveler_anonymous")))
    names = job.members("traveler_name", lambda: FL.name_candidates(named, t["traveler_name"]), FL.NAME_KEY, "name_id",
                        t["traveler_name"])

    def tickets():
        geo = FL.rollup_geography(flights.join(fact.select(*FL.KEY, "travel_product_id"), FL.KEY),
                                  FL.KEY, t["geography_priority"], out="ticket_geography_type_id")
        return FL.add_name_id(with_route(named), names).join(geo, FL.KEY, "left")
    job.step("tickets", tickets)
    job.step("keys", lambda: register_keys(fact, FL.KEY, KEY_TYPE["air_file"]))
    job.step("custom fields", lambda: FL.custom_fields(fact, FL.custom_values(t, mine("air_ticket")), t["department"]))
    out = {"segments": job.publish("air_segment_fact", "segments", "file_id", with_route(segs), DETAIL),
           "flights": job.publish("air_flight_fact", "flights", "file_id", with_route(flights), DETAIL),
           "fact": job.publish("air_fact", "tickets", "file_id", target=AIR_TICKET),
           "keys": job.publish("air_fact_key", "keys", "file_id"),
           "custom_fields": job.publish("air_custom_field", "custom fields", "file_id"),
           "routes": routes, "names": names,
           "new_routes": spark.read.parquet(job.committed["air_route members"]),
           "new_names": spark.read.parquet(job.committed["traveler_name members"])}
    job.finish()
    return out


def run_file_train(spark: SparkSession, t: dict[str, DataFrame], file_id: int,
                   out_root: str | None = None, job: Job | None = None) -> dict[str, DataFrame]:
    """L3: seed -> expand (card masked) -> segments (prefix stripped, FX, geography by the
    stations' countries) -> trips -> route text from city names -> routes -> names -> keys ->
    custom fields, as a restartable job; routes and names are stored members before tickets
    refer to them.  Trips, geography, names and custom fields need their tables to be given."""
    job = job or Job(spark, out_root or work_path(spark, "facts"), "file_train", file_id)
    stage = t["train_ticket"].where(F.col("file_id") == F.lit(file_id))

    def expand():
        amounts = [c for c in FL.AIR_AMOUNTS if c in stage.columns]
        f = FL.seed_file_fact(stage, t["booking_type"], file_id)
        f = FL.expand_ticket(f, stage, t["travel_product"], t["fx_rate"], amounts, card_col="card_nbr")
        return FL.add_department(FL.add_account(FL.add_advance_band(f, t["advance_purchase"]), t["group_account"]), t["department"])
    fact = job.step("expand", expand)

    def load_segments():
        s = HT.load_train_segments(fact, t["train_ticket_segment"].where(F.col("file_id") == F.lit(file_id)), t["fx_rate"])
        if "geography_country" not in t or "country_code" not in t["train_station"].columns:
            return s
        s = s.join(fact.select(*FL.KEY, "travel_product_id"), FL.KEY, "inner")
        return HT.train_geography(s, t["train_station"], t["geography_country"], t["geography_priority"])
    segs = job.step("segments", load_segments)
    located = "geography_type_id" in segs.columns

    def load_trips():
        trips = FL.load_trips(fact, t["train_ticket_trip"].where(F.col("file_id") == F.lit(file_id)), t["fx_rate"])
        return FL.trip_geography(trips, segs, t["geography_priority"]) if located else trips
    if "train_ticket_trip" in t:
        job.step("trips", load_trips)

    def route_text():
        lang = t["travel_product"].select("travel_product_id", F.col("default_lang_id").alias("lang_id"))
        own = fact.select(*FL.KEY, "travel_product_id").join(lang, "travel_product_id").drop("travel_product_id")
        return HT.parse_route_text(HT.train_route_text(segs.drop("travel_product_id").join(own, FL.KEY), t["train_station"]))
    parsed = job.step("route text", route_text)
    routes = job.members("train_route", lambda: FL.route_candidates(parsed, "route_from", "route_to"),
                         ["route_code", "airport_from", "airport_to"], "route_id", t["route"], FL.with_both_ways)
    names = None
    if "traveler_stage_name" in t and "traveler_name" in t:
        named = job.step("names", lambda: FL.traveler_names(fact, t["traveler_stage_name"], t.get("traveler_anonymous")))
        names = job.members("traveler_name", lambda: FL.name_candidates(named, t["traveler_name"]), FL.NAME_KEY, "name_id",
                            t["traveler_name"])

    def tickets():
        base = fact if names is None else FL.add_name_id(named, names)
        text = FL.add_route_id(parsed, routes, "route_from", "route_to").select(
            *FL.KEY, *[c for c in parsed.columns if c not in fact.columns], "route_id")
        out = base.drop("route_id", "route_txt").join(text, FL.KEY, "left")
        if not located:
            return out
        geo = FL.rollup_geography(segs, FL.KEY, t["geography_priority"], line_of_business=TRAIN, out="ticket_geography_type_id")
        return out.join(geo, FL.KEY, "left")
    job.step("tickets", tickets)
    job.step("keys", lambda: register_keys(fact, FL.KEY, KEY_TYPE["train_file"]))
    out = {"segments": job.publish("train_segment_fact", "segments", "file_id", target=DETAIL),
           "fact": job.publish("train_fact", "tickets", "file_id", target=TRAIN_TICKET),
           "keys": job.publish("train_fact_key", "keys", "file_id"),
           "route_text": parsed, "routes": routes,
           "new_routes": spark.read.parquet(job.committed["train_route members"])}
    if "train_ticket_trip" in t:
        out["trips"] = job.publish("train_trip_fact", "trips", "file_id", target=DETAIL)
    custom = FL.custom_values(t, stage)
    if custom is not None:
        job.step("custom fields", lambda: FL.custom_fields(fact, custom, t["department"]))
        out["custom_fields"] = job.publish("train_custom_field", "custom fields", "file_id")
    job.finish()
    return out
