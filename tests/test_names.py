"""Names of travellers and approvers; consultants with their fallback; target tables; train trips."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from itinera.plans import file_loads as FL
from itinera.plans import hotel_train as HT
from itinera.plans import names as NM
from itinera.sources.targets import Target

T = dt.datetime


def resolved(spark, empty=False):
    tickets = spark.createDataFrame(
        [("K1", "55", "42", 88, 7), ("K2", "56", "42", None, 7), ("K3", "57", "43", 99, 8), ("K4", "58", "44", 88, 9),
         ("K5", None, None, None, None), ("K6", "59", "45", 88, 8)],
        "record_key string, traveler_code string, meta_dossier_id string, approver_id int, group_account_id int")
    tickets = tickets.select("*", F.lit(1).alias("booking_type_id"), F.lit(5).alias("extract_id"), F.lit(1).alias("product_id"),
                             F.col("record_key").alias("document_no"), F.lit(10).alias("line_no"),
                             F.col("traveler_code").cast("int").alias("traveler_id"))
    people = spark.createDataFrame(
        [(4, 1, "55", 0, "MR", "Old", "Name"), (5, 1, " 55 ", 0, "MR", "Ann", "Aye"), (6, 1, "55", 0, "MR", "New", "Later"),
         (5, 1, "56", 1, "MS", "Occ", "Asional"), (5, 1, "57", 0, None, " ", "Only"), (5, 1, "88", 1, "DR", "App", "Rover"),
         (5, 1, "59", 0, None, "TBA", "n/a"), (5, 2, "58", 0, "MR", "Other", "Product")],
        "extract_id int, product_id int, no string, is_occasional int, title string, first_name string, name string")
    lines = tickets.select("extract_id", "product_id", "document_no", "line_no").withColumn(
        "traveller_alias", F.when(F.col("document_no") == "K2", "BEE/BO").when(F.col("document_no") == "K3", "Cy de Sea"))
    lines = lines.unionByName(lines.where("document_no = 'K2'"))                       # a repeated row
    fields = spark.createDataFrame([("44", 1, 5, "TRAVELLER_LAST_NAME", "Dee"), ("44", 1, 4, "TRAVELLER_LAST_NAME", "Older"),
                                    ("44", 1, 6, "TRAVELLER_LAST_NAME", "Later"), ("44", 1, 5, "OTHER", "x")],
                                   "metaid string, product_id int, extract_id int, fld_key string, fld_value string")
    anonymous = spark.createDataFrame([(1, 9, "", "Anon", "", "Ymous"), (1, 9, "", "Anon", "", "Zweite")],
                                      "product_id int, group_account_id int, title string, first_name string, "
                                      "middle_name string, last_name string")
    if empty:
        people, lines, fields, anonymous = people.limit(0), lines.limit(0), fields.limit(0), anonymous.limit(0)
    return NM.resolve_names(tickets, 5, people, lines, fields, anonymous)


def test_sources_in_order_and_by_missing_names(spark):
    got = {r.record_key: r for r in resolved(spark).collect()}
    assert len(got) == 6
    assert (got["K1"].name_source, got["K1"].first_name, got["K1"].last_name) == (1, "Ann", "Aye")
    assert (got["K2"].name_source, got["K2"].first_name, got["K2"].last_name) == (2, "BO", "BEE")      # occasional
    assert (got["K3"].name_source, got["K3"].first_name, got["K3"].last_name) == (2, "Cy de", "Sea")   # more complete
    assert (got["K4"].name_source, got["K4"].last_name) == (3, "Dee")
    assert got["K5"].name_source is None and got["K6"].name_source is None                             # none; placeholders
    a = {k: (r.approver_first_name, r.approver_last_name) for k, r in got.items()}
    assert a == {"K1": ("App", "Rover"), "K2": (None, None), "K3": ("", ""), "K4": ("Anon", "Ymous"),
                 "K5": (None, None), "K6": ("App", "Rover")}
    assert {r.name_source for r in resolved(spark, empty=True).collect()} == {None}


def test_members_ids_and_status(spark):
    named = resolved(spark)
    dim = spark.createDataFrame([], "name_id int, traveler_id int, customer_system_id int, title string, first_name string, "
                                    "middle_name string, last_name string")
    members = NM.name_members(named, dim).collect()
    assert {(m.traveler_id, m.last_name) for m in members} == {
        (55, "Aye"), (56, "BEE"), (57, "Sea"), (58, "Dee"), (88, "Rover"), (88, "Ymous"), (99, "")}
    rows = [(i, *m) for i, m in enumerate(sorted(members), 1)]
    dim = spark.createDataFrame(rows + [(90, *rows[0][1:])], dim.schema)              # a repeated member
    with_ids = NM.add_name_ids(named, dim).withColumn("status", NM.mark_missing_name(
        F.lit(0), F.col("traveler_name_id"), F.col("approver_id"), F.col("approver_name_id")))
    got = {r.record_key: r for r in with_ids.collect()}
    assert len(got) == 6 and {k for k, r in got.items() if r.status == 9} == {"K5", "K6"}
    by_id = {r[0]: r for r in rows}
    assert by_id[got["K1"].traveler_name_id][1] == 55 and by_id[got["K4"].approver_name_id][6] == "Ymous"
    assert got["K1"].traveler_name_id == 1


def test_consultant_falls_back_to_the_name(spark):
    fact = spark.createDataFrame([("K1", "123", 1, T(2024, 3, 5, 18), 1, None), ("K2", "124", 1, T(2024, 3, 5), 1, 4),
                                  ("K3", "M77", 1, T(2024, 3, 5), 1, None), ("K4", "NMD8", 1, T(2024, 3, 5), 1, None),
                                  ("K5", "123", 1, T(2024, 3, 1), 0, 31), ("K6", "X1", 1, T(2024, 3, 5), 1, None),
                                  ("K7", None, 1, None, 1, None), ("K8", "124", 2, T(2024, 3, 5), 1, None)],
                                 "record_key string, meta_dossier_id string, product_id int, issue_date timestamp_ntz, "
                                 "agent_assisted int, consultant_id int")
    events = spark.createDataFrame([("123", T(2024, 3, 4), 11, 1), ("123", T(2024, 3, 4), 12, 1), ("123", T(2024, 3, 4, 9), 12, 1),
                                    ("123", T(2024, 3, 6), 13, 1), ("123", T(2024, 3, 5), 504141, 1), ("123", T(2024, 3, 5), None, 1),
                                    ("123", T(2024, 3, 5), 14, 2)],
                                   "dossier_id string, event_date timestamp_ntz, consultant_id int, action_id int")
    actions = spark.createDataFrame([(1, "HCBOOK"), (2, "OTHER")], "id int, label_code string")
    fields = spark.createDataFrame([(m, 1, "TRAVEL_CONSULTANT", "Doe Jo") for m in ("123", "124", "M77", "NMD8", "X1")]
                                   + [("124", 1, "OTHER", "Doe Jo")], "metaid string, product_id int, fld_key string, fld_value string")
    logins = spark.createDataFrame([(21, "Doe", "Jo"), (22, "Doe", "Jo"), (23, None, "Jo")],
                                   "consultant_id int, last_name string, first_name string")
    got = {r.record_key: r.consultant_id for r in
           HT.consultant_by_levels(fact, events, actions, fields, logins).collect()}
    assert got == {"K1": -12, "K2": -21, "K3": -21, "K4": -500000, "K5": 31, "K6": -500000, "K7": -500000, "K8": -500000}


def test_target_cuts_pads_and_stamps(spark):
    df = spark.createDataFrame([("x" * 200, "A"), (None, None)], "route_txt string, code string")
    at = T(2024, 1, 2, 3)
    r = Target({"route_txt": 150, "absent": 3}, {"code": 3}).shape(df, "job", at).collect()
    assert (len(r[0].route_txt), r[0].code, r[0].update_date, r[0].last_updated_by) == (150, "A  ", at, "job")
    assert r[1].route_txt is None and r[1].code is None


def test_trips_take_the_segments_geography(spark):
    fact = spark.createDataFrame([(1, "R1", 1, 10, 1, "EUR", "GBP", T(2024, 3, 1)), (1, "R2", 7, 10, -1, "EUR", "XXX", T(2024, 3, 1))],
                                 "file_id int, record_key string, booking_type_id int, travel_product_id int, increment_cnt int, "
                                 "currency_code string, currency string, invoice_date timestamp_ntz")
    stage = spark.createDataFrame([(1, "R1", 1, 9, D("10")), (1, "R1", 2, 9, D("20")), (1, "R2", 1, None, D("30")), (1, "R9", 1, 1, D("1"))],
                                  "file_id int, record_key string, trip_nbr int, geography_type_id int, trip_value decimal(19,4)")
    rates = spark.createDataFrame([(20240301, "GBP", "EUR", D("1.2"))], "time_id int, from_currency string, to_currency string, rate decimal(19,6)")
    from itinera.functions.dates import time_id
    day = fact.select(time_id(F.col("invoice_date")).alias("d")).first().d
    rates = rates.withColumn("time_id", F.lit(day))
    segs = spark.createDataFrame([(1, "R1", 1, 1, "AA", "BB"), (1, "R1", 1, 1, "BB", "CC"), (1, "R1", 1, 2, "AA", "ZZ")],
                                 "file_id int, record_key string, booking_type_id int, trip_nbr int, station_from string, station_to string")
    stations = spark.createDataFrame([("AA", "FR", 1033), ("BB", "FR", 1033), ("CC", "DE", 1033), ("CC", "XX", 1036)],
                                     "station_code string, country_code string, lang_id int")
    country = spark.createDataFrame([(10, 5, "FR", None, 3), (10, 5, "DE", None, 4), (10, 5, "FR", "DE", 6), (10, 5, "", None, 8), (10, 1, "FR", "FR", 7)],
                                    "travel_product_id int, line_of_business_id int, country_code string, country_code_destination string, geography_type_id int")
    priority = spark.createDataFrame([(10, 5, 3, 1), (10, 5, 4, 2), (10, 5, 6, 0), (10, 5, 8, 5)],
                                     "travel_product_id int, line_of_business_id int, geography_type_id int, priority int")
    segs = HT.train_geography(segs.withColumn("travel_product_id", F.lit(10)), stations, country, priority)
    assert sorted((r.station_from, r.station_to, r.geography_type_id) for r in segs.collect()) == [
        ("AA", "BB", 3), ("AA", "ZZ", None), ("BB", "CC", 6)]
    trips = FL.trip_geography(FL.load_trips(fact, stage, rates), segs, priority)
    got = {(r.record_key, r.booking_type_id, r.trip_nbr): (r.geography_type_id, float(r.trip_value), r.increment_cnt) for r in trips.collect()}
    assert got == {("R1", 1, 1): (6, 12.0, 1), ("R1", 1, 2): (9, 24.0, 1), ("R2", 7, 1): (None, 0.0, -1)}
