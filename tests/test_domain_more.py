import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from itinera.plans import extract_air as EA
from itinera.plans import file_loads as FL
from itinera.plans import hotel_train as HT
from itinera.plans import savings as SV

T = dt.datetime


def test_utc_offset_and_incomplete(spark):
    segs = spark.createDataFrame([("R1", 1, "CDG", "JFK", T(2024, 7, 1, 10), T(2024, 7, 1, 13)),
                                  ("R2", 7, "CDG", "JFK", T(2024, 1, 1, 10), T(2024, 1, 1, 13)),
                                  ("R3", 1, None, "JFK", T(2024, 1, 1, 10), T(2024, 1, 1, 13))],
                                 "record_key string, booking_type_id int, airport_from string, airport_to string, "
                                 "segment_start timestamp_ntz, segment_end timestamp_ntz")
    loc = spark.createDataFrame([("CDG", 1), ("JFK", 2)], "location_code string, tz_id int")
    zones = spark.createDataFrame([(1, 60), (2, -300)], "tz_id int, offset_min int")
    dst = spark.createDataFrame([(1, 120, T(2024, 3, 31), T(2024, 10, 27)), (2, -240, T(2024, 3, 10), T(2024, 11, 3))],
                                "tz_id int, offset_min int, begin_ts timestamp_ntz, end_ts timestamp_ntz")
    got = {r.record_key: (r.from_offset_min, r.to_offset_min, r.duration_minutes)
           for r in EA.with_utc_offset(segs, loc, zones, dst).collect()}
    # summer: 10:00 +2h = 08:00Z, 13:00 -4h = 17:00Z -> 540; winter refund: 09:00Z -> 18:00Z = 540, signed
    assert got == {"R1": (120, -240, 540), "R2": (60, -300, -540)}
    fact = spark.createDataFrame([("R1", 0), ("R3", 0)], "record_key string, record_status_id int")
    f, s = EA.mark_incomplete(fact, segs.withColumn("extract_id", F.lit(1)),
                              keys=("record_key",))
    assert sorted((r.record_key, r.record_status_id) for r in f.collect()) == [("R1", 0), ("R3", 10)]
    assert sorted(r.record_key for r in s.collect()) == ["R1", "R2"]


def test_link_penalty(spark):
    fact = spark.createDataFrame([(7, "K2", 5, "M", 55, "TK0", D("50")), (7, "K1", 1, "M", 55, None, D("100"))],
                                 "file_id int, record_key string, booking_type_id short, meta_dossier_id string, "
                                 "traveler_id int, ticket_code string, gross_amt decimal(19,4)")
    pen = spark.createDataFrame([("M", 55, "TK0", D("20"), "P2"), ("M", 55, "TK0", D("30"), "P1")],
                                "meta_dossier_id string, traveler_id int, ticket_code_prior string, gross_amt decimal(19,4), "
                                "record_key string")
    got = {r.record_key: float(r.gross_amt) for r in FL.link_penalty(fact, pen).collect()}
    assert got == {"K2": 80.0, "K1": 100.0}    # first penalty by key: P1 (30)


def test_fare_summary_keys_totals_finish(spark):
    k = ["extract_id", "message_unique_id", "booked_fare_number", "fare_number"]
    fares = spark.createDataFrame([(1, "M1", 1, 1), (1, "M1", 1, 2)], ", ".join(f"{c} {'string' if c == 'message_unique_id' else 'int'}" for c in k))
    amounts = spark.createDataFrame([(1, "M1", 1, 1, "TOTAL", D("100")), (1, "M1", 1, 1, "BASE", D("80")),
                                     (1, "M1", 1, 2, "TOTAL", D("50")), (1, "M1", 1, 2, "ANCILLARY", D("5"))],
                                    "extract_id int, message_unique_id string, booked_fare_number int, fare_number int, "
                                    "amount_type string, amount decimal(19,4)")
    segs = spark.createDataFrame([
        (1, "M1", 1, 1, 1, 1, T(2024, 1, 1), T(2024, 1, 1, 2), "AF", "Y", 3, "YOW", "CDG", "LHR"),
        (1, "M1", 1, 1, 2, 2, T(2024, 1, 5), T(2024, 1, 5, 2), "AF", "Y", 3, "YOW", "LHR", "CDG"),
        (1, "M1", 1, 2, 1, 1, T(2024, 1, 1), T(2024, 1, 1, 2), "BA", "M", 3, "MOW", "CDG", "LHR")],
        "extract_id int, message_unique_id string, booked_fare_number int, fare_number int, segment_rank int, "
        "leg_number int, departure_date timestamp_ntz, arrival_date timestamp_ntz, marketing_carrier string, "
        "booking_class string, cabin_class_id int, fare_basis string, airport_from string, airport_to string")
    s = {r.fare_number: r for r in SV.fare_summary(fares, amounts, segs, k).collect()}
    assert (s[1].geometry_type, s[1].route_txt, float(s[1].total_amount), s[1].has_ancillaries) == \
        ("RT", "CDG-LHR/LHR-CDG", 100.0, 0)
    assert s[1].marketing_carrier == "AF/AF"
    assert (s[2].geometry_type, s[2].first_carrier, s[2].has_ancillaries) == ("OW", "BA", 1)
    assert (float(s[1].total_amount_down), float(s[1].total_amount_up)) == (97.0, 103.0)
    msgs = spark.createDataFrame([(1, "M1", "ORIGINAL", "P1"), (2, "M1", "ORIGINAL", "P1"), (1, "M2", "ORIGINAL", "P9"),
                                  (2, "M3", "CHANGE", "P1")],
                                 "extract_id int, message_unique_id string, type string, pnr string")
    tickets = spark.createDataFrame([("P1",)], "pnr_code string")
    assert [(r.extract_id, r.message_unique_id) for r in SV.savings_keys(msgs, tickets).collect()] == [(2, "M1")]
    matches = spark.createDataFrame([("R1", 1, 1, "M1", 1), ("R2", 1, 1, "M1", 1)],
                                    "record_key string, booking_type_id int, extract_id int, message_unique_id string, booked_fare_number int")
    flights = spark.createDataFrame([("R1", 1, D("30")), ("R1", 1, D("20")), ("R2", 1, D("50"))],
                                    "record_key string, booking_type_id int, flight_value decimal(19,4)")
    tot = {float(r.booked_fare_total) for r in SV.matched_total(matches, flights).collect()}
    assert tot == {100.0}
    fact = spark.createDataFrame([("R1", 1, T(2013, 6, 1)), ("R2", 1, T(2020, 6, 1))],
                                 "record_key string, booking_type_id int, invoice_date timestamp_ntz")
    legacy = spark.createDataFrame([("R1", 1, D("1")), ("R2", 1, D("2"))], "record_key string, booking_type_id int, fare_amt_lowest decimal(19,4)")
    engine = spark.createDataFrame([("R1", 1, D("3")), ("R2", 1, D("4"))], "record_key string, booking_type_id int, fare_amt_lowest decimal(19,4)")
    got = {r.record_key: float(r.fare_amt_lowest) for r in SV.finish_savings(fact, legacy, engine, "2014-01-01").collect()}
    assert got == {"R1": 1.0, "R2": 4.0}


def test_hotel_geography_and_rate_supply(spark):
    fact = spark.createDataFrame([(10, "FR", "EPR"), (10, "XX", "NEG")], "travel_product_id int, hotel_country_code string, rate_type string")
    geo = spark.createDataFrame([(10, "FR", None, 2), (10, "FR", "GB", 9)],
                                "travel_product_id int, country_code string, country_code_destination string, geography_type_id int")
    g = HT.hotel_geography(fact, geo, 5).withColumn("supply", HT.hotel_rate_supply(F.lit("SRC1"), F.col("rate_type"),
                                                                                  {("SRC1", "EPR"): 3}, 0))
    got = sorted((r.hotel_country_code, r.geography_type_id, r.supply) for r in g.collect())
    assert got == [("FR", 2, 3), ("XX", 5, 0)]
