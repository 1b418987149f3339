import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from itinera.plans import hotel_train as HT
from itinera.plans.pipelines import run_file_train
from tests.fixtures import air_tables

T = dt.datetime


def test_hotel_brand_chain_and_consultant(spark):
    fact = spark.createDataFrame([("H1", 7, 32, T(2024, 5, 1)), ("H2", 8, 40, T(2024, 5, 1)), ("H3", 9, 40, T(2024, 5, 1))],
                                 "record_key string, hotel_id int, booking_source_id int, check_in_date timestamp_ntz")
    sku = spark.createDataFrame([(7, 100, 1, T(2024, 1, 1), 5), (7, 101, 1, T(2024, 2, 1), 5), (8, 200, 1, T(2024, 1, 1), 4)],
                                "sku_item_id int, brand_id int, brand_use_rank int, update_date timestamp_ntz, extract_id_max int")
    ext = spark.createDataFrame([("hotel_catalog", 4, True), ("hotel_catalog", 5, True), ("hotel_catalog", 6, False)],
                                "source string, extract_id int, complete boolean")
    chain = spark.createDataFrame([(101, 9, dt.date(2024, 1, 1), dt.date(2024, 12, 31))],
                                  "brand_id int, chain_id int, effective_begin date, effective_end date")
    got = {r.record_key: (r.hotel_brand_id, r.hotel_chain_id)
           for r in HT.hotel_brand_chain(fact, sku, ext, chain).collect()}
    # newest update wins for hotel 7; hotel 8 only in an older catalogue -> default by source
    assert got == {"H1": (101, 9), "H2": (-10000, 0), "H3": (-10000, 0)}
    tickets = spark.createDataFrame([("K1", "123", T(2024, 3, 5, 18), 1), ("K2", "12x", T(2024, 3, 5), 1),
                                     ("K3", "123", T(2024, 3, 1), 0)],
                                    "record_key string, meta_dossier_id string, issue_date timestamp_ntz, agent_assisted int")
    events = spark.createDataFrame([("123", T(2024, 3, 5, 9), 11, 1), ("123", T(2024, 3, 5, 10), 12, 1),
                                    ("123", T(2024, 3, 5, 11), 12, 2), ("123", T(2024, 3, 6), 13, 1),
                                    ("123", T(2024, 3, 4), 14, 9)],
                                   "dossier_id string, event_date timestamp_ntz, consultant_id int, action_id int")
    actions = spark.createDataFrame([(1, "BOOK"), (2, "ISSUE"), (9, "OTHER")], "id int, label_code string")
    got = {r.record_key: r.consultant_id for r in HT.attribute_consultant(tickets, events, actions).collect()}
    assert got == {"K1": 12, "K2": -500000, "K3": None}


def test_train_pipeline(spark):
    t = air_tables(spark)
    t["train_ticket"] = t["air_ticket"].withColumn("card_nbr", F.lit("4111111111111111"))
    t["train_ticket_segment"] = spark.createDataFrame([
        (7, "K1", 1, 1, "FR-PARIS", "LYS", D("30")), (7, "K1", 1, 2, "LYS", "FR-MARS", D("20"))],
        "file_id int, record_key string, booking_type_id short, segment_nbr int, station_from string, "
        "station_to string, segment_value decimal(19,4)")
    t["train_station"] = spark.createDataFrame([("PARIS", "Paris", 1033), ("LYS", "Lyon", 1033), ("MARS", "Marseille", 1033)],
                                               "station_code string, city_name string, lang_id int")
    t["route"] = spark.createDataFrame([(1, "PARIS:LYON", "PARIS", "LYON", "LYON:PARIS", "LYON", "PARIS")],
                                       t["route"].schema)
    import tempfile
    out = run_file_train(spark, t, 7, tempfile.mkdtemp())
    f = {r.record_key: (r.card_first6, r.card_last4) for r in out["fact"].collect()}
    assert f["K1"] == ("411111", "1111") and "card_nbr" not in out["fact"].columns
    rt = {r.record_key: (r.route_txt, r.route_from, r.route_to) for r in out["route_text"].collect()}
    assert rt["K1"] == ("Paris/Lyon/Marseille", "Paris", "Marseille")
    segs = sorted((r.segment_nbr, r.station_from, float(r.segment_value)) for r in out["segments"].collect())
    assert segs == [(1, "PARIS", 34.5), (2, "LYS", 23.0)]
    assert [r.route_code for r in out["new_routes"].collect()] == ["PARIS:MARSEILLE"]
