"""Savings summaries from raw message tables, and L4 on them."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from itinera.plans import saving_messages as SM
from itinera.plans.extract_job import run_extract_air
from tests.test_extract_job import AS_OF, interpreted, raw_tables  # noqa: F401

T = dt.datetime
BF = "extract_id int, message_unique_id string, booked_fare_number int"
SEG = (", segment_rank int, segment_number int, is_connection int, marketing_carrier_is_lowcost boolean, from_date timestamp_ntz, "
       "to_date timestamp_ntz, from_airport_code string, to_airport_code string, marketing_carrier_code string, "
       "flexibility_level string, cabin_class string, booking_class string, farebasis string")
AMT = ", type string, amount decimal(19,4)"


def seg(*key, rank, a, b, connection=0, low=False, carrier="XX", day=1, flex="F", number=None):
    return (*key, rank, rank if number is None else number, connection, low, T(2024, 5, day, 8), T(2024, 5, day, 11), a, b,
            carrier, flex, "BUSINESS", "BC", "BASISBASISBASISBASIS")


def messages(spark):
    df = spark.createDataFrame
    k = (5, "M1", 1)
    amounts = lambda key, total, fare, anc: [(*key, "total_amount", D(total)), (*key, "fare_amount", D(fare)),
                                             *([(*key, "ancillaries", D(anc))] if anc is not None else [])]
    loop = [seg(*k, 1, rank=1, a="AAA", b="BBB", day=1), seg(*k, 1, rank=2, a="BBB", b="CCC", day=4, connection=1),
            seg(*k, 1, rank=3, a="CCC", b="AAA", day=8)]
    part = [(5, "M1", 2, *s[3:]) for s in (loop[0], loop[2])]
    compare = [seg(*k, 1, 1, rank=1, a="AAA", b="BBB", day=1), seg(*k, 1, 1, rank=2, a="BBB", b="CCC", day=4, connection=1),
               seg(*k, 1, 1, rank=3, a="CCC", b="AAA", day=8),
               seg(*k, 2, 1, rank=1, a="AAA", b="CCC", day=1, low=True, carrier="LC"),
               seg(*k, 2, 2, rank=2, a="CCC", b="AAA", day=8, carrier=None)]
    return {
        "saving_message": df([(5, "M1", "ORIGINAL_PURCHASE"), (4, "M1", "ORIGINAL_PURCHASE"), (6, "M1", "CHANGE"),
                              (5, "M2", "ORIGINAL_PURCHASE"), (None, "M3", "ORIGINAL_PURCHASE")],
                             "extract_id int, message_unique_id string, xml_generated_at string"),
        "saving_booked_fare": df([(*k, 55), (5, "M1", 2, 56), (5, "M2", 1, 55)], BF + ", percode int"),
        "saving_fare": df([(*k, 1, "P", "PUBLISHED"), (5, "M1", 2, 1, "P", None), (4, "M1", 1, 1, "P", None),
                           (6, "M1", 1, 1, "P", None), (5, "M2", 1, 1, "OTHER", None), (None, "M3", 1, 1, "P", None)],
                          BF + ", fare_number int, pnr string, fare_type string"),
        "saving_fare_amount": df(amounts((*k, 1), "300", "250", "0") + amounts((5, "M1", 2, 1), "100", "90", None)
                                 + [(*k, 1, "obfees", None), (5, "M2", 1, 1, "total_amount", D("9"))], BF + ", fare_number int" + AMT),
        "saving_segment": df(loop + part + [seg(5, "M2", 1, 1, rank=1, a="X", b="Y")], BF + ", fare_number int" + SEG),
        "saving_option": df([(*k, 1, 0), (*k, 2, 1), (*k, 3, 1)],
                            BF + ", comparison_option_number int, is_lowest_recommended_fare int"),
        "saving_comparison_fare": df([(*k, 1, 1, "PUBLISHED"), (*k, 2, 1, "TPC"), (*k, 2, 2, None)],
                                     BF + ", comparison_option_number int, comparison_fare_number int, fare_type string"),
        "saving_comparison_amount": df(amounts((*k, 1, 1), "290", "250", "0") + amounts((*k, 2, 1), "100", "80", "0")
                                       + amounts((*k, 2, 2), "50", "40", "3"),
                                       BF + ", comparison_option_number int, comparison_fare_number int" + AMT),
        "saving_comparison_segment": df(compare, (BF + ", comparison_option_number int, comparison_fare_number int" + SEG)),
    }


@pytest.fixture(scope="module")
def levels(spark):
    t = messages(spark)
    tickets = spark.createDataFrame([(1, "P"), (5, "OTHER"), (1, None)], "booking_type_id int, pnr_code string")
    keys = SM.message_keys(t["saving_message"], t["saving_fare"], tickets)
    fine = SM.booked_levels(t, keys)
    booked, matched = SM.booked_fares(t, keys, fine), keys
    fine_options = SM.option_levels(t, matched)
    return keys, booked, SM.fares(t, keys, fine), SM.options(t, matched, fine_options, booked), \
        SM.comparison_fares(t, matched, fine_options)


def test_keys_are_first_purchases_of_a_bought_locator(levels):
    # extract 6 is newer but no first purchase; M2's locator belongs to an exchange; M3 has no extract
    assert [tuple(r) for r in levels[0].select("message_unique_id", "extract_id").collect()] == [("M1", 5)]


def test_fares_and_booked_fares(levels):
    f = {r.booked_fare_number: r for r in levels[2].collect()}
    assert len(f) == 2
    a, b = f[1], f[2]
    assert (a.geometry_type, a.segment_cnt, a.route_txt, a.marketing_carrier) == \
        ("RT", 3, "AAA-BBB/BBB-CCC/CCC-AAA", "XX/XX/XX")           # the connection is no leg of the shape
    assert (a.from_date, a.to_date, a.percode, a.has_ancillaries) == (T(2024, 5, 1, 8), T(2024, 5, 8, 11), 55, 0)
    assert (a.total_amount_down, a.total_amount_up, a.obfees) == (D("291"), D("309"), None)
    assert (a.first_booking_class, a.first_fare_basis, a.first_cabin_class_id) == ("B", "BASISBASISBASIS", 2)
    assert b.has_ancillaries is None and b.percode == 56           # no such amount row: matches no ticket
    assert {r.booked_fare_number: r.fare_amount for r in levels[1].collect()} == {1: D("250"), 2: D("90")}


def test_options_and_comparison_fares(levels):
    o = {r.comparison_option_number: r for r in levels[3].collect()}
    assert set(o) == {1, 2}                                        # option 3 has no fare
    assert (o[1].is_booked_fare, o[1].geometry_type, o[1].fare_type_id) == (1, "RT", 1)
    assert (o[2].is_booked_fare, o[2].geometry_type, o[2].total_amount, o[2].has_ancillaries) == (0, "2OW", D("150"), 1)
    assert (o[2].is_lowcost, o[2].flexibility_level, o[2].marketing_carrier, o[2].first_booking_class) == (1, "LOWCOST", "LC/", None)
    c = {(r.comparison_option_number, r.comparison_fare_number): r for r in levels[4].collect()}
    assert set(c) == {(1, 1), (2, 1), (2, 2)}
    assert (c[2, 1].geometry_type, c[2, 1].fare_type_id, c[2, 1].is_lowest_recommended_fare) == ("OW", 101, 1)
    assert (c[2, 2].fare_type_id, c[2, 2].flexibility_level, c[2, 2].is_lowcost) == (0, "F", 0)


def test_empty_tables(spark):
    t = {n: df.limit(0) for n, df in messages(spark).items()}
    tickets = spark.createDataFrame([], "booking_type_id int, pnr_code string")
    keys = SM.message_keys(t["saving_message"], t["saving_fare"], tickets)
    fine = SM.booked_levels(t, keys)
    booked = SM.booked_fares(t, keys, fine)
    assert booked.count() == SM.fares(t, keys, fine).count() == 0
    assert SM.options(t, keys, SM.option_levels(t, keys), booked).count() == 0


def test_ties_and_missing_ranks(spark):
    t = messages(spark)
    k = (5, "M1", 1, 1)
    segs = spark.createDataFrame([seg(*k, rank=1, a="B", b="C", number=2, day=2), seg(*k, rank=1, a="A", b="B", number=1),
                                  seg(*k, rank=None, a="Z", b="A", number=9, day=9), seg(*k, rank=2, a=None, b="D", day=3)],
                                 t["saving_segment"].schema)
    keys = spark.createDataFrame([(5, "M1")], "extract_id int, message_unique_id string")
    r = SM.described(SM.finest(SM.events(t["saving_fare_amount"], segs, SM.FARE, keys), SM.FARE), SM.FARE) \
        .where("booked_fare_number = 1").first()
    assert (r.route_txt, r.segment_cnt, r.geometry_type) == ("Z-A/A-B/B-C/-D", 4, "MD")
    assert (r.from_date, r.to_date) == (T(2024, 5, 1, 8), T(2024, 5, 3, 11))


def test_two_scans_of_the_detail_tables(spark, tmp_path):
    t = {}
    for n, df in messages(spark).items():
        df.write.parquet(str(tmp_path / n))
        t[n] = spark.read.parquet(str(tmp_path / n))
    keys = spark.createDataFrame([(5, "M1")], "extract_id int, message_unique_id string")
    plan = SM.booked_levels(t, keys)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Aggregate") == 1


def test_extract_job_takes_the_raw_tables(spark, tmp_path):
    t = raw_tables(spark)
    t.pop("savings")
    t.update(messages(spark))
    # the itinerary is CCC-AAA (8 May), AAA-BBB, BBB-CCC (1 May); traveller 55 paid 300
    own = [("CCC", "AAA"), ("AAA", "BBB"), ("BBB", "CCC")]
    loop = [(*s[:8], T(2024, 5, 8, 9), T(2024, 5, 1, 17), a, b, *s[12:]) for s, (a, b) in
            zip((seg(5, "M1", 1, 1, rank=i, a="", b="", connection=int(i == 2))
                 for i in (1, 2, 3)), own)]
    t["saving_segment"] = spark.createDataFrame(loop, t["saving_segment"].schema)
    t["saving_comparison_segment"] = spark.createDataFrame(
        [(*s[:3], 1, 1, *s[4:]) for s in loop] + [(*s[:3], 2, 1, *s[4:]) for s in (loop[0], loop[2])],
        t["saving_comparison_segment"].schema)
    t["traveller"] = spark.createDataFrame([("88", 1, 0, 5, "", "Bo", "Ker", 0), ("55", 1, 1, 5, "MR", "Ann", "Aye", 0)],
                                           "no string, product_id int, is_vip int, extract_id int, title string, "
                                           "first_name string, name string, is_occasional int")
    t["traveler_name"] = spark.createDataFrame([(7, 55, 2, "MR", "Ann", "", "Aye")],
                                               "name_id int, traveler_id int, customer_system_id int, title string, "
                                               "first_name string, middle_name string, last_name string")
    out = run_extract_air(spark, t, 5, AS_OF, str(tmp_path / "facts"))
    tickets = {r.record_key: r for r in out["tickets"].collect()}
    # traveller 55 is a stored member; approver 77 is in no table and becomes one without a name
    assert {r.traveler_name_id for r in tickets.values()} == {7} and tickets["INV1-10"].approver_name_id == 8
    assert tickets["INV1-10"].record_status_id == 0 and tickets["INV1-10"].last_updated_by == "extract_air"
    got = {r.record_key: r for r in out["savings"].collect()}["INV1-10"]
    # the recommended option (100 + 50, no booked fare) has the booked shape RT; fare 1 of it costs 100
    assert round(got.amt_percentage_diff, 4) == 99.3333                # 300 less the online fee of 2
    assert got.savings_rule == "1. || RT vs RT"
    assert got.fare_amt_lowest == D("100") and got.low_fare_chosen == 0
