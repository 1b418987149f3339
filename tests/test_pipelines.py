import datetime as dt
from decimal import Decimal as D

from itinera.plans.pipelines import run_extract_air

T = dt.datetime


def extract_tables(spark):
    cols = ("extract_id int, product_id int, document_no string, id_2 string, ticket string, line_no int, "
            "ticket_type int, exchange_ticket int, resource_type int, amount_incl_vat decimal(19,4), "
            "principal_ticket string")
    t = {}
    t["invoice_line"] = spark.createDataFrame([
        (5, 1, "INV1", "P", "T1", 10, 1, 0, 0, D("300"), None),
        (5, 1, "INV2", "P", "T2", 10, 1, 1, 0, D("100"), "PT"),
        (5, 1, "INV2", "P", "T3", 20, 1, 0, 0, D("50"), "PT"),
        (6, 1, "INV9", "P", "T9", 10, 1, 0, 0, D("1"), None)], cols)
    t["credit_line"] = spark.createDataFrame([(5, 1, "CR1", "P", "T1", 10, 2, 0, 0, D("300"), None)], cols)
    t["credit_header"] = spark.createDataFrame([(5, 1, "CR1", "INV1")],
                                               "extract_id int, product_id int, no string, issued_to_doc string")
    d = dt.date
    t["travel_leg"] = spark.createDataFrame([
        # extract, doc, line, entry, leg, dep date, issued, dep time, arr time, arr d/m, duration, from, to, geo
        (5, "INV1", 10, 1, 1, d(2024, 5, 1), d(2024, 4, 1), "0800", "1000", "01/05", "0200", "AAA", "BBB", 1),
        (5, "INV1", 10, 1, 2, d(2024, 5, 1), d(2024, 4, 1), "1500", "1700", "01/05", "0200", "BBB", "CCC", 1),
        (5, "INV1", 10, 2, 1, d(2024, 5, 8), d(2024, 4, 1), "0900", "1100", "08/05", "0200", "CCC", "AAA", 1),
        (5, "INV2", 10, 1, 1, d(2024, 6, 1), d(2024, 4, 1), "0700", "0800", "01/06", "0100", "DDD", "EEE", 2),
    ], "extract_id int, document_no string, line_no int, entry_no int, leg_no int, departure_date date, "
       "issued_date date, departure_time string, arrival_time string, arrival_day_month string, "
       "fly_duration string, city_from string, city_to string, geography_type_id int")
    from pyspark.sql import functions as F
    t["travel_leg"] = (t["travel_leg"].withColumn("within_country", F.lit(0)).withColumn("mileage_gds", F.lit(100))
                       .withColumn("class_code", F.lit("Y")).withColumn("cabin_class_id", F.lit(1))
                       .withColumn("basis", F.lit("YOW")).withColumn("airline", F.lit("XX")))
    t["geography_priority"] = spark.createDataFrame([(1, 20), (2, 10)], "geography_type_id int, priority int")
    extra = {"public_price": F.lit(0).cast("decimal(19,4)"), "amount": F.col("amount_incl_vat") - F.lit(20),
             "airport_tax": F.lit(15).cast("decimal(19,4)"), "commission_excl_vat": F.lit(1).cast("decimal(19,4)"),
             "ob_fees_amt": F.lit(2).cast("decimal(19,4)"), "markup_total": F.lit(0).cast("decimal(19,4)"),
             "markup_gds": F.lit(0).cast("decimal(19,4)"), "markup_pub": F.lit(0).cast("decimal(19,4)"),
             "id_1": F.lit("FILE1"), "crs": F.lit("1A"), "business_category": F.lit(1),
             "business_sub_category": F.lit(0)}
    erp = {"traveller_code": F.lit("55"), "corporation": F.lit("XX"), "e_ticket": F.lit(1),
           "e_ticket_refused": F.lit(0), "group": F.lit(0), "issued_date": F.lit(None).cast("timestamp_ntz"),
           "posting_date": F.lit(T(2024, 4, 1)).cast("timestamp_ntz"), "increment_order": F.lit(0),
           "meta_id": F.lit("42"), "ect_error": F.lit(0), "rtu": F.lit(0), "service_group": F.lit(1),
           "original_ticket": F.lit(None).cast("string")}
    for name in ("invoice_line", "credit_line"):
        for c, v in {**extra, **erp}.items():
            t[name] = t[name].withColumn(c, v)
    bf = "extract_id int, message_unique_id string, booked_fare_number int"
    t["savings"] = {
        "fares": spark.createDataFrame([(5, "M1", 1, 1, "AAA-BBB/BBB-CCC/CCC-AAA", 3, T(2024, 5, 1, 8), T(2024, 5, 8, 11),
                                         55, "P", 0, D("300"), D("291"), D("309"), "RT", 0, "F")],
                                       bf + ", fare_number int, route_txt string, segment_cnt long, from_date timestamp_ntz, "
                                       "to_date timestamp_ntz, percode int, pnr string, has_ancillaries int, "
                                       "total_amount decimal(19,4), total_amount_down decimal(19,4), "
                                       "total_amount_up decimal(19,4), geometry_type string, is_lowcost int, "
                                       "flexibility_level string"),
        "options": spark.createDataFrame([
            (5, "M1", 1, 1, 0, "XX", D("250"), 0, "XX", "RT", 1, "PUBLISHED", "F", "B", "Y", 3),
            (5, "M1", 1, 2, 0, "XX", D("280"), 0, "XX", "RT", 0, "PUBLISHED", "F", "B", "Y", 3)],
            bf + ", comparison_option_number int, is_booked_fare int, marketing_carrier string, "
            "total_amount decimal(19,4), is_lowcost int, first_carrier string, geometry_type string, "
            "is_lowest_recommended_fare int, fare_type string, flexibility_level string, first_fare_basis string, "
            "first_booking_class string, first_cabin_class_id int"),
        "comp_fares": spark.createDataFrame([(5, "M1", 1, 1, 1, D("250"), 0, "XX", "LB", "L", 3, "F"),
                                             (5, "M1", 1, 2, 1, D("280"), 0, "XX", "PB", "P", 3, "F")],
                                            bf + ", comparison_option_number int, comparison_fare_number int, "
                                            "total_amount decimal(19,4), is_lowcost int, first_carrier string, "
                                            "first_fare_basis string, first_booking_class string, "
                                            "first_cabin_class_id int, flexibility_level string"),
        "booked": spark.createDataFrame([(5, "M1", 1, "XX", "F")], bf + ", marketing_carrier string, flexibility_level string"),
    }
    t["tagged_text"] = spark.createDataFrame([(1, 5, "FILE1", "TAX", 1, "     7.50YQ     2.00YR")],
                                             "product_id int, extract_id int, file_name string, tag string, "
                                             "line_id int, text1 string")
    return t


def test_extract_pipeline(spark, tmp_path):
    out = run_extract_air(spark, extract_tables(spark), 5, dt.date(2024, 6, 1), str(tmp_path))
    fact = sorted((r.document_no, r.line_no, r.record_key, r.booking_type_id) for r in out["fact"].collect())
    assert fact == [("CR1", 10, "CR1-10", 7), ("INV1", 10, "INV1-10", 1), ("INV2", 10, "INV2-10", 5),
                    ("INV2", 20, "INV2-10", 1)]
    segs = {(r.record_key, r.segment_nbr): r.trip_nbr for r in out["segments"].collect()}
    # INV1: 08-10 then 15-17 (5 h gap, not domestic) -> new trip; a week later -> third trip
    assert segs[("INV1-10", 1)] == 1 and segs[("INV1-10", 2)] == 2 and segs[("INV1-10", 3)] == 3
    routes = {r.record_key: (r.route_txt, r.airport_to) for r in out["routes"].collect()}
    assert routes["INV1-10"] == ("AAA/BBB/CCC/AAA", "CCC")
    ru = {r.record_key: r for r in out["rollups"].collect()}
    assert ru["INV1-10"].trip_cnt == 3 and ru["INV1-10"].travel_start == T(2024, 5, 1, 8, 0)
    am = {(r.document_no, r.line_no): (float(r.ticket_amt), float(r.ticket_amt_tax), float(r.ticket_amt_tax_fee))
          for r in out["amounts"].collect()}
    # invoice 300: tax = airport 15 + VAT 20; tax fee |7.5| + |2.0|; the refund credit is negative
    assert am[("INV1", 10)] == (300.0, 35.0, 9.5) and am[("CR1", 10)][0] == -300.0
    sv = {(r.record_key, r.segment_nbr): float(r.segment_value) for r in out["segment_values"].collect()}
    # INV1 base = 280 - 15 airport tax = 265 over three legs of 100 GDS miles each
    assert abs(sv[("INV1-10", 1)] - 265 / 3) < 1e-6
    fl = {(r.record_key, r.trip_nbr): r for r in out["flights"].collect()}
    assert abs(float(fl[("INV1-10", 2)].flight_value) - 265 / 3) < 1e-6
    sav = {r.record_key: r for r in out["savings"].collect()}
    # INV1-10 paid 300 - 2 online fees matches the 300 fare (+-3 %): lowest recommended 250 + fees 2;
    # published 280 scaled by the match percentage (99.33 %) + fees 2
    x = sav["INV1-10"]
    assert x.savings_rule == "1. || RT vs RT" and float(x.fare_amt_lowest) == 252.0
    assert abs(float(x.fare_amt_published) - (280 * 0.993333 + 2)) < 0.01
    assert sav["CR1-10"].savings_rule == "4"   # refunds never match: negated to the paid amount
    assert fl[("INV1-10", 1)].airport_from == "AAA" and fl[("INV1-10", 1)].airport_to == "BBB"



def test_extract_pipeline_rules_exclude_company_fares(spark, tmp_path):
    t = extract_tables(spark)
    t.pop("savings")
    on = (dt.date(2000, 1, 1), dt.date(2100, 1, 1))
    t["fare_rules"] = spark.createDataFrame([(300, "ticket", "=", "T1", *on), (300, "doc_kind", "=", "I", *on)],
                                            "rule_id int, column_name string, comparison string, value string, "
                                            "effective_start date, effective_end date")
    t["fare_rule_groups"] = spark.createDataFrame([(300, 101)], "rule_id int, fare_type_id int")
    out = run_extract_air(spark, t, 5, dt.date(2024, 6, 1), str(tmp_path))
    ft = {(r.document_no, r.line_no): r.fare_type_id for r in out["fact"].collect()}
    assert ft[("INV1", 10)] == 101 and ft[("CR1", 10)] is None
    am = {(r.document_no, r.line_no): float(r.ticket_amt_tax_fee) for r in out["amounts"].collect()}
    assert am[("INV1", 10)] == 0.0        # company fare: no tax fee


def test_extract_conjunction_ticket_sums_its_lines(spark, tmp_path):
    from pyspark.sql import functions as F
    t = extract_tables(spark)
    # INV1 becomes a conjunction ticket: a second line of the same principal ticket, 120 beside 300
    line = t["invoice_line"].where("document_no = 'INV1'").withColumn("principal_ticket", F.lit("T1"))
    second = (line.withColumn("line_no", F.lit(20)).withColumn("ticket", F.lit("T1B"))
              .withColumn("amount_incl_vat", F.lit(D("120")).cast("decimal(19,4)"))
              .withColumn("amount", F.lit(D("100")).cast("decimal(19,4)")))
    t["invoice_line"] = t["invoice_line"].where("document_no <> 'INV1'").unionByName(line).unionByName(second)
    leg = t["travel_leg"].where("document_no = 'INV1' AND entry_no = 2").withColumn("line_no", F.lit(20))
    t["travel_leg"] = t["travel_leg"].where("document_no <> 'INV1' OR entry_no <> 2").unionByName(leg)
    out = run_extract_air(spark, t, 5, dt.date(2024, 6, 1), str(tmp_path))
    assert sorted((r.line_no, float(r.ticket_amt_base)) for r in out["amounts"].where("record_key = 'INV1-10'").collect()) \
        == [(10, 265.0), (20, 85.0)]
    # 265 + 85 over three legs of 100 miles, and nothing lost
    sv = [float(r.segment_value) for r in out["segment_values"].where("record_key = 'INV1-10'").collect()]
    assert len(sv) == 3 and abs(sum(sv) - 350) < 1e-6 and all(abs(v - 350 / 3) < 1e-6 for v in sv)
    fl = [float(r.flight_value) for r in out["flights"].where("record_key = 'INV1-10'").collect()]
    assert abs(sum(fl) - 350) < 1e-6
    # one savings row per ticket, with the whole paid amount
    sav = out["savings"].where("record_key = 'INV1-10'").collect()
    assert [float(r.ticket_amt) for r in sav] == [420.0]
