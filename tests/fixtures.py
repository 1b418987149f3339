"""Small travel fixtures (FIXTURES.md shapes), 3-20 rows per table."""

import datetime as dt
from decimal import Decimal as D

T = dt.datetime


def air_tables(spark):
    t = {}
    t["booking_type"] = spark.createDataFrame([(0,), (1,), (4,), (5,), (7,)], "booking_type_id short")
    t["air_ticket"] = spark.createDataFrame([
        # file, key, type, status, product, comcode, cc, cat, invoice, issue, booking, start, end, from, to, ccy,
        # ticket, base, tax, vat, penalty, commission, markup, gross, dossier, traveler, prior, card owner
        (7, "K1", 1, 1, 10, " acme ", 100, 1, T(2024, 3, 1), T(2024, 3, 1), T(2024, 2, 20), T(2024, 4, 1),
         T(2024, 4, 5), "LHR", "CDG", "GBP", D("100.00"), D("80.00"), D("15.00"), D("5.00"), D("0"), D("1"),
         D("2"), D("100.00"), "123", 55, None, 1),
        (7, "K2", 5, 1, 10, "ACME", 101, 1, T(2024, 3, 1), T(2024, 3, 1), T(2024, 3, 5), T(2024, 2, 28),
         T(2024, 3, 2), "CDG", "LHR", "EUR", D("50.00"), D("40.00"), D("10.00"), D("0"), D("0"), D("0"),
         D("0"), D("50.00"), "123", 55, "TK0", 2),
        (7, "K3", None, 1, 10, "ACME", 100, 2, T(2024, 3, 1), T(2024, 3, 1), None, T(2024, 3, 10),
         T(2024, 3, 10), "JFK", "LHR", "USD", D("10.00"), D("10.00"), D("0"), D("0"), D("0"), D("0"),
         D("0"), D("10.00"), "x9", 56, None, None),
        (7, "K4", 3, 1, 10, "ACME", 100, 1, T(2024, 3, 1), T(2024, 3, 1), None, T(2024, 3, 10),
         T(2024, 3, 10), "JFK", "LHR", "USD", D("1"), D("1"), D("0"), D("0"), D("0"), D("0"), D("0"), D("1"),
         "1", 57, None, None),                                   # unknown booking type 3 -> dropped
        (7, "K5", 1, 2, 10, "ACME", 100, 1, T(2024, 3, 1), T(2024, 3, 1), None, T(2024, 3, 10),
         T(2024, 3, 10), "JFK", "LHR", "USD", D("1"), D("1"), D("0"), D("0"), D("0"), D("0"), D("0"), D("1"),
         "1", 57, None, None),                                   # status 2 -> not loaded
        (8, "K1", 1, 1, 10, "ACME", 100, 1, T(2024, 3, 1), T(2024, 3, 1), None, T(2024, 3, 10),
         T(2024, 3, 10), "JFK", "LHR", "USD", D("1"), D("1"), D("0"), D("0"), D("0"), D("0"), D("0"), D("1"),
         "1", 57, None, None),                                   # other file
    ], "file_id int, record_key string, booking_type_id short, record_status_id short, travel_product_id int, "
       "comcode string, cost_center_id int, traveler_category_id int, invoice_date timestamp_ntz, "
       "issue_date timestamp_ntz, booking_date timestamp_ntz, travel_start timestamp_ntz, travel_end timestamp_ntz, "
       "airport_from string, airport_to string, currency string, ticket_amt decimal(19,4), base_amt decimal(19,4), "
       "tax_amt decimal(19,4), vat_amt decimal(19,4), penalty_amt decimal(19,4), commission_amt decimal(19,4), "
       "markup_amt decimal(19,4), gross_amt decimal(19,4), meta_dossier_id string, traveler_id int, "
       "ticket_code_prior string, card_owner_id int")
    t["travel_product"] = spark.createDataFrame([(10, "EUR", 1033)],
                                                "travel_product_id int, currency_code_storage string, default_lang_id int")
    t["fx_rate"] = spark.createDataFrame([
        (20240301, "GBP", "EUR", D("1.15")), (20240301, "EUR", "EUR", D("1"))],   # USD missing -> 0
        "time_id int, from_currency string, to_currency string, rate decimal(19,8)")
    t["advance_purchase"] = spark.createDataFrame([(1, 0, 6, 1033), (2, 7, 20, 1033), (3, 21, 90, 1033),
                                                   (9, 0, 400, 1036)],
                                                  "band_id short, start_day int, end_day int, lang_id int")
    t["group_account"] = spark.createDataFrame([(500, "ACME", 10)], "group_account_id int, comcode string, travel_product_id int")
    t["department"] = spark.createDataFrame([(900, 500, 100, 2, "Sales"), (901, 500, 101, 2, "Ops")],
                                            "department_id int, group_account_id int, main_cc_value_id int, "
                                            "customer_system_id short, name string")
    t["traveler_group_policy"] = spark.createDataFrame([(70, 500, 1, 2)],
                                                       "policy_id int, group_account_id int, traveler_category_id int, customer_system_id short")
    t["airport"] = spark.createDataFrame([
        ("LHR", "GB", 51.47, -0.45, 1033), ("CDG", "FR", 49.01, 2.55, 1033), ("JFK", "US", 40.64, -73.78, 1033),
        ("LHR", "GB", 0.0, 0.0, 1036)],
        "airport_code string, country_code string, latitude double, longitude double, lang_id int")
    t["air_ticket_segment"] = spark.createDataFrame([
        (7, "K1", 1, 1, 1, "LHR", "CDG"), (7, "K1", 1, 2, 1, "CDG", "LHR"),
        (7, "K2", 5, 1, 1, "CDG", "LHR"),
        (7, "K3", 0, 1, 1, "JFK", "XXX"),                      # unknown airport -> dropped by inner join
    ], "file_id int, record_key string, booking_type_id short, segment_nbr short, trip_nbr short, "
       "airport_from string, airport_to string")
    t["air_ticket_flight"] = spark.createDataFrame([
        (7, "K1", 1, 1, "LHR", "LHR", D("80.00")), (7, "K2", 5, 1, "CDG", "LHR", D("40.00"))],
        "file_id int, record_key string, booking_type_id short, trip_nbr short, airport_from string, "
        "airport_to string, flight_value decimal(19,4)")
    t["geography_priority"] = spark.createDataFrame([(10, 1, 1, 30), (10, 1, 2, 20), (10, 1, 3, 10), (10, 1, 5, 50)],
                                                    "travel_product_id int, line_of_business_id short, geography_type_id short, priority int")
    t["geography_country"] = spark.createDataFrame([
        (10, 1, "GB", None, 2), (10, 1, "FR", None, 1), (10, 1, "", None, 5), (10, 1, "FR", "GB", 3)],
        "travel_product_id int, line_of_business_id short, country_code string, country_code_destination string, "
        "geography_type_id short")
    t["route"] = spark.createDataFrame([(1, "LHR:CDG", "LHR", "CDG", "CDG:LHR", "CDG", "LHR")],
                                       "route_id int, route_code string, airport_from string, airport_to string, "
                                       "route_code_bidirectional string, airport_from_bidirectional string, "
                                       "airport_to_bidirectional string")
    t["traveler_stage_name"] = spark.createDataFrame([
        (7, "K1", 1, "Mr", "John", None, "Smith"), (7, "K2", 5, "Ms", " Ann ", None, "Lee")],
        "file_id int, record_key string, booking_type_id short, title string, first_name string, "
        "middle_name string, last_name string")
    t["traveler_name"] = spark.createDataFrame([(1, 55, 2, "Mr", "John", None, "Smith")],
                                               "name_id int, traveler_id int, customer_system_id short, title string, "
                                               "first_name string, middle_name string, last_name string")
    t["custom_field_long"] = spark.createDataFrame([
        (7, "K1", 1, 3, "B", "v2"), (7, "K1", 1, 3, "A", "v9"), (7, "K1", 1, 4, "C", None)],
        "file_id int, record_key string, booking_type_id short, field_id int, field_name string, field_value string")
    return t
