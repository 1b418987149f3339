"""L4 from raw tables to written facts: every optional step, kills after any step, routes over batches."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from itinera.jobs import Job
from itinera.plans import extract_air as EA
from itinera.plans.extract_job import run_extract_air
from tests.test_jobs import Flaky, Killed
from tests.test_pipelines import extract_tables

T = dt.datetime
AS_OF = dt.date(2024, 6, 1)


def raw_tables(spark):
    t = extract_tables(spark)
    extra = {"sell_to_customer_no": F.lit("900"), "type": F.lit(3), "reservation_mode": F.lit(0), "subscription": F.lit(0),
             "card_number": F.lit("TOK1"), "card_reference": F.lit("REF"), "rtu": F.lit(1)}
    for name in ("invoice_line", "credit_line"):
        for c, v in extra.items():
            t[name] = t[name].withColumn(c, v)
    # T9 of the other extract has no leg; INV2 line 20 is an ancillary; its ticket T3 has no leg either
    t["invoice_line"] = (t["invoice_line"].withColumn("principal_ticket", F.lit(None).cast("string"))
                         .withColumn("original_ticket", F.when(F.col("ticket") == "T2", "T1"))
                         .withColumn("business_category", F.when(F.col("ticket") == "T2", 3).otherwise(1)))
    header = "extract_id int, product_id int, no string, sell_to_customer_no string, posting_date timestamp_ntz"
    t["invoice_header"] = spark.createDataFrame([(5, 1, "INV1", "900", T(2024, 4, 1)), (5, 1, "INV2", "900", T(2024, 4, 2)),
                                                 (6, 1, "INV9", "900", T(2024, 4, 3))], header)
    t["credit_header"] = spark.createDataFrame([(5, 1, "CR1", "900", T(2024, 4, 5), "INV1")], header + ", issued_to_doc string")
    t["travel_leg"] = (t["travel_leg"].withColumn("product_id", F.lit(1)).withColumn("class_code_raw", F.lit("Y"))
                       .withColumn("ticket_no", F.when(F.col("document_no") == "INV1", "T1").otherwise("T2"))
                       .withColumn("segment_no", F.expr("CASE WHEN entry_no = 2 THEN 1 ELSE leg_no + 1 END"))
                       .withColumn("from_country_code", F.lit("AAA")).withColumn("to_country_code", F.lit("BBB")).drop("line_no"))
    credit = t["travel_leg"].where("document_no = 'INV1' and entry_no = 2").withColumn("document_no", F.lit("CR1"))
    lost = credit.withColumn("entry_no", F.lit(3)).withColumn("city_to", F.lit(None).cast("string"))
    t["travel_leg"] = t["travel_leg"].unionByName(credit).unionByName(lost)
    led = ("extract_id int, product_id int, entry_no int, document_no string, line_no int, ticket_no string, "
           "traveller_code string, sell_to_customer_no string, id_2 string, service_group int, entry_type int, resource_type int, "
           "posting_date timestamp_ntz, amount_lcy_incl_vat decimal(19,4), net_amount decimal(19,4), tax_amount decimal(19,4), "
           "gross_commission decimal(19,4)")
    row = lambda entry, doc, line, ticket, day, amount, kind=3: (
        5, 1, entry, doc, line, ticket, "55", "900", "P", 1, kind, 0, T(2024, 4, day), D(amount), D(amount) - 20, D("15"), D("1"))
    t["service_ledger"] = spark.createDataFrame([row(1, "INV1", 10, "T1", 1, "300"), row(2, "INV2", 10, "T2", 1, "100"),
                                                 row(3, "CR1", 10, "T1", 1, "-300", 4), row(0, "INV2", 10, "T1", 1, "0")], led)
    t["class_of_service"] = spark.createDataFrame([("XX", "Y", 3)], "airline_code string, class_code string, cabin_class_id int")
    t["flexibility_rule"] = spark.createDataFrame([(1, "XX", "YOW", "Y", 2), (1, "XX", "YOW", "Y", 2), (1, "XX", "YOW", "Y", 1)],
                                                  "product_id int, airline string, basis string, class_code string, flexibility_id int")
    t["travel_leg"] = t["travel_leg"].withColumn("low_cost", F.lit(0))
    t["location"] = spark.createDataFrame([(c * 3, k % 2) for k, c in enumerate("ABCDE")], "location_code string, tz_id int")
    t["time_zone"] = spark.createDataFrame([(0, 60), (1, -300)], "tz_id int, offset_min int")
    t["daylight"] = spark.createDataFrame([(0, 120, T(2024, 3, 31), T(2024, 10, 27))],
                                          "tz_id int, offset_min int, begin_ts timestamp_ntz, end_ts timestamp_ntz")
    t["travel_product"] = spark.createDataFrame([(1, "EUR")], "product_id int, currency_code_storage string")
    t["dossier_field"] = spark.createDataFrame([
        ("42", 1, 5, "BOOKER_PERCODE", "88", "N", T(2024, 1, 1), None), ("42", 1, 5, "BOOK_DATE", "2024-03-01 10:00:00", "N", T(2024, 1, 1), None),
        ("42", 1, 5, "APPROVER_PERCODE", "77", "N", T(2024, 1, 1), None), ("42", 1, 5, "ISCOMPLIANT", "True", "N", T(2024, 4, 1), "P")],
        "metaid string, product_id int, extract_id int, fld_key string, fld_value string, system string, "
        "date_insert timestamp_ntz, ref string")
    t["policy_reason"] = spark.createDataFrame([("42", "P", 5, "WHY_CHOSEN_AS_OOP_ID", 1, "12")],
                                               "md_code string, pnr string, extract_id int, reason_type string, service_type_id int, reasons_txt string")
    t["traveller"] = spark.createDataFrame([("88", 1, 0), ("55", 1, 1)], "no string, product_id int, is_vip int")
    t["traveler_account"] = spark.createDataFrame([(5, 2)], "tuid int, customer_system_id int")
    card = ("product_id int, customer_no string, token string, extract_id int, card_no_1 string, card_no_2 string, "
            "card_no_3 string, card_no_4 string, card_type int, sharing_type int")
    t["payment_card"] = spark.createDataFrame([(1, "900", "TOK1", 2, "4999", "1111", "2222", "4444", 0, 2)], card)
    t["payment_card_history"] = t["payment_card"].limit(0)
    t["payment_data"] = spark.createDataFrame([], "product_id int, customer_no string, card_reference string, no string, extract_id int, "
                                              "card_no_1 string, card_no_2 string, card_no_3 string, card_no_4 string, card_type int, sharing_type int")
    t["agent_login"] = spark.createDataFrame([("AB12", 31)], "login string, id int")
    t["remark_patterns"] = [("^IFD", 1)]
    t["tagged_text"] = t["tagged_text"].unionByName(spark.createDataFrame(
        [(1, 5, "FILE1", "RM", 2, "IFD FEE 12,50 ab12")], t["tagged_text"].schema))
    t["route"] = spark.createDataFrame([(70, "AAA:BBB", "AAA", "BBB", "AAA:BBB", "AAA", "BBB")],
                                       "route_id int, route_code string, airport_from string, airport_to string, "
                                       "route_code_bidirectional string, airport_from_bidirectional string, airport_to_bidirectional string")
    return t


def everything(spark, root):
    """All published rows, as comparable tuples."""
    return {name: sorted(map(repr, spark.read.parquet(f"{root}/{name}").drop("update_date").collect()))
            for name in ("air_fact", "air_segment_fact", "air_flight_fact", "air_fact_key")}


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """A job plans some thirty queries over a few rows; compiling each takes longer than running it."""
    small = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
             "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))
    return root, run_extract_air(spark, raw_tables(spark), 5, AS_OF, root)


def test_raw_tables_to_facts(spark, whole):
    _, out = whole
    tickets = {r.record_key: r for r in out["tickets"].collect()}
    assert set(tickets) == {"INV1-10", "INV2-10", "CR1-10"}            # INV2 line 20 has no leg: no candidate
    a, x, c = tickets["INV1-10"], tickets["INV2-10"], tickets["CR1-10"]
    assert (a.booking_type_id, x.booking_type_id, c.booking_type_id) == (1, 5, 7)
    assert (a.currency_code, a.booking_date, a.arranger_id, a.logon_id, a.approver_id) == ("EUR", T(2024, 3, 1, 10), 88, 88, 77)
    assert (a.service_level_id, a.card_last4, a.fsf, a.fsf_consultant_id) == (2, "4444", 1, 31)
    assert (a.policy_reason_code_id, a.policy_status_id, x.policy_status_id) == (12, 1, 0)
    # lineage: the purchase is its own origin, the exchange and the credit come from it
    assert (a.record_key_original, x.record_key_original, c.record_key_original) == ("INV1-10",) * 3
    # The credit has a leg without an airport
    assert (a.record_status_id, c.record_status_id) == (0, 10)
    # the exchange of 100 adds the original ticket's 300
    assert float(x.ticket_amt) == 400.0 and float(c.ticket_amt) == -300.0
    assert a.savings_rule.startswith("4") or a.savings_rule


def test_trips_follow_the_first_order_and_routes_the_second(spark, whole):
    _, out = whole
    segs = sorted((r.segment_nbr, r.segment_nbr_adj, r.airport_from, r.trip_nbr, r.cabin_class_id, r.fare_flexibility_id)
                  for r in out["segments"].where("record_key = 'INV1-10'").collect())
    # ledger order AAA-BBB, BBB-CCC, CCC-AAA; the itinerary begins with CCC-AAA
    assert [s[:3] for s in segs] == [(1, 2, "AAA"), (2, 3, "BBB"), (3, 1, "CCC")]
    assert [s[3] for s in segs] == [1, 2, 3] and {s[4:] for s in segs} == {(3, 2)}
    route = out["routes"].where("record_key = 'INV1-10'").first()
    assert (route.route_txt, route.airport_from) == ("CCC/AAA/BBB/CCC", "CCC")


def test_routes_are_members_before_facts(spark, whole):
    _, out = whole
    dim = {r.route_id: (r.airport_from, r.airport_to) for r in out["route_dim"].collect()}
    assert dim[70] == ("AAA", "BBB") and len(dim) == out["route_dim"].count()
    for name in ("segments", "flights", "tickets"):
        for r in out[name].where("airport_from is not null and airport_to is not null").collect():
            assert dim[r.route_id] == (r.airport_from, r.airport_to)


def test_killed_after_any_step(spark, whole, tmp_path):
    root, t, kills = str(tmp_path), raw_tables(spark), 0
    while True:
        job = Flaky(spark, root, "extract_air", 5)
        done = set(job.committed)

        def log(step, status, *args, job=job, **kwargs):
            Job.log(job, step, status, *args, **kwargs)
            if status == "committed":
                raise Killed                                     # right after the marker of the next step
        job.log = log
        try:
            run_extract_air(spark, t, 5, AS_OF, root, job)
            break
        except Killed:
            kills += 1
            assert len(Job(spark, root, "extract_air", 5).committed) == len(done) + 1
    assert kills >= 18 and everything(spark, root) == everything(spark, whole[0])


def test_two_batches_share_routes(spark, whole):
    root, first = whole
    before = {r.route_id: r.route_code for r in first["route_dim"].collect()}
    t = raw_tables(spark)
    t["travel_leg"] = t["travel_leg"].where("extract_id = 5").withColumn("extract_id", F.lit(6)).withColumn(
        "city_from", F.lit("EEE")).withColumn("document_no", F.lit("INV9")).withColumn("ticket_no", F.lit("T9"))
    for name in ("tagged_text", "savings"):
        t.pop(name)
    out = run_extract_air(spark, t, 6, AS_OF, root)
    after = {r.route_id: r.route_code for r in out["route_dim"].collect()}
    assert before.items() <= after.items() and len(set(after.values())) == len(after) > len(before)
    assert out["tickets"].count() == 1 and spark.read.parquet(f"{root}/air_fact").select("extract_id").distinct().count() == 2


def test_lineage_without_ledger_entries_is_the_line_itself(spark):
    t = raw_tables(spark)
    fact = EA.record_key(EA.invoice_booking_type(t["invoice_line"])).withColumn("doc_kind", F.lit("I"))
    got = EA.lineage_keys(fact, fact, t["service_ledger"].limit(0)).collect()
    assert got and all(r.record_key_original == r.record_key_prior == r.record_key for r in got)
