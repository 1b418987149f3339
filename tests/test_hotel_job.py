"""L2 from stage rows to written facts: gate, every step, kills after any step."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from itinera.jobs import Job
from itinera.plans import hotel_job as HJ
from itinera.plans import names as N
from itinera.plans.pipelines import run_file_hotel
from tests.fixtures import air_tables
from tests.test_jobs import Flaky, Killed

T = dt.datetime
STAGE = """file_id int, record_key string, booking_type_id short, record_status_id short, travel_product_id int, comcode string,
cost_center_id int, traveler_category_id int, invoice_date timestamp_ntz, issue_date timestamp_ntz, currency string, nights_cnt int,
booking_source_code string, rate_type_id int, itinerary_txt string, eu_hotel_id int, hotel_brand_id int, hotel_country_code string,
meta_dossier_id string, sales_document_code string, traveler_id int, approver_id int, agent_assisted int, logon_type_id int,
logon_id int, card_owner_id int, card_nbr string, cost_center_txt string, hotel_name string, first_name string, last_name string,
approver_last_name string, booking_amt_base decimal(19,4), booking_amt_tax decimal(19,4), booking_amt_vat decimal(19,4)"""
FIELDS = [c.split()[0] for c in STAGE.replace("\n", " ").split(", ")]
BASE = dict(file_id=3, booking_type_id=1, record_status_id=1, travel_product_id=10, comcode=" acme ", cost_center_id=100,
            traveler_category_id=4, invoice_date=T(2024, 1, 2), issue_date=T(2024, 1, 2, 9), currency="USD", nights_cnt=2,
            booking_source_code="M", rate_type_id=6, itinerary_txt="1123456789 ", eu_hotel_id=7, hotel_country_code="FR",
            meta_dossier_id="123", traveler_id=55, agent_assisted=0, logon_type_id=2, logon_id=8, card_owner_id=1,
            card_nbr="4111111111111234", hotel_name="x" * 300, first_name=" Jo ", last_name="Doe", booking_amt_base=D("100"),
            booking_amt_tax=D("10"), booking_amt_vat=D("5"))


def hotel_tables(spark):
    t = air_tables(spark)
    rows = [
        dict(BASE, record_key="H-1"),
        # a cancellation without rate, booked through a source without references, documented
        dict(BASE, record_key="H-20", booking_type_id=2, booking_source_code="B", currency="CHF", hotel_country_code="ZZ",
             sales_document_code="INV7", agent_assisted=1, rate_type_id=3, comcode="NOBODY", approver_id=77, approver_last_name=" Boss "),
        # a refund with its own brand, of an unknown source code; its document has no line
        dict(BASE, record_key="H3", booking_type_id=7, booking_source_code="?", hotel_brand_id=5, sales_document_code="INV9",
             invoice_date=None, approver_id=78, hotel_country_code=None),
        dict(BASE, record_key="H-4", booking_source_code="W", hotel_brand_id=5, rate_type_id=2, itinerary_txt="1x2", traveler_id=None),
        dict(BASE, record_key="H-5", booking_type_id=99), dict(BASE, record_key="H-6", record_status_id=2),
        dict(BASE, record_key="H-1", file_id=4), dict(BASE, record_key="H-9", file_id=8)]
    t["hotel_stage"] = spark.createDataFrame([tuple(r.get(c) for c in FIELDS) for r in rows], STAGE)
    for c in ("booking_amt_gross", "booking_amt_extra_person", "booking_amt_fee", "booking_amt_change_penalty"):
        t["hotel_stage"] = t["hotel_stage"].withColumn(c, F.lit(1).cast("decimal(19,4)"))
    for c in ("title", "middle_name", "approver_title", "approver_first_name", "approver_middle_name"):
        t["hotel_stage"] = t["hotel_stage"].withColumn(c, F.lit(None).cast("string"))
    for k, (ccy, base) in {"epr": ("USD", 200), "esr": (None, 5), "published": ("USD", 0), "negotiated": ("CHF", 9)}.items():
        t["hotel_stage"] = t["hotel_stage"].withColumns({
            f"currency_{k}": F.lit(ccy).cast("string"), f"base_{k}": F.lit(base).cast("decimal(19,4)"),
            f"tax_{k}": F.lit(None).cast("decimal(19,4)"), f"description_{k}": F.lit(k)})
    t["booking_type"] = spark.createDataFrame([(0,), (1,), (2,), (3,), (7,)], "booking_type_id short")
    t["external_file"] = spark.createDataFrame([(3, 9, 2), (4, 10, 2), (8, 9, 1)], "file_id int, file_type_id int, file_status_id int")
    t["booking_source"] = spark.createDataFrame([(9, "M", 32), (9, "W", 33), (9, "B", 37), (10, "M", 99)],
                                                "file_type_id int, source_code string, booking_source_id int")
    t["fx_rate"] = spark.createDataFrame([(20240102, "EUR", "EUR", D("1")), (20240102, "USD", "EUR", D("0.9"))],
                                         "time_id int, from_currency string, to_currency string, rate decimal(19,8)")
    t["geography_country"] = spark.createDataFrame(
        [(10, 2, "FR", None, 2), (10, 2, "", None, 5), (10, 1, "FR", None, 7), (10, 2, "FR", "GB", 3)],
        "travel_product_id int, line_of_business_id short, country_code string, country_code_destination string, geography_type_id short")
    t["hotel_sku_brand"] = spark.createDataFrame(
        [(7, 100, 1, T(2024, 1, 1), 5), (7, 101, 1, T(2024, 2, 1), 5), (7, 102, 2, T(2024, 3, 1), 5), (7, 103, 1, T(2024, 4, 1), 6)],
        "sku_item_id int, brand_id int, brand_use_rank int, update_date timestamp_ntz, extract_id_max int")
    t["extract"] = spark.createDataFrame([("hotel_catalog", 5, True), ("hotel_catalog", 6, False), ("other", 9, True)],
                                         "source string, extract_id int, complete boolean")
    day = dt.date
    t["hotel_brand_chain"] = spark.createDataFrame(
        [(101, 9, day(2024, 1, 1), day(2024, 1, 2)), (101, 8, day(2024, 1, 3), day(2024, 12, 31)), (5, 4, day(2023, 1, 1), day(2023, 12, 31))],
        "brand_id int, chain_id int, effective_begin date, effective_end date")
    t["consultant_event"] = spark.createDataFrame([("123", T(2024, 1, 1), 11, 1)],
                                                  "dossier_id string, event_date timestamp_ntz, consultant_id int, action_id int")
    t["event_action"] = spark.createDataFrame([(1, "HCBOOK")], "id int, label_code string")
    t["dossier_field"] = spark.createDataFrame([], "metaid string, product_id int, extract_id int, fld_key string, fld_value string")
    t["consultant_login"] = spark.createDataFrame([], "consultant_id int, last_name string, first_name string")
    line = "extract_id int, product_id int, document_no string, line_no int, traveller_code string, traveller_alias string"
    t["invoice_line"] = spark.createDataFrame([(5, 10, "INV7", 20, "55", "OLD/NAME"), (6, 10, "INV7", 20, "55", "ROE/ANN"),
                                               (6, 10, "INV7", 21, "55", "X/Y")], line)
    t["credit_line"] = spark.createDataFrame([(7, 10, "INV7", 20, "55", "CREDIT/NAME")], line)
    t["travellers"] = spark.createDataFrame([], "extract_id int, product_id int, no string, is_occasional int, title string, "
                                                "first_name string, name string")
    t["traveler_name"] = spark.createDataFrame([(40, 55, 2, "", "Jo", "", "Doe")], t["traveler_name"].schema)
    t["traveler_anonymous"] = spark.createDataFrame([("Nobody", 10, None, "Anon", None, None)],
                                                    "comcode string, travel_product_id int, title string, first_name string, "
                                                    "middle_name string, last_name string")
    t["hotel_log"] = spark.createDataFrame([(1, 1, 12345678, 10, "USD"), (2, 5, 12345678, 10, "USD")],
                                           "extract_id int, log_id long, trl int, travel_product_id int, currency string")
    t["hotel_log_comparison"] = spark.createDataFrame(
        [(1, 1, 1, 1, D("100"), D("10"), "old"), (2, 5, 1, 1, D("90"), None, "new"), (2, 5, 2, 2, D("1"), D("1"), "x")],
        "extract_id int, log_id long, comparison_type_id int, rate_type_id int, base decimal(19,4), tax decimal(19,4), room_desc string")
    t["custom_field_long"] = spark.createDataFrame([(3, "H-1", 1, 3, "B", "v2"), (3, "H-1", 1, 3, "A", "v9"), (4, "H-1", 1, 3, "A", "z")],
                                                   t["custom_field_long"].schema)
    return t


TABLES = ("hotel_fact", "hotel_comparison", "hotel_fact_key", "hotel_custom_field", "traveler_name")


def everything(spark, root):
    out = {}
    for name in TABLES:
        df = spark.read.parquet(f"{root}/{name}").drop("update_date", "loaded_by")
        out[name] = sorted((tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect()))
    return out


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Many small plans: compiling each takes longer than running it."""
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
    root = str(tmp_path_factory.mktemp("hotel"))
    return root, run_file_hotel(spark, hotel_tables(spark), 3, root)


def test_attributes(whole):
    f = {r.record_key: r for r in whole[1]["fact"].collect()}
    assert set(f) == {"H-1", "H-20", "H3", "H-4"}
    pick = lambda *cols: {k: tuple(r[c] for c in cols) for k, r in f.items()}
    assert pick("nights_cnt", "increment_cnt", "booking_source_id", "rate_supply_id") == {
        "H-1": (2, 1, 32, 9), "H-20": (-2, -1, 37, None), "H3": (-2, -1, None, None), "H-4": (2, 1, 33, 12)}
    # the itinerary '1123456789' loses its first and last two characters; billback has no reference
    assert pick("booking_ref") == {"H-1": (1234567,), "H-20": (None,), "H3": (1234567,), "H-4": (None,)}
    # brand 0 of H-1 comes from the newest complete catalogue (chain by issue date); others keep theirs
    assert pick("hotel_id", "hotel_brand_id", "hotel_chain_id") == {
        "H-1": (7, 101, 9), "H-20": (None, -10000, -10000), "H3": (None, -10000, -10000), "H-4": (7, 5, -10000)}
    assert pick("geography_type_id") == {"H-1": (2,), "H-20": (5,), "H3": (5,), "H-4": (2,)}
    assert pick("group_account_id", "department_id", "policy_id", "fact_source_id") == {
        "H-1": (500, 900, 4, 15), "H-20": (0, 0, 4, 15), "H3": (500, 900, 4, 15), "H-4": (500, 900, 4, 15)}
    assert pick("consultant_id") == {"H-1": (-8,), "H-20": (-11,), "H3": (-8,), "H-4": (-8,)}
    assert {k: (float(r.booking_amt_base), float(r.booking_amt_tax)) for k, r in f.items()} == {
        "H-1": (90.0, 13.5), "H-20": (0.0, 0.0), "H3": (90.0, 13.5), "H-4": (90.0, 13.5)}
    assert {(len(r.hotel_name), r.card_first6, r.card_last4, r.central_bill, r.hotel_country_code) for r in f.values()} == {
        (255, "411111", "1234", 1, "FR "), (255, "411111", "1234", 1, "ZZ "), (255, "411111", "1234", 1, None)}
    assert "card_nbr" not in whole[1]["fact"].columns


def test_names_are_stored_members(whole):
    f = {r.record_key: r for r in whole[1]["fact"].collect()}
    dim = {r.name_id: (r.traveler_id, r.title, r.first_name, r.middle_name, r.last_name) for r in whole[1]["names"].collect()}
    who = {k: (dim.get(r.traveler_name_id), dim.get(r.approver_name_id)) for k, r in f.items()}
    assert who == {
        "H-1": ((55, "", "Jo", "", "Doe"), None),                                # the stored member
        "H-20": ((55, "", "ANN", "", "ROE"), (77, "", "Anon", "", "Boss")),      # the newest invoice line; part by part
        "H3": (None, (78, "", "", "", "")),                                      # no line of that document
        "H-4": (None, None)}
    assert f["H-1"].traveler_name_id == 40 and len(dim) == 4


def test_comparisons_and_custom_fields(whole):
    cmp = sorted((r.record_key, r.rate_comparison_type_id, float(r.total_base_amt), r.description)
                 for r in whole[1]["comparisons"].collect())
    # '1123456789 ' holds the log's reference 12345678: the newest same-hotel row; no backfill then
    # (stage rows of status 1 count, as in the source, also H-5 whose booking type is unknown)
    assert cmp == [("H-1", 1, 81.0, "new"), ("H-20", 1, 81.0, "new"), ("H-4", 1, 180.0, "epr"), ("H-5", 1, 81.0, "new"),
                   ("H3", 1, 81.0, "new")]
    cf = sorted((r.record_key, r.field_id, r.field_value) for r in whole[1]["custom_fields"].collect())
    assert cf == [("H-1", 0, "Sales"), ("H-1", 3, "v9"), ("H-4", 0, "Sales"), ("H3", 0, "Sales")]
    assert {r.fact_type_id for r in whole[1]["keys"].collect()} == {19}


def test_killed_after_any_step(spark, whole, tmp_path):
    root, t, kills = str(tmp_path), hotel_tables(spark), 0
    while True:
        job = Flaky(spark, root, "file_hotel_15", 3)

        def log(step, status, *args, job=job, **kwargs):
            Job.log(job, step, status, *args, **kwargs)
            if status == "committed":
                raise Killed
        job.log = log
        try:
            run_file_hotel(spark, t, 3, root, job)
            break
        except Killed:
            kills += 1
    assert kills >= 13 and everything(spark, root) == everything(spark, whole[0])


def test_other_file_type_and_file_that_is_not_ready(spark, tmp_path):
    t = hotel_tables(spark)
    assert run_file_hotel(spark, t, 8, str(tmp_path)) == {}
    out = run_file_hotel(spark, t, 4, str(tmp_path))
    assert [(r.booking_source_id, r.hotel_brand_id, r.hotel_id, r.fact_source_id) for r in out["fact"].collect()] == [(13, -10000, None, 16)]
    # no booking log for this file type: rates of the stage
    assert [(r.rate_comparison_type_id, float(r.total_base_amt)) for r in out["comparisons"].collect()] == [(1, 180.0)]


def test_booking_reference_and_rate_supply(spark):
    rows = [("1-12 99", 32, 2), ("12", 32, 6), ("", 33, 2), (None, 33, 1), ("x99999999999yz", 28, None), ("x2147483647yz", 36, 1),
            ("112 3499", 30, 1), ("11 234599", 37, 4), ("100078999", 12, 6), ("1 42 99", None, 6)]
    df = spark.createDataFrame(rows, "itin string, source int, rate int")
    got = [tuple(r) for r in df.select(HJ.booking_reference("itin", "source"), HJ.rate_supply("source", "rate")).collect()]
    assert got == [(-12, 7), (None, 9), (None, 12), (None, 1), (None, 7), (2147483647, 6), (None, 13), (None, 7), (789, None), (42, None)]


def test_approver_of_a_file(spark):
    tickets = spark.createDataFrame([(1, "a", "ACME", 5), (1, "b", "acme ", None), (1, "c", None, 5), (2, "a", "ACME", 5)],
                                    "file_id int, record_key string, comcode string, approver_id int")
    cols = "file_id int, record_key string, approver_title string, approver_first_name string, approver_middle_name string, approver_last_name string"
    stage = spark.createDataFrame([(1, "a", "Dr", " A ", None, "B"), (1, "a", "Ms", "A", None, "B"), (1, "b", "x", "x", "x", "x"),
                                   (1, "c", None, "C", None, None)], cols)
    got = sorted((r.file_id, r.record_key, r.approver_title, r.approver_first_name, r.approver_middle_name, r.approver_last_name)
                 for r in N.file_approver_names(tickets, stage).collect())
    assert got == [(1, "a", "Dr", "A", "", "B"), (1, "b", None, None, None, None), (1, "c", "", "C", "", ""), (2, "a", "", "", "", "")]
    assert N.file_approver_names(tickets, stage.limit(0)).where("approver_last_name = ''").count() == 3
