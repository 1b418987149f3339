"""L2: one external hotel file, from its stage rows to written facts, as a restartable job.

Input tables follow FIXTURES.md; besides the shared dimensions these are ``external_file``
(file_id, file_type_id, file_status_id), ``booking_source`` (file_type_id, source_code,
booking_source_id), ``hotel_stage``, and, where given, the hotel catalogue, the consultant's
sources, the sources of names and custom fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from itinera import functions as X
from itinera import operators as O
from itinera.jobs import Job
from itinera.plans import file_loads as FL
from itinera.plans import hotel_train as HT
from itinera.plans import names as N
from itinera.session import work_path
from itinera.sources import register_keys
from itinera.sources.targets import HOTEL_COMPARISON, HOTEL_FACT

# fixed values: file types, their fact sources, the status of a file that may be loaded
IAN_FILE, AMADEUS_FILE = 9, 10
IAN_FACTS, AMADEUS_FACTS = 15, 16
READY = 2
HOTEL = 2                    # line of business
KEY_TYPE = 19
AMADEUS_SOURCE = 13          # booking source of every Amadeus row
BT_CANCEL = 2
NO_BRAND = -10000
NO_REFERENCE_SOURCES = (30, 31, 37)
# fixed values: rate supply by booking source and rate type (None: every other rate type)
RATE_SUPPLY = {
    (28, 6): 9, (28, None): 7,
    (29, 2): 12, (29, None): 1,
    (30, None): 13,
    (31, None): 14,
    (32, 6): 9, (32, None): 7,
    (33, 2): 12, (33, None): 1,
    (35, None): 3,
    (36, None): 6,
    (37, 1): 1, (37, 2): 12, (37, 4): 7,
}
AMOUNTS = ("booking_amt_gross", "booking_amt_base", "booking_amt_tax", "booking_amt_vat", "booking_amt_extra_person",
           "booking_amt_fee", "booking_amt_change_penalty")
NEWEST = 2 ** 31 - 1         # extract bound of names: file rows take the newest


# ---- expand ------------------------------------------------------------------------------

def direction(booking_type) -> Column:
    """1 for a purchase or reservation, -1 for a cancellation or refund, else null."""
    bt = F.col(booking_type)
    return F.when(bt.isin(X.BT_PURCHASE, X.BT_RESERVE), 1).when(bt.isin(BT_CANCEL, X.BT_REFUND), -1)


def booking_reference(itinerary, source) -> Column:
    """The itinerary without its first and its last two characters, where that is a whole
    number of 32 bits; sources without references have none (Q10 fixed: the new source)."""
    t = F.rtrim(F.col(itinerary))
    inner = F.substring(t, F.lit(2), F.greatest(F.length(t) - 3, F.lit(0)))
    number = F.when(inner.rlike(r"^ *[+-]?[0-9]+ *$"), F.trim(inner).try_cast("decimal(38,0)")).try_cast("int")
    return F.when(~F.coalesce(F.col(source).isin(*NO_REFERENCE_SOURCES), F.lit(False)), number)


def rate_supply(source, rate_type) -> Column:
    """By source and rate type, else the source's own, else null."""
    exact = {f"{s}|{r}": v for (s, r), v in RATE_SUPPLY.items() if r is not None}
    other = {s: v for (s, r), v in RATE_SUPPLY.items() if r is None}
    return F.coalesce(X.map_code(F.concat_ws("|", F.col(source), F.col(rate_type)), exact), X.map_code(F.col(source).cast("int"), other))


def expand(fact: DataFrame, stage: DataFrame, file_type: int, travel_product: DataFrame, fx_rates: DataFrame,
           sources: DataFrame) -> DataFrame:
    """Ticket attributes from the stage row of the same record key (one row a key: the
    smallest booking type), signed nights and counts, booking source by file type and source
    code, amounts in the product's currency (tax with VAT; no rate: 0), the card's ends."""
    st = O.first_per_key(stage.withColumnRenamed("booking_type_id", "_bt"), ["file_id", "record_key"], ["_bt"]).drop("_bt")
    j = fact.select(*FL.KEY).join(st, ["file_id", "record_key"], "inner")
    j = j.join(travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code")),
               "travel_product_id", "inner")
    if file_type == IAN_FILE:
        own = sources.where(F.col("file_type_id") == file_type).groupBy("source_code").agg(
            F.min("booking_source_id").alias("booking_source_id"))
        j = j.drop("booking_source_id").join(own.withColumnRenamed("source_code", "booking_source_code"), "booking_source_code", "left")
    else:
        j = j.withColumn("booking_source_id", F.lit(AMADEUS_SOURCE if file_type == AMADEUS_FILE else None).cast("int"))
    has_brand = F.coalesce(F.col("booking_source_id").isin(*HT.BRAND_ZERO_SOURCES), F.lit(False))
    sign = direction("booking_type_id")
    blank = lambda c: F.coalesce(X.clean(c), F.lit(""))
    first6, last4 = X.mask_card("card_nbr")
    j = j.withColumns({
        "comcode": X.clean("comcode", upper=True),
        "nights_cnt": sign * F.abs("nights_cnt"), "increment_cnt": sign, "transaction_cnt": F.lit(1),
        "consultant_id": F.when(F.col("logon_type_id") == 1, F.col("logon_id")).when(F.col("logon_type_id") == 2, -F.col("logon_id")),
        "central_bill": F.when(F.col("card_owner_id") == 1, 1).when(F.col("card_owner_id") == 2, 0),
        "custom_data_txt": blank("cost_center_txt"),
        "hotel_brand_id": F.when(has_brand, F.coalesce("hotel_brand_id", F.lit(0))).otherwise(NO_BRAND),
        "hotel_id": F.when(has_brand, F.col("eu_hotel_id")),
        "booking_ref": booking_reference("itinerary_txt", "booking_source_id"),
        "rate_supply_id": rate_supply("booking_source_id", "rate_type_id"),
        "booking_amt_tax": F.col("booking_amt_tax") + F.col("booking_amt_vat"),
        "card_first6": first6, "card_last4": last4,
        "_rate_day": F.coalesce("invoice_date", "issue_date"),
        **{c: X.clean(c) for c in ("meta_dossier_id", "sales_document_code", "hotel_country_code")},
    })
    return O.fx_convert(j, fx_rates, "_rate_day", "currency", "currency_code", AMOUNTS).drop("_rate_day", "card_nbr")


def accounts(fact: DataFrame, accounts_dim: DataFrame, departments: DataFrame) -> DataFrame:
    """D16-D18 of a hotel file: account by company code alone, department by account and cost
    centre, 0 where there is none; the policy group is the traveller's category."""
    a = (accounts_dim.select(X.clean("comcode", upper=True).alias("comcode"), "group_account_id")
         .groupBy("comcode").agg(F.min("group_account_id").alias("group_account_id")))
    j = fact.join(a, "comcode", "left").withColumn("group_account_id", F.coalesce("group_account_id", F.lit(0)))
    return FL.add_department(j, departments).withColumn("policy_id", F.col("traveler_category_id"))


def brands(fact: DataFrame, sku_brand: DataFrame, extracts: DataFrame, brand_chain: DataFrame,
           catalogue: str = "hotel_catalog") -> DataFrame:
    """A brand that the file lacks (0, -10000) comes from the newest complete catalogue
    extract (first-rank brand, newest update), else stays; the chain is that of the brand on the
    issue date (the smallest of several), else -10000."""
    newest = extracts.where((F.col("source") == catalogue) & F.col("complete")).agg(F.max("extract_id").alias("extract_id_max"))
    cat = sku_brand.where(F.col("brand_use_rank") == 1).join(newest, "extract_id_max", "left_semi")
    best = O.first_per_key(cat.select("sku_item_id", "update_date", "brand_id"), ["sku_item_id"], ["-update_date", "brand_id"])
    j = fact.join(best.select(F.col("sku_item_id").alias("hotel_id"), F.col("brand_id").alias("_b")), "hotel_id", "left")
    lacks = F.coalesce(F.col("hotel_brand_id").isin(0, NO_BRAND), F.lit(True))
    j = j.withColumn("hotel_brand_id", F.when(lacks, F.coalesce("_b", "hotel_brand_id")).otherwise(F.col("hotel_brand_id"))).drop("_b")
    days = j.select("hotel_brand_id", F.to_date("issue_date").alias("_day")).distinct()
    bc = brand_chain.select(F.col("brand_id").alias("_bb"), "chain_id", "effective_begin", "effective_end")
    chain = (O.dated_join(days, bc, [("hotel_brand_id", "_bb")], "_day", "effective_begin", "effective_end", how="inner")
             .groupBy("hotel_brand_id", "_day").agg(F.min("chain_id").alias("_chain")))
    j = j.withColumn("_day", F.to_date("issue_date")).join(chain, ["hotel_brand_id", "_day"], "left")
    return j.withColumn("hotel_chain_id", F.coalesce("_chain", F.lit(NO_BRAND))).drop("_day", "_chain")


def geography(fact: DataFrame, geo_country: DataFrame) -> DataFrame:
    """By (product, country), else the product's row without a country; both are columns
    of one small frame (one row a product with a map of its countries), joined once."""
    g = (geo_country.where((F.col("line_of_business_id") == HOTEL) & F.col("country_code_destination").isNull())
         .groupBy("travel_product_id", F.coalesce(X.clean("country_code"), F.lit("")).alias("_c")).agg(F.min("geography_type_id").alias("_g"))
         .groupBy("travel_product_id").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_g"))).alias("_by_country")))
    j = fact.drop("geography_type_id").join(g, "travel_product_id", "left")
    own = F.coalesce(F.col("_by_country")[F.col("hotel_country_code")], F.col("_by_country")[F.lit("")])
    return j.withColumn("geography_type_id", own).drop("_by_country")


# ---- names -------------------------------------------------------------------------------

def document_lines(tickets: DataFrame, invoice: DataFrame, credit: DataFrame) -> DataFrame:
    """The sales line of each ticket (document code; line number behind the record key's
    last dash): an invoice line before a credit line, then the newest extract's.  Tickets
    without one have nulls."""
    cols = ["extract_id", "product_id", "document_no", "line_no", "traveller_code", "traveller_alias"]
    lines = (invoice.select(*cols, F.lit(0).alias("_kind")).unionByName(credit.select(*cols, F.lit(1).alias("_kind")))
             .withColumn("_older", -F.col("extract_id").cast("long")))
    first = O.first_per_key(lines, ["document_no", "line_no"], ["_kind", "_older", "product_id", "traveller_code", "traveller_alias"])
    number = F.when(F.instr("record_key", "-") > 0, X.int32_or_null(X.clean(X.last_token("record_key", "-"))))
    wanted = tickets.withColumns({"document_no": F.col("sales_document_code"), "line_no": number})
    return wanted.join(first.select(*cols), ["document_no", "line_no"], "left")


def traveller_names(tickets: DataFrame, stage: DataFrame, invoice: DataFrame | None = None, credit: DataFrame | None = None,
                    travellers: DataFrame | None = None, fields: DataFrame | None = None) -> DataFrame:
    """D72 of a hotel file: with a sales document the name comes from its line's sources, else
    from the stage (missing parts are blank); nobody where there is no traveller, where the
    traveller of a documented ticket is 0, or where no line is found."""
    st = O.first_per_key(stage.select("file_id", "record_key", F.struct(
        *[F.coalesce(X.clean(c), F.lit("")).alias(c) for c in N.NAME_COLS]).alias("_stage")), ["file_id", "record_key"], ["_stage"])
    plain = tickets.drop(*N.NAME_COLS)
    out = plain.join(st, ["file_id", "record_key"], "left")
    from_stage = F.col("sales_document_code").isNull() & F.col("traveler_id").isNotNull()
    if invoice is None:
        return out.select(*plain.columns, *[F.when(from_stage, F.col(f"_stage.{c}")).alias(c) for c in N.NAME_COLS])
    lined = document_lines(plain.where(F.col("sales_document_code").isNotNull() & (F.col("traveler_id") != 0))
                           .select(*FL.KEY, "sales_document_code", "meta_dossier_id"), invoice, credit)
    lined = lined.where(F.col("extract_id").isNotNull()).withColumn("traveler_code", F.col("traveller_code"))
    lines = invoice.select(*N.LINE, "traveller_alias").unionByName(credit.select(*N.LINE, "traveller_alias"))
    who = N.traveller_names(lined.drop("traveller_alias"), NEWEST, travellers, lines, fields)
    who = who.select(*FL.KEY, F.struct(*N.NAME_COLS).alias("_line"))
    out = out.join(who, FL.KEY, "left")
    return out.select(*plain.columns, *[F.when(from_stage, F.col(f"_stage.{c}")).otherwise(F.col(f"_line.{c}")).alias(c)
                                        for c in N.NAME_COLS])


# ---- the job -----------------------------------------------------------------------------

def run_file_hotel(spark: SparkSession, t: dict[str, DataFrame], file_id: int, out_root: str | None = None,
                   job: Job | None = None) -> dict[str, DataFrame]:
    """L2: gate -> seed -> expand (accounts, brand, chain, geography, consultant) -> comparisons
    -> names -> keys -> custom fields, for one file.  A file that is not ready (status 2) is left
    alone: nothing is written, the result is empty.  Names are stored members before tickets
    refer to them.  Catalogue, consultant, names and custom fields need their tables."""
    files = t["external_file"].where((F.col("file_id") == F.lit(file_id)) & (F.col("file_status_id") == READY))
    file = files.select("file_type_id").first()                    # one row
    if file is None:
        return {}
    file_type = file.file_type_id
    source = IAN_FACTS if file_type == IAN_FILE else AMADEUS_FACTS
    job = job or Job(spark, out_root or work_path(spark, "facts"), f"file_hotel_{source}", file_id)
    stage = t["hotel_stage"].where(F.col("file_id") == F.lit(file_id))

    def expanded():
        f = FL.seed_file_fact(stage, t["booking_type"], file_id)
        f = accounts(expand(f, stage, file_type, t["travel_product"], t["fx_rate"], t["booking_source"]),
                     t["group_account"], t["department"])
        if "hotel_sku_brand" in t:
            f = brands(f, t["hotel_sku_brand"], t["extract"], t["hotel_brand_chain"])
        return geography(f, t["geography_country"]).withColumn("fact_source_id", F.lit(source))
    fact = job.step("expand", expanded)

    if "consultant_event" in t:
        def consultants():
            f = fact.withColumn("product_id", F.col("travel_product_id"))
            return HT.consultant_by_levels(f, t["consultant_event"], t["event_action"], t["dossier_field"],
                                           t["consultant_login"]).drop("product_id")
        fact = job.step("consultants", consultants)

    def comparisons():
        live = stage.withColumn("booking_type_id", F.coalesce("booking_type_id", F.lit(0)).cast("short"))
        back = lambda found: HT.backfill_comparisons(live, found, t["travel_product"], t["fx_rate"])
        if file_type != IAN_FILE:                                  # only these files have a booking log
            return back(live.select(*FL.KEY).limit(0))
        logged = job.step("logged comparisons", lambda: HT.hotel_comparisons(
            live, t["hotel_log"], t["hotel_log_comparison"], t["travel_product"], t["fx_rate"]))
        return logged.unionByName(back(logged))
    job.step("comparisons", comparisons)

    tickets, names = fact, None
    if "traveler_name" in t:
        def named():
            lines = (t.get("invoice_line"), t.get("credit_line"))
            own = fact.withColumn("product_id", F.col("travel_product_id"))
            f = traveller_names(own, stage, *(lines if None not in lines else (None, None)), t.get("travellers"), t.get("dossier_field"))
            return N.file_approver_names(f.drop("product_id"), stage, t.get("traveler_anonymous"))
        people = job.step("names", named)
        names = job.members("traveler_name", lambda: N.name_members(people, t["traveler_name"]), FL.NAME_KEY, "name_id",
                            t["traveler_name"])
        tickets = job.step("tickets", lambda: N.add_name_ids(people, names))
    else:
        job.step("tickets", lambda: fact)
    job.step("keys", lambda: register_keys(fact, FL.KEY, KEY_TYPE))
    out = {"fact": job.publish("hotel_fact", "tickets", "file_id", target=HOTEL_FACT),
           "comparisons": job.publish("hotel_comparison", "comparisons", "file_id", target=HOTEL_COMPARISON),
           "keys": job.publish("hotel_fact_key", "keys", "file_id")}
    if names is not None:
        out["names"] = names
    custom = FL.custom_values(t, stage)
    if custom is not None:
        job.step("custom fields", lambda: FL.custom_fields(fact, custom, t["department"]))
        out["custom_fields"] = job.publish("hotel_custom_field", "custom fields", "file_id")
    job.finish()
    return out
