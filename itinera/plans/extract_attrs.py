"""Extract-air attribute steps (D22, D23, D25, D28, D29).  Each per-row
``TOP 1 ... ORDER BY extract desc`` lookup of the key-value table is one
latest-row aggregate per (dossier, product, key), joined once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O

KEY_SL = ["extract_id", "product_id", "document_no", "line_no"]


def _latest_field(fields: DataFrame, fld_key: str, extra=None) -> DataFrame:
    f = fields.where(F.col("fld_key") == fld_key)
    if extra is not None:
        f = f.where(extra)
    f = f.select(F.col("metaid").alias("meta_dossier_id"), "product_id", "extract_id", "fld_value")
    return O.latest_lookup(f, ["meta_dossier_id", "product_id"], ["extract_id", "fld_value"]).drop("extract_id")


def booking_channel(fact: DataFrame, sales_lines: DataFrame, fields: DataFrame) -> DataFrame:
    """Credits and exchanges are agent-assisted and offline;
    reservation mode 2 is online.  Offline type: null when online, 1 when the
    dossier has a TRAVEL_CONSULTANT field, 0 when it has any field, else 2
    (existence flags from one aggregate, no per-row EXISTS)."""
    flags = (fields.groupBy(F.col("metaid").alias("meta_dossier_id"), "product_id")
             .agg(F.bool_or(F.col("fld_key") == "TRAVEL_CONSULTANT").alias("_has_tc")))
    j = (fact.join(sales_lines.select(*KEY_SL, "exchange_ticket", "reservation_mode"), KEY_SL, "inner")
         .join(flags, ["meta_dossier_id", "product_id"], "left"))
    credit, exch, online = (F.col("sales_document_type_id") == 2), (F.col("exchange_ticket") == 1), \
        (F.col("reservation_mode") == 2)
    return (j.withColumn("online", F.when(credit | exch, 0).when(online, 1).otherwise(0))
            .withColumn("agent_assisted", F.when(credit | exch, 1).when(online, 0).otherwise(1))
            .withColumn("offline_booking_type_id", F.when(online, F.lit(None))
                        .when(F.col("_has_tc"), 1).when(F.col("_has_tc").isNotNull(), 0).otherwise(2))
            .drop("_has_tc", "exchange_ticket", "reservation_mode"))


def arranger_logon(fact: DataFrame, fields: DataFrame, travellers: DataFrame,
                   traveler_accounts: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """arranger = newest numeric BOOKER_PERCODE of the dossier; logon =
    arranger only when it is a known traveller of the product or a traveller
    account of the customer system."""
    arr = _latest_field(fields, "BOOKER_PERCODE", X.is_int32_text(X.clean("fld_value")))
    j = fact.join(arr.withColumn("arranger_id", X.clean("fld_value").cast("int")).drop("fld_value"),
                  ["meta_dossier_id", "product_id"], "left")
    known_t = travellers.select(F.col("no").alias("_no"), F.col("product_id").alias("_tp")).distinct()
    known_a = traveler_accounts.where(F.col("customer_system_id") == customer_system_id).select(
        F.col("tuid").alias("_tuid")).distinct()
    j = (j.join(known_t.withColumn("_k1", F.lit(True)),
                (F.col("arranger_id").cast("string") == F.col("_no")) & (F.col("product_id") == F.col("_tp")), "left")
         .join(known_a.withColumn("_k2", F.lit(True)), F.col("arranger_id") == F.col("_tuid"), "left"))
    known = F.coalesce(F.col("_k1"), F.lit(False)) | F.coalesce(F.col("_k2"), F.lit(False))
    return j.withColumn("logon_id", F.when(known, F.col("arranger_id"))).drop("_no", "_tp", "_k1", "_tuid", "_k2")


def booking_dates(fact: DataFrame, headers: DataFrame, fields: DataFrame,
                  date_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Booking date = issue date for cancels (2), none for exchanges (5)
    and cancel-refunds (10), else the newest valid non-system BOOK_DATE of
    the dossier, else the posting date; invoice date = posting date + 12 h."""
    valid = F.try_to_timestamp(X.clean("fld_value"), F.lit(date_format)).isNotNull()
    bd = _latest_field(fields.where(F.col("system") != "Y"), "BOOK_DATE", valid).withColumn(
        "_book", F.try_to_timestamp(X.clean("fld_value"), F.lit(date_format)).cast("timestamp_ntz")).drop("fld_value")
    h = headers.select("extract_id", "product_id", F.col("no").alias("document_no"), "posting_date")
    j = fact.join(h, ["extract_id", "product_id", "document_no"], "inner").join(
        bd, ["meta_dossier_id", "product_id"], "left")
    bt = F.col("booking_type_id")
    return (j.withColumn("booking_date", F.when(bt == 2, F.col("issue_date")).when(bt.isin(5, 10), F.lit(None))
                         .otherwise(F.coalesce("_book", "posting_date")))
            .withColumn("invoice_date", F.col("posting_date") + F.expr("INTERVAL 12 HOURS"))
            .drop("_book", "posting_date"))


def service_level(fact: DataFrame, invoice_lines: DataFrame, credit_lines: DataFrame,
                  travellers: DataFrame) -> DataFrame:
    """VIP travellers get service level 2 (else null), from the invoice
    line of the row, then from its credit line (the credit wins)."""
    vip = travellers.select(F.col("no").alias("traveller_code"), "product_id", "is_vip")

    def level(lines):
        return (lines.select(*KEY_SL, "traveller_code").join(vip, ["traveller_code", "product_id"], "inner")
                .select(*KEY_SL, F.when(F.col("is_vip") == 1, 2).alias("_lvl")))
    inv, cr = level(invoice_lines), level(credit_lines).withColumnRenamed("_lvl", "_lvl_cr")
    j = (fact.join(inv.withColumn("_hit_i", F.lit(True)), KEY_SL, "left")
         .join(cr.withColumn("_hit_c", F.lit(True)), KEY_SL, "left"))
    lvl = F.when(F.col("_hit_c"), F.col("_lvl_cr")).when(F.col("_hit_i"), F.col("_lvl"))
    if "service_level_id" in fact.columns:
        lvl = F.when(F.col("_hit_c") | F.col("_hit_i"), lvl).otherwise(F.col("service_level_id"))
    return j.withColumn("service_level_id", lvl).drop("_lvl", "_lvl_cr", "_hit_i", "_hit_c")


def storage_currency(fact: DataFrame, travel_product: DataFrame) -> DataFrame:
    """The product's storage currency."""
    t = travel_product.select("product_id", F.col("currency_code_storage").alias("currency_code"))
    return fact.drop("currency_code").join(t, "product_id", "inner") if "currency_code" in fact.columns \
        else fact.join(t, "product_id", "inner")


# fixed values: ERP card type -> card type id (unmatched -> 254 other)
CARD_TYPE_MAP = {0: 0, 1: 1, 2: 11, 3: 2, 4: 4, 5: 3, 6: 8, 7: 8, 8: 254, 9: 254, 10: 254, 11: 254,
                 12: 5, 13: 12, 14: 100}
CARD_OTHER = 254


def payment_card(fact: DataFrame, headers: DataFrame, sales_lines: DataFrame, cards: DataFrame,
                 card_history: DataFrame, payment_data: DataFrame) -> DataFrame:
    """The card of each line — for tokenised lines (RTU 1) the newest
    card of the token and customer, else its newest history entry; for
    other lines the newest payment-data entry of the card reference and
    document.  Card type mapped (unknown 254); for known types the first 6
    and last 4 digits and the central-bill flag from the sharing type."""
    h = headers.select("extract_id", "product_id", F.col("no").alias("document_no"), "sell_to_customer_no")
    cc = (fact.select("extract_id", "product_id", "document_no", "line_no")
          .join(h, ["extract_id", "product_id", "document_no"], "inner")
          .join(sales_lines.select(*KEY_SL, "rtu", "card_number", "card_reference"), KEY_SL, "inner"))

    def newest(df, keys, prefix):
        cols = ["card_no_1", "card_no_2", "card_no_3", "card_no_4", "card_type", "sharing_type"]
        n = O.latest_lookup(df.select(*keys, "extract_id", *cols), keys, ["extract_id"]).drop("extract_id")
        return n.select(*[F.col(k).alias(f"{prefix}_{k}") for k in keys],
                        F.concat(*[F.col(c) for c in cols[:4]]).alias(f"{prefix}_num"),
                        F.col("card_type").alias(f"{prefix}_type"), F.col("sharing_type").alias(f"{prefix}_share"))

    def of_customer(prefix):
        return ((F.col("product_id") == F.col(f"{prefix}_product_id"))
                & (F.col("sell_to_customer_no") == F.col(f"{prefix}_customer_no")))
    tok = ["product_id", "customer_no", "token"]
    j = (cc.join(newest(cards, tok, "pc"), of_customer("pc") & (F.col("card_number") == F.col("pc_token")), "left")
         .join(newest(card_history, tok, "pch"), of_customer("pch") & (F.col("card_number") == F.col("pch_token")), "left")
         .join(newest(payment_data, ["product_id", "customer_no", "card_reference", "no"], "pdh"),
               of_customer("pdh") & (F.col("card_reference") == F.col("pdh_card_reference"))
               & (F.col("document_no") == F.col("pdh_no")), "left"))
    rtu = F.col("rtu")
    use_pc = F.coalesce(F.col("pc_num"), F.lit("")) != ""
    num = F.when(rtu == 1, F.when(use_pc, F.col("pc_num")).otherwise(F.col("pch_num"))) \
        .when(rtu == 0, F.col("pdh_num"))
    ctype = F.when(rtu == 1, F.coalesce("pc_type", "pch_type")).when(rtu == 0, F.col("pdh_type"))
    share = F.when(rtu == 1, F.coalesce("pc_share", "pch_share")).when(rtu == 0, F.col("pdh_share"))
    type_id = X.map_code(ctype, CARD_TYPE_MAP, CARD_OTHER)
    known = type_id != CARD_OTHER
    out = j.select(*KEY_SL, type_id.alias("credit_card_type_id"),
                   F.when(known, F.left(num, F.lit(6))).alias("card_first6"),
                   F.when(known, F.right(num, F.lit(4))).alias("card_last4"),
                   F.when(known, F.when(share == 1, 1).when(share == 2, 0)).alias("central_bill"))
    return fact.join(out, KEY_SL, "left")


def approval_info(fact: DataFrame, fields: DataFrame, date_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Approval date (valid date text), approver (numeric) and comment
    (non-empty) of the dossier.  The source joins the key-value rows
    without an order (M1); here the newest extract wins, then the value."""
    d = _latest_field(fields, "APPROVAL_DATE",
                      F.try_to_timestamp(X.clean("fld_value"), F.lit(date_format)).isNotNull())
    a = _latest_field(fields, "APPROVER_PERCODE", X.is_int32_text(X.clean("fld_value")))
    c = _latest_field(fields, "APPROVER_COMMENT", F.col("fld_value") != "")
    k = ["meta_dossier_id", "product_id"]
    return (fact.join(d.select(*k, F.try_to_timestamp(X.clean("fld_value"), F.lit(date_format))
                               .cast("timestamp_ntz").alias("approval_date")), k, "left")
            .join(a.select(*k, X.clean("fld_value").cast("int").alias("approver_id")), k, "left")
            .join(c.select(*k, F.col("fld_value").alias("approval_txt")), k, "left"))


POLICY_SWITCH = "2014-03-25"


def policy_info(fact: DataFrame, reasons: DataFrame, fields: DataFrame) -> DataFrame:
    """Exchanges get reason and status 0.  Others: reason = newest
    numeric out-of-policy reason of the dossier whose locator list contains
    the ticket's locator (air / low-cost services); status from the newest
    ISCOMPLIANT field (matching the locator from 2014-03-25 on): True 1,
    False 2, else 0."""
    fk = ["record_key", "booking_type_id"]
    r = reasons.where((F.col("reason_type") == "WHY_CHOSEN_AS_OOP_ID") & F.col("service_type_id").isin(1, 6)
                      & X.is_int32_text(X.clean("reasons_txt")))
    f = fact.select(*fk, "meta_dossier_id", "pnr_code")
    pairs = O.contains_join(f, r, [("meta_dossier_id", "md_code")], F.col("pnr"), F.col("pnr_code"))
    best_r = O.latest_lookup(pairs.select(*fk, "extract_id", X.clean("reasons_txt").cast("int").alias("reason")),
                             fk, ["extract_id", "reason"]).drop("extract_id")
    comp = fields.where(F.col("fld_key") == "ISCOMPLIANT")
    fc = (fact.select(*fk, "meta_dossier_id", "product_id", "pnr_code")
          .join(comp.select(F.col("metaid").alias("meta_dossier_id"), "product_id", "extract_id", "fld_value",
                            "date_insert", "ref"), ["meta_dossier_id", "product_id"], "inner")
          .where(((F.col("date_insert") >= F.lit(POLICY_SWITCH)) & (F.col("ref") == F.col("pnr_code")))
                 | (F.col("date_insert") < F.lit(POLICY_SWITCH))))
    best_s = O.latest_lookup(fc.select(*fk, "extract_id", "fld_value"), fk, ["extract_id", "fld_value"]) \
        .drop("extract_id")
    j = fact.join(best_r, fk, "left").join(best_s, fk, "left")
    ex = F.col("booking_type_id") == X.BT_EXCHANGE
    status = F.when(F.col("fld_value") == "True", 1).when(F.col("fld_value") == "False", 2).otherwise(0)
    return (j.withColumn("policy_reason_code_id", F.when(ex, F.lit(0)).otherwise(F.col("reason")))
            .withColumn("policy_status_id", F.when(ex, F.lit(0)).otherwise(status))
            .drop("reason", "fld_value"))


def _newest_tag(tagged: DataFrame, tag: str) -> DataFrame:
    t = tagged.where(F.col("tag") == tag).select(
        "product_id", "file_name", F.col("code_pnr").alias("pnr_code"), "extract_id", "text1")
    return O.latest_lookup(t, ["product_id", "file_name", "pnr_code"], ["extract_id", "text1"]).drop("extract_id")


def flatten_sales_line(fact: DataFrame, sales_lines: DataFrame, tagged: DataFrame) -> DataFrame:
    """Ticket attributes from the ERP line: traveller, locator, airline
    ('YY' when missing or longer than 2), ticket codes, e-ticket type and
    refusal, group flag, issue date (posting date when missing or a 1753 /
    1900 placeholder) plus the line's increment seconds, booking source
    (low-cost 4 else 3), increment count, tour code (newest FT line: text
    before the first ';', from its 3rd character) and pricing entry
    (newest Q- line: text after the last ';', blanks removed, 'UU' -> 'U',
    100 characters)."""
    l = sales_lines.select(
        *KEY_SL, "traveller_code", "id_1", "id_2", "corporation", "ticket", "original_ticket", "e_ticket",
        "e_ticket_refused", "group", "issued_date", "posting_date", "increment_order", "meta_id", "ect_error",
        "rtu", "service_group", "amount_incl_vat", "public_price")
    j = fact.join(l, KEY_SL, "inner").withColumn("pnr_code", X.clean("id_2")).withColumn(
        "file_name", F.col("id_1"))
    issued = F.when(F.col("issued_date").isNull() | F.year("issued_date").isin(1753, 1900),
                    F.col("posting_date")).otherwise(F.col("issued_date"))
    bt = F.col("booking_type_id")
    incr = (F.when(bt == X.BT_PURCHASE, F.when(F.col("amount_incl_vat") + F.col("public_price") == 0, 0).otherwise(1))
            .when(bt.isin(X.BT_EXCHANGE, X.BT_PARTIAL_REFUND), 0)
            .when(bt.isin(X.BT_VOID, X.BT_REFUND), -1))
    ft = _newest_tag(tagged, "FT").withColumnRenamed("text1", "_ft")
    qp = _newest_tag(tagged, "Q-").withColumnRenamed("text1", "_q")
    j = j.join(ft, ["product_id", "file_name", "pnr_code"], "left").join(
        qp, ["product_id", "file_name", "pnr_code"], "left")
    head = F.when(F.instr("_ft", ";") > 0, F.substring_index("_ft", ";", 1)).otherwise(F.substring("_ft", 1, 150))
    tail = F.when(F.instr("_q", ";") > 0, F.substring_index("_q", ";", -1)).otherwise(F.right("_q", F.lit(150)))
    pricing = F.substring(F.regexp_replace(F.regexp_replace(tail, " ", ""), "UU", "U"), 1, 100)
    corp = F.col("corporation")
    return j.select(
        *fact.columns,
        F.lit(2).alias("customer_system_id"), F.col("traveller_code").alias("traveler_code"), "pnr_code",
        F.when(F.length(corp) > 2, F.lit("YY")).otherwise(F.coalesce(corp, F.lit("YY"))).alias("airline_code"),
        X.clean("ticket").alias("ticket_code"), F.col("original_ticket").alias("ticket_code_prior"),
        F.when(F.col("e_ticket") == 1, 2).otherwise(1).alias("ticket_type_id"),
        F.when((F.col("e_ticket") != 1) & (F.col("e_ticket_refused") == 1), 1).otherwise(0).alias("e_ticket_refused"),
        F.when(F.col("group") == 1, 1).otherwise(0).alias("group_ticket"),
        (issued + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.coalesce("increment_order", F.lit(0))))
        .alias("issue_date"),
        F.col("meta_id").alias("meta_dossier_id"), F.col("ect_error").alias("agent_error"),
        F.coalesce("rtu", F.lit(0)).alias("direct_payment"),
        F.when(F.col("service_group") == 6, 4).otherwise(3).alias("booking_source_id"),
        F.lit(1).alias("transaction_cnt"), incr.alias("increment_cnt"),
        F.substring(head, 3, 150).alias("tour_code"), pricing.alias("pricing_entry"),
        F.when(F.col("service_group") == 6, 1).otherwise(0).alias("low_cost"))


def account_department(fact: DataFrame, headers: DataFrame, lines: DataFrame, accounts: DataFrame,
                       departments: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """D16 and D17 of an extract: the account of the document's customer (digits only) and
    product; the department whose name is the line's cleaned analytical code, compared without
    case.  No account, no department; of several the smallest id."""
    h = headers.where(F.col("sell_to_customer_no").rlike("^[0-9]+$")).groupBy(
        "extract_id", "product_id", F.col("no").alias("document_no")).agg(F.min("sell_to_customer_no").alias("comcode"))
    a = (accounts.groupBy(F.col("travel_product_id").alias("product_id"), "comcode")
         .agg(F.min("group_account_id").alias("group_account_id")))
    d = (departments.where(F.col("customer_system_id") == customer_system_id)
         .groupBy("group_account_id", X.clean("name", upper=True).alias("_name")).agg(F.min("department_id").alias("department_id")))
    j = (fact.drop("group_account_id", "department_id")
         .join(lines.select(*KEY_SL, X.clean_department_name("analytical_code_1").alias("_name")), KEY_SL, "left")
         .join(h, ["extract_id", "product_id", "document_no"], "left").join(a, ["product_id", "comcode"], "left")
         .join(d, ["group_account_id", "_name"], "left"))
    return j.drop("comcode", "_name")


def policy_group(fact: DataFrame, traveler_accounts: DataFrame, policies: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """D18 of an extract: the policy group of the traveller's account record, where the ticket's
    group account has that group; else null."""
    mine = F.col("customer_system_id") == customer_system_id
    known = policies.where(mine).select("group_account_id", "policy_id").distinct()
    b = traveler_accounts.where(mine & F.col("group_account_id").isNotNull()).select(F.col("tuid").alias("_tuid"), "policy_id")
    who = (fact.select(*KEY_SL, "group_account_id", F.col("traveler_code").try_cast("int").alias("_tuid"))
           .join(b, "_tuid", "inner").join(known, ["group_account_id", "policy_id"], "left_semi")
           .groupBy(*KEY_SL).agg(F.min("policy_id").alias("policy_id")))
    return fact.drop("policy_id").join(who, KEY_SL, "left")


def service_fee_flag(fact: DataFrame, sales_lines: DataFrame, remarks: DataFrame,
                     agent_logins: DataFrame) -> DataFrame:
    """A line whose file (air, not low-cost, primary, type 3) carries an
    IFD remark (rank 1 of ``parse_remarks``) is a service-fee sale; the
    remark's login names the consultant (unknown login -> null)."""
    files = sales_lines.where((F.col("service_group") == 1) & (F.col("crs") != "LOWCOST")
                              & (F.col("resource_type") == 0) & (F.col("id_1") != "") & (F.col("type") == 3)) \
        .select(*KEY_SL, F.col("id_1").alias("file_name"))
    logins = O.first_per_key(agent_logins.select(F.upper(X.clean("login")).alias("_login"),
                                                 F.col("id").alias("consultant_id")), ["_login"], ["consultant_id"])
    rem = remarks.select("extract_id", "file_name", "remark_rank", F.upper(X.clean("login")).alias("_login")) \
        .join(logins, "_login", "left")
    j = fact.join(files, KEY_SL, "left").join(rem, ["extract_id", "file_name"], "left")
    return (j.withColumn("fsf", F.when(F.col("remark_rank") == 1, 1).otherwise(0))
            .withColumn("fsf_consultant_id", F.when(F.col("remark_rank") == 1, F.col("consultant_id")))
            .drop("file_name", "remark_rank", "_login", "consultant_id"))
