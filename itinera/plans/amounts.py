"""Extract-air amounts: base amounts per line, the original ticket of an
exchange, and YQ / YR surcharges parsed from tagged text lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O

# fixed values: products whose subcategory-12 lines are priced from the public price
PUBLIC_PRICE_PRODUCTS = (60010, 60083, 60035, 60013)
SURCHARGE_TAGS = ("TAX", "KRF", "KST")


def line_amounts(lines: DataFrame) -> DataFrame:
    """Ticket, base, tax/VAT, markup and commission amounts of each sales
    line; subcategory 12 of the listed products uses the public price."""
    pub = F.col("product_id").isin(*PUBLIC_PRICE_PRODUCTS) & (F.col("business_sub_category") == 12)
    m = "decimal(19,4)"
    price, amt, incl = F.col("public_price"), F.col("amount"), F.col("amount_incl_vat")
    tax = F.col("airport_tax")
    return lines.select(
        "document_no", "line_no", "product_id",
        F.col("commission_excl_vat").cast(m).alias("commission_amt"),
        tax.cast(m).alias("other_tax_amt"), "ob_fees_amt",
        F.when(pub, price).otherwise(incl).cast(m).alias("ticket_amt"),
        F.when(pub, price - tax).otherwise(amt - tax).cast(m).alias("ticket_amt_base"),
        F.when(pub, F.lit(0)).otherwise(incl - amt).cast(m).alias("ticket_amt_tax_vat"),
        F.when(price == 0, F.lit(None)).otherwise(F.abs(amt) - F.abs(price)).cast(m).alias("markup_full"),
        F.abs("markup_total").alias("markup_amt"), F.abs("markup_gds").alias("markup_gds_amt"),
        F.abs("markup_pub").alias("markup_pub_amt"),
        F.col("id_1").alias("file_name"), "crs", "business_category", "business_sub_category")


def exchange_origin(fact: DataFrame, invoice_lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """For each exchange, the newest primary air ledger entry (entry
    type 3) of its prior ticket, same traveller and same customer; its
    amounts become the original amounts."""
    ex = (fact.where(F.col("booking_type_id") == X.BT_EXCHANGE)
          .join(invoice_lines.select("product_id", "document_no", "line_no", "sell_to_customer_no"),
                ["product_id", "document_no", "line_no"], "inner"))
    led = (ledger.where(F.col("service_group").isin(1, 6) & (F.col("entry_type") == 3)
                        & (F.col("resource_type") == 0))
           .select("product_id", F.col("ticket_no").alias("ticket_prior"),
                   F.col("traveller_code").alias("traveler_code"), "sell_to_customer_no", "extract_id", "entry_no",
                   F.col("document_no").alias("sle_document_no"), F.col("line_no").alias("sle_line_no"),
                   F.col("amount_lcy_incl_vat").alias("original_amt"),
                   F.col("gross_commission").alias("original_commission"),
                   (F.col("net_amount") - F.col("tax_amount")).alias("original_base"),
                   (F.col("amount_lcy_incl_vat") - F.col("net_amount")).alias("original_vat"),
                   F.col("tax_amount").alias("original_tax")))
    keys = ["product_id", "ticket_prior", "traveler_code", "sell_to_customer_no"]
    newest = O.latest_lookup(led, keys, ["extract_id", "entry_no"]).drop("extract_id", "entry_no")
    ex = ex.withColumn("traveler_code", F.col("traveler_id").cast("string"))
    return ex.join(newest, keys, "inner").select(
        "product_id", "document_no", "line_no", "sle_document_no", "sle_line_no", "original_amt",
        "original_commission", "original_base", "original_vat", "original_tax")


def surcharges(tagged: DataFrame, lines: DataFrame) -> DataFrame:
    """YQ and YR surcharges from TAX / KRF / KST text lines of the files
    of non-low-cost sales lines — the amount before the first and before the
    second occurrence of each code, a row kept when either amount text is
    numeric.  Equal rows seen in several extracts count once (the newest
    extract); the rest is summed per (product, file, tag, extract), and the
    newest extract's sum holds, so a corrected amount replaces the old one."""
    files = (lines.where((F.col("crs") != "LOWCOST") & (F.col("file_name") != ""))
             .select("product_id", "file_name").distinct())
    t = (tagged.where(F.col("tag").isin(*SURCHARGE_TAGS)
                      & (F.col("text1").contains("YQ") | F.col("text1").contains("YR")))
         .join(files, ["product_id", "file_name"], "left_semi"))
    parts = []
    for nth in (1, 2):
        cols = {}
        ok = F.lit(False)
        for code in ("YQ", "YR"):
            first = F.locate(code, F.col("text1"))
            pos = first if nth == 1 else F.expr(f"locate('{code}', text1, locate('{code}', text1) + 1)")
            raw = X.tsql_substring(F.col("text1"), pos - 9, F.lit(8))
            cols[code.lower()] = X.to_money(F.regexp_replace(raw, "EXEMPT", ""))
            ok = ok | X.is_numeric_text(raw)
        parts.append(t.where(ok).select("product_id", "extract_id", "file_name", "tag", "line_id",
                                        F.lit(nth).alias("occurrence"), cols["yq"].alias("yq"),
                                        cols["yr"].alias("yr")))
    s = parts[0].unionByName(parts[1])
    eq = ["product_id", "file_name", "tag", "yq", "yr"]
    newest = s.groupBy(*eq).agg(F.max("extract_id").alias("extract_id"))
    alone = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in eq])       # equals no other row
    kept = s.join(newest, eq + ["extract_id"], "left_semi").unionByName(s.where(alone))
    sums = kept.groupBy("product_id", "file_name", "tag", "extract_id").agg(F.sum("yq").alias("yq"), F.sum("yr").alias("yr"))
    return (sums.groupBy("product_id", "file_name", "tag")
            .agg(F.max_by(F.struct("yq", "yr"), "extract_id").alias("_s"))
            .select("product_id", "file_name", "tag", F.col("_s.yq").alias("yq_amt"), F.col("_s.yr").alias("yr_amt")))


# fixed values: fare types excluded from the tax fee (company fares)
TAX_FEE_EXCLUDED_FARE_TYPES = (101, 102, 103, 104, 105)


# fixed values: remarks that tell of a saving, in the order in which the first of a file counts
SAVING_REMARKS = ("IFD", "AO", "MICE")


def remark_savings(tagged: DataFrame, lines: DataFrame) -> DataFrame:
    """The saving in the remarks of the files of non-low-cost lines, one row per (product,
    file).  Of several remarks the first kind counts, then the smallest text; only IFD has an
    amount: the number from the first digit on where a digit stands before ';', else the last
    word; ',' is a decimal point and what is no number is 0."""
    files = (lines.where((F.col("crs") != "LOWCOST") & (F.col("file_name") != ""))
             .select("product_id", "file_name").distinct())
    text = X.clean("text1")
    said = tagged.where((F.col("tag") == "RM") & text.rlike(r"^RM\* {0,2}(IFD|AO|MICE) ")).select(
        "product_id", "file_name", text.alias("_text"))
    kind = F.lit(len(SAVING_REMARKS))
    for i, word in reversed(list(enumerate(SAVING_REMARKS))):
        kind = F.when(F.col("_text").rlike(rf"^RM.*\*.*{word} "), i).otherwise(kind)
    first = (said.join(files, ["product_id", "file_name"], "left_semi").groupBy("product_id", "file_name")
             .agg(F.min(F.struct(kind.alias("kind"), F.col("_text").alias("text"))).alias("_r")))
    t = F.col("_r.text")
    raw = F.regexp_replace(F.when(t.rlike("[0-9];"), F.regexp_extract(t, "([0-9][0-9.,]*)", 1))
                           .otherwise(X.last_token(t, " ")), ",", ".")
    return first.select("product_id", "file_name", F.when((F.col("_r.kind") == 0) & X.is_numeric_text(raw), X.to_money(raw))
                        .otherwise(F.lit(0)).cast("decimal(19,4)").alias("fsf_amt_savings"))


# fixed values: when exchanges and penalties began to be linked by ticket, and by time
LINKED_BY_TIME_FROM, LINKED_BY_TICKET_FROM = "2014-01-01", "2014-04-01"
PENALTY_STATUS = 11


def exchange_penalties(fact: DataFrame, minutes: int = 2) -> DataFrame:
    """D19 and D20 of an extract: the gross amount of an exchange grows by its penalty's, which
    is stored as ``ticket_amt_exchange_penalty`` as well.  Exchanges invoiced from April 2014 on
    take the first penalty (by line) of their dossier and traveller whose prior ticket is
    their own ticket; those of the quarter before take the single penalty of dossier, traveller
    and locator that was posted less than ``minutes`` minutes after them.  The two never meet,
    as the dates exclude each other.  Penalties are in the storage currency already."""
    line = ["product_id", "document_no", "line_no"]
    gross = F.col("ticket_amt_gross")
    paid = fact.where((F.col("record_status_id") == PENALTY_STATUS) & (F.col("booking_type_id") == X.BT_PURCHASE) & (gross > 0))
    ex = fact.where(F.col("booking_type_id") == X.BT_EXCHANGE)
    day = F.col("invoice_date")
    who = ["meta_dossier_id", "traveler_id"]
    by_ticket = O.first_per_key(
        paid.where(F.col("business_category").isin(6, 7)).select(*who, F.col("ticket_code_prior").alias("ticket_code"),
                                                                 "line_no", "document_no", gross.alias("_penalty")),
        [*who, "ticket_code"], ["line_no", "document_no"]).select(*who, "ticket_code", "_penalty")
    late = (ex.where(day >= F.lit(LINKED_BY_TICKET_FROM)).select(*line, *who, "ticket_code")
            .join(by_ticket, [*who, "ticket_code"], "inner").select(*line, "_penalty"))
    quarter = lambda c: (F.col(c) >= F.lit(LINKED_BY_TIME_FROM)) & (F.col(c) < F.lit(LINKED_BY_TICKET_FROM))
    place = [*who, "pnr_code"]
    single = (paid.where((F.col("business_category") == 6) & F.col("business_sub_category").isin(1, 2, 3)
                         & (F.col("resource_type") == 0) & quarter("posting_date"))
              .groupBy(*place).agg(F.count(F.lit(1)).alias("_n"), F.max("posting_date").alias("_posted"),
                                   F.max(gross).alias("_penalty")).where("_n = 1").drop("_n"))
    early = O.near_in_time(ex.where(quarter("invoice_date")).select(*line, *place, "posting_date"), single, place,
                           "posting_date", "_posted", minutes).select(*line, "_penalty")
    j = fact.join(late.unionByName(early), line, "left")
    return (j.withColumn("ticket_amt_gross", gross + F.coalesce("_penalty", F.lit(0)))
            .withColumnRenamed("_penalty", "ticket_amt_exchange_penalty"))


def apply_amounts(fact: DataFrame, amounts: DataFrame, surcharge: DataFrame, savings: DataFrame | None = None) -> DataFrame:
    """Line amounts onto the fact; the saving of the file's remarks (0 where there is
    none); tax = other tax + tax/VAT; gross = ticket; tax fee = |YQ| and |YR| of the first tag that applies — TAX or
    KST for purchase / void / exchange (1, 4, 5), KRF for refunds (7, 8) —
    only for ticket categories 1, 3, 10 and not company fares."""
    k = ["product_id", "document_no", "line_no"]
    j = fact.join(amounts, k, "inner")
    s = surcharge.select("product_id", "file_name", "tag", "yq_amt", "yr_amt")
    for tag in ("TAX", "KRF", "KST"):
        t = s.where(F.col("tag") == tag).select("product_id", "file_name",
                                                 F.col("yq_amt").alias(f"_yq_{tag}"), F.col("yr_amt").alias(f"_yr_{tag}"))
        j = j.join(t, ["product_id", "file_name"], "left")
    bt = F.col("booking_type_id")
    eligible = F.col("business_category").isin(1, 3, 10) & ~F.coalesce(
        F.col("fare_type_id").isin(*TAX_FEE_EXCLUDED_FARE_TYPES), F.lit(False))

    def pick(tag, types):
        return F.when(eligible & bt.isin(*types), F.abs(F.col(f"_yq_{tag}"))), \
            F.when(eligible & bt.isin(*types), F.abs(F.col(f"_yr_{tag}")))
    q1, r1 = pick("TAX", (1, 4, 5))
    q2, r2 = pick("KRF", (7, 8))
    q3, r3 = pick("KST", (1, 4, 5))
    fee = F.coalesce(q1, q2, q3, F.lit(0)) + F.coalesce(r1, r2, r3, F.lit(0))
    if savings is not None:
        j = j.join(savings, ["product_id", "file_name"], "left").withColumn(
            "fsf_amt_savings", F.coalesce("fsf_amt_savings", F.lit(0).cast("decimal(19,4)")))
    out = (j.withColumn("ticket_amt_tax", F.col("other_tax_amt") + F.col("ticket_amt_tax_vat"))
           .withColumn("ticket_amt_gross", F.col("ticket_amt"))
           .withColumn("ticket_amt_tax_fee", fee))
    return out.drop(*[f"_{a}_{t}" for a in ("yq", "yr") for t in ("TAX", "KRF", "KST")])


def add_exchange_origin(fact: DataFrame, origin: DataFrame) -> DataFrame:
    """Exchanges add the original ticket's amounts (nulls count as 0)."""
    k = ["product_id", "document_no", "line_no"]
    j = fact.join(origin, k, "left")
    hit = F.col("original_amt").isNotNull()

    def add(col, extra):
        return F.when(hit, F.coalesce(F.col(col), F.lit(0)) + extra).otherwise(F.col(col))
    return (j.withColumn("ticket_amt", add("ticket_amt", F.col("original_amt")))
            .withColumn("commission_amt", add("commission_amt", F.col("original_commission")))
            .withColumn("ticket_amt_base", add("ticket_amt_base", F.col("original_base")))
            .withColumn("ticket_amt_tax_vat", add("ticket_amt_tax_vat", F.col("original_vat")))
            .withColumn("ticket_amt_tax", add("ticket_amt_tax", F.col("original_tax") + F.col("original_vat")))
            .drop("sle_document_no", "sle_line_no", "original_amt", "original_commission", "original_base",
                  "original_vat", "original_tax"))
