"""Hotel and train specifics of the external-file loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from itinera import functions as X
from itinera import operators as O
from itinera.plans.file_loads import KEY, segment_geography
from itinera.sources import latest_extract

# fixed values: hotel comparison kinds
SAME_HOTEL = 1
RATE_EPR, RATE_ESR, RATE_PUBLISHED, RATE_NEGOTIATED = 1, 2, 3, 4
# fixed values: booking sources whose missing brand defaults to 0 (else -10000)
BRAND_ZERO_SOURCES = (32, 33, 34, 35, 36)
CONSULTANT_NONE = -500000


# ---- D10 / D36 / D37 / D38 / D39 hotel expand ---------------------------------------

def expand_hotel(fact: DataFrame, stage: DataFrame, travel_product: DataFrame,
                 fx_rates: DataFrame, source_by_file_type: dict[int, int],
                 amounts=("room_amt", "tax_amt", "gross_amt")) -> DataFrame:
    """Signed nights, booking source from the file type, FX amounts and
    D39 booking reference (characters 2-9 of the itinerary, only when the
    itinerary is digits and fits int32; Q10 fixed: tested on the new
    source)."""
    st = O.first_per_key(stage.drop("booking_type_id"), ["file_id", "record_key"], ["record_key"])
    j = fact.select(*KEY).join(st, ["file_id", "record_key"], "inner")
    tp = travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code"))
    j = j.join(tp, "travel_product_id", "inner")
    j = j.withColumn("nights_cnt", F.col("nights_cnt") * X.sign_factor("booking_type_id"))
    j = j.withColumn("booking_source_id", X.map_code("file_type_id", source_by_file_type))
    itin = X.clean("itinerary_txt")
    ref = F.substring(itin, 2, 8)
    j = j.withColumn("booking_ref", F.when(X.is_int32_text(itin), X.int32_or_null(ref)))
    return O.fx_convert(j, fx_rates, "invoice_date", "currency", "currency_code", list(amounts))


def hotel_brand_chain(fact: DataFrame, sku_brand: DataFrame, extracts: DataFrame,
                      brand_chain: DataFrame, catalog_source: str = "hotel_catalog") -> DataFrame:
    """Brand from the newest complete catalogue extract (rank-1 brand,
    newest update per hotel); default 0 for some sources else -10000; chain
    by the brand's effective dates on the check-in date, default 0."""
    newest = latest_extract(extracts.where(F.col("source") == catalog_source), "source", "extract_id",
                            complete_col="complete")
    cat = sku_brand.where(F.col("brand_use_rank") == 1).join(
        newest.select(F.col("extract_id").alias("extract_id_max")), "extract_id_max", "left_semi")
    best = O.first_per_key(cat.select("sku_item_id", "brand_use_rank", "update_date", "brand_id"),
                           ["sku_item_id"], ["brand_use_rank", "-update_date", "brand_id"])
    j = fact.join(best.select(F.col("sku_item_id").alias("hotel_id"), F.col("brand_id").alias("_b")),
                  "hotel_id", "left")
    dflt = F.when(F.col("booking_source_id").isin(*BRAND_ZERO_SOURCES), 0).otherwise(-10000)
    j = j.withColumn("hotel_brand_id", F.coalesce("_b", dflt)).drop("_b")
    bc = brand_chain.select(F.col("brand_id").alias("_bb"), "chain_id", "effective_begin", "effective_end")
    j = O.dated_join(j, bc, [("hotel_brand_id", "_bb")], "check_in_date", "effective_begin", "effective_end")
    return (j.withColumn("hotel_chain_id", F.coalesce("chain_id", F.lit(0)))
            .drop("_bb", "chain_id", "effective_begin", "effective_end"))


def hotel_geography(fact: DataFrame, geo_country: DataFrame, default_geo: int) -> DataFrame:
    """Geography of the hotel country, else the default."""
    g = O.first_per_key(geo_country.where(F.col("country_code_destination").isNull())
                        .select("travel_product_id", "country_code", "geography_type_id"),
                        ["travel_product_id", "country_code"], ["geography_type_id"])
    j = fact.join(g.withColumnRenamed("country_code", "hotel_country_code"),
                  ["travel_product_id", "hotel_country_code"], "left")
    return j.withColumn("geography_type_id", F.coalesce("geography_type_id", F.lit(default_geo)))


def hotel_rate_supply(source_code, rate_type, table: dict[tuple[str, str], int], default=0):
    """Rate-supply type from (source code, rate type) via a literal map."""
    m = {f"{a}|{b}": v for (a, b), v in table.items()}
    return X.map_code(F.concat_ws("|", source_code, rate_type), m, default)


# ---- D77 / D78 comparisons --------------------------------------------------------------

def hotel_comparisons(stage: DataFrame, tx_log: DataFrame, cmp_log: DataFrame,
                      travel_product: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Newest same-hotel log row per (reference, product, comparison
    type), joined on the booking reference; FX with an inner join (a missing
    rate drops the row)."""
    logs = tx_log.join(cmp_log.where(F.col("comparison_type_id") == SAME_HOTEL), ["extract_id", "log_id"])
    newest = O.first_per_key(
        logs.select("trl", "travel_product_id", "rate_type_id", "extract_id", "log_id", "currency",
                    "base", "tax", "room_desc"),
        ["trl", "travel_product_id", "rate_type_id"], ["-extract_id", "-log_id"])
    itin = X.clean("itinerary_txt")
    s = stage.where(F.col("record_status_id") == 1).where(itin.rlike("^[0-9]+$")).withColumn(
        "trl", F.substring(itin, 2, 8).cast("int"))
    j = s.select(*KEY, "travel_product_id", "trl", "invoice_date", "issue_date").join(
        newest, ["trl", "travel_product_id"], "inner")
    tp = travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code"))
    j = j.join(tp, "travel_product_id").withColumn("rate_day", F.coalesce("invoice_date", "issue_date"))
    j = j.withColumn("tax", F.coalesce("tax", F.lit(0)))
    j = O.fx_convert(j, fx_rates, "rate_day", "currency", "currency_code", ["base", "tax"], how="inner",
                     keep_rate=None)
    return j.select(*KEY, F.col("rate_type_id").alias("rate_comparison_type_id"), "currency_code",
                    F.coalesce("room_desc", F.lit("")).alias("description"),
                    F.col("base").alias("total_base_amt"), F.col("tax").alias("total_tax_amt"))


def backfill_comparisons(stage: DataFrame, existing: DataFrame, travel_product: DataFrame,
                         fx_rates: DataFrame) -> DataFrame:
    """The four stage rate groups (EPR, ESR, published, negotiated) as
    rows — one scan, each group kept when its base is non-zero and it has a
    currency — for tickets without any comparison row yet."""
    groups = {}
    for gid, sfx in ((RATE_EPR, "epr"), (RATE_ESR, "esr"), (RATE_PUBLISHED, "published"),
                     (RATE_NEGOTIATED, "negotiated")):
        groups[str(gid)] = ({"currency": F.col(f"currency_{sfx}"), "base": F.col(f"base_{sfx}"),
                             "tax": F.col(f"tax_{sfx}"), "description": F.col(f"description_{sfx}")},
                            F.coalesce(F.col(f"base_{sfx}") != 0, F.lit(False))
                            & F.col(f"currency_{sfx}").isNotNull())
    rows = O.groups_to_rows(stage.where(F.col("record_status_id") == 1),
                            KEY + ["travel_product_id", "invoice_date", "issue_date"], groups, "kind")
    rows = O.keep_if_absent(rows, existing.select(*KEY).distinct(), KEY)
    tp = travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code"))
    j = rows.join(tp, "travel_product_id").withColumn("rate_day", F.coalesce("invoice_date", "issue_date"))
    j = j.withColumn("tax", F.coalesce("tax", F.lit(0)))
    j = O.fx_convert(j, fx_rates, "rate_day", "currency", "currency_code", ["base", "tax"], how="inner",
                     keep_rate=None)
    return j.select(*KEY, F.col("kind").cast("int").alias("rate_comparison_type_id"), "currency_code",
                    F.coalesce("description", F.lit("")).alias("description"),
                    F.col("base").alias("total_base_amt"), F.col("tax").alias("total_tax_amt"))


# ---- D30 consultant ---------------------------------------------------------------------

# fixed values: actions that show who worked on a hotel, the automation's login, kinds of dossier
HOTEL_ACTIONS = ("HCCANCEL", "TCCHANGED", "TCHOTELMODIFIED", "TCHOTELADDED", "HCBOOK", "IANHOTELCANCEL",
                 "IANHOTELDATECHANGE", "IANHOTELPRICECHANGE", "HCADD", "CHECKOUT_INSERTION")
AUTOMATION = 504141
NO_DOSSIER, MANUAL_DOSSIER = "NMD", "M"


def consultant_as_of(fact: DataFrame, events: DataFrame, keys, event_day: str, who: str, issue_day: str,
                     out: str = "consulted", bucket=None) -> DataFrame:
    """``fact`` with a struct (day, ``who``, n): of the newest day with events at or before the
    issue day, who has most of them (then the smallest)."""
    keys = list(keys)
    daily = events.groupBy(*keys, F.col(event_day).alias("day"), who).agg(F.count(F.lit(1)).alias("n"))
    top = O.first_per_key(daily, [*keys, "day"], ["-n", who])
    return O.asof_join(fact, top, keys, issue_day, "day", ["day", who, "n"], out=out, bucket=bucket or O.time_bucket(30 * 86400))


def consultant_names(logins: DataFrame) -> DataFrame:
    """(name, named_consultant): 'LAST FIRST' of each consultant's login; equal names go to the
    smallest id.  Ids are stored negated."""
    name = F.concat(F.col("last_name"), F.lit(" "), F.col("first_name"))
    return (logins.select(X.clean(name).alias("name"), (-F.col("consultant_id")).alias("_c")).where(F.col("name").isNotNull())
            .groupBy("name").agg(F.max("_c").alias("named_consultant")))


def consultant_by_levels(fact: DataFrame, events: DataFrame, actions: DataFrame, fields: DataFrame, logins: DataFrame,
                         action_codes=HOTEL_ACTIONS, automation: int = AUTOMATION) -> DataFrame:
    """D30 with its fallback: on agent-assisted tickets of a numeric dossier the consultant of
    the event log, else of the name in the dossier's field, else none (-500000); of a manual
    dossier ('M..', not 'NMD..') the named one, else none; of others none.  Tickets without an
    agent keep their ``consultant_id``."""
    a = actions.where(F.col("label_code").isin(*action_codes)).select(F.col("id").alias("action_id"))
    ev = (events.where(F.col("consultant_id").isNotNull() & (F.col("consultant_id") != automation))
          .join(a, "action_id", "left_semi")
          .select(X.clean("dossier_id").alias("_dossier"), F.to_date("event_date").alias("_event_day"),
                  (-F.col("consultant_id")).alias("_who")))
    numeric = X.is_int32_text(X.clean("meta_dossier_id"))
    own = [c for c in fact.columns if c != "consultant_id"]
    f = fact.withColumn("_dossier", F.when(numeric, X.clean("meta_dossier_id"))).withColumn("_issued", F.to_date("issue_date"))
    f = consultant_as_of(f, ev, ["_dossier"], "_event_day", "_who", "_issued", "_log")
    by_name = (fields.where(F.col("fld_key") == "TRAVEL_CONSULTANT")
               .select(F.col("metaid").alias("_meta"), F.col("product_id").alias("_product"), X.clean("fld_value").alias("name"))
               .join(consultant_names(logins), "name", "inner")
               .groupBy("_meta", "_product").agg(F.max("named_consultant").alias("_named")))
    f = f.join(by_name, (F.col("meta_dossier_id") == F.col("_meta")) & (F.col("product_id") == F.col("_product")), "left")
    none, meta = F.lit(CONSULTANT_NONE), X.clean("meta_dossier_id", upper=True)
    found = (F.when(numeric, F.coalesce("_log._who", "_named", none))
             .when(meta.startswith(NO_DOSSIER), none)
             .when(meta.startswith(MANUAL_DOSSIER), F.coalesce("_named", none)).otherwise(none))
    kept = F.col("consultant_id") if "consultant_id" in fact.columns else F.lit(None).cast("int")
    return f.select(*own, F.when(F.col("agent_assisted") == 1, found).otherwise(kept).alias("consultant_id"))


def attribute_consultant(fact: DataFrame, events: DataFrame, actions: DataFrame,
                         action_codes=("BOOK", "ISSUE", "MODIFY")) -> DataFrame:
    """For agent-assisted tickets, the consultant with the most events
    on the newest day at or before the issue date (dossier id must be an
    int32 text); none -> -500000."""
    a = actions.where(F.col("label_code").isin(*action_codes)).select(F.col("id").alias("action_id"))
    ev = events.join(a, "action_id", "left_semi").where(X.is_int32_text(X.clean("dossier_id")))
    ev = ev.select(X.clean("dossier_id").cast("int").alias("dossier"), F.to_date("event_date").alias("event_day"), "consultant_id")
    f = fact.withColumn("dossier", F.when(X.is_int32_text(X.clean("meta_dossier_id")),
                                          X.clean("meta_dossier_id").cast("int")))
    f = f.withColumn("issue_day", F.to_date("issue_date"))
    r = consultant_as_of(f, ev, ["dossier"], "event_day", "consultant_id", "issue_day", "_m")
    cons = F.when(F.col("agent_assisted") == 1, F.coalesce(F.col("_m.consultant_id"), F.lit(CONSULTANT_NONE)))
    return r.withColumn("consultant_id", cons).drop("_m", "dossier", "issue_day")


# ---- train: D41 / D63 / D64 ----------------------------------------------------------------

def strip_country_prefix(code):
    """D41: 'XX-CODE' -> 'CODE' (two letters and a dash)."""
    c = X.clean(code)
    return F.when(c.rlike("^[A-Za-z]{2}-"), F.substring(c, 4, 1 << 20)).otherwise(c)


def load_train_segments(fact: DataFrame, seg_stage: DataFrame, fx_rates: DataFrame) -> DataFrame:
    s = seg_stage.join(fact.select(*KEY, "currency_code", "invoice_date", F.col("currency").alias("_ccy")),
                       KEY, "inner")
    s = (s.withColumn("station_from", strip_country_prefix("station_from"))
         .withColumn("station_to", strip_country_prefix("station_to")))
    return O.fx_convert(s, fx_rates, "invoice_date", "_ccy", "currency_code", ["segment_value"],
                        keep_rate=None).drop("_ccy")


def train_geography(segments: DataFrame, stations: DataFrame, geo_country: DataFrame, geo_priority: DataFrame,
                    lang_id: int = 1033, line_of_business: int = 5) -> DataFrame:
    """D51 (train): geography by the countries of both stations; a segment with an unknown
    station has none.  ``segments`` have travel_product_id."""
    st = O.first_per_key(stations.where(F.col("lang_id") == lang_id).select("station_code", "country_code"),
                         ["station_code"], ["country_code"])
    s = segments
    for side in ("from", "to"):
        d = st.select(F.col("station_code").alias("_sc"), F.col("country_code").alias(f"{side}_country_code"))
        s = s.drop(f"{side}_country_code").join(d, F.col(f"station_{side}") == F.col("_sc"), "left").drop("_sc")
    s = segment_geography(s, geo_country, geo_priority, line_of_business=line_of_business)
    both = F.col("from_country_code").isNotNull() & F.col("to_country_code").isNotNull()
    return s.withColumn("geography_type_id", F.when(both, F.col("geography_type_id")))


def train_route_text(segments: DataFrame, stations: DataFrame, lang_col: str = "lang_id") -> DataFrame:
    """City names in segment order, each cut to 25 characters and
    'Unknown' where missing: every departure with '/', the arrival with '_'
    where the next segment departs elsewhere, and the last arrival (cut to 500 at the sink)."""
    city = X.clean("city_name")
    shown = F.coalesce(city, X.clean("display_name")) if "display_name" in stations.columns else city
    st = stations.select(F.col("station_code").alias("_sc"), F.col(lang_col).alias("_lang"),
                         F.coalesce(city, F.col("station_code")).alias("_place"), shown.alias("_name"))
    s = segments
    for side in ("from", "to"):
        d = st.select(*[F.col(c).alias(f"{c}_{side}") for c in st.columns])
        s = s.join(d, (s[f"station_{side}"] == d[f"_sc_{side}"]) & (s["lang_id"] == d[f"_lang_{side}"]), "left")
    # the segments of one ticket are a bounded group
    w = Window.partitionBy(*KEY).orderBy("segment_nbr")
    follows = F.lead("segment_nbr").over(w) == F.col("segment_nbr") + 1
    s = s.withColumn("_next", F.when(follows, F.lead("_place_from").over(w)))
    name = {side: X.fit(F.coalesce(f"_name_{side}", F.lit("Unknown")), 25) for side in ("from", "to")}
    s = s.withColumn("_piece", F.concat(
        name["from"], F.lit("/"),
        F.when(F.col("_next").isNull(), name["to"])
        .when(F.col("_place_to") != F.col("_next"), F.concat(name["to"], F.lit("_"))).otherwise("")))
    return s.groupBy(*KEY).agg(O.concat_ordered("_piece", ["segment_nbr"], "").alias("route_txt"))


def parse_route_text(df: DataFrame, excluded_prefixes=("FR", "ES")) -> DataFrame:
    """End stations from 'A_B' or 'A/B[/C...]' route text (first and
    last token), for record keys outside the excluded country prefixes."""
    t = X.clean("route_txt")
    parts = F.split(F.regexp_replace(t, "_", "/"), "/")
    keep = ~F.substring(X.clean("record_key"), 1, 2).isin(*excluded_prefixes)
    return (df.withColumn("route_from", F.when(keep & (F.size(parts) >= 2), X.clean(parts.getItem(0))))
            .withColumn("route_to", F.when(keep & (F.size(parts) >= 2),
                                           X.clean(F.element_at(parts, -1)))))


def train_policy_backfill(fact: DataFrame, reasons: DataFrame) -> DataFrame:
    """D26 (train): non-compliant tickets without a reason take the newest
    numeric rail out-of-policy reason of the dossier and locator."""
    r = reasons.where((F.col("reason_type") == "WHY_CHOSEN_AS_OOP_ID") & (F.col("service_type_id") == 2)
                      & X.is_int32_text(X.clean("reasons_txt"))).select(
        F.col("md_code").alias("meta_dossier_id"), F.col("pnr").alias("pnr_code"), "extract_id",
        X.clean("reasons_txt").cast("int").alias("_reason"))
    newest = O.latest_lookup(r, ["meta_dossier_id", "pnr_code"], ["extract_id", "_reason"]).drop("extract_id")
    j = fact.join(newest, ["meta_dossier_id", "pnr_code"], "left")
    fill = (F.col("policy_status_id") == 2) & F.col("policy_reason_code_id").isNull()
    return j.withColumn("policy_reason_code_id",
                        F.when(fill, F.col("_reason")).otherwise(F.col("policy_reason_code_id"))).drop("_reason")
