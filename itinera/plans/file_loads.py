"""External-file loads (air, hotel, train): one batch (``file_id``) per run.

Every function takes and returns DataFrames; nothing is collected.  Inputs
follow the column names of FIXTURES.md (snake case).  Each lookup that feeds
an update is deduplicated to one row per key first (a stated tie-break), so
a key never fans out.  Only literal or language-filtered dimensions are
broadcast explicitly; everything else is left to AQE.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O

KEY = ["file_id", "record_key", "booking_type_id"]
LANG_EN = 1033
AIR_AMOUNTS = ["ticket_amt", "base_amt", "tax_amt", "vat_amt", "penalty_amt", "commission_amt",
               "markup_amt", "gross_amt"]
FARE_AMOUNTS = ["fare_amt_lowest_in_policy", "fare_amt_published", "fare_amt_negotiated"]
# fixed values: fare types that follow from the business sub-category; a file's exchange penalties
SUBCATEGORY_FARE_TYPE = {12: 101, 13: 104, 14: 102, 15: 105, 16: 103}
ANCILLARY, PENALTY_STATUS = 6, 9


# ---- D1 seed ------------------------------------------------------------------

def seed_file_fact(stage: DataFrame, booking_types: DataFrame, file_id,
                   batch_col: str = "file_id") -> DataFrame:
    """Status-1 rows of the batch; null booking type -> 0; rows whose type is
    NOT IN the booking-type dimension are deleted (SQL null semantics)."""
    s = O.delete_not_in(
        stage.where((F.col(batch_col) == F.lit(file_id)) & (F.col("record_status_id") == 1))
        .select(F.col(batch_col).alias("file_id"), "record_key",
                F.coalesce("booking_type_id", F.lit(0)).cast("short").alias("booking_type_id")),
        "booking_type_id", booking_types, "booking_type_id")
    return s


# ---- D9 / D11 / D12 / D14 expand ---------------------------------------------------

def expand_ticket(fact: DataFrame, stage: DataFrame, travel_product: DataFrame,
                  fx_rates: DataFrame, amounts: Sequence[str] = AIR_AMOUNTS,
                  card_col: str | None = None) -> DataFrame:
    """Ticket attributes from the stage row of the same key: trimmed codes,
    advance-purchase days, increment count, central-bill flag, storage
    currency and FX conversion of every amount (missing rate -> 0).
    The three comparison fares, the fare type of the listed sub-categories and
    the low-fare choice are taken where the stage has them.  Tax is stored as tax + VAT.  With ``card_col`` the card is masked.

    The stage row is found by (file, record key) — its own booking type may
    be null where the fact's is 0 — deduplicated to one row per key first
    (M1: a stated tie-break instead of an arbitrary match)."""
    st = O.first_per_key(stage.drop("booking_type_id"), ["file_id", "record_key"], ["record_key"])
    j = fact.select(*KEY).join(st, ["file_id", "record_key"], "inner")
    tp = travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code"))
    j = j.join(tp, "travel_product_id", "inner")
    j = j.withColumn("comcode", X.clean("comcode", upper=True))
    j = j.withColumn("advance_purchase_days", X.advance_days(
        "booking_type_id", "booking_date", "issue_date", "travel_start", F.lit(None).cast("int")))
    j = j.withColumn("increment_cnt", X.increment_count("booking_type_id"))
    if "business_sub_category" in j.columns and "fare_type_id" in j.columns:
        j = j.withColumn("fare_type_id", F.coalesce(X.map_code(F.col("business_sub_category").cast("int"), SUBCATEGORY_FARE_TYPE),
                                                    F.col("fare_type_id")))
    if "low_fare_choice_type_id" in j.columns:
        j = j.withColumn("low_fare_chosen", F.when(F.col("low_fare_choice_type_id").isin(0, 1), F.col("low_fare_choice_type_id")))
    j = j.withColumn("central_bill", F.when(F.col("card_owner_id") == 1, 1)
                     .when(F.col("card_owner_id") == 2, 0))
    if "tax_amt" in amounts and "vat_amt" in amounts:
        j = j.withColumn("tax_amt", F.col("tax_amt") + F.col("vat_amt"))
    j = O.fx_convert(j, fx_rates, "invoice_date", "currency", "currency_code",
                     [*amounts, *(c for c in FARE_AMOUNTS if c in j.columns)])
    if card_col:
        first6, last4 = X.mask_card(card_col)
        j = j.withColumn("card_first6", first6).withColumn("card_last4", last4).drop(card_col)
    return j


def add_advance_band(fact: DataFrame, bands: DataFrame, lang_id: int = LANG_EN) -> DataFrame:
    """Band of the advance days; null -> -1, negative -> 99, none -> -1."""
    b = bands.where(F.col("lang_id") == lang_id).select("band_id", "start_day", "end_day")
    j = O.band_join(fact, b, "advance_purchase_days", "start_day", "end_day", "left")
    d = F.col("advance_purchase_days")
    return (j.withColumn("advance_purchase_id", F.when(d.isNull(), -1).when(d < 0, 99)
                         .otherwise(F.coalesce("band_id", F.lit(-1))))
            .drop("band_id", "start_day", "end_day"))


def add_account(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """Group account by (company code, product); one row per key."""
    a = O.first_per_key(accounts.select(X.clean("comcode", upper=True).alias("comcode"),
                                        "travel_product_id", "group_account_id"),
                        ["comcode", "travel_product_id"], ["group_account_id"])
    return fact.join(a, ["comcode", "travel_product_id"], "left")


def add_department(fact: DataFrame, departments: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """Department by (account, cost centre); default 0."""
    d = O.first_per_key(
        departments.where(F.col("customer_system_id") == customer_system_id)
        .select("group_account_id", F.col("main_cc_value_id").alias("cost_center_id"), "department_id"),
        ["group_account_id", "cost_center_id"], ["department_id"])
    j = fact.join(d, ["group_account_id", "cost_center_id"], "left")
    return j.withColumn("department_id", F.coalesce("department_id", F.lit(0)))


def add_policy_group(fact: DataFrame, policies: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """Traveller policy group by (account, traveller category)."""
    p = O.first_per_key(
        policies.where(F.col("customer_system_id") == customer_system_id)
        .select("group_account_id", "traveler_category_id", "policy_id"),
        ["group_account_id", "traveler_category_id"], ["policy_id"])
    return fact.join(p, ["group_account_id", "traveler_category_id"], "left")


def link_penalty(fact: DataFrame, penalties: DataFrame) -> DataFrame:
    """The first exchange penalty per (dossier, traveller, prior ticket)
    is linked to the exchange whose own ticket that is; gross += penalty."""
    p = O.first_per_key(
        penalties.select("meta_dossier_id", "traveler_id", F.col("ticket_code_prior").alias("_prior"),
                         F.col("gross_amt").alias("penalty_linked"), F.col("record_key").alias("penalty_key")),
        ["meta_dossier_id", "traveler_id", "_prior"], ["penalty_key"])
    j = fact.join(p, (fact["meta_dossier_id"] == p["meta_dossier_id"])
                  & (fact["traveler_id"] == p["traveler_id"])
                  & (fact["ticket_code"] == p["_prior"])
                  & (fact["booking_type_id"] == X.BT_EXCHANGE), "left")
    j = j.drop(p["meta_dossier_id"]).drop(p["traveler_id"]).drop("_prior")
    return j.withColumn("gross_amt", F.col("gross_amt") + F.coalesce("penalty_linked", F.lit(0)))


def stage_penalties(stage: DataFrame, travel_product: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """The exchange penalties among a file's stage rows (purchases of ancillaries with a gross
    amount), in the product's currency; no rate: 0."""
    p = stage.where((F.col("business_category") == ANCILLARY) & (F.col("record_status_id") == PENALTY_STATUS)
                    & (F.col("booking_type_id") == X.BT_PURCHASE) & (F.col("gross_amt") > 0))
    tp = travel_product.select("travel_product_id", F.col("currency_code_storage").alias("currency_code"))
    p = p.join(tp, "travel_product_id", "inner").withColumns(
        {c: X.clean(c) for c in ("meta_dossier_id", "ticket_code_prior")})
    return O.fx_convert(p, fx_rates, "invoice_date", "currency", "currency_code", ["gross_amt"]).select(
        "meta_dossier_id", "traveler_id", "ticket_code_prior", "gross_amt", "record_key")


# ---- D40 / D48 / D49 / D51 segments --------------------------------------------------

def _airports(airports: DataFrame, lang_id: int = LANG_EN) -> DataFrame:
    return airports.where(F.col("lang_id") == lang_id).select(
        X.clean("airport_code", upper=True).alias("airport_code"), "country_code", "latitude", "longitude")


def load_segments(fact: DataFrame, seg_stage: DataFrame, airports: DataFrame) -> DataFrame:
    """D40 + D48: segment rows of the batch's tickets with both airports
    (role-playing joins) and signed great-circle miles."""
    a = _airports(airports)
    s = seg_stage.join(fact.select(*KEY, "base_amt"), KEY, "inner")
    s = O.join_role(s, a, "airport_from", "airport_code", "from_", ["country_code", "latitude", "longitude"])
    s = O.join_role(s, a, "airport_to", "airport_code", "to_", ["country_code", "latitude", "longitude"])
    miles = X.great_circle_miles("from_latitude", "from_longitude", "to_latitude", "to_longitude")
    return s.withColumn("mileage_cnt", miles * X.sign_factor("booking_type_id"))


def segment_values(segments: DataFrame) -> DataFrame:
    """value = miles / ticket miles * base; null when any mile of the
    ticket is missing or the total is 0."""
    return O.prorate(segments, KEY, "mileage_cnt", "base_amt", "segment_value")


LAST = 2 ** 31 - 1          # a priority behind all others


def least_geography(pair: Column, singles: Sequence[Column], default: Column) -> Column:
    """The pair's type where there is one; else the type of least priority among
    the singles and, unless all of them are known, the default.  Equal priorities
    go to the earlier single, then the default.  Singles and default are structs
    of priority and type."""
    complete = F.lit(True)
    for c in singles:
        complete = complete & c.isNotNull()
    offered = [*singles, F.when(~complete, default)]
    ranked = [F.when(c.isNotNull(), F.struct(F.coalesce(c["priority"], F.lit(LAST)).alias("priority"),
                                             F.lit(i).alias("place"), c["type"].alias("type")))
              for i, c in enumerate(offered)]
    return F.coalesce(pair, F.array_min(F.array_compact(F.array(*ranked)))["type"])


def segment_geography(segments: DataFrame, geo_country: DataFrame, geo_priority: DataFrame,
                      travel_product_col: str = "travel_product_id", line_of_business: int = 1,
                      from_country: str = "from_country_code",
                      to_country: str = "to_country_code") -> DataFrame:
    """The country pair's geography first; else the one of least priority
    among both countries' own and, where one of these is missing, the default
    (country '')."""
    ours = F.col("line_of_business_id") == line_of_business
    country = geo_country.where(ours).select(
        F.col("travel_product_id").alias("_product"), F.col("country_code").alias("_country"),
        F.col("country_code_destination").alias("_to"), F.col("geography_type_id").alias("type"))
    priority = geo_priority.where(ours & F.col("priority").isNotNull()).select(
        F.col("travel_product_id").alias("_product"), F.col("geography_type_id").alias("type"), "priority")
    own = (country.where(F.col("_to").isNull()).join(priority, ["_product", "type"])
           .groupBy("_product", "_country").agg(F.min(F.struct("priority", "type")).alias("_offer")))
    pairs = country.where(F.col("_to").isNotNull()).groupBy("_product", "_country", "_to").agg(
        F.min("type").alias("_pair"))
    # the segments' distinct country pairs are looked up, a few thousand rows whatever the number
    # of segments; the struct of a pair equals itself whatever is null in it
    pair = F.struct(F.col(travel_product_col).alias("_p"), F.col(from_country).alias("_f"), F.col(to_country).alias("_t"))
    out = segments.select(pair.alias("_asked")).distinct().select("_asked", "_asked.*")
    out = _with_value(out, own.where("_country != ''"), {"_p": "_product", "_f": "_country"}, "_offer", "_origin")
    out = _with_value(out, own.where("_country != ''"), {"_p": "_product", "_t": "_country"}, "_offer", "_destination")
    out = _with_value(out, own.where("_country = ''"), {"_p": "_product"}, "_offer", "_default")
    out = _with_value(out, pairs, {"_p": "_product", "_f": "_country", "_t": "_to"}, "_pair", "_both")
    chosen = least_geography(F.col("_both"), [F.col("_origin"), F.col("_destination")], F.col("_default"))
    known = out.select("_asked", chosen.alias("geography_type_id"))
    return segments.drop("geography_type_id").withColumn("_asked", pair).join(known, "_asked", "left").drop("_asked")


def _with_value(df: DataFrame, dim: DataFrame, on: dict[str, str], value: str, out: str) -> DataFrame:
    """``df`` with the ``value`` of the dimension row whose columns equal its own, as ``out``."""
    keys = {c: f"{out}_{k}" for k, c in enumerate(on.values())}
    d = dim.select(*[F.col(c).alias(k) for c, k in keys.items()], F.col(value).alias(out))
    same = reduce(lambda a, b: a & b, [df[c] == d[keys[k]] for c, k in on.items()])
    return df.join(d, same, "left").drop(*keys.values())


# ---- D42 / D50 / D52 flights -----------------------------------------------------------

def load_flights(fact: DataFrame, flight_stage: DataFrame, airports: DataFrame,
                 fx_rates: DataFrame) -> DataFrame:
    """Flight rows with signed miles and the flight value in storage
    currency (missing rate -> 0)."""
    a = _airports(airports)
    f = flight_stage.join(fact.select(*KEY, "increment_cnt", "currency_code", "invoice_date",
                                      F.col("currency").alias("_ccy")), KEY, "inner")
    f = O.join_role(f, a, "airport_from", "airport_code", "from_", ["latitude", "longitude"])
    f = O.join_role(f, a, "airport_to", "airport_code", "to_", ["latitude", "longitude"])
    f = f.withColumn("mileage_cnt", X.great_circle_miles("from_latitude", "from_longitude", "to_latitude",
                                                         "to_longitude") * X.sign_factor("booking_type_id"))
    f = O.fx_convert(f, fx_rates, "invoice_date", "_ccy", "currency_code", ["flight_value"], keep_rate=None)
    return f.drop("_ccy", "from_latitude", "from_longitude", "to_latitude", "to_longitude")


def load_trips(fact: DataFrame, trip_stage: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """D42 (train): trip rows of the batch's tickets with the trip value in storage currency
    (missing rate -> 0).  The stage names tickets by file and record key; where it has no booking
    type, a trip belongs to every booking of its record.  Miles and route are not given for trips."""
    on = [c for c in KEY if c in trip_stage.columns]
    own = fact.select(*KEY, "travel_product_id", "increment_cnt", "currency_code", "invoice_date", F.col("currency").alias("_ccy"))
    t = trip_stage.drop("travel_product_id", "increment_cnt", "currency_code", "invoice_date").join(own, on, "inner")
    t = O.fx_convert(t, fx_rates, "invoice_date", "_ccy", "currency_code", ["trip_value"], keep_rate=None)
    return (t.drop("_ccy", "invoice_date").withColumn("mileage_cnt", F.lit(None).cast("double"))
            .withColumn("route_id", F.lit(None).cast("int")))


def trip_geography(trips: DataFrame, segments: DataFrame, geo_priority: DataFrame, line_of_business: int = 5) -> DataFrame:
    """D52 (train): a trip takes the geography of least priority among its segments; a trip
    whose segments have none keeps its own."""
    best = rollup_geography(segments, KEY + ["trip_nbr"], geo_priority, line_of_business=line_of_business, out="_best")
    return (trips.join(best, KEY + ["trip_nbr"], "left")
            .withColumn("geography_type_id", F.coalesce("_best", "geography_type_id")).drop("_best"))


def flight_values(flights: DataFrame, segments: DataFrame, trip_col: str = "trip_nbr") -> DataFrame:
    """Flight value = strict sum of its segment values."""
    v = segments.groupBy(*KEY, trip_col).agg(O.strict_sum("segment_value").alias("_fv"))
    j = flights.join(v, KEY + [trip_col], "left")
    return j.withColumn("flight_value", F.col("_fv")).drop("_fv")


def rollup_geography(child: DataFrame, parent_keys: Sequence[str], geo_priority: DataFrame,
                     travel_product_col: str = "travel_product_id", line_of_business: int = 1,
                     out: str = "geography_type_id") -> DataFrame:
    """The geography with the smallest priority among the children
    (per parent key, booking type included — quirk Q5 fixed)."""
    gp = geo_priority.where(F.col("line_of_business_id") == line_of_business).select(
        F.col("travel_product_id").alias(travel_product_col), "geography_type_id", "priority")
    c = child.select(*parent_keys, travel_product_col, "geography_type_id").join(
        gp, [travel_product_col, "geography_type_id"], "inner")
    best = O.first_per_key(c.select(*parent_keys, "priority", "geography_type_id"), parent_keys,
                           ["priority", "geography_type_id"])
    return best.select(*parent_keys, F.col("geography_type_id").alias(out))


# ---- D60 / D61 routes ------------------------------------------------------------------

def route_candidates(df: DataFrame, from_col: str, to_col: str) -> DataFrame:
    f, t = F.upper(F.trim(from_col)), F.upper(F.trim(to_col))
    return df.select(F.concat_ws(":", f, t).alias("route_code"), f.alias("airport_from"),
                     t.alias("airport_to")).where(F.col("airport_from").isNotNull()
                                                  & F.col("airport_to").isNotNull()).distinct()


def with_both_ways(routes: DataFrame) -> DataFrame:
    """Routes with their form for both directions (smaller code first)."""
    lo, hi = F.least("airport_from", "airport_to"), F.greatest("airport_from", "airport_to")
    return routes.select("route_id", "route_code", "airport_from", "airport_to",
                         F.concat_ws(":", lo, hi).alias("route_code_bidirectional"),
                         lo.alias("airport_from_bidirectional"), hi.alias("airport_to_bidirectional"))


def upsert_routes(route_dim: DataFrame, candidates: DataFrame) -> DataFrame:
    """The new routes with surrogate keys, not stored; jobs keep them durably with
    ``Job.members``."""
    from itinera.sources import insert_new_members
    return with_both_ways(insert_new_members(candidates, route_dim, ["route_code", "airport_from", "airport_to"], "route_id"))


def add_route_id(df: DataFrame, route_dim: DataFrame, from_col: str, to_col: str,
                 out: str = "route_id") -> DataFrame:
    """Route id onto a ticket / flight / segment."""
    r = route_dim.select(F.col("airport_from").alias("_rf"), F.col("airport_to").alias("_rt"),
                         F.col("route_id").alias(out))
    j = df.join(r, (F.upper(F.trim(F.col(from_col))) == r["_rf"]) & (F.upper(F.trim(F.col(to_col))) == r["_rt"]),
                "left")
    return j.drop("_rf", "_rt")


# ---- D72-D74 names ---------------------------------------------------------------------

NAME_COLS = ["title", "first_name", "middle_name", "last_name"]


def traveler_names(fact: DataFrame, stage_names: DataFrame, anonymous: DataFrame | None = None,
                   approver_cols: Sequence[str] | None = None) -> DataFrame:
    """Traveller name per ticket from the stage (first per key by
    name), overridden by the company's anonymous name when configured."""
    n = O.first_per_key(stage_names.select(*KEY, *[X.clean(c).alias(c) for c in NAME_COLS]), KEY, NAME_COLS)
    j = fact.join(n, KEY, "left")
    if anonymous is not None:
        a = O.first_per_key(anonymous.select(X.clean("comcode", upper=True).alias("comcode"), "travel_product_id",
                                             *[F.col(c).alias(f"anon_{c}") for c in NAME_COLS]),
                            ["comcode", "travel_product_id"], [f"anon_{c}" for c in NAME_COLS])
        j = j.join(a, ["comcode", "travel_product_id"], "left")
        hit = F.col("anon_last_name").isNotNull()
        for c in NAME_COLS:
            j = j.withColumn(c, F.when(hit, F.col(f"anon_{c}")).otherwise(F.col(c))).drop(f"anon_{c}")
    return j


NAME_KEY = ["traveler_id", "customer_system_id"] + NAME_COLS


def name_candidates(with_names: DataFrame, name_dim: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """The (traveller, full name) members that tickets need; the full name is part of the
    natural key (Q7 fixed)."""
    system = F.lit(customer_system_id).cast(name_dim.schema["customer_system_id"].dataType)
    return with_names.where(F.col("last_name").isNotNull()).select(
        "traveler_id", system.alias("customer_system_id"), *NAME_COLS)


def add_name_id(with_names: DataFrame, name_dim: DataFrame, customer_system_id: int = 2) -> DataFrame:
    """``traveler_name_id`` of each ticket, compared null-safely."""
    keyed = with_names.withColumn("customer_system_id", F.lit(customer_system_id).cast(
        name_dim.schema["customer_system_id"].dataType))
    dim = name_dim.select(F.col("name_id").alias("traveler_name_id"), *[F.col(c).alias(f"_n_{c}") for c in NAME_KEY])
    cond = reduce(lambda a, b: a & b, [keyed[c].eqNullSafe(dim[f"_n_{c}"]) for c in NAME_KEY])
    return keyed.join(dim, cond, "left").drop(*[f"_n_{c}" for c in NAME_KEY])


def upsert_names(name_dim: DataFrame, with_names: DataFrame, customer_system_id: int = 2) -> tuple[DataFrame, DataFrame]:
    """(new members with keys, fact with ``traveler_name_id``); the members are not stored
    here, jobs keep them durably with ``Job.members``."""
    from itinera.sources import insert_new_members
    new = insert_new_members(name_candidates(with_names, name_dim, customer_system_id), name_dim, NAME_KEY, "name_id")
    full = name_dim.select("name_id", *NAME_KEY).unionByName(new.select("name_id", *NAME_KEY))
    return new, add_name_id(with_names, full, customer_system_id)


# ---- D76 custom fields ---------------------------------------------------------------

def custom_field_rows(stage: DataFrame, fields: dict[str, tuple[int, str]]) -> DataFrame:
    """A stage's custom columns, ``{column: (field id, field name)}``, as one row per value
    that is not null.  One scan, nothing is shuffled; columns that the stage lacks are skipped."""
    there = [c for c in fields if c in stage.columns]
    keyed = stage.withColumn("booking_type_id", F.coalesce("booking_type_id", F.lit(0)).cast("short"))
    rows = O.unpivot_nonnull(keyed, KEY, there, "_column", "field_value", "string") if there else keyed.select(
        *KEY, F.lit(None).cast("string").alias("_column"), F.lit(None).cast("string").alias("field_value")).where("false")
    return rows.select(*KEY, X.map_code("_column", {c: fields[c][0] for c in there}).cast("int").alias("field_id"),
                       X.map_code("_column", {c: fields[c][1] for c in there}).cast("string").alias("field_name"), "field_value")


def custom_values(t: dict, stage: DataFrame) -> DataFrame | None:
    """A job's custom values: ``custom_field_long`` as given, or unpivoted from the stage's
    ``custom_field_columns``; None where neither is given."""
    if "custom_field_columns" in t:
        return custom_field_rows(stage, t["custom_field_columns"])
    return t.get("custom_field_long")


def custom_fields(fact: DataFrame, cdf_long: DataFrame, departments: DataFrame,
                  customer_system_id: int = 2) -> DataFrame:
    """Non-null custom values, first per (ticket, field) by (name,
    value); plus the department name as field 0."""
    v = cdf_long.where(F.col("field_value").isNotNull()).join(fact.select(*KEY), KEY, "inner")
    first = O.first_per_key(v.select(*KEY, "field_id", "field_name", "field_value"), KEY + ["field_id"],
                            ["field_name", "field_value"])
    d = departments.where(F.col("customer_system_id") == customer_system_id).select(
        "department_id", F.col("name").alias("field_value"))
    dept = fact.select(*KEY, "department_id").join(d, "department_id").select(
        *KEY, F.lit(0).alias("field_id"), "field_value")
    return first.select(*KEY, "field_id", "field_value").unionByName(dept)
