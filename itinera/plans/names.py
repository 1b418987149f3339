"""Names of travellers and approvers on the ERP extract.

A traveller's name comes from up to three sources, in this order: the traveller table (not
for occasional travellers), the alias on the document line, the dossier's fields.  The source
with the fewest missing names (first, last) wins, then the earlier one; a source without any
name, or with a placeholder for one, does not count.  The bodies of the name functions are
not given; the alias form, the field names and the placeholders here are our own choice.

All sources hang on keys of the ticket (one row a key is kept: the newest extract, then the
smallest name), so a ticket is joined once to each and the choice is an expression.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from itinera import functions as X
from itinera import operators as O
from itinera.plans.file_loads import NAME_COLS, NAME_KEY

LINE = ["extract_id", "product_id", "document_no", "line_no"]
TICKET = ["record_key", "booking_type_id"]
# our choice: words that stand where no name is known; dossier fields that hold name parts
NOT_A_NAME = ("NA", "N/A", "TBA", "UNKNOWN", "-", ".")
NAME_FIELDS = {"title": "TRAVELLER_TITLE", "first_name": "TRAVELLER_FIRST_NAME", "last_name": "TRAVELLER_LAST_NAME"}
# fixed values: customer system of these names; status of a ticket without its names
CUSTOMER_SYSTEM = 2
STATUS_NO_NAME = 9


def part(c) -> Column:
    """A trimmed name part, '' where it is missing or a placeholder."""
    t = F.coalesce(X.clean(c), F.lit(""))
    return F.when(F.upper(t).isin(*NOT_A_NAME), "").otherwise(t)


def named(title, first, last) -> Column:
    """A source's offer: the number of missing names and the parts."""
    f, l = part(first), part(last)
    missing = F.when(f == "", 1).otherwise(0) + F.when(l == "", 1).otherwise(0)
    return F.struct(missing.alias("missing"), part(title).alias("title"), f.alias("first_name"),
                    F.lit("").alias("middle_name"), l.alias("last_name"))


def alias_parts(alias) -> tuple[Column, Column]:
    """(first, last) of 'LAST/FIRST', or of 'FIRST .. LAST' where there is no slash."""
    t = X.clean(alias)
    slash = F.instr(t, "/") > 0
    last = F.when(slash, F.substring_index(t, "/", 1)).otherwise(F.substring_index(t, " ", -1))
    first = F.when(slash, F.substring_index(t, "/", -1)).otherwise(F.left(t, F.greatest(F.length(t) - F.length(last), F.lit(0))))
    return first, last


def best_offer(offers: Sequence[Column]) -> Column:
    """The offer (struct of ``named``) with the fewest missing names, then the earliest; null
    where none has a name.  ``source`` is its position from 1."""
    ranked = [F.when(o["missing"] < 2, F.struct(o["missing"].alias("missing"), F.lit(i).alias("source"),
                                                *[o[c].alias(c) for c in NAME_COLS])) for i, o in enumerate(offers, 1)]
    return F.array_min(F.array_compact(F.array(*ranked)))


def newest_person(travellers: DataFrame, extract_id, regular_only: bool) -> DataFrame:
    """(product_id, no, offer): each person's newest row up to the extract."""
    t = travellers.where(F.col("extract_id") <= F.lit(extract_id))
    if regular_only:
        t = t.where(F.col("is_occasional") == 0)
    t = t.select("product_id", X.clean("no").alias("no"), "extract_id",
                 named("title", "first_name", "name").alias("offer"))
    return O.first_per_key(t, ["product_id", "no"], ["-extract_id", "offer"]).select("product_id", "no", "offer")


def field_names(fields: DataFrame, extract_id, keys: Mapping[str, str] = NAME_FIELDS) -> DataFrame:
    """(metaid, product_id, offer): the dossier's newest value of each name field, in one aggregate."""
    f = fields.where((F.col("extract_id") <= F.lit(extract_id)) & F.col("fld_key").isin(*keys.values()))
    newest = f.groupBy("metaid", "product_id").agg(*[
        F.max(F.when(F.col("fld_key") == k, F.struct("extract_id", "fld_value"))).alias(p) for p, k in keys.items()])
    value = lambda p: F.col(f"{p}.fld_value")
    return newest.select("metaid", "product_id", named(value("title"), value("first_name"), value("last_name")).alias("offer"))


def traveller_names(tickets: DataFrame, extract_id, travellers: DataFrame | None = None, lines: DataFrame | None = None,
                    fields: DataFrame | None = None) -> DataFrame:
    """``tickets`` with the traveller's name parts and ``name_source``, null where no source
    names anybody.  Tickets have product_id, traveler_code, meta_dossier_id and the line's key."""
    out, offers = tickets, []
    if travellers is not None:
        p = newest_person(travellers, extract_id, True).select(F.col("product_id").alias("_p"), F.col("no").alias("_no"),
                                                               F.col("offer").alias("_person"))
        out = out.join(p, (F.col("product_id") == F.col("_p")) & (X.clean("traveler_code") == F.col("_no")), "left").drop("_p", "_no")
        offers.append("_person")
    if lines is not None:
        first, last = alias_parts("traveller_alias")
        a = lines.select(*LINE, named(F.lit(None).cast("string"), first, last).alias("_alias"))
        out = out.join(O.first_per_key(a, LINE, ["_alias"]), LINE, "left")
        offers.append("_alias")
    if fields is not None:
        d = field_names(fields, extract_id).select(F.col("metaid").alias("_m"), F.col("product_id").alias("_p"),
                                                   F.col("offer").alias("_field"))
        out = out.join(d, (F.col("meta_dossier_id") == F.col("_m")) & (F.col("product_id") == F.col("_p")), "left").drop("_m", "_p")
        offers.append("_field")
    if not offers:
        nobody = F.lit(None).cast("string")
        return out.select("*", *[nobody.alias(c) for c in NAME_COLS], F.lit(None).cast("int").alias("name_source"))
    best = out.withColumn("_best", best_offer([F.col(o) for o in offers])).drop(*offers)
    return best.select(*tickets.columns, *[F.col(f"_best.{c}").alias(c) for c in NAME_COLS],
                       F.col("_best.source").alias("name_source"))


def approver_names(tickets: DataFrame, extract_id, travellers: DataFrame, anonymous: DataFrame | None = None) -> DataFrame:
    """The approver as a second role: the newest row of the traveller table, blank parts
    where there is none, replaced by the company's anonymous name where one is configured
    (product, group account); null parts on tickets without an approver."""
    p = newest_person(travellers, extract_id, False).select(F.col("product_id").alias("_p"), F.col("no").alias("_no"),
                                                            F.col("offer").alias("_person"))
    code = F.col("approver_id").cast("string")
    out = tickets.join(p, (F.col("product_id") == F.col("_p")) & (code == F.col("_no")), "left").drop("_p", "_no")
    hit = F.lit(False)
    if anonymous is not None:
        a = anonymous.select("product_id", "group_account_id", F.struct(
            *[F.coalesce(X.clean(c), F.lit("")).alias(c) for c in NAME_COLS]).alias("_anon"))
        a = O.first_per_key(a, ["product_id", "group_account_id"], ["_anon"])
        out = out.join(a, ["product_id", "group_account_id"], "left")
        hit = F.col("_anon").isNotNull()
    has = F.col("approver_id").isNotNull()
    pick = lambda c: F.when(has, F.when(hit, F.col(f"_anon.{c}") if anonymous is not None else F.lit(None))
                            .otherwise(F.coalesce(F.col(f"_person.{c}"), F.lit(""))))
    return out.select(*tickets.columns, *[pick(c).alias(f"approver_{c}") for c in NAME_COLS])


def file_approver_names(tickets: DataFrame, stage: DataFrame, anonymous: DataFrame | None = None) -> DataFrame:
    """D73 of the file loads: the approver's parts from the stage row of the ticket's key, each
    replaced by the company's anonymous name's where that has one, blank where neither has;
    null parts on tickets without an approver.  Stages have approver_title, approver_first_name
    and so on; of several rows a key or company the smallest counts."""
    staged = [f"approver_{c}" for c in NAME_COLS]
    s = O.first_per_key(stage.select("file_id", "record_key", F.struct(*[X.clean(c).alias(c) for c in staged]).alias("_own")),
                        ["file_id", "record_key"], ["_own"])
    plain = tickets.drop(*staged)
    out = plain.join(s, ["file_id", "record_key"], "left")
    offers = {c: [F.col(f"_own.approver_{c}")] for c in NAME_COLS}
    if anonymous is not None:
        a = anonymous.select(X.clean("comcode", upper=True).alias("_company"), F.struct(*NAME_COLS).alias("_anon"))
        out = out.join(O.first_per_key(a, ["_company"], ["_anon"]), X.clean("comcode", upper=True) == F.col("_company"), "left")
        offers = {c: [F.col(f"_anon.{c}"), *o] for c, o in offers.items()}
    has = F.col("approver_id").isNotNull()
    return out.select(*plain.columns, *[F.when(has, F.coalesce(*o, F.lit(""))).alias(f"approver_{c}") for c, o in offers.items()])


def resolve_names(tickets: DataFrame, extract_id, travellers: DataFrame, lines: DataFrame | None = None,
                  fields: DataFrame | None = None, anonymous: DataFrame | None = None) -> DataFrame:
    """D72 and D73 of the tickets; without an ``approver_id`` column there is no second role."""
    out = traveller_names(tickets, extract_id, travellers, lines, fields)
    if "approver_id" not in tickets.columns:
        return out.select("*", F.lit(None).cast("int").alias("approver_id"),
                          *[F.lit(None).cast("string").alias(f"approver_{c}") for c in NAME_COLS])
    return approver_names(out, extract_id, travellers, anonymous if "group_account_id" in tickets.columns else None)


def name_members(named_tickets: DataFrame, name_dim: DataFrame, customer_system_id: int = CUSTOMER_SYSTEM) -> DataFrame:
    """The members that both roles need, one relation."""
    kind = name_dim.schema
    roles = F.array(*[F.struct(F.col(i).cast(kind["traveler_id"].dataType).alias("traveler_id"),
                               F.lit(customer_system_id).cast(kind["customer_system_id"].dataType).alias("customer_system_id"),
                               *[F.col(f"{p}{c}").alias(c) for c in NAME_COLS])
                      for i, p in (("traveler_id", ""), ("approver_id", "approver_"))])
    return (named_tickets.select(F.explode(roles).alias("_r")).select("_r.*")
            .where(F.col("traveler_id").isNotNull() & F.col("last_name").isNotNull()).distinct())


def add_name_ids(named_tickets: DataFrame, name_dim: DataFrame, customer_system_id: int = CUSTOMER_SYSTEM) -> DataFrame:
    """``traveler_name_id`` and ``approver_name_id`` of each ticket.  A person or part that
    is null has no member; of repeated members the smallest id counts."""
    dim = (name_dim.where(F.col("customer_system_id") == customer_system_id)
           .groupBy(*[c for c in NAME_KEY if c != "customer_system_id"]).agg(F.min("name_id").alias("_id")))
    out = named_tickets
    for person, prefix, id_col in (("traveler_id", "", "traveler_name_id"), ("approver_id", "approver_", "approver_name_id")):
        d = dim.select(F.col("traveler_id").alias("_t"), *[F.col(c).alias(f"_d_{c}") for c in NAME_COLS], F.col("_id").alias(id_col))
        same = F.col(person) == F.col("_t")
        for c in NAME_COLS:
            same = same & (F.col(f"{prefix}{c}") == F.col(f"_d_{c}"))
        out = out.join(d, same, "left").drop("_t", *[f"_d_{c}" for c in NAME_COLS])
    return out


def mark_missing_name(status, traveler_name, approver, approver_name) -> Column:
    """Status 9 where the traveller, or a given approver, has no name."""
    missing = traveler_name.isNull() | (approver_name.isNull() & approver.isNotNull())
    return F.when(missing, F.lit(STATUS_NO_NAME)).otherwise(status)
