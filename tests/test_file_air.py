from decimal import Decimal as D

from pyspark.sql import functions as F

from itinera.plans import file_loads as FL
from itinera.plans.pipelines import run_file_air
from tests.fixtures import air_tables


def by_key(df, cols):
    return {r["record_key"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_seed(spark):
    t = air_tables(spark)
    s = FL.seed_file_fact(t["air_ticket"], t["booking_type"], 7)
    assert sorted((r.record_key, r.booking_type_id) for r in s.collect()) == [("K1", 1), ("K2", 5), ("K3", 0)]


def test_pipeline_end_to_end_and_idempotent(spark, tmp_path):
    t = air_tables(spark)
    out = run_file_air(spark, t, 7, str(tmp_path))
    fact = out["fact"]
    got = by_key(fact, ["comcode", "advance_purchase_days", "advance_purchase_id", "ticket_amt", "tax_amt",
                        "group_account_id", "department_id", "policy_id", "increment_cnt", "central_bill"])
    # K1 purchase: booked 2024-02-20, travel 2024-04-01 -> 41 days, band 3; GBP at 1.15
    assert got["K1"] == ("ACME", 41, 3, D("115.000000000000"), D("23.000000000000"), 500, 900, 70, 1, 1)
    # K2 exchange: booked after issue, travel before issue -> -1 -> band 99; EUR rate 1
    assert got["K2"][1:3] == (-1, 99) and got["K2"][5:7] == (500, 901)
    # K3 null type -> 0; USD rate missing -> amounts 0; other type keeps null days -> band -1
    assert got["K3"][1:4] == (None, -1, D("0E-12")) or got["K3"][1:4] == (None, -1, D("0"))
    assert fact.count() == 3
    segs = out["segments"]
    v = {(r.record_key, r.segment_nbr): (r.segment_value, r.geography_type_id) for r in segs.collect()}
    # K1 two legs of equal miles share the base 80 GBP * 1.15 = 92 -> 46 each
    assert abs(float(v[("K1", 1)][0]) - 46.0) < 1e-6 and abs(float(v[("K1", 2)][0]) - 46.0) < 1e-6
    # GB -> FR: the pair (FR, GB) does not apply in that direction; GB prio 20 < FR prio 30 -> 2
    assert v[("K1", 1)][1] == 2
    # FR -> GB: the city pair wins -> 3
    assert v[("K1", 2)][1] == 3
    flights = by_key(out["flights"], ["flight_value", "geography_type_id"])
    assert abs(float(flights["K1"][0]) - 92.0) < 1e-6 and flights["K1"][1] == 3
    fin = by_key(fact, ["route_id", "traveler_name_id", "ticket_geography_type_id", "first_name"])
    assert fin["K1"][0] == 1 and fin["K1"][1] == 1 and fin["K1"][2] == 3
    assert fin["K2"][3] == "Ann" and fin["K2"][1] == 2
    routes = sorted(r.route_code for r in out["new_routes"].collect())
    assert routes == ["CDG:LHR", "JFK:LHR", "LHR:LHR"] or "CDG:LHR" in routes
    cdf = sorted((r.record_key, r.field_id, r.field_value) for r in out["custom_fields"].collect())
    assert cdf == [("K1", 0, "Sales"), ("K1", 3, "v9"), ("K2", 0, "Ops"), ("K3", 0, "Sales")]
    # re-run of the same batch replaces its rows
    out2 = run_file_air(spark, t, 7, str(tmp_path))
    assert out2["fact"].count() == 3
    assert spark.read.parquet(str(tmp_path / "air_fact")).where(F.col("file_id") == 7).count() == 3


def test_two_files_in_a_row_share_members(spark, tmp_path):
    """Members are stored before facts use them: no id has two meanings."""
    t, root = air_tables(spark), str(tmp_path)
    first = run_file_air(spark, t, 7, root)
    second = run_file_air(spark, t, 8, root)
    for dim, key, out in (("routes", "route_id", second["routes"]), ("names", "name_id", second["names"])):
        before, after = ({r[key]: tuple(x for c, x in sorted(r.asDict().items()) if c != key) for r in d.collect()}
                         for d in (first[dim], out))
        assert before.items() <= after.items() and len(set(after.values())) == len(after) == out.count()
    dim = {r.route_id: (r.airport_from, r.airport_to) for r in second["routes"].collect()}
    for table in ("air_fact", "air_segment_fact", "air_flight_fact"):
        rows = spark.read.parquet(f"{root}/{table}").where("airport_from is not null and airport_to is not null").collect()
        assert rows and all(dim[r.route_id] == (r.airport_from, r.airport_to) for r in rows)

