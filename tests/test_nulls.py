"""Results do not depend on the bucket, and no null drops a row."""

import pytest
from pyspark.sql import functions as F

from itinera.operators import lookups, scans, shaping
from itinera.plans.amounts import surcharges
from itinera.plans.hotel_train import train_route_text
from itinera.sources import replace_batch

ROWS = [("a", 1, 10, 1), ("a", 50, 20, 2), ("a", 3700, 30, 3), ("a", None, 40, 4), (None, 5, 50, 5), (None, None, 60, 6)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "k string, t long, v long, id long").withColumn("t", F.timestamp_seconds("t"))


@pytest.mark.parametrize("bucket", [scans.time_bucket(60), scans.range_bucket(3)])
def test_scans_with_nulls(rows, bucket):
    for scan in (lambda b: scans.sequence_number(rows, ["k"], ["t", "id"], "x", bucket=b),
                 lambda b: scans.running_sum(rows, ["k"], ["t", "id"], "v", "x", bucket=b),
                 lambda b: scans.with_next(rows, ["k"], ["t", "id"], ["id"], "x", bucket=b),
                 lambda b: scans.split_by_gap(rows, ["k"], ["t", "id"], ["id"], lambda p: p["id"] == 2, "x", bucket=b)):
        plain = sorted((r["id"], str(r["x"])) for r in scan(None).collect())
        assert sorted((r["id"], str(r["x"])) for r in scan(bucket).collect()) == plain and len(plain) == 6


@pytest.mark.parametrize("bucket", [None, scans.time_bucket(60), scans.range_bucket(3)])
def test_asof_with_nulls(rows, bucket):
    right = rows.select("k", F.col("t").alias("rt"), F.col("id").alias("rid"))
    got = scans.asof_join(rows, right, ["k"], "t", "rt", ["rid"], out="m", bucket=bucket).collect()
    assert {r["id"]: r["m"] and r["m"]["rid"] for r in got} == {1: 1, 2: 2, 3: 3, 4: None, 5: None, 6: None}


def test_prorate_and_dedupe_keep_null_rows(rows):
    out = shaping.prorate(rows, ["k"], "v", "v", "x").collect()
    assert len(out) == 6 and all(r["x"] is None for r in out if r["k"] is None)
    total = shaping.dedupe_two_pass(rows.withColumn("g", F.lit(1)), ["k"], "t", ["g"], "v", "x").first()
    assert (total["x"], total["x_rows"]) == (30 + 40 + 50 + 60, 4)


def test_not_in_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    got = lambda other: sorted(str(r[0]) for r in lookups.not_in(left, "a", other, "b").collect())
    side = lambda *v: spark.createDataFrame([(x,) for x in v], "b int")
    assert (got(side(2)), got(side(2, None)), got(side())) == (["1"], [], ["1", "2", "None"])


def test_empty_batch_replaces_and_stays_readable(spark, tmp_path):
    df = spark.createDataFrame([(1, 7), (2, 8)], "k int, file_id int")
    for batch in (7, 8):
        replace_batch(df, str(tmp_path), "file_id", batch)
    assert spark.read.parquet(str(tmp_path)).count() == 2
    replace_batch(df.limit(0), str(tmp_path), "file_id", 7)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path)).collect()] == [(2, 8)]
    replace_batch(df.limit(0), str(tmp_path / "first"), "file_id", 7)
    assert spark.read.parquet(str(tmp_path / "first")).count() == 0


def test_train_text_open_leg_and_unknown(spark):
    segs = spark.createDataFrame([(7, "K", 1, n, a, b, 1) for n, (a, b) in enumerate(["AB", "CD", "DZ"], 1)],
                                 "file_id int, record_key string, booking_type_id short, segment_nbr int, "
                                 "station_from string, station_to string, lang_id int")
    st = spark.createDataFrame([("A", "Ay", 1), ("B", "Be", 1), ("C", "Ce", 1), ("D", "De", 1)],
                               "station_code string, city_name string, lang_id int")
    assert train_route_text(segs, st).first()["route_txt"] == "Ay/Be_Ce/De/Unknown"


def test_newest_extract_of_surcharges_holds(spark):
    lines = spark.createDataFrame([(1, "F", "X")], "product_id int, file_name string, crs string")
    tagged = spark.createDataFrame([(1, 1, "F", "TAX", 1, "    12.50 YQ"), (1, 2, "F", "TAX", 1, "    20.00 YQ")],
                                   "product_id int, extract_id int, file_name string, tag string, line_id int, text1 string")
    assert [float(r.yq_amt) for r in surcharges(tagged, lines).collect()] == [20.0]
