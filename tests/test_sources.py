import datetime as dt

from pyspark.sql import functions as F

from itinera.plans import file_loads as FL
from itinera.sources import (append_slice, drop_rows, insert_absent, like, literal_dim, read_slice,
                             read_table, register_keys, sales_lines, log_step)


def test_source_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 11)], "k int, v string, batch int")
    assert read_slice(df, "batch", 10).count() == 2
    inv = spark.createDataFrame([(1, "I1")], "k int, doc string")
    cr = spark.createDataFrame([(2, "C1", "x")], "k int, doc string, extra string")
    sl = sales_lines(inv, cr)
    assert sorted((r.doc, r.doc_kind, r.extra) for r in sl.collect()) == [("C1", "C", "x"), ("I1", "I", None)]
    empty = like(df, {"k": "long"})
    assert empty.count() == 0 and dict(empty.dtypes)["k"] == "bigint"
    tgt = spark.createDataFrame([(2,)], "k int")
    assert sorted(r.k for r in insert_absent(df, tgt, ["k"]).collect()) == [1, 3]
    assert sorted(r.k for r in drop_rows(df, F.col("v") == "a", anti=tgt, keys=["k"]).collect()) == [3]
    keys = register_keys(df.withColumn("k2", F.col("k")), ["k"], 18)
    assert sorted((r.k, r.fact_type_id) for r in keys.collect()) == [(1, 18), (2, 18), (3, 18)]
    path = str(tmp_path / "t")
    append_slice(df, path, ["batch"])
    assert read_table(spark, str(tmp_path), "t").count() == 3
    lit = literal_dim(spark, [(1, "x")], "id int, name string")
    assert lit.count() == 1
    log = str(tmp_path / "log")
    log_step(spark, log, 7, "expand", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1))
    assert spark.read.parquet(log).collect()[0].step == "expand"


def test_anonymous_names(spark):
    fact = spark.createDataFrame([(7, "K1", 1, "ACME", 10), (7, "K2", 1, "OTHER", 10)],
                                 "file_id int, record_key string, booking_type_id short, comcode string, travel_product_id int")
    names = spark.createDataFrame([(7, "K1", 1, "Mr", " John ", None, "Smith"), (7, "K2", 1, "Ms", "Ann", None, "Lee")],
                                  "file_id int, record_key string, booking_type_id short, title string, first_name string, "
                                  "middle_name string, last_name string")
    anon = spark.createDataFrame([(" acme ", 10, None, "Anonymous", None, "Traveller")],
                                 "comcode string, travel_product_id int, title string, first_name string, "
                                 "middle_name string, last_name string")
    got = {r.record_key: (r.first_name, r.last_name) for r in FL.traveler_names(fact, names, anon).collect()}
    assert got == {"K1": ("Anonymous", "Traveller"), "K2": ("Ann", "Lee")}
