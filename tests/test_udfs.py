"""User-function shapes."""

from pyspark.sql import functions as F

from tablestream.functions import udfs as U
from tablestream.operators import aggs as A, joins as J, relational as R

from .conftest import rows


def frame(spark):
    return spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", 4.0)], "k string, v double")


def test_scalar_and_registered(spark):
    f = U.scalar_function(lambda v: v + 1, "double")
    assert rows(frame(spark).select(f("v").alias("y"))) == [(2.0,), (3.0,), (5.0,), (7.0,)]
    U.register(spark, "twice", lambda v: v * 2, "double")
    assert rows(frame(spark).select(F.expr("twice(v)").alias("y")))[0] == (12.0,)


def test_aggregate_function_and_accumulator(spark):
    by_pandas = rows(U.aggregate_function(frame(spark), "k", lambda v: float(v.mean()), "v", "m"))
    by_parts = rows(U.accumulate(frame(spark), "k", {"s": F.sum("v"), "n": F.count("v")}, F.col("s") / F.col("n"), "m"))
    assert by_pandas == by_parts == [("a", 3.0), ("b", 4.0)]


def test_table_functions(spark):
    d = spark.createDataFrame([(1, "to be  or"), (2, "")], "id int, text string")
    assert rows(J.join_lateral(d, U.split_words("text"), ["w", "n"]), "id", "w", "n") == [(1, "be", 2), (1, "or", 2), (1, "to", 2)]
    assert J.join_lateral(d, U.split_words("text"), ["w", "n"], how="left").count() == 4
    assert rows(U.table_aggregate_top(frame(spark), "k", "v", 2), "k", "v", "rank") == [("a", 2.0, 2), ("a", 6.0, 1), ("b", 4.0, 1)]


def test_predict_and_external_call(spark):
    one = U.predict(frame(spark), lambda x: x["v"] * 10, "v")
    assert rows(one, "prediction") == [(10.0,), (20.0,), (40.0,), (60.0,)]
    two = U.predict(frame(spark).withColumn("w", F.lit(1.0)), lambda x: x["v"] + x["w"], ["v", "w"])
    assert rows(two, "prediction")[0] == (2.0,)
    called = U.call_external(frame(spark), lambda r: {"ok": r["v"] > 1.5, "tag": f"t{int(r['v'])}"}, "v", "ok boolean, tag string")
    assert rows(called, "v", "ok", "tag") == [(1.0, False, "t1"), (2.0, True, "t2"), (4.0, True, "t4"), (6.0, True, "t6")]


def test_apply_window_lets_a_function_stop_early(spark):
    from tablestream.operators import windows as W
    import datetime as dt
    d = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0, i % 50), i) for i in range(500)] + [("b", dt.datetime(2024, 1, 1), 1)], "k string, at timestamp, v int")

    def first(key, parts):
        yield key[2], int(next(iter(parts))["v"].iloc[0] >= 0)

    def total(key, parts):
        yield key[2], int(sum(p["v"].sum() for p in parts))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        assert rows(W.apply_window(d, "at", "1 hour", "k", first, "k string, n int")) == [("a", 1), ("b", 1)]
        assert rows(W.apply_window(d, "at", "1 hour", "k", total, "k string, n bigint")) == [("a", sum(range(500))), ("b", 1)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_arrays_in_parts(spark):
    d = spark.createDataFrame([("a", i, f"x{i}") for i in range(7)] + [("b", 0, "y")], "k string, seq int, v string")
    got = {(r.k, r.part): [x.v for x in r["items"]] for r in A.collect_parts(d, "k", "seq", "v", 3).collect()}
    assert got == {("a", 0): ["x0", "x1", "x2"], ("a", 1): ["x3", "x4", "x5"], ("a", 2): ["x6"], ("b", 0): ["y"]}


def test_normalize_out_and_back(spark):
    d = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", 5)], "id int, kind string, discount int")
    base, side = R.normalize_out(d, "id", ["kind", "discount"], "kind_id")
    assert side.count() == 2 and rows(base.join(side, "kind_id").select("id", "kind", "discount")) == rows(d)
