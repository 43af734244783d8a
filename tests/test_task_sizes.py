"""What a task or a state store is given grows no faster than the input."""

import datetime as dt

from pyspark.sql import functions as F

from tablestream.operators import windows as W
from tablestream.operators.core import tasks_for
from tablestream.plans.registry import load_all
from tablestream.streaming import streams as S

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)


def rolled_stream(spark, tmp_path, made, schema, *args):
    """Rows of the rolling stream, and how many rows each of its states wrote."""
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    s = S.with_watermark(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "at", "1 minute")
    d = S.stream_rolling_features(s, "at", "k", "v", *args)
    q = d.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/out").start()
    q.awaitTermination()
    wrote = {}
    for p in q.recentProgress:
        for i, o in enumerate(p.stateOperators):
            wrote[i] = wrote.get(i, 0) + o.numRowsUpdated
    return spark.read.parquet(f"{tmp_path}/out"), wrote


def test_rolling_stream_writes_a_bucket_fewer_times_than_it_has_windows(spark, tmp_path):
    made = [(f"k{i % 7}" if i % 11 else None, T0 + dt.timedelta(minutes=97 * i), float(i) if i % 5 else None) for i in range(200)]
    made.append(("end", T0 + dt.timedelta(days=400), 0.0))               # moves the watermark past everything else
    got, wrote = rolled_stream(spark, tmp_path, made, "k string, at timestamp, v double")
    want = W.rolling_features(spark.createDataFrame(made, "k string, at timestamp, v double").filter("k is null or k <> 'end'"), "at", "k", "v")
    assert rows(got, *want.columns) == rows(want)
    buckets = len({(k, at.replace(minute=0)) for k, at, _ in made})
    assert max(wrote.values()) <= 5 * buckets                            # each of them lies in twelve windows


def test_rolling_stream_horizons_of_any_length(spark, tmp_path):
    made = [("a", T0 + dt.timedelta(minutes=131 * i), float(i)) for i in range(40)]
    end = [("end", T0 + dt.timedelta(days=400), 0.0)]
    got, _ = rolled_stream(spark, tmp_path, made + end, "k string, at timestamp, v double", "1 hour", 10, 3)
    want = W.rolling_features(spark.createDataFrame(made, "k string, at timestamp, v double"), "at", "k", "v", "1 hour", 10, 3)
    assert rows(got, *want.columns) == rows(want)


def test_completeness_joins_in_tasks_of_bounded_size(spark, tmp_path):
    """However few shuffle partitions are set, a task of the join gets about 250,000 lines."""
    n = 1_300_000
    spark.range(n).select((F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 4).cast("int").alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(n // 4).select(F.col("id").alias("o_orderkey"), (F.col("id") % 100).alias("o_custkey"), F.lit(1.0).alias("o_totalprice"), F.lit(T0).alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    d = load_all()["x13_completeness"](spark, str(tmp_path))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert ", 6), REPARTITION_BY_NUM" in plan
    assert d.count() == 20
    assert tasks_for(0) == 1 and tasks_for(250_000) == 1 and tasks_for(250_001) == 2
