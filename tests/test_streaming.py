"""Streams fed by several files: parity with batch, late rows, lateness, idle partitions, lookups, upserts."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tablestream.operators import dedup as DD, over as O, temporal as T, windows as W
from tablestream.sinks import tables as K
from tablestream.streaming import stateful as ST, streams as S

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id int, k string, at timestamp, v double"


def write_files(spark, folder, batches, schema=SCHEMA):
    """One file per batch, in order of modification time."""
    os.makedirs(folder, exist_ok=True)
    for i, b in enumerate(batches):
        part = f"{folder}-{i}"
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(part)
        src = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.link(f"{part}/{src}", f"{folder}/{i}.parquet")
        stamp = time.time() - 1000 + i * 10
        os.utime(f"{folder}/{i}.parquet", (stamp, stamp))


def stream(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def at(sec):
    return T0 + dt.timedelta(seconds=sec)


def batches(n=5, per=20, step=7):
    out, i = [], 0
    for b in range(n):
        part = []
        for _ in range(per):
            part.append((i, "uvw"[i % 3], at(i * step), float(i % 11)))
            i += 1
        out.append(part)
    out.append([(9999, None, at(10_000_000), 0.0)])            # heartbeat: lets the last windows out
    return out


def go(spark, df, path, mode="append", keys=()):
    S.run_stream(df, f"{path}/out", f"{path}/chk", mode, keys)
    return spark.read.parquet(f"{path}/out")


@pytest.fixture
def source(spark, tmp_path):
    b = batches()
    write_files(spark, str(tmp_path / "in"), b)
    real = spark.createDataFrame([r for x in b[:-1] for r in x], SCHEMA)
    return S.with_watermark(stream(spark, str(tmp_path / "in")), "at", "10 seconds"), real, str(tmp_path)


def test_tumble_and_session_parity(spark, source):
    s, real, path = source
    aggs = {"n": ("count", "*"), "t": ("sum", "v")}
    assert rows(go(spark, S.stream_tumble(s, "at", "1 minute", "k", aggs), f"{path}/a")) == rows(W.tumble(real, "at", "1 minute", "k", aggs))
    assert rows(go(spark, S.stream_session(s, "at", "21 seconds", "k", aggs), f"{path}/b")) == rows(W.session(real, "at", "21 seconds", "k", aggs))


def test_over_range_on_change_count_window_parity(spark, source):
    s, real, path = source
    got = go(spark, ST.stream_over_range(s.withColumn("label", F.col("id").cast("string")), "k", "at", "1 minute", "label", "v"), f"{path}/a").filter("k is not null")
    want = O.over_range(real, "k", "at", "1 minute", {"n": ("count", "*"), "t": ("sum", "v")})
    assert rows(got.select(F.col("label").cast("int").alias("id"), "n", "total")) == rows(want.select("id", "n", "t"))
    got = go(spark, ST.stream_on_change(s.withColumn("c", (F.col("v") > 5).cast("string")), "k", "at", "c", "id"), f"{path}/b").filter("k is not null")
    want = O.on_change(real.withColumn("c", (F.col("v") > 5).cast("string")), "k", ["at"], "c")
    assert rows(got.select(F.col("id").cast("int").alias("id"))) == rows(want.select("id"))


def test_missing_followup_and_pairs(spark, source):
    s, real, path = source
    op, cl = F.col("v") < 4, F.col("v") > 8
    got = go(spark, ST.stream_missing_followup(s, "k", "at", op & F.col("k").isNotNull(), cl, "40 seconds", "id"), f"{path}/a")
    want = T.missing_followup(real, "k", "at", op, cl, "40 seconds")
    assert rows(got.select(F.col("id").cast("int").alias("id"))) == rows(want.select("id"))
    pairs = go(spark, ST.stream_pair_once(s, "k", "at", F.col("v") == 1, F.col("v") == 2, "id"), f"{path}/b")
    left = [x[0] for x in rows(pairs.select("left_id"))]
    assert len(left) == len(set(left)) and all(int(b) % 11 == 2 for b in [x[0] for x in rows(pairs.select("right_id"))])


def test_keep_first_and_keep_last(spark, source):
    s, real, path = source
    first = go(spark, S.dedup_ttl(S.with_watermark(stream(spark, f"{path}/in"), "at", "100 days").filter("k is not null"), "k").select("id", "k"), f"{path}/a")
    assert rows(first) == rows(DD.dedup_first(real, "k", "at").select("id", "k"))
    K.materialize_stream(stream(spark, f"{path}/in").filter("k is not null"), f"{path}/t", f"{path}/c", "k", "at").awaitTermination()
    assert rows(K.read_upsert(spark, f"{path}/t", "k", "at")) == rows(DD.dedup_last(real, "k", "at"))


def test_late_rows_reach_their_own_table(spark, tmp_path):
    p = str(tmp_path)
    write_files(spark, f"{p}/in", [[(1, "a", at(0), 0.0), (2, "a", at(100), 0.0)], [(3, "a", at(95), 0.0), (4, "a", at(60), 0.0)], [(5, "a", at(300), 0.0)], [(6, "a", at(200), 0.0), (7, "a", at(291), 0.0)]])
    S.split_late(spark, stream(spark, f"{p}/in"), "at", "10 seconds", f"{p}/ok", f"{p}/late", f"{p}/marks", f"{p}/chk")
    assert rows(spark.read.parquet(f"{p}/late").select("id")) == [(4,), (6,)]
    assert rows(spark.read.parquet(f"{p}/ok").select("id")) == [(1,), (2,), (3,), (5,), (7,)]


def test_late_row_fires_its_window_again(spark, tmp_path):
    p = str(tmp_path)
    write_files(spark, f"{p}/in", [[(1, "a", at(1), 1.0)], [(2, "a", at(70), 1.0)], [(4, "a", at(71), 1.0)], [(3, "a", at(5), 1.0)]])
    aggs = {"n": ("count", "*")}
    w = S.stream_tumble(S.allowed_lateness(stream(spark, f"{p}/in"), "at", "1 second", "5 minutes"), "at", "1 minute", "k", aggs)
    d = go(spark, w, f"{p}/a", "update", ["window_start", "k"])
    assert rows(d.filter(F.col("window_start") == F.lit(T0)), "n") == [(1,), (2,)]
    strict = S.stream_tumble(S.with_watermark(stream(spark, f"{p}/in"), "at", "1 second"), "at", "1 minute", "k", aggs)
    d = go(spark, strict, f"{p}/b", "update", ["window_start", "k"])
    assert rows(d.filter(F.col("window_start") == F.lit(T0)), "n") == [(1,)]


def test_idle_partitions_do_not_hold_back_windows(spark, tmp_path):
    """Partitions 2 and 3 go silent after 20 s; the window [50 s, 60 s) still comes out."""
    p = str(tmp_path)
    phase1 = [(s * 4 + q, str(q), at(s), 0.0) for s in range(21) for q in range(4)]
    phase2 = [(1000 + s * 4 + q, str(q), at(s), 0.0) for s in range(21, 60) for q in (0, 1)]
    write_files(spark, f"{p}/in", [phase1, phase2, [(5000, "0", at(100), 0.0)]])
    w = S.stream_tumble(S.with_watermark(stream(spark, f"{p}/in"), "at", "2 seconds"), "at", "10 seconds", None, {"n": ("count", "*")})
    got = go(spark, w, p).orderBy("window_start")
    assert [r.n for r in got.collect()] == [40, 40, 22, 20, 20, 20]


def test_processing_time_windows(spark, source):
    s, real, path = source
    w = S.processing_time_tumble(stream(spark, f"{path}/in"), "1 hour", "k", {"n": ("count", "*")})
    got = go(spark, w, f"{path}/a", "update", ["window_start", "k"])
    assert got.groupBy("k").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] >= real.count() // 2


def test_lookup_sees_the_table_of_each_batch(spark, tmp_path):
    p = str(tmp_path)
    write_files(spark, f"{p}/in", [[(1, "a", at(0), 0.0)], [(2, "a", at(1), 0.0)]])
    dims = iter([[("x", "old")], [("a", "new")]])

    def write(found, missing, i):
        found.unionByName(missing).write.mode("overwrite").parquet(f"{p}/out/_batch={i}")

    S.lookup_each_batch(stream(spark, f"{p}/in"), lambda: spark.createDataFrame(next(dims), "k string, label string"), "k", write, f"{p}/chk")
    assert rows(spark.read.parquet(f"{p}/out"), "id", "lookup_status") == [(1, "FAILED"), (2, "SUCCESS")]


def test_one_stream_many_sinks(spark, tmp_path):
    p = str(tmp_path)
    write_files(spark, f"{p}/in", batches()[:2])
    each = K.fan_out_stream({"all": lambda b, i: b.write.mode("overwrite").parquet(f"{p}/all/_batch={i}"), "big": lambda b, i: b.filter("v > 5").write.mode("overwrite").parquet(f"{p}/big/_batch={i}")})
    stream(spark, f"{p}/in").writeStream.foreachBatch(each).option("checkpointLocation", f"{p}/chk").trigger(availableNow=True).start().awaitTermination()
    assert (spark.read.parquet(f"{p}/all").count(), spark.read.parquet(f"{p}/big").filter("v <= 5").count()) == (40, 0)


def test_interval_join_with_outer_rows(spark, tmp_path):
    b, path = batches(), str(tmp_path)
    real = spark.createDataFrame([r for x in b[:-1] for r in x], SCHEMA)
    write_files(spark, f"{path}/in", [*b[:-1], [(9999, "beat", at(10_000_000), 0.0)]])       # a NULL key would be dropped before the watermark
    l = S.with_watermark(stream(spark, f"{path}/in"), "at", "10 seconds").filter("v < 3 or id = 9999").select("id", "k", "at")
    r = S.with_watermark(stream(spark, f"{path}/in"), "at", "10 seconds").filter("v > 8 or id = 9999").select(F.col("id").alias("rid"), "k", F.col("at").alias("rt"))
    got = go(spark, S.stream_join_interval(l, r, "k", "at", "rt", "-30 seconds", "10 seconds", "left").select("id", "rid"), path).filter("id <> 9999")
    want = T.join_interval(real.filter("v < 3").select("id", "k", "at"), real.filter("v > 8").select(F.col("id").alias("rid"), "k", F.col("at").alias("rt")), "k", "at", "rt", "-30 seconds", "10 seconds", "left")
    assert rows(got) == rows(want.select("id", "rid"))
