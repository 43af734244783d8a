"""Readers, writers and their options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tablestream.operators import quality as Q
from tablestream.sinks import tables as K
from tablestream.sources import database as D, files as R, topic as TP

from .conftest import rows


def test_topic_options():
    o = TP.topic_options("h:9092", "orders", {1: 5, 0: 3}, end="latest", max_per_trigger=100)
    assert o["startingOffsets"] == '{"orders": {"0": 3, "1": 5}}' and o["endingOffsets"] == "latest" and o["maxOffsetsPerTrigger"] == "100"
    assert TP.topic_options("h:9092", "orders")["startingOffsets"] == "earliest"


def test_topic_values_with_header(spark):
    d = spark.createDataFrame([(b"k", b"\x00\x00\x00\x00\x07" + b'{"id": 1, "name": "x"}', 0, 12), (b"k", b"\x00\x00\x00\x00\x07broken", 0, 13)], "key binary, value binary, partition int, offset bigint")
    assert rows(TP.parse_values(d, "id int, name string", framed=True), "offset", "id", "name") == [(12, 1, "x"), (13, None, None)]


def test_jdbc_options_and_statement():
    o = D.jdbc_read_options("jdbc:x", "claims", "id", (0, 1000), 8)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "1000", "8")
    with pytest.raises(ValueError):
        D.jdbc_read_options("jdbc:x", "claims", "id")
    assert D.upsert_statement("t", "t_staging", ["id"], ["id", "n", "at"]) == \
        "INSERT INTO t (id, n, at) SELECT id, n, at FROM t_staging ON CONFLICT (id) DO UPDATE SET n = EXCLUDED.n, at = EXCLUDED.at"


def test_retries_then_raises():
    calls = []

    def fail_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
    D.with_retries(fail_twice, 3, 0.0)
    assert len(calls) == 3
    with pytest.raises(OSError):
        D.with_retries(lambda: (_ for _ in ()).throw(OSError("down")), 2, 0.0)


def test_json_keeps_or_drops_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\nnonsense\n{"id": 2, "name": "x", "more": true}\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    kept = R.read_json(spark, str(tmp_path), schema)
    assert rows(kept, "id", R.CORRUPT) == [(None, "nonsense"), (1, None), (2, None)]
    assert rows(R.read_json(spark, str(tmp_path), schema, keep_bad=False), "id") == [(1,), (2,)]


def test_comments_travel_with_the_schema(spark):
    d = R.with_comments(spark.range(3), {"id": "key"})
    assert d.schema["id"].metadata["comment"] == "key" and d.count() == 3


def test_empty_like(spark):
    e = R.empty_like(spark.range(2), {"discount": "decimal(10,2)"})
    assert e.dtypes == [("id", "bigint"), ("discount", "decimal(10,2)")] and e.count() == 0


def frame(spark, data):
    return spark.createDataFrame(data, "k string, v int, at int")


def test_upsert_out_of_order_tombstone_and_retry(spark, tmp_path):
    p = str(tmp_path / "t")
    gone = F.col("v") < 0
    K.write_upsert(frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 5, 1)]), p, "k", "at", 1, gone)
    K.write_upsert(frame(spark, [("a", 0, 0), ("b", -1, 3), ("c", 7, 1)]), p, "k", "at", 2, gone)
    assert rows(K.read_upsert(spark, p, "k", "at"), "k", "v") == [("a", 2), ("c", 7)]
    K.write_upsert(frame(spark, [("a", 0, 0), ("b", -1, 3), ("c", 7, 1)]), p, "k", "at", 2, gone)
    assert rows(K.read_upsert(spark, p, "k", "at"), "k", "v") == [("a", 2), ("c", 7)]
    assert rows(K.read_upsert(spark, p, "k", "at", upto=1), "k", "v") == [("a", 2), ("b", 5)]
    assert K.compact_upsert(spark, p, f"{p}-c", "k", "at") == 2
    K.write_upsert(frame(spark, [("b", 9, 2)]), f"{p}-c", "k", "at", 3, gone)           # older than the delete
    assert rows(K.read_upsert(spark, f"{p}-c", "k", "at"), "k", "v") == [("a", 2), ("c", 7)]


def test_retract_log(spark, tmp_path):
    p = str(tmp_path / "r")
    K.write_retract(frame(spark, [("a", 1, 1), ("b", 2, 1)]), p, "k", "at", 1)
    for _ in range(2):
        K.write_retract(frame(spark, [("a", 3, 2), ("b", 2, 1), ("c", 4, 1)]), p, "k", "at", 2)
    assert rows(spark.read.parquet(p).filter("_batch = 2"), "row_kind", "k", "v") == [("+I", "c", 4), ("+U", "a", 3), ("-U", "a", 1)]
    assert rows(K.read_retract(spark, p, "k"), "k", "v") == [("a", 3), ("b", 2), ("c", 4)]


def test_incremental_load_reads_only_newer(spark, tmp_path):
    p = str(tmp_path / "i")
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i)) for i in range(5)], "id int, at timestamp")
    K.incremental_append(src.filter("id < 3"), p, "at")
    new = K.incremental_append(src, p, "at")
    assert rows(new, "id") == [(3,), (4,)] and spark.read.parquet(p).count() == 5
    assert "GreaterThan" in str(new._jdf.queryExecution().optimizedPlan().toString()) or "at" in new.columns


def test_materialized_versions(spark, tmp_path):
    p = str(tmp_path / "m")
    with pytest.raises(ValueError):
        K.read_materialized(spark, p)
    K.materialize_full(lambda: spark.range(3), p)
    K.materialize_full(lambda: spark.range(7), p)
    assert K.read_materialized(spark, p).count() == 7


def test_text_noop_console_sinks(spark, tmp_path, capsys):
    K.write_text(spark.range(2), str(tmp_path / "t"), F.concat(F.lit("n"), F.col("id").cast("string")))
    assert rows(R.read_text(spark, str(tmp_path / "t"))) == [("n0",), ("n1",)]
    K.write_noop(spark.range(5))
    K.write_console(spark.range(1))
    assert "id" in capsys.readouterr().out


def test_bucketed_join_needs_no_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in ("l", "r"):
            K.write_bucketed(spark.range(1000).withColumn(n, F.col("id") * 2), f"bucketed_{n}", "id", 4, path=str(tmp_path / n))
        j = spark.table("bucketed_l").join(spark.table("bucketed_r"), "id")
        assert j.count() == 1000 and "Exchange hashpartitioning(id" not in j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in ("l", "r"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{n}")


def test_quality_helpers(spark):
    d = spark.createDataFrame([("1", "x", "2024-01-01"), ("", "y", "2024-02-02"), ("3000000000", "1.5", None)], "a string, b string, c string")
    assert rows(Q.infer_types(d), "column", "type") == [("a", "BIGINT"), ("b", "STRING"), ("c", "DATE")]
    assert Q.assert_schema(d, {"a": "string", "b": "int", "e": "string"}) == ["missing column e", "column b is string, not int", "unexpected column c"]
    same = Q.expect_equal(d, d, "b").first()
    assert same.test_result == "PASS"
    other = Q.expect_equal(d, d.withColumn("a", F.lit("z")), "b").first()
    assert (other.test_result, other.matching_rows) == ("FAIL", 0)


def test_schema_evolution_by_union(spark):
    from tablestream.operators.relational import union_all
    a, b = spark.createDataFrame([(0,), (1,)], "id int"), spark.createDataFrame([(0, "x")], "id int, extra string")
    assert rows(union_all([a, b], allow_missing=True)) == [(0, None), (0, "x"), (1, None)]
