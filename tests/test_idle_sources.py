"""Several streams with a watermark each: the slowest holds the time, a silent one is let go by a heartbeat."""

import datetime as dt

from tablestream.streaming import streams as S

SCHEMA = "ts timestamp, v int"


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def test_silent_source_is_released(spark, tmp_path):
    own = S.tune(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", "2")
    schema = own.createDataFrame([], SCHEMA).schema
    sources = {n: (f"{tmp_path}/{n}", f"{tmp_path}/beats-{n}") for n in ("a", "b", "never")}
    for folders in sources.values():
        for f in folders:
            own.createDataFrame([], schema).write.mode("append").parquet(f)

    def put(name, *seconds):
        own.createDataFrame([(at(x), x) for x in seconds] + [(None, 0)], schema).coalesce(1).write.mode("append").parquet(sources[name][0])

    def once():
        d = S.union_of_sources(own, sources, schema, "ts", "0 seconds", files=100)
        d = S.stream_tumble(d, "ts", "10 seconds", None, {"n": ("count_if", f"not {S.BEAT}")}).filter("n > 0")
        S.run_stream(d, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        return {r.window_start.second: r.n for r in own.read.parquet(f"{tmp_path}/out").collect()}

    assert S.release_idle(own, sources, schema, "ts", "5 seconds") == []          # no row anywhere: nothing to compare with
    put("a", 1, 12, 35, 41, 52, 55)
    put("b", 2, 15, 28)
    assert once() == {}                                                            # one source has not begun
    assert S.release_idle(own, sources, schema, "ts", "40 seconds") == ["never"]
    assert once() == {0: 2, 10: 2}                                                 # the slowest source is at 28 s
    put("a", 59)
    put("b", 33)
    assert once() == {0: 2, 10: 2}
    assert S.release_idle(own, sources, schema, "ts", "40 seconds") == []
    assert once() == {0: 2, 10: 2, 20: 1}                                          # 33 s now
    put("a", 65)
    assert once() == {0: 2, 10: 2, 20: 1}
    assert S.release_idle(own, sources, schema, "ts", "20 seconds") == ["b"]
    assert once() == {0: 2, 10: 2, 20: 1, 30: 2, 40: 1}                            # the lagging source's row at 33 s was not late
    assert S.release_idle(own, sources, schema, "ts", "5 seconds") == ["never"]
    assert once() == {0: 2, 10: 2, 20: 1, 30: 2, 40: 1, 50: 3}                     # 50-60 s is out while two sources are silent
