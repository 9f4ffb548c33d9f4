from pyspark.sql import functions as F

from tessella.operators.state import latest
from tessella.sources.store import Store
from tessella.streaming import windows as W


def stream(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_streak_over_batches(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "k string, t int, kind string"
    put(spark, folder, [("a", 2, "fail"), ("a", 1, "fail"), ("b", 1, "ok")], schema)
    put(spark, folder, [("a", 3, "other"), ("a", 4, "fail"), ("a", 5, "ok"), ("b", 2, "fail")], schema)
    out = W.run_to_folder(W.streak_state(stream(spark, folder, schema, 9), "k", "kind", "t", "fail", "ok"), "update")
    assert sorted(map(tuple, out.collect())) == [("a", 0, 3), ("b", 1, 1)]


def test_counter_goes_on_after_a_restart(spark, tmp_path):
    folder, schema, target, check = str(tmp_path / "in"), "k string, t int, n long", Store(spark, str(tmp_path)), str(tmp_path / "check")
    keep = lambda df, n: target.append("grown", df)
    put(spark, folder, [("a", 1, 5), ("a", 2, 9)], schema)
    W.run_batches(W.counter_state(stream(spark, folder, schema), "k", "t", "n"), keep, check)
    put(spark, folder, [("a", 3, 4), ("a", 4, 6)], schema)
    W.run_batches(W.counter_state(stream(spark, folder, schema), "k", "t", "n"), keep, check)
    assert sorted(r["grown"] for r in target.log("grown", "k string, grown long").collect()) == [6, 9]


def test_file_sink_is_exactly_once(spark, tmp_path):
    folder, schema, out, check = str(tmp_path / "in"), "k string, t int", str(tmp_path / "out"), str(tmp_path / "check")
    for k in range(2):
        put(spark, folder, [(f"r{k}", k)], schema)
        W.run_to_table(stream(spark, folder, schema), out, check)
    W.run_to_table(stream(spark, folder, schema), out, check)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["r0", "r1"]


def test_upsert_by_batches(spark, tmp_path):
    folder, schema, s = str(tmp_path / "in"), "k string, v int, t string", Store(spark, str(tmp_path))
    put(spark, folder, [("a", 1, "x"), ("b", 1, "y")], schema)
    put(spark, folder, [("a", 2, "z"), ("a", 0, "w")], schema)
    W.run_batches(stream(spark, folder, schema), lambda df, n: s.upsert("t", df, "k", "v"), str(tmp_path / "check"))
    assert sorted(map(tuple, s.load("t").select("k", "v", "t").collect())) == [("a", 2, "z"), ("b", 1, "y")]
    assert latest(s.load("t"), "k", "v").count() == 2


def test_windows_are_the_same_on_tables(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source = W.event_stream(spark, data, "events.parquet", spark.read.parquet(f"{data}/events.parquet").schema)
    for n, make in enumerate((lambda df: W.tumbling(df, "1 day", ["event_type"]), lambda df: W.sessions(df, "3 hours", ["user_id"]))):
        got = W.run_to_folder(make(source), "complete").drop("total")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, make(events).drop("total").collect()))


def test_late_rows_are_dropped(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "ts timestamp, event_type string, value double"
    at = lambda h: F.timestamp_seconds(F.lit(h * 3600))
    for n, hours in enumerate([[1, 1, 30], [31], [2, 90]]):
        df = spark.createDataFrame([(h, "e", 1.0) for h in hours], "h int, event_type string, value double").select(F.timestamp_seconds(F.col("h") * 3600).alias("ts"), "event_type", "value")
        df.coalesce(1).write.parquet(f"{folder}/part={n}")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(folder)
    out = W.run_to_folder(W.tumbling(src, "1 hour", ["event_type"], late="5 hours"), "append")
    got = {r["begin"].hour + 24 * (r["begin"].day - 1): r["n"] for r in out.collect()}
    assert got.get(1) == 2 and 2 not in got
