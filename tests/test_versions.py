"""Versioned tables, views of streams, the store of keys, streaks and observed counts."""

import os
import random
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ironsift.operators import ranges, triage
from ironsift.operators.dedup import latest_per_key
from ironsift.sources.versions import Conflict, VersionedTable
from ironsift.streaming import ingest
from ironsift.streaming.key_store import KeyStore, once_per_key
from ironsift.streaming.streaks import ROCKS, streak_state


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_writer_that_dies_before_its_manifest(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert table.read() is None
    table.append(spark.range(3).coalesce(1))
    table.stage(spark.range(100).coalesce(1))  # and no commit
    assert values(table.read()) == [0, 1, 2]
    assert table.collect_garbage(grace=3600) == 0
    assert table.collect_garbage(grace=-10) == 1
    assert values(table.read()) == [0, 1, 2]


def test_two_writers(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.append(spark.range(1).coalesce(1))
    base = table.manifest()
    jobs = [threading.Thread(target=lambda k=k: VersionedTable(spark, f"{tmp_path}/t").append(spark.range(k, k + 1).coalesce(1))) for k in range(1, 6)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert values(table.read()) == list(range(6))
    with pytest.raises(Conflict):
        table.rewrite(spark.range(1), base)
    assert values(table.read()) == list(range(6))
    old = table.manifest()
    table.rewrite(table.read(old).filter("id > 3"), old)
    assert values(table.read()) == [4, 5] and values(table.read(old)) == list(range(6))
    table.rewrite(spark.range(0), table.manifest())
    assert table.read().count() == 0


def test_only_one_creates_a_manifest(spark, tmp_path):
    files = VersionedTable(spark, f"{tmp_path}/t").files
    made = []
    jobs = [threading.Thread(target=lambda k=k: made.append((files.create("_log/x.json", str(k)), str(k)))) for k in range(8)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert [k for ok, k in made if ok] == [files.read("_log/x.json")]
    assert list(files.names("_log")) == ["x.json"]


def test_a_hundred_batches(spark, tmp_path):
    step = ingest.latest_view(f"{tmp_path}/v", ["k"], "ts", "seq", compact=10, grace=-10)
    latest = {}
    for batch in range(100):
        rows = [((batch * 7 + j) % 13, f"{batch:03d}", j, batch) for j in range(3)]
        latest |= {k: (k, ts, seq, b) for k, ts, seq, b in rows}
        step(spark.createDataFrame(rows, "k long, ts string, seq long, b long").coalesce(1), batch)
    view = ingest.read_latest(spark, f"{tmp_path}/v", ["k"], "ts", "seq")
    assert sorted(map(tuple, view.collect())) == sorted(latest.values())
    assert sum(len(f) for _, _, f in os.walk(tmp_path)) < 100
    before = VersionedTable(spark, f"{tmp_path}/v").versions()
    step(spark.createDataFrame([(99, "000", 0, 0)], "k long, ts string, seq long, b long"), 99)  # a repeat of a batch that is folded in
    assert VersionedTable(spark, f"{tmp_path}/v").versions() == before


def test_store_reads_what_a_batch_may_hit(spark, tmp_path):
    store = KeyStore(spark, f"{tmp_path}/s", "k", buckets=8, fold_after=100)
    rows = VersionedTable(spark, f"{tmp_path}/r")
    step = once_per_key(store, rows)
    batches = [[(k,) for k in range(a, a + 400)] for a in (0, 350, 1000, 2000)]
    for i, batch in enumerate(batches):
        step(spark.createDataFrame(batch, "k long"), i)
    assert values(rows.read()) == sorted({k for b in batches for (k,) in b})
    n_files = store.filters.read().count()
    few = spark.createDataFrame([(5,), (10**9,)], "k long")
    assert n_files > 20 and 1 <= len(store.files_to_read(few, 9)) <= 3
    step(spark.createDataFrame(batches[3], "k long"), 3)  # a repeat
    assert values(rows.read()) == sorted({k for b in batches for (k,) in b})


def test_store_folds(spark, tmp_path):
    store = KeyStore(spark, f"{tmp_path}/s", "k", buckets=4, fold_after=3)
    rows = VersionedTable(spark, f"{tmp_path}/r")
    step = once_per_key(store, rows)
    for i in range(9):
        step(spark.createDataFrame([(k,) for k in range(i * 20, i * 20 + 30)] + [(None,)], "k long"), i)
        assert store.filters.read().count() <= 4 * 5
    assert values(rows.read()) == list(range(190))


def streaks_of(spark, folder, schema, name, delay):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        out = streak_state(stream, "bad", "ok", 3, delay)
        out.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.table(name).collect()))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


SCHEMA = "source string, seq long, status string, t long"


def outcomes(spark, n, seed, sources):
    pick = random.Random(seed)
    rows = [(pick.choice(sources), k, pick.choice(["bad", "bad", "bad", "ok", "other"]), k + 1) for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("t")).drop("t")


def batch_streaks(df):
    out = ranges.streaks(df, "source", "seq", "bad", "ok", 3).select("source", "seq", "status", "streak", "stopped")
    return sorted(map(tuple, out.collect()))


def test_streaks_of_one_large_batch(spark, tmp_path):
    df = outcomes(spark, 25_000, 1, ["s"])
    df.orderBy(F.rand(3)).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    last = spark.createDataFrame([("z", 0, "ok", 10**6), ("s", 10**6, "ok", 10**6)], SCHEMA).withColumn("ts", F.timestamp_seconds("t")).drop("t")
    last.coalesce(1).write.parquet(f"{tmp_path}/in/b")
    spark.createDataFrame([("z", 1, "ok", 10**6)], SCHEMA).withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(f"{tmp_path}/in/c")
    got = [r for r in streaks_of(spark, f"{tmp_path}/in/*", df.schema, "one_batch", "0 seconds") if r[0] == "s" and r[1] < 10**6]
    assert got == batch_streaks(df)


def test_streaks_with_rows_late_by_a_batch(spark, tmp_path):
    df = outcomes(spark, 900, 2, ["a", "b", "c"])
    late = (F.col("seq") / 100).cast("int") + F.when(F.col("seq") % 7 == 0, 1).otherwise(0)
    for k in range(10):
        df.filter(late == k).orderBy(F.rand(k)).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    for k in (10, 11):
        end = [(x, 10**6 + k, "ok", 10**6) for x in "abcz"]
        spark.createDataFrame(end, SCHEMA).withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(f"{tmp_path}/in/x{k}")
    got = [r for r in streaks_of(spark, f"{tmp_path}/in/*", df.schema, "late_rows", "300 seconds") if r[1] < 10**6]
    assert got == batch_streaks(df)


def test_observed_counts_of_batch_and_stream(spark, tmp_path):
    items = spark.createDataFrame([(k,) for k in range(40)], "k long")
    keys, short, done = items.filter("k % 2 = 0"), items.filter("k % 3 = 0").union(items.limit(3)), items.filter("k > 30")
    seen = Observation()
    triage.counted_work_list(items, "k", seen, keys, short, done).write.parquet(f"{tmp_path}/list")
    assert values(spark.read.parquet(f"{tmp_path}/list")) == values(triage.work_list(items, "k", keys, short, done))
    steps = {r.step: r.n_after for r in triage.work_list_counts(items, "k", keys, short, done).collect()}
    assert seen.get == {"total": 40, **steps}
    items.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(items.schema).parquet(f"{tmp_path}/in").observe("counts", F.count("*").alias("total"), F.count_if(F.col("k") > 30).alias("old"))
    q = stream.writeStream.format("noop").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress.observedMetrics["counts"].asDict() == {"total": 40, "old": 9}


def test_latest_view_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(k % 5, f"{k % 17:02d}", k) for k in range(60)], "k long, ts string, seq long")
    step = ingest.latest_view(f"{tmp_path}/v", ["k"], "ts", "seq", compact=2)
    for b in range(3):
        step(df.filter(F.col("seq") % 3 == b), b)
        step(df.filter(F.col("seq") % 3 == b), b)  # repeated
    got = ingest.read_latest(spark, f"{tmp_path}/v", ["k"], "ts", "seq")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, latest_per_key(df, ["k"], "ts", "seq").collect()))
