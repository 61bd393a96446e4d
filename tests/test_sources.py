"""Readers, writers and streams over small files."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from ironsift.operators import gate, match, quality, worklist
from ironsift.operators.dedup import latest_per_key
from ironsift.sources import tables
from ironsift.sources.versions import VersionedTable
from ironsift.streaming import ingest
from tests.conftest import DATA

SCHEMA = "item string, n long"
LINES = ['{"item": "a", "n": 1}', "", "   ", "{broken", '{"item": "b"}', '{"item": "c", "n": "x"}', "7"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rows_and_audit(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text("\n".join(LINES))
    good, bad = tables.read_rows_audited(spark, str(tmp_path), SCHEMA)
    assert rows(good) == [("a", 1), ("b", None)] and rows(tables.read_rows(spark, str(tmp_path), SCHEMA)) == rows(good)
    assert rows(bad) == [("7",), ('{"item": "c", "n": "x"}',), ("{broken",)]


def test_manifests(spark, tmp_path):
    for k, drivers in (("a", [{"sha": "x"}, {"sha": "y"}]), ("b", [])):
        (tmp_path / f"{k}.json").write_text(json.dumps({"source": k, "drivers": drivers}, indent=1))
    got = tables.read_manifests(spark, f"{tmp_path}/*.json", "source string, drivers array<struct<sha: string>>")
    assert rows(got.select("source", "pos", "driver.sha")) == [("a", 0, "x"), ("a", 1, "y"), ("b", None, None)]
    assert {r.path.rsplit("/", 1)[1] for r in got.collect()} == {"a.json", "b.json"}


def test_profiles(spark, tmp_path):
    (tmp_path / "alpha.json").write_text(json.dumps({"must_have_one": ["x", "y"], "device_name": ["^d"], "weights": {"must_have_one": 3}}))
    (tmp_path / "beta.json").write_text("{not a document")
    got = tables.read_profiles(spark, f"{tmp_path}/*.json")
    assert rows(got["symbols"]) == [("alpha", "must_have_one", "x"), ("alpha", "must_have_one", "y")]
    assert rows(got["patterns"]) == [("alpha", "device_name", "^d")] and rows(got["weights"]) == [("alpha", "must_have_one", 3)]


def test_xml_catalog(spark, tmp_path):
    part = lambda path, date, size, kind, cat: f'<SoftwareComponent path="{path}" dateTime="{date}" size="{size}"><ComponentType value="{kind}"/>' + (f'<Category value="{cat}"/>' if cat else "") + "</SoftwareComponent>"
    parts = [part("a\\b\\c.exe", "2024-02-01", 10, "DRVR", "NI"), part("d/e.exe", "2023-01-01", 20, "drvr", "CS"), part("f.exe", "2022", 5, "BIOS", "CS"), part("g.exe", "2022", 2 << 20, "DRVR", "CS"), part("h.exe", "2022", 1, "DRVR", "")]
    (tmp_path / "catalog.xml").write_bytes(("<?xml version='1.0' encoding='utf-16'?><Manifest>" + "\n".join(parts) + "</Manifest>").encode("utf-16"))
    components = tables.read_xml_catalog(spark, f"{tmp_path}/catalog.xml")
    assert components.count() == 5 and {r.category for r in components.collect()} == {"NI", "CS", "?"}
    got = [(r.url, r.name, r.size) for r in tables.driver_packages(components, max_mb=1, base="https://h/").collect()]
    assert got == [("https://h/d/e.exe", "e.exe", 20), ("https://h/a/b/c.exe", "c.exe", 10)]


def binary(machine, subsystem):
    head = bytearray(256)
    head[:2], head[0x3C:0x40] = b"MZ", struct.pack("<I", 64)
    head[64:68], head[68:70], head[64 + 92 : 64 + 94] = b"PE\0\0", struct.pack("<H", machine), struct.pack("<H", subsystem)
    return bytes(head)


def test_corpus_and_headers(spark, tmp_path):
    import hashlib

    (tmp_path / "sub").mkdir()
    files = {"a.sys": binary(0x8664, 1), "sub/b.sys": b"MZ", "c.bin": b"x"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    got = {r.name: r for r in tables.header_census(tables.scan_corpus(spark, str(tmp_path))).collect()}
    assert {n: r.sha256 for n, r in got.items()} == {n.rsplit("/", 1)[-1]: hashlib.sha256(c).hexdigest() for n, c in files.items()}
    assert (got["a.sys"].machine, got["a.sys"].subsystem, got["a.sys"].size) == (0x8664, 1, 256)
    assert got["b.sys"].machine is None and got["c.bin"].subsystem is None


def test_key_list_and_gate(spark, tmp_path):
    (tmp_path / "keys.txt").write_text("# all\nAB  # one\n\ncd\nEFG\n")
    assert rows(tables.read_key_list(spark, f"{tmp_path}/keys.txt")) == [("ab",), ("cd",), ("efg",)]
    keys = tables.read_key_list(spark, f"{tmp_path}/keys.txt", 2)
    assert rows(keys) == [("ab",), ("cd",)]
    section = "array<struct<name: string, raw_ptr: long, raw_size: long, executable: boolean, entropy: double>>"
    fine, packed = [(".text", 0, 5, True, 6.0)], [(".text", 0, 5, True, 7.9), (".data", 0, 5, False, 1.0)]
    items = [("AB", 9, 1, 1, True, ["hal.dll"], fine), ("c", 0, 1, 1, True, ["hal.dll"], fine), ("d", 9, 1, 1, True, [], fine), ("e", 9, 1, 7, True, ["x"], fine), ("f", 9, 1, 1, False, ["HAL.dll"], fine), ("g", 9, 1, 1, True, ["ks.sys"], packed), ("h", 9, None, 1, True, None, None), ("i", 4, 1, 1, True, ["hal.dll"], fine)]
    heads = spark.createDataFrame(items, f"item string, size long, machine int, subsystem int, has_signature boolean, modules array<string>, sections {section}")
    got = {r["item"]: (r.reason, r.reason_detail) for r in gate.gate(heads, keys.select(F.col("key").alias("item")), "present").collect()}
    assert got["AB"] == ("blacklisted", "on the blocklist") and got["c"][1] == "no content" and got["d"][1] == "nothing is imported"
    assert got["e"] == ("wrong-subsystem", "subsystem 7, POSIX_CUI, isn't 1") and got["f"][0] == "signature-policy-mismatch"
    assert got["g"] == ("packed-unknown", "code of an entropy up to 7.90, all over 7.5") and got["h"][0] == "not-pe" and got["i"][1] == "section .text reaches to 5 in a file of 4"
    assert [x for x in gate.gate(heads, keys.limit(0).select(F.col("key").alias("item"))).filter("reason IS NULL").select("item").collect() if x[0] == "f"]
    assert {r.size_bytes for r in gate.rejected_rows(gate.gate(heads, keys.select(F.col("key").alias("item")))).filter("item = 'c'").collect()} == {None}


def test_writers(spark, tmp_path):
    path = f"{tmp_path}/table"
    tables.append_rows(spark.range(3), f"{tmp_path}/log")
    tables.append_rows(spark.range(2), f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 5
    tables.write_run_summary(spark.range(1), f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 6
    tables.rewrite_table(spark.range(3), path)
    assert tables.rewrite_table(spark.range(9), path, dry_run=True) is None and tables.current_table(spark, path).count() == 3
    old = tables.current_table(spark, path)
    tables.rewrite_table(old.filter("id > 0"), path)
    assert tables.current_table(spark, path).count() == 2 and old.count() == 3
    assert rows(tables.row_size_violations(spark.range(2).withColumn("x", F.repeat(F.lit("y"), 5000)), "id").select("row_bytes")) == [(5016,), (5016,)]


def test_catalog_checks():
    assert quality.catalog_problems({"version": 1, "symbols": []}, "symbols") == [] and quality.catalog_problems({}, "symbols") == ["version", "symbols"]


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture()
def events(spark, tmp_path):
    table = spark.read.parquet(f"{DATA}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    table.repartition(3).write.parquet(f"{tmp_path}/events")
    return spark.read.parquet(f"{tmp_path}/events"), f"{tmp_path}/events"


def test_fingerprint_stream(spark, tmp_path):
    items = [(k, ["red bolt", "Small Ring"] if k % 2 else ["blue gear"], ["small ring"]) for k in range(20)] + [(3, ["x"], ["y"]), (50, None, ["small"])]
    df = spark.createDataFrame(items, "item long, symbols array<string>, names array<string>").dropDuplicates(["item"])
    df.repartition(4).write.parquet(f"{tmp_path}/in")
    profiles = {"p": {"must_have_one": ["red bolt"], "device_name": ["^small"], "weights": {"must_have_one": 2, "device_match": 5}}}
    ingest.start_fingerprint(stream(spark, f"{tmp_path}/in", df.schema), ["red bolt"], profiles, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    whole = df.withColumn("symbols", F.coalesce("symbols", F.array().cast("array<string>")))
    assert rows(VersionedTable(spark, f"{tmp_path}/out/rows").read().select("item", "matches")) == rows(match.fingerprint(whole, ["red bolt"], profiles).select("item", "matches"))


def run_batches(df, step, checkpoint):
    df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("compact", [2, 20])
def test_latest_view(spark, tmp_path, events, compact):
    table, folder = events
    step = ingest.latest_view(f"{tmp_path}/view", ["user_id"], "ts", "event_id", compact)
    run_batches(stream(spark, folder, table.schema), step, f"{tmp_path}/ck")
    assert rows(ingest.read_latest(spark, f"{tmp_path}/view", ["user_id"], "ts", "event_id")) == rows(latest_per_key(table, ["user_id"], "ts", "event_id"))
    step(table.limit(5), 2)  # a repeated batch replaces its own rows
    assert ingest.read_latest(spark, f"{tmp_path}/view", ["user_id"], "ts", "event_id").count() <= table.select("user_id").distinct().count()


def test_new_to_store(spark, tmp_path, events):
    table, folder = events
    step = ingest.new_to_store(f"{tmp_path}/store", "user_id")
    run_batches(stream(spark, folder, table.schema), step, f"{tmp_path}/ck")
    read = lambda: VersionedTable(spark, f"{tmp_path}/store/rows").read()
    assert read().count() == read().select("user_id").distinct().count() == table.select("user_id").distinct().count()
    step(table, 7)
    assert read().count() == table.select("user_id").distinct().count()


def test_totals(spark, events):
    table, folder = events
    live = ingest.live_totals(stream(spark, folder, table.schema), "event_type")
    live.writeStream.outputMode("complete").format("memory").queryName("live_totals").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("live_totals")) == rows(table.groupBy("event_type").agg(F.count("*")))


def test_dead_letters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(LINES))
    lines = spark.readStream.text(f"{tmp_path}/in")
    for q in ingest.rows_and_rejects(lines, SCHEMA, f"{tmp_path}/rows", f"{tmp_path}/rejects", f"{tmp_path}/ck"):
        q.awaitTermination()
    good, bad = tables.audit_lines(spark.read.text(f"{tmp_path}/in"), SCHEMA)
    assert rows(spark.read.parquet(f"{tmp_path}/rows")) == rows(good) and rows(spark.read.parquet(f"{tmp_path}/rejects")) == rows(bad)


def test_magic_of_files(spark):
    df = spark.createDataFrame([("a.sys", b"MZ1"), ("b.sys", b"PK"), ("c.txt", b"?"), ("d.zip", b"PK\3\4")], "name string, content binary")
    assert [r.name for r in worklist.valid_magic(df, "name", "content").orderBy("name").collect()] == ["a.sys", "c.txt", "d.zip"]
