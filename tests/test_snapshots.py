"""Snapshots of known samples, and the lookup of clones in them."""

import json

import pytest

from ironsift.operators import clones
from ironsift.sources import snapshots

ENTRIES = [
    {"Id": "a", "CVE": ["", "see cve-2020-12345 x"], "Category": "c1", "Tags": ["CVE-1999-111"], "KnownVulnerableSamples": [{"SHA256": "AA11", "Imphash": "FAM1", "Filename": "a.sys"}, {"SHA256": "bb22", "Imphash": "fam1"}]},
    {"Id": "b", "CVE": "cve-2021-777", "KnownVulnerableSamples": [{"SHA256": "aa11", "Imphash": ""}, {"Filename": "no keys"}]},
    {"Id": "c", "CVE": [], "Tags": [None, "x", "about CVE-2019-4242!"], "KnownVulnerableSamples": [{"SHA256": "", "Imphash": "fam1"}]},
    {"Id": "d", "CVE": "none", "Tags": ["cve-2018-1234"], "KnownVulnerableSamples": [{"SHA256": "dd"}]},
    {"Id": "e", "CVE": None, "KnownVulnerableSamples": [{"SHA256": "ee"}]},
    {"Id": "f", "CVE": ["CVE-2020-1111"]},
]


@pytest.fixture()
def base(tmp_path):
    for day, entries in (("20240101", ENTRIES[:1]), ("20240301", ENTRIES), ("20240201", ENTRIES[1:2])):
        folder = tmp_path / "known" / day / "catalog"
        folder.mkdir(parents=True)
        (folder / "drivers.json").write_text(json.dumps(entries, indent=1))
    (tmp_path / "known" / "20240401").mkdir()  # a run that brought no snapshot
    return f"{tmp_path}/known"


def test_newest_only(spark, base):
    got = snapshots.load_snapshot(spark, base)
    assert [x.rsplit("/", 3)[1] for x in got.inputFiles()] == ["20240301"]
    rows = {(r.ref_id, r.pos): r for r in got.collect()}
    assert {k: r.cve for k, r in rows.items()} == {("a", 0): "CVE-2020-12345", ("a", 1): "CVE-2020-12345", ("b", 0): "CVE-2021-777", ("b", 1): "CVE-2021-777", ("c", 0): "CVE-2019-4242", ("d", 0): "CVE-2018-1234", ("e", 0): None}
    assert (rows["a", 0].key, rows["a", 0].family, rows["a", 0].sha256, rows["a", 0].filename, rows["a", 0].category) == ("aa11", "fam1", "AA11", "a.sys", "c1")
    assert (rows["b", 0].family, rows["b", 1].key, rows["c", 0].key) == (None, None, None)


@pytest.mark.parametrize("prefix", ["", "file://"])
def test_no_snapshot(spark, tmp_path, prefix):
    assert snapshots.load_snapshot(spark, f"{prefix}{tmp_path}/none") is None
    (tmp_path / "some" / "2024" / "catalog").mkdir(parents=True)
    assert snapshots.load_snapshot(spark, f"{prefix}{tmp_path}/some") is None


def test_path_with_scheme_and_lines(spark, base):
    assert snapshots.newest_path(spark, f"file://{base}") == f"file:{base}/20240301/catalog/drivers.json"
    spark.createDataFrame([("z", "zz")], "Id string, k string").selectExpr("Id", "array(named_struct('SHA256', k)) AS KnownVulnerableSamples").write.json(f"{base}/20250101/catalog/drivers.json")
    assert [(r.ref_id, r.key) for r in snapshots.load_snapshot(spark, base, lines=True).collect()] == [("z", "zz")]


def test_clones_in_a_snapshot(spark, base):
    items = spark.createDataFrame([(1, "Aa11", "FAM1"), (2, "xx", "fam1"), (3, None, ""), (4, "", None), (5, "DD", None)], "item long, key string, family string")
    got = sorted((r.item, r.match_type, r.ref_id, r.key, r.cve, r.similarity) for r in clones.clones(items, snapshots.load_snapshot(spark, base)).fillna({"key": "-"}).collect())
    assert got == [
        (1, "imphash", "a", "bb22", "CVE-2020-12345", 0.6), (1, "imphash", "c", "-", "CVE-2019-4242", 0.6), (1, "sha256-exact", "a", "aa11", "CVE-2020-12345", 1.0),
        (2, "imphash", "a", "aa11", "CVE-2020-12345", 0.6), (2, "imphash", "a", "bb22", "CVE-2020-12345", 0.6), (2, "imphash", "c", "-", "CVE-2019-4242", 0.6), (5, "sha256-exact", "d", "dd", "CVE-2018-1234", 1.0),
    ]
    status = {r.item: (r.status, r.hits) for r in clones.clone_status(items, snapshots.load_snapshot(spark, f"{base}/none")).collect()}
    assert status[1] == ("not_computed", None)
    status = {r.item: (r.status, len(r.hits)) for r in clones.clone_status(items, snapshots.load_snapshot(spark, base)).collect()}
    assert status == {1: ("computed", 3), 2: ("computed", 3), 3: ("computed", 0), 4: ("computed", 0), 5: ("computed", 1)}
