"""Snapshots of known samples: the newest directory of a base, as one row for each sample."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.functions.columns import pick_cve

LAYOUT = "*/catalog/drivers.json"
_SAMPLE = "struct<SHA256: string, Imphash: string, Filename: string>"
_ENTRY = f"Id string, CVE variant, Category string, Tags array<string>, KnownVulnerableSamples array<{_SAMPLE}>"


def newest_path(spark: SparkSession, base: str, layout: str = LAYOUT) -> str | None:
    """The last of the snapshots in path order, each a file or a folder of files; None where there is none. Only names are
    listed, no content is read."""
    leaf = "[^/]*".join(re.escape(x) for x in layout.rpartition("/")[2].split("*"))
    try:
        files = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/{layout}")
        path = F.regexp_extract(F.col("_metadata.file_path"), f"^(.*/{leaf})(/[^/]*)?$", 1)
        return files.select(path.alias("p")).agg(F.max("p")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def read_entries(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Entries of a snapshot with their place in it: a document with a list, or (lines) a folder of files with one entry a line."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.schema(_ENTRY).json(path, multiLine=not lines).select("*", place.alias("ref_pos"))


def samples_of(entries: DataFrame) -> DataFrame:
    """One row for each sample of each entry: ref_id, ref_pos, pos, cve, category, tags, filename, sha256, imphash, and key and family,
    which are sha256 and imphash in lower case or null where they are empty. A CVE may be text or a list of texts; an
    entry without samples has no row."""
    many = F.try_variant_get("CVE", "$", "array<string>")
    one = F.array(F.try_variant_get("CVE", "$", "string"))
    cve = pick_cve(F.coalesce(many, one), F.coalesce("Tags", F.array().cast("array<string>")))
    rows = entries.select(F.col("Id").alias("ref_id"), "ref_pos", cve.alias("cve"), F.col("Category").alias("category"), F.col("Tags").alias("tags"), F.posexplode("KnownVulnerableSamples").alias("pos", "s"))
    lowered = lambda c: F.nullif(F.lower(c), F.lit(""))
    return rows.select("ref_id", "ref_pos", "pos", "cve", "category", "tags", F.col("s.Filename").alias("filename"), F.col("s.SHA256").alias("sha256"), F.col("s.Imphash").alias("imphash"), lowered(F.col("s.SHA256")).alias("key"), lowered(F.col("s.Imphash")).alias("family"))


def load_snapshot(spark: SparkSession, base: str, layout: str = LAYOUT, lines: bool = False) -> DataFrame | None:
    """The samples of the newest snapshot below a base; None where there is none, so that clones are not computed."""
    path = newest_path(spark, base, layout)
    return None if path is None else samples_of(read_entries(spark, path, lines))
