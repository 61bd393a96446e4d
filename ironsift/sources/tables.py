"""Reading append-only streams of rows, manifests, catalogs and file stores; appending and rewriting tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.functions.columns import little_endian
from ironsift.sources.versions import Manifest, VersionedTable

BAD = "_corrupt_record"
# The component type of drivers in a package catalog, and the categories that are kept by default.
DRIVER_TYPE = "DRVR"
CATEGORIES = ("CS", "NI", "SG", "SA", "SE", "IN", "AU", "CM")


def audit_lines(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines (value), and the lines that are none, of a table or a stream. Blank lines are neither."""
    lines = lines.filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"), "value")
    good = parsed.filter(F.col(f"r.{BAD}").isNull() & F.col("r").isNotNull()).select("r.*").drop(BAD)
    return good, parsed.filter(F.col(f"r.{BAD}").isNotNull() | F.col("r").isNull()).select(F.col("value").alias("line"))


def read_rows_audited(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    return audit_lines(spark.read.text(path), schema)


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_rows_audited(spark, path, schema)[0]


def read_manifests(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """One row for each driver record of each run document, with its file and place."""
    docs = spark.read.schema(schema).json(glob, multiLine=True).withColumn("path", F.col("_metadata.file_path"))
    return docs.select("*", F.posexplode_outer("drivers").alias("pos", "driver")).drop("drivers")


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    return df.join(df.agg(F.max(snapshot).alias(snapshot)), snapshot, "left_semi")


_PROFILE = "must_have_one array<string>, weight_each array<string>, taint_sink array<string>, device_name array<string>, ioctl array<string>, string array<string>, weights map<string, long>"


def read_profiles(spark: SparkSession, glob: str) -> dict[str, DataFrame]:
    """Long tables of hunt profiles: symbols by role, patterns by kind, weights by term. Each file is a JSON document; its
    stem is the scope's name, and a file that can't be read as one is skipped."""
    files = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)(\.[^./]*)?$", 1).alias("scope"), "value")
    docs = files.select("scope", F.from_json("value", f"{_PROFILE}, {BAD} string", {"columnNameOfCorruptRecord": BAD}).alias("p")).filter(F.col("p").isNotNull() & F.col(f"p.{BAD}").isNull())
    long = lambda names, kind, value: docs.select("scope", F.explode(F.array(*(F.struct(F.lit(n).alias(kind), F.col(f"p.{n}").alias("x")) for n in names))).alias("e")).select("scope", f"e.{kind}", F.explode("e.x").alias(value))
    return {
        "symbols": long(("must_have_one", "weight_each", "taint_sink"), "role", "symbol"),
        "patterns": long(("device_name", "ioctl", "string"), "kind", "pattern"),
        "weights": docs.select("scope", F.explode("p.weights").alias("term", "weight")),
    }


_SCOPE = "name string, short_name string, search struct<queries: array<string>, categories: array<string>>, device_classes_of_interest array<string>"


def read_scopes(spark: SparkSession, glob: str) -> DataFrame:
    """file, stem, name, short_name, search and classes of hunt profiles, one JSON document each; a file that can't be read as one is skipped."""
    file = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1)
    files = spark.read.text(glob, wholetext=True).select(file.alias("file"), F.from_json("value", f"{_SCOPE}, {BAD} string", {"columnNameOfCorruptRecord": BAD}).alias("p"))
    docs = files.filter(F.col("p").isNotNull() & F.col(f"p.{BAD}").isNull())
    return docs.select("file", F.regexp_replace("file", r"\.[^.]*$", "").alias("stem"), "p.name", "p.short_name", "p.search", F.col("p.device_classes_of_interest").alias("classes"))


_CATALOG = "_path string, _dateTime string, _size long, ComponentType struct<_value: string>, Category struct<_value: string>"


def read_xml_catalog(spark: SparkSession, path: str, row_tag: str = "SoftwareComponent", encoding: str = "UTF-16") -> DataFrame:
    """path, date, size, type and category of every component of a package catalog."""
    rows = spark.read.format("xml").option("rowTag", row_tag).option("encoding", encoding).schema(_CATALOG).load(path)
    return rows.select(F.replace("_path", F.lit("\\"), F.lit("/")).alias("path"), F.col("_dateTime").alias("date"), F.col("_size").alias("size"), F.col("ComponentType._value").alias("type"), F.coalesce("Category._value", F.lit("?")).alias("category"))


def driver_packages(components: DataFrame, categories: tuple[str, ...] = CATEGORIES, max_mb: int = 200, base: str = "") -> DataFrame:
    """Components of type driver in the categories and up to the size, with address and file name, oldest first."""
    kept = components.filter((F.upper("type") == DRIVER_TYPE) & F.col("category").isin(*categories) & (F.col("size") <= max_mb << 20))
    return kept.select(F.concat(F.lit(base), "path").alias("url"), "path", "date", "size", "category", F.regexp_extract("path", "[^/]*$", 0).alias("name")).orderBy("date", "path")


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def scan_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """sha256, size, name and content of every file that isn't empty (Spark reads no empty files)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(content_hash(F.col("content")).alias("sha256"), F.col("length").alias("size"), F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def header_census(files: DataFrame) -> DataFrame:
    """Adds machine and subsystem, read at their offsets; null where the header is malformed."""
    start = little_endian(F.col("content"), F.lit(0x3C), 4).cast("int")
    ok = (F.hex(F.substring("content", 1, 2)) == "4D5A") & (little_endian(F.col("content"), start, 4) == 0x4550)
    return files.withColumns({"machine": F.when(ok, little_endian(F.col("content"), start + 4, 2)), "subsystem": F.when(ok, little_endian(F.col("content"), start + 24 + 68, 2))})


def extract_links(df: DataFrame, html_col: str, pattern: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(F.regexp_extract_all(html_col, F.lit(pattern), F.lit(1))).alias("link"))


def read_key_list(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """Keys of a plain list: comments and blanks dropped, lower-cased; of one length if given."""
    key = F.lower(F.trim(F.regexp_replace("value", "#.*$", "")))
    out = spark.read.text(path).select(key.alias("key")).filter("key <> ''")
    return out.filter(F.char_length("key") == length) if length else out


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def row_size_violations(df: DataFrame, key: str, limit: int = 4096, text: str | None = None) -> DataFrame:
    """key and row_bytes of rows that are too long as a line: of their JSON form with its line end, or of a column that has the line."""
    size = F.octet_length(F.to_json(F.struct(*df.columns))) + 1 if text is None else F.octet_length(text)
    return df.select(F.col(key), size.cast("long").alias("row_bytes")).filter(F.col("row_bytes") >= limit)


def rewrite_table(df: DataFrame, path: str, dry_run: bool = False, base: Manifest | None = None) -> str | None:
    """Writes df as the next version of a table, whose folder comes back; a reader of current_table sees the old rows or the new ones.
    Nothing on a dry run. base: the version that df was made from; if there is a newer one, that is an error, and nothing is lost."""
    if dry_run:
        return None
    table = VersionedTable(df.sparkSession, path)
    return f"{table.folder}/{table.rewrite(df, base or table.manifest()).parts[0].folder}"


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last version."""
    rows = VersionedTable(spark, path).read()
    if rows is None:
        raise FileNotFoundError(f"{path} has no version")
    return rows


def write_run_summary(df: DataFrame, path: str) -> None:
    append_rows(df, path)
