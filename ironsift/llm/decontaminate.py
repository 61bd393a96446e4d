"""Benchmark decontamination: document words inside a benchmark window, with DataFrame functions only.

Method: winnowing. Words are hashed; of the 5-gram hashes in every sliding window of 6 (10 words in all) the
least is the window's fingerprint. Two equal runs of 10 words have equal fingerprints, so joining the
documents' distinct fingerprints with those of the benchmark finds every shared run of 10 words or more. Hits
are then extended: in documents that share a fingerprint, the windows that have it are compared word by word.
Items of 1 to 9 words are one window each; their fingerprint is the hash of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.llm.shared import Kept

WINDOW = 10
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lowered and nothing else; texts of ASCII alone take the fast function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _fingerprints(df: DataFrame, sizes: list[int]) -> tuple[DataFrame, dict[int, str]]:
    """Adds for each size a column with the fingerprint of each window of the size, in order, to a table with words; and
    the names of these columns. Each document is split and hashed once for all sizes.

    Take them apart with the outer forms of explode: for the plain forms Spark adds a filter on the array, moves it
    below these steps and so computes every step once for each element of the next.
    """
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    tail = lambda n: F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - n, F.lit(0)))
    for size in sizes:
        gram = GRAM if size == WINDOW else size
        grams = F.transform(tail(gram - 1), lambda h, i: F.xxhash64(F.lit(size), h, *(F.get("hashes", i + k) for k in range(1, gram))))  # noqa: B023
        if size < WINDOW:
            df = df.withColumn(f"prints_{size}", grams)
            continue
        df = df.withColumn("grams", grams).withColumn("pairs", F.transform("grams", lambda g, i: F.least(g, F.get("grams", i + 1))))
        steps = range(2, size - gram + 1, 2)  # the window has size - gram + 1 grams, an even number
        df = df.withColumn(f"prints_{size}", F.transform(tail(size - 1), lambda h, i: F.least(F.get("pairs", i), *(F.get("pairs", i + k) for k in steps)))).drop("grams", "pairs")
    return df.drop("hashes"), {size: f"prints_{size}" for size in sizes}


def _targets(items: DataFrame, sizes: list[int]) -> DataFrame:
    """One row for each window of the items: item_id, print and the words of the window (run)."""
    out = []
    for size in sizes:
        own = items.filter(F.col("n") >= WINDOW if size == WINDOW else F.col("n") == size).select("item_id", "words")
        own, names = _fingerprints(own, [size])
        own = own.select("item_id", "words", F.posexplode_outer(names[size]).alias("place", "print")).filter(F.col("print").isNotNull())
        out.append(own.select("item_id", "print", F.slice("words", F.col("place") + 1, F.lit(size)).alias("run")))
    return reduce(DataFrame.unionByName, out).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, n_words, n_hit (words inside any occurrence of a window), items (ids with such windows,
    sorted as strings) and contaminated, for every document.

    Null and empty texts, of documents or items, have no words and no hit. Rows that share an id are judged one by
    one; items that share an id count once. A null item id never appears among items, but its words are hit.
    Columns named in carry go along with their row; others are ignored. An empty table of documents gives an empty one,
    and one of items no hit. Tables of fingerprints, hits and windows are kept, and Spark broadcasts those whose files are small.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carry)
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    items = items.select(F.col(item_id_col).cast("string").alias("item_id"), words(F.col(item_text_col)).alias("words")).withColumn("n", F.size("words")).filter("n > 0")
    sizes = sorted(r.n for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect())  # 10 at most
    counts = keyed.withColumn("n_words", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long"))
    none = F.array().cast("array<string>")
    if not sizes:
        return counts.select("doc_id", "text", *carry, "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"), F.lit(False).alias("contaminated"))

    tables = Kept(docs.sparkSession)
    targets = tables.keep(_targets(items, sizes), "targets")
    prints = tables.keep(targets.select("print").distinct(), "prints")
    texts, names = _fingerprints(keyed.select("doc_id", "text_key", words(F.col("text")).alias("words")), sizes)
    every = F.array_distinct(F.concat(*(F.array_distinct(x) for x in names.values())))
    found = texts.select("doc_id", "text_key", F.explode_outer(every).alias("print")).join(prints, "print", "left_semi")
    found = tables.keep(found.groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("shared")), "suspects")

    suspects = keyed.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "text").join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key")))
    suspects, names = _fingerprints(suspects.select("doc_id", "text_key", "shared", words(F.col("text")).alias("words")).distinct(), sizes)
    places = lambda size: F.filter(F.transform(names[size], lambda p, i: F.when(F.array_contains("shared", p), F.struct(F.lit(size).alias("size"), i.alias("place"), p.alias("print")))), lambda x: x.isNotNull())
    near = suspects.select("doc_id", "text_key", "words", F.explode_outer(F.concat(*map(places, sizes))).alias("at")).filter("at IS NOT NULL")
    near = near.select("doc_id", "text_key", "at.size", "at.place", "at.print", F.slice("words", F.col("at.place") + 1, F.col("at.size")).alias("run"))
    matched = near.join(targets, ["print", "run"])
    # what windows cover is added up from the gaps between their starts, not place by place
    runs = matched.groupBy("doc_id", "text_key", "place").agg(F.max("size").alias("size"))
    by = Window.partitionBy("doc_id", "text_key").orderBy("place")
    reach = F.max(F.col("place") + F.col("size")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.greatest(F.lit(0), F.col("place") + F.col("size") - F.greatest("place", F.coalesce(reach, F.lit(0)))))
    n_hit = runs.groupBy("doc_id", "text_key").agg(F.sum("new").alias("n_hit"))
    ids = matched.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    same = n_hit["doc_id"].eqNullSafe(ids["doc_id"]) & (n_hit["text_key"] == ids["text_key"])
    hits = n_hit.join(ids, same).select(n_hit["doc_id"].alias("d"), n_hit["text_key"].alias("k"), "n_hit", "items")
    out = counts.join(tables.keep(hits, "hits"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "text", *carry, "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated"))
