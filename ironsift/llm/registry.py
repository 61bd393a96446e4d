"""The operators of this subpackage as registered queries: whole tables in, contract columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.llm.byte_bpe import encode_ranked
from ironsift.llm.collocations import collocations
from ironsift.llm.compression_rules import quality_rules
from ironsift.llm.decontaminate import decontaminate
from ironsift.llm.main_text import extract_main_text
from ironsift.llm.ngram_join import similar_documents
from ironsift.llm.oracles import ORACLES
from ironsift.llm.periodic_runs import find_runs
from ironsift.llm.perspectives import rotate_perspectives
from ironsift.llm.piece_codec import encode_pieces
from ironsift.llm.quality_model import score_quality
from ironsift.llm.substring_dedup import dedup_word_runs
from ironsift.llm.suffix_dedup import dedup_bytes
from ironsift.llm.token_records import new_folder, read_records, write_records

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), _sha256(F.col("kept")).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"))[0].select("doc_id", "n_shingles", "component_id")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_word_runs(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = _sha256(F.array_join("items", ","))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def piece_digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ids, decoded texts and the source spans of all pieces."""
    ids = _sha256(F.array_join(F.col("ids").cast("array<string>"), ","))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), _sha256(F.col("decoded")).alias("decoded_sha256"), F.xxhash64("starts", "ends").alias("spans_xxhash64"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(encode_pieces(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write_records(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2, new_folder(spark))
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return read_records(shards).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents (by the checksum of their id) repeat a part of their words up to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    n = F.size("words").cast("long")
    planted = chosen.withColumn("n", n).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int"))), " ")
    return planted.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    longer = lambda r, s: r["length"] * s["period"] > s["length"] * r["period"]
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda s, r: F.when(longer(r, s), r).otherwise(s))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    out = out.withColumn("best", best)
    ratio = F.expr("(1000 * best.length) div best.period").alias("exponent_milli")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", ratio, _sha256(listed).alias("runs_sha256"), _sha256(F.col("collapsed")).alias("collapsed_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_ranked(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    ids = _sha256(F.array_join(F.col("ids").cast("array<string>"), ","))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_ngram_jaccard_join,
        op3_chat_formatting,
        op4_quality_classifier,
        op5_html_extraction,
        op6_substring_dedup,
        op7_decontamination,
        op8_quality_rules,
        op9_sentencepiece,
        op10_token_records,
        op11_periodic_runs,
        op12_byte_bpe,
        op13_collocations,
        pipeline,
    )
}
