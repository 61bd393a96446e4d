"""A training-data pipeline of five stages; each is written as Parquet and read again as the next one's documents.

Every stage takes null ids, null and empty texts, repeated ids and further columns as its docstring says, carries the other
columns of a row along with it, and returns an empty table for an empty one. This module belongs to the optional
subpackage and can't be imported without it; only that subpackage's registry imports it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.llm.compression_rules import quality_rules
from ironsift.llm.decontaminate import decontaminate
from ironsift.llm.ngram_join import similar_documents
from ironsift.llm.piece_codec import encode_pieces
from ironsift.llm.registry import piece_digests, tokenizer_file
from ironsift.llm.shared import shared_dir
from ironsift.llm.substring_dedup import dedup_word_runs


def _apart(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The documents with their other columns renamed apart from those of operators, and these names."""
    names = {x: f"carried_{x}" for x in docs.columns if x not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), tuple(names.values())


def _together(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again, of rows that an operator carried along."""
    return out.withColumnsRenamed({f"carried_{x}": x for x in docs.columns}).select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Each row is judged by its own text, whether its id is null or repeated."""
    apart, carry = _apart(docs)
    return _together(quality_rules(apart, carry=("text", *carry)).filter("kept").select("doc_id", "text", *carry), docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id. Rows that share an id are one document, so they
    stay or go together; a row without an id links with nothing and stays."""
    others = similar_documents(docs)[0].filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word runs that earlier documents have; a text of which nothing is left goes. Rows that share
    an id are cleaned one by one and none is earlier than the other; a row without an id keeps all its words."""
    apart, carry = _apart(docs)
    left = dedup_word_runs(apart, carry=carry).filter("kept <> ''").select("doc_id", F.col("kept").alias("text"), *carry)
    return _together(left, docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window. Each row is judged by its own text, whether its id is null or repeated."""
    apart, carry = _apart(docs)
    out = decontaminate(apart, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=carry)
    return _together(out.filter("NOT contaminated").select("doc_id", "text", *carry), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, source spans of the pieces included."""
    return piece_digests(encode_pieces(docs, tokenizer_file("piece_bpe_32k.model")))


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("substring dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None  # zstandard and SentencePiece are beyond SQL; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
