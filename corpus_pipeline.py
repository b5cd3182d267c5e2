"""The corpus pipeline: documents in, packed token pieces out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next
stage's documents. All but the last keep the columns of their input. Null and empty texts, repeated rows, empty
tables and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import decontaminate, lines, packing, quality, simhash
from firnline.llm.common import table
from firnline.session import stage

#: Near-duplicates: fingerprints of three-word shingles, at most this many differing bits.
SHINGLE, BITS = 3, 2
OWN = "__firnline_"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts."""
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn(OWN + "score", quality.score(docs, weights))
    return scored.filter(F.col(OWN + "score") >= quality.THRESHOLD).drop(OWN + "score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their host's boilerplate lines; the length follows the text."""
    cleaned = lines.without_boilerplate(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of close fingerprints join, the one with the smallest id."""
    return simhash.one_of_each(docs, SHINGLE, BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    scanned = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), column=OWN + "hits")
    return scanned.filter(F.col(f"{OWN}hits.n_hit") == 0).drop(OWN + "hits")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packed(cut)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Hashing, tokenising and the fitted classifier have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
