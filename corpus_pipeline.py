"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, byte-level BPE.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; what one returns is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents``: doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import byte_bpe, decontamination, line_dedup, simhash_dedup, toxicity
from attesta.llm.common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. The model learns from the labelled rows of the corpus as it came."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model).select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; a document of nothing else stays, as an empty text."""
    out = line_dedup.drop_boilerplate(docs)
    n = F.when(F.col("ld_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", "text", "lang", "source", n.alias("n_chars"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (sets of five-word shingles, Jaccard similarity 0.8, verified) the document with the smallest doc_id stays."""
    return simhash_dedup.first_of_each(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return byte_bpe.digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

#: Models, hashes and merges have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{k}")
            if docs.isEmpty() and not before.isEmpty():
                raise RuntimeError(f"the stage {name} left no document; it was given some")
    return docs
