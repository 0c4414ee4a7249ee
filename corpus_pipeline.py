"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents`` (``n_chars`` follows
the text). Null and empty texts go through every stage (SimHash keeps one of
them), rows without an id and repeated rows are rows of their own but for SimHash,
which keeps one of equal rows; empty tables give empty tables; columns of other
names pass through the filtering stages. ``run`` writes every stage as Parquet in the shared folder and reads
it again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, line_dedup, packing, simhash, toxicity
from ledgerlens.llm.common import read, shared_table
from ledgerlens.llm.queries import QUERIES, TOKENIZER, id_crc


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; learnt from the labelled rows outside the
    held-out fifth."""
    scored = toxicity.toxicity_scores(docs, read(spark, sf_dir, "labels"), id_crc() % 5 == 0, score_col="__toxic")
    return scored.where(F.col("__toxic") < 0.5).select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that occur in ten documents or more."""
    kept = line_dedup.line_dedup(docs, min_docs=10)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of fingerprints within three bits whose
    shingle sketches agree."""
    return simhash.simhash_dedup(docs, words=3, radius=3).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids and their places in sequences."""
    return packing.pack_documents(docs, TOKENIZER, size=4096, end_id=1)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_common_lines), ("simhash", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: A trained stage and token ids are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
