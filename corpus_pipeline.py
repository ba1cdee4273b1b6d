"""A corpus pipeline: language ID, line dedup, SimHash near-dedup, source mixing, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns is written as Parquet and read
again as the next one's docs. All stages but the last return the columns of documents.

Of every stage holds: an empty table gives no rows; texts are read whole, however long; columns beside those of documents stay, but for the names that
the operators keep for themselves (they begin with an underscore); rows without doc_id are documents like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import langid, line_dedup, mixing, packing, simhash
from quarry.llm.common import stage, table

#: Documents whose words agree on no language so far, on average, are rejected; of four languages a blind guess has 0.25.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty texts too) and those in no known language; the others get the language that was found. Repeated rows fare
    alike; of equal probabilities the first language by code point counts. Where no row has a lang, nothing is known and all go."""
    found = langid.identify(docs, langid.fit(langid.learner_rows(docs)))
    kept = found.where((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_score") >= LEAST_SCORE))
    return kept.select(*[F.col("_lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later repeated runs of lines; documents of which nothing is left go, while null and empty texts, of which nothing was cut, stay. Rows with the
    same doc_id and text are one document here."""
    out = line_dedup.dedup_lines(docs).where((F.col("_n_deleted") == 0) | (F.col("_n_deleted") < F.col("_n_lines")))
    return out.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the least doc_id (null last). Null and empty texts are one group. Of rows with the same doc_id in a
    group one stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words (null and empty texts too) are never taken. A null source is a source of its own. Which of equal rows is taken
    makes no difference."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence. Null and empty texts are one piece, the end id; repeated rows are packed as often as they
    stand."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("simhash_dedup", dedup_documents), ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs


#: Language ID, SimHash and tokenising can't be said in SQL; tests/llm/test_pipeline.py has each stage against brute force.
ORACLE_SQL = None
