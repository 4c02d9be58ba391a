"""The corpus pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage's rows to the shared checkpoint folder and reads
them again as the next stage's documents, so a lost executor never costs more
than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollcast.llm import decontaminate, language, packing, secrets, simhash
from tollcast.llm.common import importable, read, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no learned language, go.

    Profiles are learned from the documents' own labels; where the rows have
    none, there is nothing to reject by and all of them stay."""
    profiles = language.learn_profiles(docs)
    if not profiles.languages:
        return docs
    return language.keep_identified(docs, profiles, min_score=MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest doc_id.

    NULL texts, empty ones and those without a word have the fingerprint zero and are
    linked like any other; a NULL doc_id comes last, ties go by the texts' hash, and of
    rows that repeat the kept doc_id and text one stays."""
    return simhash.one_per_component(docs, shingle_words=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    NULL and empty texts hold none and stay; rows are judged one by one, so repeated rows
    go or stay together; items without a word match nothing, and an empty benchmark
    removes nothing."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays.

    NULL texts stay NULL, empty ones empty; spans that overlap become one mark, those
    that only touch one each; repeated rows change alike."""
    return secrets.redact(docs, parts=True)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence and place there.

    A NULL or empty text is a piece of the end id alone; repeated rows are packed each for
    itself; ties between bins may fall either way, as sequence numbers carry no meaning."""
    return packing.pack_documents(docs, capacity=1024, end_id=2)


#: Texts of a learned language, however short or noisy, lie far above.
MIN_LANGUAGE_SCORE = 0.1

STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("secret scans", secret_scan),
          ("best-fit packing", best_fit_packing)]

#: Fingerprints, language profiles and token ids are not expressible in SQL; the
#: pipeline is tested stage by stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(importable(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs


QUERIES = {"pipeline": run}
