"""Documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; ``run`` and the caller write each stage's
result and hand it on. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandem.llm import overlap_join, packing, pii, risk_rules, run_index
from tandem.llm.common import documents, prepare, small, written
from tandem.llm.tokens import file

END_ID = 0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; the labels table is the holdout. A row without doc_id is judged alike."""
    prepare(spark)
    verdicts = risk_rules.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=True)
    return verdicts.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies (5-word shingles, similarity 0.8 or more) stays."""
    groups = overlap_join.near_duplicates(docs, width=5, num=8, den=10)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(small(gone, 1), "doc_id", "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that also start in a smaller doc_id.

    A cut may split a character of several bytes; what is left of one is dropped. Documents stay, also with nothing
    left of their text.
    """
    return run_index.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids at the corpus' mixture of sources."""
    return packing.pack(docs, file("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

# The stages cut texts by tokenizers, indexes and trained classifiers, which SQL cannot express; tests hold the result
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``; each stage is written and read back."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
