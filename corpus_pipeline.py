"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it leaves, with the columns
of documents; the last one returns the mix. run() writes every stage as Parquet in the shared
checkpoint folder and reads it again for the next one, so a lost executor costs one stage's
tasks at most and no lineage grows.

Defined cases: an empty table passes through all stages and gives an empty mix. A null text is
rejected by the quality rules (no words). Repeated rows are judged alike: both lose the same
lines, and one of them is left after near duplicates; rows without doc_id are ordered after all
others, by their text. A document that line dedup empties stays with an empty text, as one group
of near duplicates with all other empty ones. Extra columns are kept, whatever their names.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelproj.llm.decontaminate import clean_documents
from panelproj.llm.line_dedup import without_repeated_lines
from panelproj.llm.mixing import mix
from panelproj.llm.quality_rules import good_documents, trusted_ids
from panelproj.llm.shared import written
from panelproj.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: too few words, too many repeated ones, or far from the trusted text. Without labels only the first two."""
    return good_documents(docs, trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that nearly repeat an earlier line go; every document stays, with the length of the text it is left with."""
    kept = without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. An empty benchmark removes nothing."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document that is left."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# SimHash needs XXH64 and linking to a fixed point, which the SQL engine lacks; tests compare the line and near-duplicate stages with plain versions.
ORACLE_SQL = None
