"""The registered queries of the operators, each over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelproj.llm import lsh_forest, mixing, ranked_search, spelling, substring_dedup
from panelproj.llm.decontaminate import contamination
from panelproj.llm.line_dedup import line_dedup
from panelproj.llm.pii import personal_data
from panelproj.llm.quality_classifier import quality_scores
from panelproj.llm.quality_rules import quality_rules, trusted_ids
from panelproj.llm.secret_scan import secret_scan
from panelproj.llm.simhash import simhash_components
from panelproj.llm.suffix_dedup import suffix_dedup


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), trusted_ids(_table(spark, sf_dir, "labels")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(_table(spark, sf_dir, "documents"), least_length=7, least_count=2, noise_every=31)
    return spelling.spelling_variants(counts, ratio=10)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, sf_dir, "documents"), percent=80)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_simhash_near_dedup,
        op3_quality_classifier,
        op4_suffix_array_dedup,
        op5_secret_scan,
        op6_line_dedup,
        op7_benchmark_decontamination,
        op8_source_mixing,
        op9_pii,
        op10_substring_dedup,
        op11_spelling_variants,
        op12_minhash_near_dedup,
        op13_ranked_search,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op8_source_mixing": mixing.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_minhash_near_dedup": lsh_forest.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
