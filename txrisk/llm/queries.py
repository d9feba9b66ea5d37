"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import table
from txrisk.llm.op01_html import extract_main_text
from txrisk.llm.op02_packing import pack, with_lengths
from txrisk.llm.op03_warc import archive_round_trip
from txrisk.llm.op04_pii import configured_key, pseudonymise
from txrisk.llm.op05_search import search
from txrisk.llm.op06_near_dedup import near_duplicates
from txrisk.llm.op07_secrets import find_secrets
from txrisk.llm.op08_rans import read_token_files, write_token_files
from txrisk.llm.op09_decontamination import contaminated
from txrisk.llm.op10_toxicity import toxicity
from txrisk.llm.op11_overlap_join import overlap_join
from txrisk.llm.op12_runs import periodic_runs
from txrisk.llm.op13_negatives import hard_negatives, usable
from txrisk.llm.oracle import ORACLE as ORACLE


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(with_lengths(table(spark, sf_dir, "documents")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), configured_key(spark), spans_column="spans")


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100, taken as a query."""
    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2).select("doc_id", "n_shingles", "component_id", "kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs after a repetition has been written over the end of a tenth of the texts."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives for every row whose id is divisible by 100; a seventh of the rows has its label shifted first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable(table(spark, sf_dir, "embeddings").withColumn("label", label)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_pii": op4_pii,
    "op5_search": op5_search,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_secrets": op7_secrets,
    "op8_token_files": op8_token_files,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_overlap_join": op11_overlap_join,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}
