"""A training corpus from documents: quality filter, line dedup, near-duplicate removal, source mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared
folder and rereads it as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import jaccard, linededup, mixing, pieces, quality
from estatelake.llm.common import documents, staged
from estatelake.llm.queries import tokenizer_file


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject, with all their columns.

    Null and empty texts are scored like others; repeated rows have one score and stay or go together; without usable labels every
    score is 0.5 and all stay; an empty table gives an empty one."""
    return quality.keep_good(docs, quality.fit_quality(docs, documents(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs cut; documents of which nothing is left go; n_chars follows the text.

    Null texts and texts without lines stay as they are; repeated rows of one id are one document and get one result each; the
    first copy is that of the least id; an empty table gives an empty one; other columns stay, whatever their names."""
    cut = linededup.first_copies(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join, that of the least id, with all its columns.

    Texts without words are in no class and stay; rows without an id stay; rows that repeat id and text stay once; an id with
    several texts keeps those that stand for a class of their own; an empty table gives an empty one."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, a row for each copy, with all their columns.

    Documents without words come in the whole copies of their source, and are never drawn besides; a null source is one source, the last; rows that
    repeat, and rows without an id, are drawn one by one; ties go by a digest of id, text and source; reruns agree; an empty table
    gives an empty one."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the SentencePiece ids of each row, and digest of the text decoded from them.

    Null counts as empty; repeated rows give repeated results; an empty table gives an empty one."""
    return pieces.encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("tokenise", tokenise),
]

#: The classifier, the tokeniser and their training cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {}
