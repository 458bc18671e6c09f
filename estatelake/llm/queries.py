"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from estatelake.llm import centroids, chat, jaccard, linededup, media, mixing, negatives, neighbours, pages, pieces, quality, secrets, tokenfiles
from estatelake.llm.common import documents, drop_staged


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files are; only queries need them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document. Null and empty texts are classes of their own."""
    return jaccard.jaccard_classes(documents(spark, sf_dir))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Null html gives an empty text."""
    return pages.extract_main_text(documents(spark, sf_dir, "pages"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text stored as a media file and read back. Null is stored as an empty text."""
    return media.media_report(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, fitted on labels outside the held-out fold. Null counts as empty."""
    docs = documents(spark, sf_dir)
    model = quality.fit_quality(docs, documents(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, each held against the library, and their decoding. Null counts as empty."""
    return pieces.encode_pieces(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in token files, read back. Null texts count as empty, null ids stay null."""
    return tokenfiles.token_files_report(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of line runs. Null texts stay null."""
    return linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document. Null texts have size 0, a null source is one source."""
    return mixing.mix_report(documents(spark, sf_dir))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of every vector whose id is divisible by 20. Unusable vectors take no part."""
    return neighbours.nearest_neighbours(documents(spark, sf_dir, "embeddings"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. Null and empty texts have none."""
    return secrets.scan_secrets(documents(spark, sf_dir))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back of every conversation, and of one made of control strings, formatted as examples of one reply each. Null texts count as empty."""
    formatted = chat.format_conversations(chat.with_hostile(documents(spark, sf_dir, "conversations")))
    report = chat.chat_report(formatted)
    drop_staged(formatted)
    return report


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact distance of every usable vector after ten rounds. Unusable vectors take no part."""
    return centroids.cluster(documents(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every positive of every anchor. Unusable rows take no part."""
    return negatives.mine(documents(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_html_main_text, op3_media_columns, op4_quality_classifier, op5_sentencepiece, op6_token_files, op7_line_dedup, op8_source_mix, op9_nearest_neighbours, op10_secret_scan, op11_chat_formatting, op12_centroid_clusters, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": jaccard.SQL, "op7_line_dedup": linededup.SQL, "op8_source_mix": mixing.SQL, "op11_chat_formatting": chat.SQL, "op12_centroid_clusters": centroids.SQL, "op13_hard_negatives": negatives.SQL}
