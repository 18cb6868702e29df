"""Registered queries of this package: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    decontaminate,
    hard_negatives,
    jaccard_join,
    language_mixture,
    line_dedup,
    quality,
    sentencepieces,
    source_divergence,
    token_counts,
    toxicity,
    training_order,
    vector_search,
)
from llm.chat import chat_digests, format_chats, text_part
from llm.common import read_table
from presswork.sources.shared import new_path

# Files of public tokenizers, in a package that driver and executors have.
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ORDER_KEY = 20_261_201
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of token ids of every document, read back from the shards that it was written to."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoder = sentencepieces.id_encoder(tokenizer_path(PIECES))
    path = new_path(spark, "training-order")
    layout = training_order.write_training_order(documents, path, ORDER_KEY, encoder=encoder)
    read = training_order.read_order(spark, layout)
    return read.select(
        "slot",
        (F.col("slot") / layout.shard_slots).cast("int").alias("shard"),
        "doc_id",
        "piece",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines: how many are left, and a digest of its text."""
    reduced = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return reduced.select(
        "doc_id",
        "n_lines",
        "n_kept",
        F.length("text").cast("bigint").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    documents = read_table(spark, sf_dir, "documents")
    return token_counts.count_documents(documents, tokenizer_path(BYTE_BPE))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a benchmark item in a document."""
    documents = read_table(spark, sf_dir, "documents")
    return decontaminate.find_leaks(documents, read_table(spark, sf_dir, "benchmark"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th, by integer inner product."""
    return vector_search.search(read_table(spark, sf_dir, "embeddings"), every=20)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    documents = read_table(spark, sf_dir, "documents")
    network = toxicity.fit(documents, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(documents, network)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    probe = spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string")
    messages = rows.unionByName(probe).withColumn("parts", text_part(F.col("text")))
    return chat_digests(format_chats(messages))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, compared with the sentencepiece library and decoded again."""
    documents = read_table(spark, sf_dir, "documents")
    return sentencepieces.encode_digests(documents, tokenizer_path(PIECES))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    documents = read_table(spark, sf_dir, "documents")
    model = quality.fit(documents, read_table(spark, sf_dir, "labels"))
    return quality.score_documents(documents, model)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near-equal documents that every document is in."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the words of every source lie from those of the language's other sources, and by which terms."""
    return source_divergence.audit_sources(read_table(spark, sf_dir, "documents"))


def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, and of how many languages it is a mixture."""
    documents = read_table(spark, sf_dir, "documents")
    found = language_mixture.identify(documents, language_mixture.learn(documents))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("languages").alias("n_languages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 50th vector and each of its positives the highest rows of other labels in the window below."""
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def op10_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op10_jaccard_join, with the number of near-equal documents that every document links with."""
    return jaccard_join.jaccard_links(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_training_order,
        op2_line_dedup,
        op3_token_counts,
        op4_decontamination,
        op5_topk_search,
        op6_toxicity,
        op7_chat_formatting,
        op8_sentencepiece,
        op9_quality_classifier,
        op10_jaccard_join,
        op11_source_divergence,
        op12_language_mixture,
        op13_hard_negatives,
    )
}

# The SQL of op10_jaccard_join gives classes only; the form with numbers of links is a query of its own.
MORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_jaccard_links": op10_jaccard_links}
