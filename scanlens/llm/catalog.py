"""Registered corpus queries, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.llm import crosstok, decontaminate, fingerprints, language, lexical, lines, pieces, quality, setjoin, shards, spans, urlrules, wrapper


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.main_texts(table(spark, folder, "pages"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words, benchmark hits and items of every document."""
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("hit_spans")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by shingle similarity."""
    return setjoin.link_groups(table(spark, folder, "documents"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the sentences of passages that an earlier place holds."""
    found = spans.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_sentences", "n_removed", F.col("kept_text").alias("text"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    docs = table(spark, folder, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, folder, "labels")))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document from its text, its declared language and its source."""
    docs = table(spark, folder, "documents")
    return language.identify(docs, ["doc_id"], declared=F.col("lang"), host=F.col("source"))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Order MinHash of every document, its edited text and the next document."""
    return fingerprints.edited_likeness(table(spark, folder, "documents"))


#: Host, path and verdict of the rules that the registered query applies.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of the longest fitting rule for every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(table(spark, folder, "pages"), rules)


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen shards of near-equal bytes over all documents."""
    return shards.shard_documents(table(spark, folder, "documents"))


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every document with the 32,000-piece model and an end id, and decode it again."""
    return pieces.encoding_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that an earlier document holds."""
    return lines.line_digests(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between a byte-level and a SentencePiece vocabulary in every document."""
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return crosstok.alignment_measures(table(spark, folder, "documents"), *files)


LLM_QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_decontamination": op2_decontamination,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_language_id": op6_language_id,
    "op7_fingerprints": op7_fingerprints,
    "op8_url_filters": op8_url_filters,
    "op9_sharding": op9_sharding,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES: dict[str, str] = {
    "op2_decontamination": decontaminate.CONTAMINATION_SQL,
    "op3_jaccard_join": setjoin.LINKS_SQL,
    "op8_url_filters": urlrules.JUDGE_SQL,
    "op11_line_dedup": lines.LINES_SQL,
    "op12_lexical_search": lexical.SEARCH_SQL,
}
