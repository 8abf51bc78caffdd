"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.functions.scratch import scratch_path
from custvalue.llm import (
    counts,
    exact,
    language,
    lines,
    mix,
    pieces,
    search,
    segment,
    simhash,
    syncmers,
    toxicity,
    trie,
    urls,
    warc,
)
from custvalue.llm.common import table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix(table(spark, folder, "documents"))


@query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


#: Host, path prefix and verdict of the rules that pages are judged by.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


@query
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Number and hash of the pieces of every text, and whether they decode to it."""
    docs = table(spark, folder, "documents")
    text = F.replace(text_of("text"), F.lit(pieces.SPACE), F.lit(" "))
    hashed = docs.select("doc_id", "text", F.sha2(text, 256).alias("text_sha256"))
    given = ("n_tokens", "ids_sha256", "decoded_sha256")
    encoded = segment.encode(hashed, ("doc_id", "text_sha256"), give=given)
    same = F.col("decoded_sha256") == F.col("text_sha256")
    return encoded.select("doc_id", *given, same.alias("round_trip"))


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(table(spark, folder, "documents"))


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = language.held_out(4, 2)
    learned = language.profiles(docs.where(~held))
    return language.identify(docs, learned).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = language.held_out(3, 1)
    chain = toxicity.fit(docs.where(~held), labels.where(~held))
    return toxicity.score(docs, chain).select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
        "spans",
    )


@query
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


@query
def op7_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Whole anchor sets, not sketches of them."""
    return syncmers.edit_likeness(table(spark, folder, "documents"), size=None)


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write the pages as archives, then read the responses, checking every payload, and the
    revisits, from whose read the headers keep all payloads."""
    path = scratch_path(spark, "archive")
    warc.write_warc(warc.page_records(table(spark, folder, "pages")), path)
    responses = warc.read_warc(spark, path, types=("response",), payload="digest")
    records = responses.unionByName(warc.read_warc(spark, path, types=("revisit",), payload="none"))
    return records.select(
        warc.page_of("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))
