"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.llm.conversation_trie import conversation_trie
from chronolake.llm.exact_dedup import exact_dedup
from chronolake.llm.language import language
from chronolake.llm.lm_scoring import lm_scores
from chronolake.llm.mixing import mix
from chronolake.llm.near_dups import near_duplicates
from chronolake.llm.packing import pack
from chronolake.llm.passages import repeated_passages
from chronolake.llm.secrets import find_secrets, secret_digest
from chronolake.llm.top_k import top_k
from chronolake.llm.toxicity import toxicity
from chronolake.llm.vector_codes import vector_codes
from chronolake.llm.warc import read_warc, write_warc
from chronolake.session import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup(table(spark, folder, "documents"), keep_row=False)
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), lambda key: key % 100 == 0)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language(table(spark, folder, "documents"))


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digest(find_secrets(table(spark, folder, "documents")))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = write_warc(table(spark, folder, "pages"), fresh_folder(spark, "warc"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read_warc(spark, archive.folder).select(*columns)


def registered() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_mixing": op3_mixing,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_packing": op5_packing,
        "op6_top_k": op6_top_k,
        "op7_language": op7_language,
        "op8_repeated_passages": op8_repeated_passages,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_secrets": op10_secrets,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_vector_codes": op12_vector_codes,
        "op13_warc": op13_warc,
    }
