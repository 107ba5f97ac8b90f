"""The registered queries of this subpackage. Each reads its whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.llm import (
    chat, decontamination, line_dedup, metric_search, ngram_join, packing, pii, repair, sharding, simhash, toxicity, trie,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.canonical_turns(table(spark, sf_dir, "conversations"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return metric_search.top_k(rows, rows.where("vec_id % 50 = 0"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "text", "lines_total", "lines_dropped")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_documents(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie_nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_chat": op3_chat,
    "op4_sharding": op4_sharding,
    "op5_topk": op5_topk,
    "op6_line_dedup": op6_line_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_simhash": op11_simhash,
    "op12_repair": op12_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {"op5_topk": metric_search.search_sql(), "op6_line_dedup": line_dedup.line_sql(), "op8_warc": warc.WARC_SQL}
