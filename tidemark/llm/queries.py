"""The operators' queries over the data folders, and their SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, imatch, language, minhash, mixing, negatives, neighbours, quality, repair, sharding, simhash, token_store, toxicity
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": lambda spark, folder: bpe.digest(table(spark, folder, "documents")),
    "op2_string_kernel_toxicity": lambda spark, folder: toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op3_fourier_quality": lambda spark, folder: quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op4_word_backoff_language": lambda spark, folder: language.judged(table(spark, folder, "documents")),
    "op5_hilbert_neighbours": lambda spark, folder: neighbours.found(table(spark, folder, "embeddings")),
    "op6_imatch_fingerprints": lambda spark, folder: imatch.compared(table(spark, folder, "documents")),
    "op7_simhash_groups": lambda spark, folder: simhash.grouped(table(spark, folder, "documents")),
    "op8_minimax_shards": lambda spark, folder: sharding.assignment(table(spark, folder, "documents")),
    "op9_token_store": lambda spark, folder: token_store.stored(table(spark, folder, "documents")),
    "op10_pareto_mix": lambda spark, folder: mixing.taken(table(spark, folder, "documents")),
    "op11_conversation_repair": lambda spark, folder: repair.mended(table(spark, folder, "conversations")),
    "op12_hard_negatives": lambda spark, folder: negatives.mined(table(spark, folder, "embeddings")),
    "op13_bbit_minhash": lambda spark, folder: minhash.grouped(table(spark, folder, "documents")),
}

ORACLES: dict[str, str] = {
    "op6_imatch_fingerprints": imatch.ORACLE,
    "op10_pareto_mix": mixing.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
}
