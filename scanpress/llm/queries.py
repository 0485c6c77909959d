"""Registered queries of the training-data operators, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanpress.llm import (
    chat,
    dedup,
    importance,
    jaccard,
    langid,
    mixing,
    packing,
    prefixtrie,
    proximity,
    tokenids,
    topk,
    warc,
    wordlm,
)
from scanpress.llm.common import scratch_uri, table


def op1_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.voronoi_topk(data, data.filter(F.col("id") % 50 == 0), k=5)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    read = chat.read_chats(chat.format_chats(rows.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_uri(spark, "warc")
    index = warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(index, path)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(F.col("doc_id").alias("id"))
    return wordlm.score_words(table(spark, sf_dir, "documents").select("doc_id", "text"), good)


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_uri(spark, "token-ids")
    index = tokenids.write_token_ids(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return tokenids.token_stream(index, path)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefixtrie.with_shared_openings(prefixtrie.conversations(table(spark, sf_dir, "conversations")))
    nodes = prefixtrie.prefix_trie(convs)
    columns = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), *columns)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")


def op13_proximity_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = proximity.vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    index = proximity.build_index(vectors)
    return proximity.search(index, vectors.filter(F.col("id") % 20 == 0), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_voronoi_topk": op1_voronoi_topk,
    "op2_chat_format": op2_chat_format,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_warc_bundles": op5_warc_bundles,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_ids": op8_token_ids,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_proximity_graph": op13_proximity_graph,
}
