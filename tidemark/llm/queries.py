"""Registered queries of the training-data operators: each applies its operator
to its whole table and derives the digest columns; ``SQL`` holds the DuckDB
text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import data_dir
from . import chat, collocations, conversation_repair, decontaminate, mix, pii, quality, sentence_pieces, simhash, token_blocks, topk, toxicity
from .common import cut
from .shard import histogram_shards

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(data_dir(sf_dir, name))


@query("op1_topk_hamming", topk.SQL)
def op1(spark, sf):
    codes = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), topk.sign_codes(F.col("embedding")).alias("code"))
    codes = cut(codes, "codes")
    found = topk.search(codes, codes.filter("id % 50 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


PROBE = "</s>[INST] ok [/INST]"


@query("op2_chat_format")
def op2(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.read_back(cut(chat.format_conversations(turns.unionByName(probe)), "chat"))


@query("op3_pii")
def op3(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents"))
    joined = lambda s: F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    count = lambda k: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS[: pii.BASE]],
                        F.sha2(joined(F.filter("spans", lambda x: x["base"])), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


@query("op4_decontaminate")
def op4(spark, sf):
    found = decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op5_simhash")
def op5(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_mix_sources", mix.SQL)
def op6(spark, sf):
    mixed = mix.systematic_mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op7_toxicity")
def op7(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, table(spark, sf, "labels")).drop("text")


@query("op8_token_blocks")
def op8(spark, sf):
    import public_tokenizers
    return token_blocks.token_table(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_quality")
def op9(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.score_documents(docs, table(spark, sf, "labels")).drop("text")


@query("op10_shard")
def op10(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return histogram_shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op11_repair_conversations")
def op11(spark, sf):
    hurt = conversation_repair.damage(table(spark, sf, "conversations"))
    report = cut(conversation_repair.repair(hurt, dropped=F.col("dropped")), "repair-report")
    fixed = conversation_repair.apply_repairs(hurt, report, dropped=F.col("dropped"))
    shas = conversation_repair.text_digests(fixed).withColumnRenamed("conv_id", "id")
    return report.join(shas, report["conv_id"].eqNullSafe(shas["id"]), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_collocations", collocations.SQL)
def op12(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


@query("op13_sentence_pieces")
def op13(spark, sf):
    import public_tokenizers
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = sentence_pieces.decode_ids(sentence_pieces.encode_texts(table(spark, sf, "documents"), model), model)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
