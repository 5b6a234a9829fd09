"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    audit,
    chat,
    decontam,
    langid,
    mixing,
    neardup,
    oracle,
    paradup,
    pseudo,
    quality,
    records,
    secrets,
    toxicity,
    trie,
)
from strata.llm.components import stored
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_source_mixing", oracle.MIXING)
def op1(spark, sf_dir):
    rows = mixing.mixed(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"),
                       (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


def remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


@register("op2_toxic_segments")
def op2(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(3) == 1
    rows = toxicity.scored(docs, toxicity.fitted(docs, labels, ~held_out), held_out)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                       F.size("passages").cast("long").alias("n_passages"), "passages")


@register("op3_chat_format", oracle.CHAT)
def op3(spark, sf_dir):
    probe = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.parsed(chat.formatted(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@register("op4_spaced_seed_decontamination")
def op4(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@register("op5_odd_sketch_dedup", oracle.NEAR_DUPLICATES)
def op5(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_binary_records")
def op6(spark, sf_dir):
    path = scratch_path(spark, "op6")
    records.write_records(table(spark, sf_dir, "documents"), path, records.tokenizer_path())
    return records.read_records(spark, path)


@register("op7_paragraph_dedup")
def op7(spark, sf_dir):
    return paradup.repeated_passages(table(spark, sf_dir, "documents"))


@register("op8_pseudo_likelihood")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pseudo.scored(docs, pseudo.fitted(docs))


@register("op9_quality_rules")
def op9(spark, sf_dir):
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.BASE, "base_failed", "kept", "class_distance", "word_distance")


@register("op10_language_id")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(5) == 0
    return langid.identified(docs, langid.fitted(docs, ~held_out), held_out)


@register("op11_prefix_trie", oracle.PREFIX_TRIE)
def op11(spark, sf_dir):
    turns = stored(trie.ordered_turns(table(spark, sf_dir, "conversations")), "placed")
    family, shared = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string")) % 9
    return trie.prefix_trie(trie.rebuilt(turns, family, shared))


@register("op12_secret_scan")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.scanned(docs, secrets.identifiers(docs))
    return secrets.digest(found)


@register("op13_filter_audit", oracle.FILTER_AUDIT)
def op13(spark, sf_dir):
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
