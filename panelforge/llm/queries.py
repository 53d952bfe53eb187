"""One query per operator over the whole test tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import oracle
from panelforge.llm.common import read_table, text_of
from panelforge.llm.decontaminate import contaminated
from panelforge.llm.line_dedup import keep_bitmaps, keep_lines
from panelforge.llm.main_text import main_text
from panelforge.llm.mixing import mix
from panelforge.llm.near_dedup import near_duplicates
from panelforge.llm.prefix_trie import prefix_trie
from panelforge.llm.quality import quality
from panelforge.llm.repeats import remove_repeats
from panelforge.llm.secrets import secrets
from panelforge.llm.sharding import row_size, shard
from panelforge.llm.token_align import MEASURES, align_tokens
from panelforge.llm.toxicity import held_out, predict
from panelforge.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_segments", "edits", "shared_grams")


@register("op2_near_dedup", oracle.NEAR_DEDUP)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), 85, 5)


@register("op3_secret_scan", oracle.secret_scan())
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col("secret_counts")[i].alias(f"n_{kind}") for i, kind in enumerate(("assign", "access", "hex"))]
    return found.select("doc_id", *counts, F.sha2(F.col("secret_base").cast("binary"), 256).alias("base_sha256"), F.col("secret_spans").alias("spans"))


@register("op4_quality_rules", oracle.QUALITY)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule rejects first depends on measured times; the verdict does not
    return quality(read_table(spark, sf_dir, "documents")).drop("rejected_by", "rules_run")


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = predict(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_predicted").alias("predicted"))


@register("op6_line_dedup", oracle.LINE_DEDUP)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = keep_lines(docs, keep_bitmaps(docs, 40, 5))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sized = docs.withColumns({"size": row_size(text_of()), "text_crc32": F.crc32(text_of().cast("binary"))})
    return shard(sized, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@register("op8_warc", oracle.WARC)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(read_table(spark, sf_dir, "pages"), 0, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_repeats")
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
        F.col("mix_passes").alias("passes"),
        "source",
    )


@register("op11_token_align")
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return aligned.select("doc_id", *[F.col(m).alias(m.removeprefix("align_")) for m in MEASURES], F.col("align_groups_sha256").alias("groups_sha256"))


@register("op12_prefix_trie", oracle.PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


@register("op13_main_text")
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumnRenamed("main_text", "text")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
