"""The queries of this subpackage: thin contract rows over each operator's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.llm import (
    brown_lm,
    collocations,
    decontam,
    fp_tree_search,
    license_scan,
    mixing,
    quality_js,
    sharding,
    simhash_vp,
    site_style_tree,
    suffix_dedup,
    toxic_crf,
    warc,
)
from fiscalflow.llm.oracle import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400, stable=True)
    # a removed run may begin or end inside a character, which becomes a replacement character in the text
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.expr("make_valid_utf8(cast(kept AS string))").alias("kept"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_vp.near_duplicates(docs, words=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).withColumn("n_spans", F.size("spans")).drop("spans")


def op6_class_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = site_style_tree.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("__contamination")
    return out.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                      F.size(c["items"]).cast("long").alias("n_items"),
                      F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), c["contaminated"].alias("contaminated"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "weight", "block", "in_block", "release", "slot", "due")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_js.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "__quality.*")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents")).drop("first_doc", "first_byte")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxic_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_tree_search.rank_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_sharding": op2_sharding,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_licenses": op5_licenses,
    "op6_class_bigrams": op6_class_bigrams,
    "op7_main_text": op7_main_text,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_toxicity": op12_toxicity,
    "op13_ranked_search": op13_ranked_search,
}
