"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm import collocations, leaks, licenses, lines, lloyd, mixing, naming, packing, pages, personal, setjoin, toxicity, vectors
from navspan.llm.shared import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(spark, table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row")).drop("row")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = naming.duplicates(spark, table(spark, sf_dir, "documents"))
    row = F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256", row).select(
        "doc_id", "keep_id", "group_size", (F.col("kept") & (F.col("row") == 1)).alias("kept"), "text_sha256")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_join(spark, table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    numbers = F.array_join(F.transform("dropped", lambda i: i.cast("string")), ",")
    return found.select("doc_id", "text", "n_lines", F.size("dropped").alias("n_dropped"), numbers.alias("dropped"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(spark, table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "sentences")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(p.kind) for p in personal.BASE]
    return found.select("doc_id", *counts, F.sha2(personal.joined(F.col("base")), 256).alias("base_sha256"), personal.joined(F.col("found")).alias("spans"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = lloyd.clusters(spark, table(spark, sf_dir, "embeddings"))
    found = written(spark, found, "assigned")
    # One row a centroid.
    own = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    names = [(i, own.get(i, 0), sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    told = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # Broadcast: one row a centroid.
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_personal_data": op10_personal_data,
    "op11_decontamination": op11_decontamination,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}
