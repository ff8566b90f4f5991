"""Stages of a corpus pipeline: an operator's decisions applied to whole rows of documents.

Operators work on doc_id, text and source alone; their decisions meet the rows again by doc_id and a hash of the text, under
names that the table does not have, so other columns pass as they are, whatever their names. Where a decision concerns
few rows, a bit map of these rows' keys lets all others pass where they are, and only what may be concerned is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm import mixing, naming, packing, setjoin, toxicity
from navspan.llm.setjoin import MAP_BITS, candidate_map
from navspan.llm.shared import written


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    known = {c.lower() for c in df.columns}
    while name.lower() in known:
        name += "_"
    return name


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def beside(docs: DataFrame, table: DataFrame, on: dict[str, Column], how: str) -> tuple[DataFrame, dict[str, str]]:
    """docs joined with a table, nulls being equal: on its columns `on`, by expressions over docs. The others' new names."""
    names = {c: fresh(docs, f"their_{c}") for c in table.columns}
    table = table.select(*[F.col(c).alias(names[c]) for c in table.columns])
    keys = {c: fresh(docs, f"key_{c}") for c in on}
    docs = docs.select("*", *[x.alias(keys[c]) for c, x in on.items()])
    same = [F.col(keys[c]).eqNullSafe(F.col(names[c])) for c in on]
    return docs.join(table, same, how), names


def pruned(spark: SparkSession, docs: DataFrame, on: dict[str, Column], gone: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """docs without the rows whose key is among `gone`, and of rows with a key among `repeated` one each."""
    columns = docs.columns
    special = gone.select(*on, F.lit(True).alias("gone"))
    if repeated is not None:
        special = special.unionByName(repeated.select(*on, F.lit(False).alias("gone")))
    special = written(spark, special, "special")
    if special.isEmpty():
        return docs
    told = spark.sparkContext.broadcast(candidate_map(special.select(F.xxhash64(*on).alias("id"))))

    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(told.value[batch.to_numpy(zero_copy_only=False)])

    flag = fresh(docs, "may_go")
    flagged = docs.select("*", F.arrow_udf(known, "boolean")(F.pmod(F.xxhash64(F.xxhash64(*on.values())), F.lit(MAP_BITS))).alias(flag))
    rows, names = beside(flagged.where(F.col(flag)), special, on, "left")
    keys = [c for c in rows.columns if c.startswith("key_") and c not in columns]
    once = rows.where(~F.col(names["gone"])).dropDuplicates(keys).select(*columns)
    return flagged.where(~F.col(flag)).select(*columns).union(rows.where(F.col(names["gone"]).isNull()).select(*columns)).union(once)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on their labels, does not reject."""
    model = toxicity.trained(spark, docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.scored(model)["score"] < toxicity.THRESHOLD)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, but for white space, the one that block naming keeps; of rows that repeat a whole
    document, one."""
    found = written(spark, naming.duplicates(spark, docs.select("doc_id", "text")).select("doc_id", "text_key", "kept", "rows"), "found")
    return pruned(spark, docs, {"doc_id": F.col("doc_id"), "text_key": text_key()}, found.where("NOT kept"), found.where("kept AND rows > 1"))


def distinct_sets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate texts, the one with the smallest doc_id; where one doc_id has several texts, each
    counts by itself, in order of a hash. Of rows that repeat a whole document, one stays. Rows without a doc_id stay."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id", text_key().alias("text_key"))
    counts = ids.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    if counts.isEmpty():
        found = setjoin.jaccard_join(spark, docs.select("doc_id", "text"))
        gone = found.where("doc_id <> component_id").select("doc_id")
        return pruned(spark, docs, {"doc_id": F.col("doc_id")}, gone)
    # Numbers in the order of doc_id, one for each of its texts.
    texts = ids.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows")).orderBy("doc_id", "text_key")
    texts = written(spark, texts.withColumn("number", F.monotonically_increasing_id()), "numbers")
    key = {"doc_id": F.col("doc_id"), "text_key": text_key()}
    numbered, names = beside(docs.select("doc_id", "text"), texts, key, "inner")
    found = setjoin.jaccard_join(spark, numbered.select(F.col(names["number"]).alias("doc_id"), "text").dropDuplicates(["doc_id"]))
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("number"))
    gone = texts.join(gone.withColumn("gone", F.lit(True)), "number", "left").select("doc_id", "text_key", "rows", F.coalesce("gone", F.lit(False)).alias("gone"))
    gone = written(spark, gone, "gone")
    return pruned(spark, docs, key, gone.where("gone"), gone.where("NOT gone AND rows > 1"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = mixing.mix(spark, docs.select("doc_id", "text", "source")).where("copies > 0").select("doc_id", "text_key", "source", "copies")
    rows, names = beside(docs, copies, {"doc_id": F.col("doc_id"), "text_key": F.xxhash64("text"), "source": F.col("source")}, "inner")
    copy = fresh(rows, "copy")
    return rows.select(*[F.col(c) for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(names["copies"]))).alias(copy)).drop(copy)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return packing.pack(docs, tokenizer)
