"""Exact dedup by deterministic block naming.

A text without white space is cut into blocks of a fixed size. Equal blocks get one name, different blocks different
ones; then pairs of neighbours' names are named in the same way, and so on until one name is left for each text. A
name is a pair of integers: a 64-bit hash of what it stands for, and the rank of that content, in sorted order, among
all contents with this hash. So no two contents ever share a name, and only the contents are sorted, once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspan.llm.shared import written

BLOCK = 4096
SPACES = " \t\n\v\f\r"
KEY = ["doc_id", "text_key"]


def without_spaces(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def ranks(contents: DataFrame, content: list[str]) -> DataFrame:
    """Of (hash, content): rank of each content whose hash has more than one."""
    distinct = contents.select("hash", *content).distinct()
    ranked = distinct.withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy(*content)))
    return ranked.withColumn("most", F.max("rank").over(Window.partitionBy("hash"))).where("most > 1").drop("most")


def named(spark: SparkSession, contents: DataFrame, content: list[str]) -> DataFrame:
    """contents with (hash, rank) in place of the content."""
    clashes = written(spark, ranks(contents, content), "clashes")
    if clashes.isEmpty():
        return contents.drop(*content).withColumn("rank", F.lit(1))
    same = [contents["hash"] == clashes["hash"], *[contents[c].eqNullSafe(clashes[c]) for c in content]]
    return contents.join(clashes, same, "left").select(
        *[contents[c] for c in contents.columns if c not in content], F.coalesce(clashes["rank"], F.lit(1)).alias("rank"))


def identities(spark: SparkSession, docs: DataFrame, block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, text_key, n_chars, text_sha256, rows, and the identity of the text
    without white space: (n_blocks, hash, rank)."""
    def hashed(*columns: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*columns), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(*columns)

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), F.length("text").alias("n_chars"), without_spaces("text").alias("plain"))
    pieces = F.regexp_extract_all("plain", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    pieces = F.when(F.col("plain") == "", F.array(F.lit(""))).otherwise(pieces)
    blocks = texts.select(*KEY, "n_chars", F.sha2("plain", 256).alias("text_sha256"), F.posexplode(pieces).alias("pos", "block"))
    blocks = blocks.withColumn("hash", hashed("block"))
    rows = named(spark, blocks, ["block"])
    rows = written(spark, rows.groupBy(*KEY, "n_chars", "text_sha256", "pos", "hash", "rank").agg(F.count("*").alias("rows")), "blocks")
    texts = rows.where("pos = 0").select(*KEY, "n_chars", "text_sha256", "rows", F.col("hash").alias("first_hash"), F.col("rank").alias("first_rank"))
    level = rows.select(*KEY, "pos", "hash", "rank")
    counts = level.groupBy(*KEY).agg((F.max("pos") + 1).alias("n_blocks"))
    long = counts.where("n_blocks > 1")
    level = level.join(long.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "k"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))).drop("d", "k")
    done = None
    while True:
        level = written(spark, level, "level")
        last = level.where("n_blocks = 1").drop("pos")
        done = last if done is None else done.unionByName(last)
        level = level.where("n_blocks > 1")
        if level.isEmpty():
            break
        half = F.floor(F.col("pos") / 2).cast("int")
        names = {f"{side}_{c}": F.max(F.when(F.col("pos") % 2 == i, F.col(c))) for i, side in enumerate(("left", "right")) for c in ("hash", "rank")}
        pairs = level.groupBy(*KEY, "n_blocks", half.alias("pos")).agg(*[v.alias(k) for k, v in names.items()])
        pairs = pairs.withColumn("hash", hashed(*names)).withColumn("n_blocks", F.ceil(F.col("n_blocks") / 2).cast("int"))
        level = named(spark, pairs, list(names))
    done = done.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "hash", "rank")
    return texts.join(counts.select(F.col("doc_id").alias("cd"), F.col("text_key").alias("ck"), F.col("n_blocks")), F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("text_key") == F.col("ck"))).join(
        done, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left").select(
        *KEY, "n_chars", "text_sha256", "rows", "n_blocks",
        F.coalesce("hash", "first_hash").alias("hash"), F.coalesce("rank", "first_rank").alias("rank"))


def duplicates(spark: SparkSession, docs: DataFrame, block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """Of documents (doc_id, text): keep_id, group_size, kept and text_sha256 of each distinct (doc_id, text), with
    text_key (hash of the text) and rows (how often it stands in docs).

    Texts are equal when identical without white space; null counts as empty, and empty texts are equal. The row with
    the most code points in the original text stays, then the smallest doc_id (a null one last), then the smallest
    text_key; of rows that repeat both doc_id and text, one. An empty table gives no rows; other columns are ignored.
    """
    found = identities(spark, docs, block, hash_bits)
    name = ["n_blocks", "hash", "rank"]
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("id"), (-F.col("text_key").cast("decimal(20,0)")).alias("key")))
    groups = found.groupBy(*name).agg(best.alias("best"), F.sum("rows").alias("group_size"))
    groups = groups.select(*name, (-F.col("best.id")).alias("keep_id"), (-F.col("best.key")).cast("long").alias("keep_key"), "group_size")
    return found.join(groups, name).select(
        *KEY, "rows", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))).alias("kept"), "text_sha256")
