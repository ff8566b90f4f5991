"""Mixing sources to target weights by pivotal dependent rounding.

A source's target sets how many copies each of its documents is due: a whole number and a fraction. Fractions are
copy probabilities. Two documents at a time, words move at random from one to the other until a probability is 0 or
1, so that the words of all copies hardly change and each document's chance stays what it was. Groups of documents
do this side by side; the one that each group leaves open goes on to the next level of a tree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspan.llm.shared import written
from navspan.llm.words import mixed

#: Weights of the sources by code point of their names, repeating.
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
GROUP, FAN = 4096, 256
WORD = r"[^\x20\x09-\x0D]+"
ROWS = "doc_id long, text_key long, source string, size long, rows long, source_size double, target double, whole long, part double, bucket long"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Of (source, size): source, source_size, n, target. Works on one row per source.

    Targets are a common level times the weight, and at most `most` times the source's size: the level is the one at
    which they add up, found on the sources in the order of the level at which each is full.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = sized.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"), F.count("*").alias("n"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = full.rowsBetween(0, Window.unboundedFollowing)
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    by = by.withColumn("level", (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    by = by.withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything))
    return by.select("source", "source_size", "n", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"))


def settle(keys: np.ndarray, words: np.ndarray, parts: np.ndarray, seed: int) -> tuple[list[int], list[tuple[int, float]]]:
    """Places of the items that get one copy more, and what stays open: (place, probability), one at most.

    The draws come from the items' keys; words and parts are each item's size and probability.
    """
    chosen: list[int] = []
    held = None
    draws = (mixed(keys + np.uint64(seed)) >> np.uint64(11)) / 2.0**53
    for i, (n, p, draw) in enumerate(zip(words.tolist(), parts.tolist(), draws.tolist(), strict=True)):
        if n <= 0 or p <= 1e-12:
            continue
        if held is None:
            held = i, n, p
            continue
        j, m, q = held
        here, there = min(q * m, (1 - p) * n), min(p * n, (1 - q) * m)  # words that can move from j to i, from i to j
        move = here if draw * (here + there) < there else -there
        held = None
        for k, size, r in ((j, m, q - move / m), (i, n, p + move / n)):
            if r >= 1 - 1e-12:
                chosen.append(k)
            elif r > 1e-12:
                held = k, size, r
    return chosen, [(held[0], held[2])] if held else []


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7) -> DataFrame:
    """How often the mix takes each document of (doc_id, text, source).

    One row per distinct (doc_id, text, source): doc_id, text_key (hash of the text), source, size (words), rows (how
    many rows of docs it stands for), source_size, target, copies (of each of these rows). No document is taken more
    than `most` times, rounded up. A null text has no words; a document without words is taken as often as its whole
    part says; a null source is a source of its own, the last; an empty table gives no rows; other columns are
    ignored. Draws hang on doc_id and text alone, so reruns agree however the table is split.
    """
    sized = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = written(spark, sized.groupBy("doc_id", "text_key", "source").agg(F.max("size").alias("size"), F.count("*").alias("rows")), "sized")
    targets = source_targets(sized.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, share, most)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumnRenamed("source", "name")
    items = sized.join(targets, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "text_key", "source", "size", "rows", "source_size", "target", F.floor(due).alias("whole"),
        (due - F.floor(due)).alias("part"),
        F.pmod(F.xxhash64("doc_id", "text_key"), F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP))).cast("long").alias("bucket"))
    depth = items.agg(F.max("bucket")).first()[0] or 0

    def level(table: pa.Table) -> pa.Table:
        # The longest first: what stays open at the end is then a short one.
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("text_key", "ascending")])
        ids = table["doc_id"].fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
        keys = mixed(ids) ^ table["text_key"].to_numpy().astype(np.int64).view(np.uint64)
        chosen, rest = settle(keys, table["size"].to_numpy() * table["rows"].to_numpy(), table["part"].to_numpy(), seed)
        whole, part = table["whole"].to_numpy().copy(), np.zeros(len(keys))
        whole[chosen] += 1
        for i, p in rest:
            part[i] = p
        at = table.schema.names.index
        table = table.set_column(at("whole"), "whole", pa.array(whole)).set_column(at("part"), "part", pa.array(part))
        return table.set_column(at("bucket"), "bucket", pa.array(table["bucket"].to_numpy() // FAN))

    out = None
    while True:
        settled = written(spark, items.groupBy("source", "bucket").applyInArrow(level, ROWS), "mixed")
        last = not depth
        done = settled if last else settled.where("part = 0")
        out = done if out is None else out.unionByName(done)
        if last:
            break
        items, depth = settled.where("part > 0"), depth // FAN
    # What the root leaves open is one document a source: its own draw decides.
    draw = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return out.select("doc_id", "text_key", "source", "size", "rows", "source_size", "target", (F.col("whole") + F.when(draw < F.col("part"), 1).otherwise(0)).alias("copies"))
