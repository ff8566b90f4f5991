"""Centroid clustering by dimension-sharded Lloyd rounds on whole numbers.

Vectors are cut into blocks of columns. A task holds a block's slices and the centroids' slices of the same columns and
computes exact partial squared distances; these are added by vector, and the least sum is the vector's centroid. Then
each shard adds up its own slices by centroid and moves its own slice of every centroid. No task ever needs a whole
vector, and all numbers are integers, so results are the same however rows are dealt.

Slices are written once, with a number for each vector. A round's assignment is one narrow table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.shared import written

CENTROIDS, ROUNDS, SCALE, DIMENSIONS, SEED = 8, 10, 1024, 64, 3
#: Columns of a block.
BLOCK = 16
#: Scaled components are within this, so that a distance over DIMENSIONS of them fits in 64 bits.
MOST = 1 << 27


def scaled(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the scaled vector (whole numbers) of each usable row."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    usable = (F.size("embedding") == dimensions) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform(x, lambda x: F.floor(x * float(scale))).alias("vector"))
    wide = F.exists("vector", lambda x: F.abs(x) > MOST)
    message = F.concat(F.lit("a component is beyond what distances can be told in: vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return rows.select("vec_id", F.when(wide, F.raise_error(message).cast("array<long>")).otherwise(F.col("vector")).alias("vector"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of their vec_id; null ids last, of equal ids the smallest vector first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(key.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([r[0] for r in first], np.int64)


def slices_of(rows: DataFrame, block: int, dimensions: int) -> DataFrame:
    """Rows (row, block, slice): a vector's columns, block by block."""
    parts = [F.struct(F.lit(b).alias("block"), F.slice("vector", b * block + 1, block).alias("slice")) for b in range(-(-dimensions // block))]
    return rows.select("row", F.explode(F.array(*parts)).alias("s")).select("row", "s.block", "s.slice")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are of one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The places of a batch's rows of each block, and their slices."""
    blocks = batch["block"].to_numpy()
    for b in np.unique(blocks).tolist():
        at = np.flatnonzero(blocks == b)
        yield b, at, matrix(batch["slice"].take(pa.array(at)))


def partial_distances(slices: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(row, d0, d1, ...): what each block adds to a vector's squared distance from each centroid."""
    # Broadcast: centroids times dimensions, whatever the number of vectors.
    told = slices.sparkSession.sparkContext.broadcast(centroids)
    names = [f"d{j}" for j in range(len(centroids))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(names), len(batch)), np.int64)
            for b, at, values in by_block(batch):
                for j, centre in enumerate(told.value[:, b * block : (b + 1) * block]):
                    out[j, at] = ((values - centre) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch["row"], *[pa.array(x) for x in out]], ["row", *names])

    return slices.mapInArrow(run, "row long, " + ", ".join(f"{n} long" for n in names))


def assigned(slices: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(row, cluster, distance): the nearest centroid of each vector; of equally near ones the first."""
    names = [f"d{j}" for j in range(len(centroids))]
    sums = partial_distances(slices, centroids, block).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    best = F.least(*names) if len(names) > 1 else F.col(names[0])
    sums = sums.select("row", best.alias("distance"), F.array(*names).alias("all"))
    return sums.select("row", (F.array_position("all", F.col("distance")) - 1).cast("int").alias("cluster"), "distance")


def moved(slices: DataFrame, assignment: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """The centroids after each shard has moved its slices to the floor of their vectors' mean; empty ones stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for batch in batches:
            clusters = batch["cluster"].to_numpy()
            for b, at, values in by_block(batch):
                for c in np.unique(clusters[at]).tolist():
                    own = values[clusters[at] == c]
                    count, total = sums.get((b, c), (0, [0] * values.shape[1]))
                    # A batch's sums fit in 64 bits; those of a task are Python's whole numbers.
                    sums[b, c] = count + len(own), [x + y for x, y in zip(total, own.sum(axis=0).tolist(), strict=True)]
        keys = list(sums)
        columns = [[b for b, _ in keys], [c for _, c in keys], [sums[k][0] for k in keys]]
        totals = pa.array([[str(x) for x in sums[k][1]] for k in keys], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in columns], totals], ["block", "cluster", "n", "total"])

    sums = slices.join(assignment.select("row", "cluster"), "row").select("block", "cluster", "slice")
    sums = sums.mapInArrow(run, "block long, cluster long, n long, total array<string>")
    sums = sums.select("block", "cluster", "n", F.posexplode("total").alias("at", "x")).groupBy("block", "cluster", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    # As many rows as the centroids have components. Floors, also of negative sums.
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"], r["block"] * block + r["at"]] = int(r["x"]) // r["n"]
    return out


def clusters(
    spark: SparkSession, vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: int = SCALE, block: int = BLOCK, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """The rows (vec_id, cluster, distance) of the usable vectors of (vec_id, embedding), and the final centroids.

    A component x counts as floor(scale * x). Usable are vectors of `dimensions` components, none of them null or not
    finite; others are left out. The k vectors with the smallest hash of their vec_id start as centroids (fewer where
    there are fewer vectors; a null vec_id comes last); each of the `rounds` assigns every vector to the nearest one, the
    first of equally near ones, and moves each centroid to the floor of its vectors' mean. One without vectors stays.
    distance is squared. Rows that repeat count each; an empty table gives no rows; other columns are ignored. Components
    beyond 2^27 after scaling are an error, as distances would not fit in 64 bits.
    """
    rows = scaled(vectors.select("vec_id", "embedding"), dimensions, scale)
    rows = written(spark, rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, dimensions), np.int64)
    slices = written(spark, slices_of(rows, block, dimensions), "slices")
    for _ in range(rounds):
        before, centroids = centroids, moved(slices, assigned(slices, centroids, block), centroids, block)
        if (before == centroids).all():
            break  # All further rounds would do the same.
    nearest = assigned(slices, centroids, block)
    return rows.select("vec_id", "row").join(nearest, "row").select("vec_id", "cluster", "distance"), centroids
