"""Embedding near-dedup: spherical k-means assigns vectors to cells, blocked cosine products compare within cells, and
one representative of each group is kept.

Equal vectors of one label are one class, compared once. A label with more classes than a cell should hold is split
into cells around centroids, fitted on a bounded sample. A vector belongs to the cell of its nearest centroid, and
also visits each later cell whose border is within the chord that the least cosine allows: a linked pair therefore
always meets in the later of its two own cells, and the result does not hang on the cells. A cell of any size is cut
into blocks, and pairs of blocks are multiplied in separate tasks, which return counts and a spanning forest of links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.components import components
from navspan.llm.shared import written

COSINE = 0.93
#: Classes that a cell should hold; cells of all labels together; sampled classes a cell; rounds of k-means.
CELL, CELLS, SAMPLE, ROUNDS = 2048, 4096, 16, 8
BLOCK = 1024


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows in double precision, each of length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = flat.reshape(len(column), -1)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def centroids(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: directions that maximise the cosine to their vectors. Starts from spread vectors."""
    chosen, near = [0], vectors @ vectors[0]
    for _ in range(k - 1):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centre = vectors[chosen]
    for _ in range(rounds):
        cell = (vectors @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, cell, vectors)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(length > 0, total / np.where(length > 0, length, 1), centre)
    return centre


def fitted(classes: DataFrame, cell: int, cells: int) -> dict[tuple, np.ndarray]:
    """Centroids of each (label, dim) with more classes than one cell should hold, `cells` in all at most."""
    large = classes.groupBy("label", "dim").count().where(F.col("count") > cell).orderBy(F.desc("count"), "label", "dim").limit(cells // 2)
    large = [((r["label"], r["dim"]), r["count"]) for r in large.collect()]
    share = min(1.0, cells / max(1, sum(math.ceil(n / cell) for _, n in large)))
    wanted = {key: max(2, math.floor(share * math.ceil(n / cell))) for key, n in large}
    if not wanted:
        return {}
    part = [(*key, wanted[key], min(1.0, SAMPLE * wanted[key] / n)) for key, n in large]
    part = F.broadcast(classes.sparkSession.createDataFrame(part, "label int, dim int, k int, part double"))
    draw = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = classes.join(part, ["label", "dim"]).where(draw <= F.col("part")).select("label", "dim", "k", "embedding")

    def fit(rows: pa.Table) -> pa.Table:
        vectors = matrix(rows["embedding"])
        found = centroids(vectors[np.lexsort(vectors.T)], min(rows["k"][0].as_py(), len(vectors)))
        return pa.table({"label": rows["label"][:1].combine_chunks(), "dim": rows["dim"][:1].combine_chunks(), "centre": pa.array([found.ravel()], pa.list_(pa.float64()))})

    model = sample.groupBy("label", "dim").applyInArrow(fit, "label int, dim int, centre array<double>")
    return {(r["label"], r["dim"]): np.array(r["centre"]).reshape(-1, r["dim"]) for r in model.collect()}


def placed(classes: DataFrame, model: dict[tuple, np.ndarray], cosine: float) -> DataFrame:
    """A row for each cell that a class belongs to or visits: class_id, label, dim, embedding, copies, home, cell."""
    told = classes.sparkSession.sparkContext.broadcast(model)
    reach = math.sqrt(2 - 2 * cosine) + 1e-9
    schema = pa.schema([("class_id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()), ("embedding", pa.list_(pa.float32())), ("copies", pa.int64()), ("home", pa.int32()), ("cell", pa.int32())])

    def run(batches):
        for batch in batches:
            home, rows, cells = np.zeros(len(batch), np.int32), [], []
            keys = list(zip(batch["label"].to_pylist(), batch["dim"].to_pylist(), strict=True))
            for key in dict.fromkeys(keys):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                if key not in told.value:
                    rows.append(at)
                    cells.append(np.zeros(len(at), np.int32))
                    continue
                centre = told.value[key]
                near = matrix(batch["embedding"].take(pa.array(at))) @ centre.T
                own = near.argmax(axis=1)
                home[at] = own
                apart = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0))[own]
                margin = near[np.arange(len(at)), own][:, None] - near
                visits = (margin <= reach * apart) & (np.arange(len(centre)) > own[:, None])
                visits[np.arange(len(at)), own] = True
                row, cell = np.nonzero(visits)
                rows.append(at[row])
                cells.append(cell.astype(np.int32))
            rows = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            taken = batch.take(rows)
            columns = [*taken.columns, pa.array(home).take(rows), pa.array(np.concatenate(cells) if cells else np.zeros(0, np.int32))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    columns = ["class_id", "label", "dim", "embedding", "copies"]
    return classes.select(*columns).mapInArrow(run, "class_id long, label int, dim int, embedding array<float>, copies long, home int, cell int")


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those links that tie nodes not tied by earlier ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if (p := root(x)) != (q := root(y)):
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def compared(placed: DataFrame, cosine: float, block: int) -> DataFrame:
    """Of all pairs of blocks of a cell: (a, b) links of a spanning forest, and (a, links) counts of linked rows."""
    cell = ["label", "dim", "cell"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = placed.join(blocks, cell).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    # Block x meets x itself and every other block once: as first side of (x, y), y > x, or as second of (y, x).
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def multiply(rows: pa.Table) -> pa.Table:
        first = rows.filter(pc.equal(rows["block"], rows["i"][0]))
        second = rows.filter(pc.equal(rows["block"], rows["j"][0]))
        here = rows["cell"][0].as_py()
        if not len(first) or not len(second):
            return table([], [], [], [])
        x, y = matrix(first["embedding"]), matrix(second["embedding"])
        a, b = first["class_id"].to_numpy(), second["class_id"].to_numpy()
        home_a, home_b = first["home"].to_numpy(), second["home"].to_numpy()
        copies_a, copies_b = first["copies"].to_numpy(), second["copies"].to_numpy()
        at, to = [], []
        for s in range(0, len(x), 256):
            p, q = np.nonzero(x[s : s + 256] @ y.T >= cosine)
            p += s
            fit = np.maximum(home_a[p], home_b[q]) == here
            if rows["i"][0] == rows["j"][0]:
                fit &= a[p] < b[q]
            at.append(p[fit])
            to.append(q[fit])
        p, q = np.concatenate(at), np.concatenate(to)
        links_a = np.bincount(p, weights=copies_b[q], minlength=len(a)).astype(np.int64)
        links_b = np.bincount(q, weights=copies_a[p], minlength=len(b)).astype(np.int64)
        tree = forest(a[p], b[q])
        return table([u for u, _ in tree], [v for _, v in tree], np.concatenate([a[links_a > 0], b[links_b > 0]]), np.concatenate([links_a[links_a > 0], links_b[links_b > 0]]))

    def table(a, b, counted, links) -> pa.Table:
        n, m = len(a), len(counted)
        return pa.table({
            "a": pa.concat_arrays([pa.array(a, pa.int64()), pa.array(counted, pa.int64())]),
            "b": pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(m, pa.int64())]),
            "links": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(links, pa.int64())])})

    return rows.groupBy(*cell, "i", "j").applyInArrow(multiply, "a long, b long, links long")


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """Of (vec_id, embedding, label): n_links, component_id and kept of each row.

    Rows with the same label are linked when the cosine of their embeddings, in double precision, is at least `cosine`;
    equal embeddings always are. A null label, and an embedding that is null, empty, zero or holds a null or non-finite
    component, links with nothing; so do embeddings of different lengths with each other. component_id is the smallest
    vec_id reachable by links (ties and repeated vec_ids: each row is a vector, and counts), and a row is kept when it
    is its vec_id. An empty table gives no rows; other columns are ignored. Links inside one huge group of different
    vectors are all counted, which takes products as the square of the group's size, spread over tasks by blocks.
    """
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int").alias("label"))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    good &= F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    good &= F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    usable = vectors.where(good)
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = written(spark, classes.select(F.monotonically_increasing_id().alias("class_id"), "*", F.size("embedding").alias("dim")), "vectors")
    model = fitted(classes, cell, cells)
    found = written(spark, compared(placed(classes, model, cosine), cosine, block), "cosines")
    links = found.where("links is not null").groupBy(F.col("a").alias("class_id")).agg(F.sum("links").alias("links"))
    root = components(spark, found.where("b is not null").select("a", "b"))
    known = classes.join(root, F.col("class_id") == F.col("node"), "left").join(links, "class_id", "left")
    known = known.select("label", "embedding", "first_id", F.coalesce("root", "class_id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(least, "root").select("label", "embedding", "n_links", "component_id")
    out = usable.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = vectors.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
