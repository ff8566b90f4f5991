"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact sorted-array intersection.

A document's set is its distinct word shingles, as sorted 64-bit numbers. Linked sets share a number among the first
few of either in any common order of numbers, so a tile holds the documents that share such a number. Numbers that
are seen often come last in the order, which keeps tiles small; the order has no part in what is found. Within a
tile, sizes and the bits in which two signatures differ bound the overlap from above; what passes is intersected.

Each document is first held against one other, of the smallest doc_ids of its tiles the one that it shares most tiles
with. Documents that this has tied into one component need no comparison with each other, so the groups of copies,
however large, cost about as many comparisons as they have members. Tiles with the same documents are one from then on.
They are cut into blocks in order of size, and pairs of blocks within the size band are compared in separate tasks, each
pair of documents in the first tile that both have. The members that have a candidate left there get their sets, and the
same pair of blocks then intersects them and returns links that tie what they tie, never more than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspan.llm.components import components
from navspan.llm.shared import frugal, runs, slices, text_bytes, written
from navspan.llm.words import U, mixed, shingles, sorted_distinct, words

SHINGLE, PERCENT = 5, 75
#: Bits of a signature: a power of two, from three quarters of the set's size on, within these bounds. Of sets without
#: common numbers, three bits in eight differ or more; of linked ones, numbers for two in seven at most.
LEAST_BITS, MOST_BITS = 64, 1 << 16
#: A block has at most so many documents, and, unless one alone has more, about so many numbers.
BLOCK, BLOCK_NUMBERS = 256, 1 << 20
#: Of a document's tiles, the first ones that it carries: a pair that shares one of them is compared in the first of these only.
FIRST_TILES = 16
#: A number counts as frequent from so many documents on, when so many of one run of texts have it.
FREQUENT, FREQUENT_HERE = 16, 3
#: Frequent numbers that tasks are told of: at most 2 MB. Of more, the most frequent.
TOLD = 1 << 18
#: Bits of the map of candidates, a bound of 512 KB; one that is full lets all documents pass, nothing else changes.
MAP_BITS = 1 << 22
RUN_BYTES = 32 << 20


def text_sets(part: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted set of each text of a batch."""
    hashes, bounds = words(*text_bytes(part["text"]), fold=True)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield sorted_distinct(shingles(hashes[a:b], size))


def identity(numbers: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers for a set."""
    pair = (mixed(numbers ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mixed(numbers + U(0x14057B7EF767814F)).sum(dtype=np.uint64))
    return tuple(int(x) for x in np.array(pair).view(np.int64))


def signature(numbers: np.ndarray) -> bytes:
    """For each bit, whether an odd number of the set's numbers fall on it."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (3 * len(numbers) // 4).bit_length()))
    return np.packbits(np.bincount((numbers & U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """In how many bits the signatures of each pair differ; the longer one is folded to the length of the other."""
    sizes = np.array([[len(a), len(b)] for a, b in zip(x, y, strict=True)], np.int64).reshape(-1, 2)
    out = np.zeros(len(x), np.int64)
    for m, n in sorted(set(map(tuple, sizes.tolist()))):
        at = np.flatnonzero((sizes == (m, n)).all(axis=1)).tolist()
        step = max(1, (8 << 20) // (m + n))
        for i in range(0, len(at), step):
            part = at[i : i + step]
            a, b = (np.frombuffer(b"".join(v[k] for k in part), np.uint64).reshape(len(part), -1) for v in (x, y))
            while a.shape[1] != b.shape[1]:
                a, b = (v if v.shape[1] == min(a.shape[1], b.shape[1]) else v[:, : v.shape[1] // 2] ^ v[:, v.shape[1] // 2 :] for v in (a, b))
            out[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return out


def head(numbers: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Those first numbers of a set, frequent ones last, of which a linked set has at least one among its own."""
    n = len(numbers) - -(-percent * len(numbers) // 100) + 1
    if len(frequent):
        at = np.searchsorted(frequent, numbers)
        often = frequent[np.minimum(at, len(frequent) - 1)] == numbers
        numbers = np.concatenate([numbers[~often][:n], numbers[often][: max(0, n - int((~often).sum()))]])
    return numbers[:n]


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: doc_id, n, h1, h2, bits; and rows (number, count) for what repeats in a run of texts."""
    fields = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("bits", pa.binary()), ("number", pa.int64()), ("count", pa.int64())])

    def often(numbers: list[np.ndarray]) -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(numbers), return_counts=True) if numbers else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        found, count = found[count >= FREQUENT_HERE], count[count >= FREQUENT_HERE]
        empty = [pa.nulls(len(found), f.type) for f in fields][:5]
        return pa.RecordBatch.from_arrays([*empty, pa.array(found.view(np.int64)), pa.array(count)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        total = 0
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for numbers in text_sets(part, size):
                    name = identity(numbers)
                    rows.append((len(numbers), *name, signature(numbers)))
                    if name not in seen and len(numbers):
                        seen.add(name)
                        held.append(numbers)
                        total += numbers.nbytes
                n, h1, h2, bits = zip(*rows, strict=True)
                empty = [pa.nulls(len(rows), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(bits, pa.binary()), *empty], schema=fields)
                if total > RUN_BYTES:
                    yield often(held)
                    held, total = [], 0
                    seen.clear()
        yield often(held)

    return docs.select("doc_id", "text").mapInArrow(frugal(run), "doc_id long, n long, h1 long, h2 long, bits binary, number long, count long")


def frequent_numbers(rows: DataFrame) -> np.ndarray:
    """The frequent numbers, sorted; at most TOLD of them, a bounded table."""
    counts = rows.where("number is not null").groupBy("number").agg(F.sum("count").alias("count")).where(F.col("count") >= FREQUENT)
    top = counts.orderBy(F.desc("count"), "number").limit(TOLD)
    return np.sort(np.array([r[0] for r in top.select("number").toLocalIterator()], np.int64).view(np.uint64))


def heads(docs: DataFrame, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Rows (number, doc_id): the head of each set; of equal sets in one task, the first one's."""
    told = docs.sparkSession.sparkContext.broadcast(frequent)
    fields = pa.schema([("number", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(i, head(x, told.value, percent)) for i, x in enumerate(text_sets(part, size)) if len(x) and (name := identity(x)) not in seen and not seen.add(name)]
                if not found:
                    continue
                numbers = np.concatenate([x for _, x in found]).view(np.int64)
                ids = part["doc_id"].take(pa.array(np.repeat([i for i, _ in found], [len(x) for _, x in found])))
                for at in range(0, len(numbers), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[at : at + (1 << 18)]), ids[at : at + (1 << 18)]], schema=fields)

    return docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(frugal(run), "number long, doc_id long")


def candidate_map(ids: DataFrame) -> np.ndarray:
    """A bit map in which the slot of each id is set; it has no more than MAP_BITS bits, whatever the ids are."""
    slot = F.pmod(F.xxhash64("id"), F.lit(MAP_BITS))
    parts = ids.select((slot / 32).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {MAP_BITS}) % 32 as int))").alias("bit"))
    parts = parts.groupBy("at").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(MAP_BITS // 32, np.uint32)
    for at, bits in parts.collect():
        out[at] = bits
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray | int, percent: int) -> np.ndarray:
    """Whether sets of n and m numbers, of which so many at least are in one only, can be linked."""
    overlap = np.minimum(np.minimum(n, m), (n + m - differ) // 2)
    return 100 * overlap >= percent * (n + m - overlap)


def bounded(pairs: DataFrame, profile: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) that their sizes and signatures do not rule out."""
    for side in "ab":
        pairs = pairs.join(profile.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = differing(batch["bits_a"].to_pylist(), batch["bits_b"].to_pylist())
            yield batch.filter(pa.array(may_link(batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), differ, percent))).select(["a", "b"])

    near = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return pairs.where(near).mapInArrow(frugal(run), "a long, b long").distinct()


def sets_of(spark: SparkSession, docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """The sets (id, m, numbers) of the documents with these ids, and of few others; m is the set's size."""
    wanted = spark.sparkContext.broadcast(candidate_map(ids))
    fields = pa.schema([("id", pa.int64()), ("m", pa.int64()), ("numbers", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.value[batch["slot"].to_numpy()]))
            for part in slices(batch, "text"):
                found = [(len(x), x.tobytes()) for x in text_sets(part, size)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([m for m, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], schema=fields)

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS)).alias("slot")
    sets = docs.where("doc_id is not null").select("doc_id", "text", slot).mapInArrow(frugal(sets), "id long, m long, numbers binary")
    return written(spark, sets, "sets")


def linked(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether the exact intersection of a sorted set with each of the others is large enough."""
    if not len(x) or not others:
        return np.zeros(len(others), bool)
    sizes = np.array([len(y) for y in others], np.int64)
    every = np.concatenate(others)
    hits = np.append(0, np.cumsum(x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every))
    ends = np.cumsum(sizes)
    common = hits[ends] - hits[ends - sizes]
    return (common > 0) & (100 * common >= percent * (len(x) + sizes - common))


def verified(spark: SparkSession, docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs whose sets' exact intersection is large enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = sets_of(spark, docs, ids, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = sorted((np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), key=len, reverse=True)
                keep.append(bool(linked(x, [y], percent)[0]))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("numbers").alias("x")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("numbers").alias("y")), "b")
    return joined.mapInArrow(frugal(run), "a long, b long").distinct()


def apart(p: np.ndarray, q: np.ndarray, number: int, first: list[list[int]]) -> np.ndarray:
    """Which pairs share no earlier tile than this one among the first ones that each carries."""
    before = [{t for t in tiles if t < number} for tiles in first]
    return np.array([before[i].isdisjoint(before[j]) for i, j in zip(p.tolist(), q.tolist(), strict=True)], bool)


def candidates(tile: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of a pair of blocks that are to be compared here and that sizes and signatures do not rule out."""
    block, ids, n, root = (tile[c].to_numpy() for c in ("block", "id", "n", "root"))
    x, y = np.flatnonzero(block == tile["i"][0].as_py()), np.flatnonzero(block == tile["j"][0].as_py())
    p, q = np.nonzero((root[x][:, None] != root[y]) & may_link(n[x][:, None], n[y], 0, percent) & ((ids[x][:, None] < ids[y]) | (block[x][:, None] != block[y])))
    p, q = x[p], y[q]
    bits = tile["bits"].to_pylist()
    fit = may_link(n[p], n[q], differing([bits[k] for k in p], [bits[k] for k in q]), percent)
    p, q = p[fit], q[fit]
    fit = apart(p, q, tile["number"][0].as_py(), tile["first"].to_pylist())
    return p[fit], q[fit]


def tied(p: np.ndarray, q: np.ndarray, root: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Of pairs of rows those that are linked, without the ones whose components are already tied here. p is sorted."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    cuts = np.flatnonzero(np.diff(p)) + 1
    for i, others in zip(p[np.append(0, cuts)].tolist() if len(p) else [], np.split(q, cuts), strict=len(p) > 0):
        own = top(root[i])
        others = [j for j in others.tolist() if top(root[j]) != own]
        for j in (j for j, found in zip(others, linked(sets[i], [sets[j] for j in others], percent), strict=True) if found):
            if (a := top(root[i])) != (b := top(root[j])):
                above[max(a, b)] = min(a, b)
                yield i, j


def tile_links(spark: SparkSession, docs: DataFrame, shared: DataFrame, profile: DataFrame, root: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that tie all that is linked within tiles and not of one component yet; a pair of blocks gives fewer
    than it has members."""
    members = shared.join(root.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    # Of tiles with the same documents, one.
    tiles = members.groupBy("number").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who"), F.count("*").alias("size"))
    tiles = tiles.where("low < high").groupBy("who", "size").agg(F.min("number").alias("number")).select("number")
    members = members.join(tiles, "number")
    members = members.withColumn("first", F.slice(F.sort_array(F.collect_list("number").over(Window.partitionBy("id"))), 1, FIRST_TILES))
    members = members.join(profile, "id")
    order = Window.partitionBy("number").orderBy("n", "id", "key")
    place, numbers = F.row_number().over(order) - 1, F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    members = members.withColumn("block", F.floor(place / BLOCK + F.coalesce(numbers, F.lit(0)) / BLOCK_NUMBERS).cast("int"))
    members = members.withColumn("last", F.max("block").over(Window.partitionBy("number")))
    columns = ["number", "i", "j", "block", "id", "n", "key", "root", "first", "bits", "last"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members with a candidate; those of tiles of several blocks all pass."""
        for tile in runs(batches, ["number", "i", "j"]):
            left = np.arange(len(tile)) if tile["last"][0].as_py() else np.unique(np.concatenate(candidates(tile, percent)))
            if len(left):
                yield from tile.take(pa.array(left)).combine_chunks().to_batches()

    # Tiles of one block are compared where they were ordered, without another exchange.
    members = members.withColumns({"i": F.col("block"), "j": F.col("block")}).select(*columns).sortWithinPartitions("number", "block")
    members = written(spark, members.mapInArrow(frugal(compare), members.schema), "members")
    large = members.where("last > 0").drop("i", "j").withColumn("last", F.lit(0))
    blocks = large.groupBy("number", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left, right = blocks.alias("l"), blocks.alias("r")
    near = (F.col("l.number") == F.col("r.number")) & (F.col("l.block") <= F.col("r.block")) & (F.col("l.high") * 100 >= F.col("r.low") * percent)
    tiles = left.join(right, near).select(F.col("l.number").alias("number"), F.col("l.block").alias("i"), F.col("r.block").alias("j"))
    first = large.join(tiles, (large["number"] == tiles["number"]) & (large["block"] == tiles["i"])).drop(tiles["number"])
    second = large.join(tiles.where("i < j"), (large["number"] == tiles["number"]) & (large["block"] == tiles["j"])).drop(tiles["number"])
    rows = first.select(*columns).unionByName(second.select(*columns))
    rows = rows.repartition("number", "i", "j").sortWithinPartitions("number", "i", "j", "block")
    rows = rows.mapInArrow(frugal(compare), rows.schema)
    left = written(spark, members.where("last = 0").unionByName(rows), "left")
    sets = sets_of(spark, docs, left.select("id").distinct(), size)
    # Texts of one size of a doc_id meet each other's rows too, which finds no link that is none.
    full = left.join(sets.withColumnsRenamed({"id": "of"}), (F.col("id") == F.col("of")) & (F.col("n") == F.col("m"))).select(*columns, "numbers")
    full = full.repartition("number", "i", "j").sortWithinPartitions("number", "i", "j", "block")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ["number", "i", "j"]):
            p, q = candidates(tile, percent)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tile["numbers"]]
            ids = tile["id"].to_pylist()
            found = [(ids[i], ids[j]) for i, j in tied(p, q, tile["root"].to_pylist(), sets, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([f(x) for x in found], pa.int64()) for f in (min, max)], ["a", "b"])

    return full.mapInArrow(frugal(verify), "a long, b long")


def jaccard_join(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of documents (doc_id, text), the groups by shingle sets that have 100 * overlap >= percent * union.

    One row per row of docs: doc_id, n_shingles (set size), class_id (smallest doc_id with the same set; null for an
    empty set) and component_id (smallest doc_id reachable by links, itself included). Words are
    `[^\\x20\\x09-\\x0D]+` with A-Z as a-z; a text with fewer words than `size` is one shingle; null counts as empty,
    and an empty set links with nothing. Rows that repeat a doc_id count as one document with several texts, and a
    null doc_id links with nothing. An empty table gives no rows; other columns are ignored. Shingles are told apart by
    64-bit hashes and equal sets found by 128 bits; nothing else is approximate.
    """
    found = written(spark, profiles(docs, size), "profiles")
    rows = found.where("number is null").select("doc_id", "n", "h1", "h2", "bits")
    usable = rows.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("class_id"))
    member = written(spark, usable.join(classes, ["h1", "h2", "n"]).select("doc_id", "class_id", "n").distinct(), "classes")
    profile = usable.select("doc_id", "n", "bits").join(member.where("doc_id = class_id").select("doc_id", "n"), ["doc_id", "n"], "left_semi")
    profile = profile.withColumnRenamed("doc_id", "id")
    # Several texts of one doc_id can be of one size; their signatures are told apart by a key, which is 0 elsewhere.
    several = profile.groupBy("id", "n").agg(F.min(F.xxhash64("bits")).alias("low"), F.max(F.xxhash64("bits")).alias("high")).where("low < high")
    several = written(spark, several.select("id", "n", F.lit(True).alias("several")), "several")
    profile = profile.distinct().join(several, ["id", "n"], "left")
    profile = profile.select("id", "n", "bits", F.when(F.col("several"), F.xxhash64("bits")).otherwise(F.lit(0)).alias("key"))
    profile = written(spark, profile, "profile")

    numbers = heads(docs, size, percent, frequent_numbers(found)).repartition("number")
    tile = Window.partitionBy("number")
    numbers = numbers.withColumn("low", F.min("doc_id").over(tile)).withColumn("high", F.max("doc_id").over(tile)).where("low < high")
    numbers = numbers.select("number", "doc_id").join(member.select("doc_id", "class_id"), "doc_id")
    shared = written(spark, numbers.select("number", F.col("class_id").alias("id")).distinct(), "shared")
    leads = shared.groupBy("number").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("number", "a")
    pairs = leads.join(shared.withColumnRenamed("id", "b"), "number").where("a < b").groupBy("a", "b").agg(F.count("*").alias("tiles"))
    pairs = pairs.groupBy("b").agg(F.max(F.struct("tiles", (-F.col("a")).alias("a"))).alias("best")).select((-F.col("best.a")).alias("a"), "b")
    pairs = written(spark, bounded(pairs, profile, percent), "pairs")
    # Several texts of one doc_id tie the classes that they are in.
    repeats = member.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("c")).where("a < c").select("doc_id", "a")
    links = verified(spark, docs, pairs, size, percent).union(repeats.join(member.select("doc_id", F.col("class_id").alias("b")), "doc_id").select("a", "b"))
    links = written(spark, links, "links")
    root = components(spark, links)
    more = tile_links(spark, docs, shared.join(leads.select("number"), "number"), profile, root, size, percent)
    more = written(spark, more, "more")
    if not more.isEmpty():
        root = components(spark, links.union(more))
    ties = member.groupBy("doc_id").agg(F.min("class_id").alias("class_id")).join(root.withColumnRenamed("node", "class_id"), "class_id", "left")
    ties = ties.select(F.col("doc_id").alias("id"), "class_id", F.coalesce("root", "class_id").alias("component_id"))
    return rows.join(ties, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class_id")).alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
