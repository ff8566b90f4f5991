"""Line dedup by a deletion-neighbourhood join: lines that are equal, or one edit apart, are dropped but the earliest.

Two lines are one edit apart when deleting one character from one or both makes them equal at the same place. The
neighbourhood of a line is a key for each such deletion; lines with an equal key are neighbours. Most lines have none,
so keys are made in three steps, each only for the lines that the step before left: halves, eighths, characters. A line
cut into parts is keyed by all but one part, and one edit apart means that one such key is equal: the lines are the same
but for this part. Characters are then deleted within the parts that differ.

Equal lines are one before that, and a key's earliest line is an aggregate, so a group of any size costs no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.native import let
from navspan.llm.shared import written

#: Lines to look up whose places are sent to all tasks, at most (some 50 bytes each); beyond that, texts are shuffled.
BROADCAST = 1_000_000
SPACES = " \t\r\v\f"
PARTS = 8
AT = ["doc_id", "text_key", "line_no"]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no and line of each line that is not blank, without the spaces around it."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", F.lit("\n"))).alias("line_no", "line"))
    return lines.withColumn("line", F.trim("line", F.lit(SPACES))).where("line <> ''")


def half_keys(line: Column) -> Column:
    """Keys of a line's first and last half. One edit leaves one of them as it is: that of half the longer line's
    characters, rounded down, which the shorter one has as half of one character more."""
    n = F.length(line)
    keys = [F.xxhash64(half, F.lit(i)) for size in (F.shiftright(n, 1), F.shiftright(n + 1, 1)) for i, half in enumerate((F.substr(line, F.lit(1), size), F.substr(line, n - size + 1, size)))]
    return F.when(n % 2 == 0, F.array(*keys[:2])).otherwise(F.array(*keys))


def part_keys(line: Column, parts: int) -> Column:
    """Keys (key, rest) of all of a line but one of its parts, and that part.

    A line of n characters is cut as one of n is, and as one of n + 1 is: of two lines that differ in length, the
    shorter one lacks a character within the part.
    """
    def keys(size: Column) -> list[Column]:
        out = []
        for j in range(parts):
            before, after = F.floor(size * j / parts).cast("int"), (size - F.floor(size * (j + 1) / parts)).cast("int")
            kept = [F.left(line, before), F.right(line, after), size * parts + j]
            # Two hashes, 128 bits: what stands beside the part is not compared again.
            out.append(F.struct(F.struct(F.xxhash64(*kept).alias("a"), F.xxhash64(F.lit(1), *kept).alias("b")).alias("key"), F.substr(line, before + 1, F.length(line) - before - after).alias("rest")))
        return out

    return F.array(*keys(F.length(line)), *keys(F.length(line) + 1))


def shared(rows: DataFrame) -> DataFrame:
    """Rows (key, id, ...) whose key several ids have."""
    often = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    return rows.join(often, "key")


def neighbours(rest: Column) -> Column:
    """Keys of a part, by kind: itself (w), and it with one character deleted, at that place (s) or anywhere (d)."""
    def deleted(i: Column) -> Column:
        return F.concat(F.left(rest, i), F.substr(rest, i + 2, F.length(rest)))

    places = F.when(F.length(rest) > 0, F.sequence(F.lit(0), F.length(rest) - 1)).otherwise(F.array().cast("array<int>"))
    one = F.transform(places, lambda i: F.struct(F.lit("s").alias("kind"), F.xxhash64(deleted(i), i, F.length(rest)).alias("variant")))
    any_ = F.transform(places, lambda i: F.struct(F.lit("d").alias("kind"), F.xxhash64(deleted(i)).alias("variant")))
    return F.concat(F.array(F.struct(F.lit("w").alias("kind"), F.xxhash64(rest).alias("variant"))), one, F.array_distinct(any_))


def dropped_lines(spark: SparkSession, docs: DataFrame, least: int = 1) -> DataFrame:
    """The lines (doc_id, text_key, line_no from 0) of docs (doc_id, text) that an earlier line makes superfluous.

    Lines end at line feeds, and spaces around them don't count. Blank lines always stay. Another line stays unless an
    equal one, or one within one edit (a character put in, left out or changed), stands earlier; with `least`, lines of
    fewer characters are compared as wholes only. Earlier is by doc_id (null first), then text_key (a hash of the text),
    then its place. Whether that one stays itself does not matter. Rows that repeat both doc_id and text are the same
    lines. Null counts as empty; an empty table gives no rows; other columns are ignored.
    """
    lines = lines_of(docs)
    halves = F.when(F.length("line") >= least, half_keys(F.col("line")))
    occurrences = lines.select(*AT, F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"), halves.alias("halves"))
    same = ["h1", "h2"]
    distinct = occurrences.groupBy(*same, "halves").agg(F.min(F.struct(*AT)).alias("first"), F.count("*").alias("n"))
    distinct = written(spark, distinct.select(F.monotonically_increasing_id().alias("id"), "*"), "lines")

    keys = distinct.where("halves is not null").select("id", F.explode("halves").alias("key"))
    some = written(spark, shared(keys).select("id").distinct().join(distinct.select("id", "first"), "id"), "some")
    # Of the texts, only those with such a line leave the scan.
    wanted = some.groupBy(F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("k")).agg(F.collect_list(F.struct("first.line_no", "id")).alias("wanted"))
    wanted = F.broadcast(wanted) if some.count() <= BROADCAST else wanted
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    texts = texts.select("doc_id", "text_key", F.split("text", F.lit("\n")).alias("lines"), "wanted")
    found = texts.select("doc_id", "text_key", F.explode(F.transform("wanted", lambda w: F.struct(w["line_no"].alias("line_no"), w["id"].alias("id"), F.get("lines", w["line_no"]).alias("line")))).alias("w"))
    found = found.select(F.struct("doc_id", "text_key", "w.line_no").alias("first"), "w.id", F.trim("w.line", F.lit(SPACES)).alias("line"))
    found = written(spark, found, "halves")
    keys = found.select("id", "first", F.explode(part_keys(F.col("line"), PARTS)).alias("k")).select("id", "first", "k.key", "k.rest")
    variants = shared(keys).select("id", "first", "key", "rest", F.explode(neighbours(F.col("rest"))).alias("v")).select("id", "first", "key", "rest", "v.kind", "v.variant")
    variants = written(spark, variants, "variants")
    # A key's earliest line of each kind; w meets d, d meets w, s meets s.
    earliest = variants.groupBy("key", "variant", F.translate("kind", "wd", "dw").alias("kind")).agg(F.min(F.struct("first", "rest")).alias("other"))
    near = variants.join(earliest, ["key", "variant", "kind"]).where("other.first < first")
    near = near.where(F.levenshtein("rest", F.col("other.rest"), 1) >= 0).select("id").distinct()

    changed = distinct.join(near.withColumn("near", F.lit(True)), "id", "left").where("near or n > 1").select(*same, F.when(F.col("near"), F.lit(None)).otherwise(F.col("first")).alias("stays"))
    return occurrences.select(*AT, *same).join(changed, same).where("stays is null or stays <> struct(doc_id, text_key, line_no)").select(*AT).distinct()


def deduplicated(spark: SparkSession, docs: DataFrame, least: int = 1) -> DataFrame:
    """docs with the text without its dropped lines, and n_lines and dropped (their numbers, from 0); see dropped_lines.

    A null text stays null. All other columns of docs stay; columns named n_lines and dropped are replaced.
    """
    gone = dropped_lines(spark, docs, least).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list("line_no")).alias("_gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_d", "text_key": "_k"})
    rows = docs.drop("n_lines", "dropped").join(gone, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k")), "left")
    rows = rows.withColumn("dropped", F.coalesce("_gone", F.array().cast("array<int>"))).drop("_d", "_k", "_gone")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")

    def kept(v: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(v["lines"]) - 1), v["dropped"])
        return F.array_join(F.transform(places, lambda i: F.get(v["lines"], i)), "\n")

    text = F.when(F.size("dropped") == 0, F.col("text")).otherwise(let(kept, lines=lines, dropped=F.col("dropped")))
    return rows.withColumn("n_lines", F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.size(lines))).withColumn("text", text)
