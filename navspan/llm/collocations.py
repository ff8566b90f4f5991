"""Phrase collocations by SON partitioning: every shard is mined whole at a proportionally lower support, the phrases
that are frequent in some shard are united, and all of these are counted exactly.

A shard is a run of about RUN_BYTES of texts in a task. Its share of a language's bytes is its share of the support: a phrase
with the whole support has at least that share in one shard. Within a shard phrases grow word by word, and only from
phrases that were kept, as no phrase is more frequent than its parts. The shards where a phrase is not frequent each have
less than their share of it, so those whose sum can't reach the support are no candidates either; where the shares are
below one occurrence, this leaves the frequent phrases alone.

Words and pairs come first, longer phrases after them: these are made of frequent pairs only, which tasks are told by a
bit map of fixed size. Where the map says yes by mistake, or is full, more is counted and nothing changes. So where
shards are so many that a support of less than one remains to each, what they hand on is still bounded by what frequent
pairs leave. A phrase is known by its words' 64-bit hashes.

A shard hands on its phrases as sets, one for each language and block of the key space; the sets of a block meet in a task,
which sums them. So rows grow with shards; the phrases in them are bounded by what a shard has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspan.llm.shared import runs, slices, text_bytes, written
from navspan.llm.words import FOLDED, ROLL, STEP, U, bounds_in, hashes_between, mixed, steps, word_bounds

SUPPORT, LONGEST, TOP, PERCENT, SCALE = 100, 5, 2000, 100, 1000
RUN_BYTES = 24 << 20
#: Phrases of a length are grouped in so many turns, which bounds what a shard holds at a time.
TURNS = 4
#: Languages of which tasks are told, at most.
FEW = 10_000
#: Parts of the key space in which the shards' phrases meet; a task holds one at a time.
BLOCKS = 1024
#: Phrases that a shard gathers before it hands them on.
GATHERED = 1 << 22
#: Bits of the map of phrases: 4 MB, whatever their number.
MAP_BITS = 1 << 25
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IS_WORD = ~ENDS
IS_WORD[[0x20, 0x09]] = False
VALUES = np.where(IS_WORD, FOLDED, U(0))
WORD = re.compile(rb"[^\x20\x09-\x0D.,;:!?]+")
PHRASES = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("count", pa.int64()), ("text", pa.string())])
LOCAL = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("keys", pa.binary()), ("overs", pa.binary()), ("n", pa.int64()), ("hidden", pa.int64())])
COUNTED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("texts", pa.string())])


def lang_seed(lang: str) -> int:
    seed = 0
    for b in lang.encode():
        seed = (seed * 1099511628211 + b + 1) % (1 << 64)
    return seed


def phrase_key(seed: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of phrases of a language, by their words' hashes. Its low bits are the place in the bit map."""
    out = seed
    for x in words:
        out = out * ROLL + x
    return mixed(out + U(len(words)))


def in_map(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys: the place of one of them; the group's number at each place; how many there are."""
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), STEP):
        some = keys[order[i - 1 : i + STEP]]
        new[i : i + STEP] = some[1:] != some[:-1]
    del keys
    starts = np.flatnonzero(new)
    inverse = np.empty(len(order), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[starts], inverse, np.diff(starts, append=len(order))


def sets(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which members of a group, told by numbers, stand together; and the bounds of the groups in it."""
    order = np.argsort(groups, kind="stable")
    groups = groups[order]
    return order, np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of numbers, or of rows of numbers, as a binary column."""
    values = np.ascontiguousarray(values)
    width = values.nbytes // len(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(values)])


def unpacked(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, one run after the other, and how many each run has."""
    runs_of = column.to_pylist()
    return np.frombuffer(b"".join(runs_of), kind), np.array([len(x) for x in runs_of], np.int64) // np.dtype(kind).itemsize


class Shard:
    """The words of a run of texts: hash, language, bytes, and how many of the words before stand in the same piece."""

    def __init__(self, parts: list[pa.RecordBatch]):
        """parts are emptied: the bytes are held once."""
        batch = pa.Table.from_batches(parts).combine_chunks()
        parts.clear()
        langs = batch["lang"].combine_chunks().dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        code = langs.indices.to_numpy()
        self.data, bounds = text_bytes(batch["text"].combine_chunks())
        self.bytes = np.bincount(code, np.diff(bounds), len(self.langs)).astype(np.int64)
        self.totals = [0] * len(self.langs)
        for c, total in zip(code.tolist(), batch["total"].to_pylist(), strict=True):
            self.totals[c] = total
        found: list[list[np.ndarray]] = [[], [], [], []]
        code = code.astype(np.int16 if len(self.langs) < 1 << 15 else np.int32)
        for at, end in steps(self.data, ~ENDS):
            own = self.data[at:end]
            starts, ends = word_bounds(own, bounds_in(bounds, at, end), IS_WORD)
            marks = ENDS[own].astype(np.int32)
            # A mark before a word ends the piece; so does a text's first byte.
            mark = np.cumsum(marks)[starts]
            new = np.append(True, mark[1:] != mark[:-1])[: len(starts)]
            text = np.searchsorted(bounds, starts + at, "right") - 1
            new |= np.append(True, text[1:] != text[:-1])[: len(starts)]
            place = np.arange(len(starts), dtype=np.int32)
            before = np.minimum(place - np.maximum.accumulate(np.where(new, place, 0)), 127) if len(starts) else place
            for held, x in zip(found, ((starts + at).astype(np.int32), hashes_between(own, starts, ends, VALUES), code[text], before.astype(np.int8)), strict=True):
                held.append(x)
        columns = []
        for held in found:
            columns.append(np.concatenate(held) if held else np.zeros(0, np.int32))
            held.clear()
        self.starts, self.hashes, self.code, self.before = columns
        self.seeds = np.array([lang_seed(x) for x in self.langs], np.uint64)

    def keys(self, at: np.ndarray, length: int) -> np.ndarray:
        """Key of the phrase of so many words that starts at each of these words."""
        return phrase_key(self.seeds[self.code[at]], [self.hashes[at + k] for k in range(length)]).view(np.int64)

    def slots(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.keys(at, length) & (MAP_BITS - 1)

    def local_support(self, support: int) -> np.ndarray:
        return np.array([max(1, -(-support * int(b) // max(1, t))) for b, t in zip(self.bytes, self.totals, strict=True)])

    def mined(self, longest: int, support: int, told: np.ndarray | None, told_to: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, counts) of the phrases kept: up to length told_to those of the map, longer ones with
        the shard's share of the support."""
        n = len(self.hashes)
        if not n:
            return
        local = self.local_support(support)
        # Whole numbers for the phrases kept that start at each word, -1 for others; those of single words.
        names = single = (self.hashes & U(TURNS - 1)).astype(np.int32)
        width = 0
        for length in range(1, longest + 1):
            m = n - length + 1
            if m <= 0:
                return
            longer, kept = np.full(n, -1, np.int32), 0
            for turn in range(TURNS):
                fits = names[:m] % TURNS == turn
                if length > 1:
                    # Both parts kept, and no piece ends within.
                    fits &= (names[:m] >= 0) & (names[1 : m + 1] >= 0) & (self.before[length - 1 :] >= length - 1)
                at = np.flatnonzero(fits).astype(np.int32)
                del fits
                if not len(at):
                    continue
                if length > 1:
                    first, inverse, counts = grouped(names[at] * np.int64(width) + single[at + (length - 1)])
                else:
                    first, inverse, counts = grouped((self.hashes[at] * ROLL + self.seeds[self.code[at]]).view(np.int64))
                first = at[first]
                keep = in_map(told, self.slots(first, length)) if told is not None and length <= told_to else counts >= local[self.code[first]]
                yield length, first[keep], counts[keep]
                longer[at] = np.where(keep, kept + np.cumsum(keep) - 1, -1).astype(np.int32)[inverse]
                kept += int(keep.sum())
            names = longer
            if length == 1:
                single, width = names, kept + 1

    def shown(self, found: list[tuple[int, np.ndarray, np.ndarray]], hidden: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Phrases (length, first words, counts) as sets of keys, with how much each count is over what can be hidden."""
        code = np.concatenate([self.code[first] for _, first, _ in found])
        keys = np.concatenate([self.keys(first, length) for length, first, _ in found])
        over = (np.concatenate([counts for _, _, counts in found]) - hidden[code]).astype(np.int32)
        found.clear()
        order, bounds = sets(code * np.int64(BLOCKS) + (keys & (BLOCKS - 1)))
        first = order[bounds[:-1]]
        none = pa.nulls(len(first), pa.int64())
        langs = pa.array(self.langs, pa.string()).take(pa.array(code[first]))
        blocks = pa.array((keys[first] & (BLOCKS - 1)).astype(np.int32))
        yield from slices(pa.RecordBatch.from_arrays([langs, blocks, packed(keys[order], bounds), packed(over[order], bounds), none, none], schema=LOCAL), "keys")

    def counted(self, length: int, first: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Phrases as sets of their words' hashes, with counts and, of single words, texts."""
        block = self.keys(first, length) & (BLOCKS - 1)
        order, bounds = sets(self.code[first] * np.int64(BLOCKS) + block)
        first, block, counts = first[order], block[order], counts[order].astype(np.int32)
        words = np.stack([self.hashes[first + k] for k in range(length)], axis=1)
        at = bounds[:-1]
        texts = pa.nulls(len(at), pa.string())
        if length == 1:
            ends = np.append(self.starts, len(self.data))[first + 1]
            raw = [WORD.match(self.data[a:b].tobytes())[0].lower().decode() for a, b in zip(self.starts[first].tolist(), ends.tolist(), strict=True)]
            # No word has a blank.
            texts = pa.array([" ".join(raw[a:b]) for a, b in zip(at.tolist(), bounds[1:].tolist(), strict=True)], pa.string())
        langs = pa.array(self.langs, pa.string()).take(pa.array(self.code[first[at]]))
        sizes = pa.array(np.full(len(at), length, np.int32))
        yield from slices(pa.RecordBatch.from_arrays([langs, sizes, pa.array(block[at].astype(np.int32)), packed(words, bounds), packed(counts, bounds), texts], schema=COUNTED), "words")


def shards(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[Shard]:
    """The last shard has between a half and three halves of the bytes, as a small one would find too much frequent."""
    held: list[pa.RecordBatch] = []
    first = total = 0
    for batch in batches:
        for part in slices(batch, "text"):
            held.append(part)
            total += part["text"].nbytes
            if total <= run_bytes:
                first = len(held)
            if 2 * total > 3 * run_bytes:
                first = max(1, first)
                rest = held[first:]
                del held[first:]
                yield Shard(held)
                held, first = rest, len(rest)
                total = sum(p["text"].nbytes for p in held)
    if held:
        yield Shard(held)


def local_phrases(docs: DataFrame, lengths: tuple[int, int], support: int, told: np.ndarray | None, told_to: int, run_bytes: int) -> DataFrame:
    """Sets of each shard's locally frequent phrases of these lengths (lang, block, keys, overs): 64-bit hashes, and how much
    their counts are over what the shard can hide of a phrase that it does not show. And of each language of a shard
    (lang, n, hidden): its words, and how much of a phrase it can hide.

    docs: lang, text and total, the bytes of all texts of the language.
    """
    # Broadcast: the bit map, of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, run_bytes):
            hidden = shard.local_support(support) - 1
            none = pa.nulls(len(hidden), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(shard.langs, pa.string()), none.cast(pa.int32()), none, none, pa.array(np.bincount(shard.code, minlength=len(hidden))), pa.array(hidden)], schema=LOCAL)
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            for length, first, counts in shard.mined(lengths[1], support, shared.value, told_to):
                if length >= lengths[0] and len(first):
                    held.append((length, first, counts))
                    if sum(len(f) for _, f, _ in held) >= GATHERED:
                        yield from shard.shown(held, hidden)
            if held:
                yield from shard.shown(held, hidden)

    return docs.select("lang", "text", "total").mapInArrow(run, "lang string, block int, keys binary, overs binary, n long, hidden long")


def possible(shown: DataFrame, support: int) -> DataFrame:
    """The keys of phrases that may have the support, by all shards' sets (block, keys, overs, hidden_everywhere): what all
    shards could hide, with what the ones that show the phrase have over it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["block"]):
            keys, lengths = unpacked(table["keys"], np.int64)
            over, _ = unpacked(table["overs"], np.int32)
            order, bounds = sets(keys)
            most = np.maximum.reduceat(np.repeat(table["hidden_everywhere"].to_numpy(), lengths)[order], bounds[:-1])
            fits = np.add.reduceat(over[order].astype(np.int64), bounds[:-1]) + most >= support
            yield pa.RecordBatch.from_arrays([pa.array(keys[order[bounds[:-1]]][fits])], ["key"])

    shown = shown.select("block", "keys", "overs", "hidden_everywhere").repartition("block").sortWithinPartitions("block")
    return shown.mapInArrow(run, "key long")


def counted_phrases(docs: DataFrame, lengths: tuple[int, int], support: int, told: np.ndarray, run_bytes: int) -> DataFrame:
    """Sets (lang, size, block, words, counts, texts) of each shard's phrases of these lengths that the map has, with all
    their occurrences.

    words: the words' hashes; texts: of single words, parted by blanks.
    """
    # Broadcast: the bit map, of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, run_bytes):
            # The turns of a length are gathered, for few and full sets.
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            for length, first, counts in shard.mined(lengths[1], support, shared.value, lengths[1]):
                if held and (length != size or sum(len(f) for f, _ in held) >= GATHERED):
                    yield from shard.counted(size, *map(np.concatenate, zip(*held, strict=True)))
                    held.clear()
                size = length
                if length >= lengths[0] and len(first):
                    held.append((first, counts))
            if held:
                yield from shard.counted(size, *map(np.concatenate, zip(*held, strict=True)))

    return docs.select("lang", "text", "total").mapInArrow(run, "lang string, size int, block int, words binary, counts binary, texts string")


def summed(counted: DataFrame, support: int) -> DataFrame:
    """Phrases (lang, words, count, text) that all shards' sets of counts together give the support."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["block", "size"]):
            size = table["size"][0].as_py()
            langs = table["lang"].combine_chunks().dictionary_encode()
            words, lengths = unpacked(table["words"], np.uint64)
            counts, _ = unpacked(table["counts"], np.int32)
            words = words.reshape(-1, size)
            code = np.repeat(langs.indices.to_numpy(), lengths // size)
            order = np.lexsort([*words.T, code])
            sorted_words, sorted_code = words[order], code[order]
            new = np.append(True, (sorted_words[1:] != sorted_words[:-1]).any(axis=1) | (sorted_code[1:] != sorted_code[:-1]))
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(counts[order].astype(np.int64), starts)
            fits = sums >= support
            starts = starts[fits]
            if not len(starts):
                continue
            first = order[starts]
            texts = pa.nulls(len(first), pa.string())
            if size == 1:
                spelled = [x for y in table["texts"].to_pylist() for x in y.split(" ")]
                texts = pa.array([spelled[i] for i in first.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(code[first])), packed(words[first], np.arange(len(first) + 1)), pa.array(sums[fits]), texts], schema=PHRASES)

    counted = counted.repartition("block").sortWithinPartitions("block", "size")
    return counted.mapInArrow(run, "lang string, words binary, count long, text string")


def key_of(phrases: DataFrame) -> DataFrame:
    """The keys of phrases (lang, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [phrase_key(np.uint64(lang_seed(lang)), list(np.frombuffer(words, np.uint64)[:, None])) for lang, words in zip(batch["lang"].to_pylist(), batch["words"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64))], ["key"])

    return phrases.select("lang", "words").mapInArrow(run, "key long")


def phrase_map(keys: DataFrame) -> np.ndarray:
    """A bit map in which the slot of each key is set: MAP_BITS bits, whatever the number of phrases."""
    slot = F.col("key").bitwiseAND(F.lit(MAP_BITS - 1))
    parts = keys.select(slot.alias("slot")).selectExpr("cast(slot div 64 as int) as at", "shiftleft(1L, cast(slot % 64 as int)) as bit")
    parts = parts.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[parts["at"].to_numpy()] = parts["bits"].to_numpy()
    return out.view(np.uint8)


def few(langs: DataFrame) -> DataFrame:
    """A table of one short row a language: broadcast up to FEW of them, else joined as the planner sees fit."""
    return F.broadcast(langs) if langs.count() <= FEW else langs


def frequent_phrases(spark: SparkSession, docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, run_bytes: int = RUN_BYTES) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, words, count, text) of up to `longest` words that are there `support` times or more, with
    exact counts; and the number of all words (lang, n)."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    totals = written(spark, docs.groupBy(F.col("lang").alias("of")).agg(F.sum(F.octet_length("text")).alias("total")), "totals")
    docs = docs.join(few(totals), F.col("lang") == F.col("of")).select("lang", "text", "total")

    def counted(lengths: tuple[int, int], told: np.ndarray | None, told_to: int) -> tuple[DataFrame, DataFrame]:
        rows = written(spark, local_phrases(docs, lengths, support, told, told_to, run_bytes), "local")
        langs = written(spark, rows.where("block is null").groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"), F.sum("hidden").alias("hidden_everywhere")), "langs")
        shown = rows.where("block is not null").join(few(langs.select("of", "hidden_everywhere")), F.col("lang") == F.col("of"))
        candidates = phrase_map(possible(shown, support))
        known = candidates if told is None else candidates | told
        return langs, written(spark, summed(counted_phrases(docs, lengths, support, known, run_bytes), support), "frequent")

    langs, short = counted((1, min(2, longest)), None, 0)
    n = langs.select(F.col("of").alias("lang"), "n")
    if longest <= 2:
        return short, n
    _, long = counted((3, longest), phrase_map(key_of(short)), 2)
    return short.unionByName(long), n


def part(first: int | Column, words: int | Column) -> Column:
    """So many words of a phrase, from the given one on, by their hashes."""
    return F.substring("words", F.lit(first) * 8 + 1 if isinstance(first, int) else first * 8 + 1, F.lit(words * 8) if isinstance(words, int) else words * 8)


def score_of(scale: int) -> Column:
    """floor(scale * a * n / (l * r)), exactly: whole decimals of 38 digits hold products of counts up to 10^16."""
    whole = {x: f"cast({x} as decimal(18,0))" for x in "alrn"}
    return F.expr(f"cast(({scale} * {whole['a']} * {whole['n']}) as decimal(38,0)) div cast({whole['l']} * {whole['r']} as decimal(38,0))")


def collocations(spark: SparkSession, docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, scale: int = SCALE, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The `top` phrases of each language of docs (lang, text) by how far they exceed chance: lang, rank, phrase, a, l, r, n, score.

    Texts are cut into pieces at `[.,;:!?\\x0A-\\x0D]` and these into words `[^\\x20\\x09]+`, with A-Z as a-z. Phrases have
    2 to `longest` words and a >= support occurrences within pieces, overlapping ones included. Of the cuts of a phrase
    into a first and a second part, with l and r occurrences, the one with the lowest score floor(scale * a * n / (l * r))
    counts, then the one with the shortest first part; n is the language's number of words. A phrase within a longer one
    that has percent % of its occurrences is left out. Order is by score and a, both descending, then phrase.
    Null texts count as empty, a null language as `und`; rows that repeat count each; an empty table gives no rows; other
    columns are ignored.
    """
    phrases, sizes = frequent_phrases(spark, docs, support, longest, run_bytes)
    size = F.octet_length("words") / 8
    phrases = phrases.select("lang", "words", "count", "text", size.cast("int").alias("size"))
    # Whether a phrase is within a longer one shows with one word more: that one is at least as frequent.
    longer = phrases.where("size > 2").select("lang", F.explode(F.array(part(0, F.col("size") - 1), part(1, F.col("size") - 1))).alias("inner"), "count")
    longer = longer.groupBy(F.col("lang").alias("of"), "inner").agg(F.max("count").alias("more"))
    kept = phrases.where("size > 1").join(longer, (F.col("lang") == F.col("of")) & (F.col("words") == F.col("inner")), "left")
    kept = kept.where(F.coalesce(F.col("more") * 100 < F.col("count") * percent, F.lit(True))).select("lang", "words", "size", F.col("count").alias("a"))

    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", part(0, F.col("k")).alias("left"), part(F.col("k"), F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        counts = phrases.select(F.col("lang").alias(f"lang_{side}"), F.col("words").alias(f"words_{side}"), F.col("count").alias(name))
        cuts = cuts.join(counts, (F.col("lang") == F.col(f"lang_{side}")) & (F.col(side) == F.col(f"words_{side}"))).drop(f"lang_{side}", f"words_{side}", side)
    cuts = cuts.join(few(sizes).withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"))
    best = cuts.withColumn("score", score_of(scale)).groupBy("lang", "words", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    best = written(spark, best.select("lang", "words", "size", "a", "n", "best.score", "best.l", "best.r"), "scored")

    # The words' texts, only for phrases that can be among the first: as good as the last of these by score and a.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = best.select("*", F.rank().over(order).alias("place")).where(F.col("place") <= top)
    texts = phrases.where("size = 1").select(F.col("lang").alias("of"), F.col("words").alias("word"), "text")
    spelled = first.select("lang", "words", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i")).withColumn("word", part(F.col("i"), 1))
    spelled = spelled.join(texts, (F.col("lang") == F.col("of")) & (spelled["word"] == texts["word"])).groupBy("lang", "words").agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("spelled"))
    spelled = spelled.select(F.col("lang").alias("of"), F.col("words").alias("which"), F.array_join(F.col("spelled.text"), " ").alias("phrase"))
    rows = first.join(spelled, (F.col("lang") == F.col("of")) & (F.col("words") == F.col("which")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.select("lang", place.cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)
