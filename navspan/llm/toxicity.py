"""Toxicity by multiple-instance learning: sentences have scores, a text's score is their noisy-or, and labels of
texts alone train the sentence scores, which then point at the offending sentences.

A sentence's score is the logistic function of a bias and the weights of its distinct words, word stems and word pairs,
hashed to a fixed number of slots; only those count whose share of toxic texts stands out from chance. The text's score
is 1 - prod(1 - score of a sentence).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.shared import frugal, slices, text_bytes
from navspan.llm.words import BASE, FOLDED, ROLL, U, bounds_in, hashes_between, mixed, powers, sorted_distinct, steps, word_bounds

SLOTS = 1 << 18
#: Words count as wholes and by their first so many bytes, where they are longer.
STEMS = (4, 5)
#: Labelled texts to learn from, at most: toxic ones and others. The sample is the first by a hash of the text.
SAMPLE = (3000, 6000)
ROUNDS, RATE, DECAY, LEAST = 120, 0.15, 0.002, 5.0
THRESHOLD = 0.3
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = True
VALUES = np.where(LETTERS, FOLDED, U(0))
#: Bytes of text that a step of scoring holds, unless one text is longer.
STEP_BYTES = 1 << 20
ENDS = np.zeros(256, bool)
ENDS[[0x0A, 0x21, 0x2E, 0x3F]] = True


def sentences(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per part of the texts: first byte, end and text of each sentence, and (sentence, slot) of its distinct features.

    A sentence ends at a full stop, question or exclamation mark, line break or the text's end, and has a word.
    """
    for at, end in steps(data, ~ENDS):
        own, part = data[at:end], bounds_in(bounds, at, end)
        starts, ends = word_bounds(own, part, LETTERS)
        if not len(starts):
            continue
        marks = ENDS[own].astype(np.int32)
        marks[part[part < len(own)]] += 1
        marks = np.cumsum(marks)[starts]
        new = np.append(True, marks[1:] != marks[:-1])
        which = np.cumsum(new) - 1
        first = starts[new] + at
        last = ends[np.append(np.flatnonzero(new)[1:], len(starts)) - 1] + at
        word = hashes_between(own, starts, ends, VALUES)
        pair = mixed(word[:-1] * ROLL + word[1:])
        found = [(which, word), (which[:-1][~new[1:]], pair[~new[1:]])]
        for n in STEMS:
            longer = ends - starts > n
            stem = VALUES[own[starts[longer][:, None] + np.arange(n)]] * powers(BASE, n)
            found.append((which[longer], mixed(stem.sum(axis=1, dtype=np.uint64) + U(n))))
        both = np.concatenate([(s.astype(np.int64) << 18) | (x & U(SLOTS - 1)).astype(np.int64) for s, x in found])
        both = sorted_distinct(both)
        yield first, last, np.searchsorted(bounds, first, "right") - 1, (both >> 18).astype(np.int32), (both & (SLOTS - 1)).astype(np.int32)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def telling(of_text: np.ndarray, slots: np.ndarray, toxic: np.ndarray, least: float) -> np.ndarray:
    """Which slots are in so many more toxic texts, or fewer, than chance has it: by `least` standard deviations."""
    once = sorted_distinct((of_text.astype(np.int64) << 18) | slots)
    slot = once & (SLOTS - 1)
    seen = np.bincount(slot, minlength=SLOTS)
    bad = np.bincount(slot, toxic[once >> 18].astype(np.float64), SLOTS)
    share = toxic.mean()
    return np.abs(bad - share * seen) > least * np.sqrt(np.maximum(share * (1 - share) * seen, 1e-9))


def learned(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY, least: float = LEAST) -> np.ndarray:
    """The slots' weights, then the bias. weight: how many texts of the corpus each one stands for."""
    of_text, of_sentence, slots, n = [], [], [], 0
    data, bounds = text_bytes(texts)
    for _, _, text, sentence, slot in sentences(data, bounds):
        of_text.append(text)
        of_sentence.append(sentence + n)
        slots.append(slot)
        n += len(text)
    if not n or not toxic.any():
        return np.append(np.zeros(SLOTS), -12.0)
    of_text, of_sentence, slots = (np.concatenate(x) for x in (of_text, of_sentence, slots))
    told = telling(of_text[of_sentence], slots, toxic, least)
    of_sentence, slots = of_sentence[told[slots]], slots[told[slots]]
    weight = weight / weight.sum()
    share = float((weight * toxic).sum())
    w, bias = np.zeros(SLOTS), np.log(max(share, 1e-6) * len(toxic) / n)
    moment, spread = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for k in range(1, rounds + 1):
        z = np.bincount(of_sentence, w[slots], n) + bias
        total = np.bincount(of_text, softplus(z), len(toxic))
        pull = np.where(toxic, -np.exp(-total) / np.maximum(-np.expm1(-total), 1e-9), 1.0) * weight
        slope = pull[of_text] / (1 + np.exp(-z))
        grad = np.append(np.bincount(slots, slope[of_sentence], SLOTS) + decay * w / len(toxic), slope.sum())
        moment = 0.9 * moment + 0.1 * grad
        spread = 0.99 * spread + 0.01 * grad**2
        move = rate * (moment / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-7)
        w, bias = w - move[:-1], bias - move[-1]
    return np.append(w, bias)


def trained(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Broadcast:
    """The model, from those labelled rows of docs whose crc32(doc_id as text) mod 4 is not 2; at most sum(sample).

    Of several labels of a doc_id the highest counts; of several texts of one, the one with the smallest hash is learned
    from, so a doc_id that stands for many rows adds one text to the sample.
    """
    known = labels.where("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 4 <> 2")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"] > 0: r["count"] for r in known.select((F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("toxic").count().collect()}
    taken = None
    for toxic, most in zip((True, False), sample, strict=True):
        part = known.where((F.col("toxic") > 0) == F.lit(toxic)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        part = part.withColumn("weight", F.lit(max(1.0, counts.get(toxic, 0) / most)))
        taken = part if taken is None else taken.union(part)
    # Broadcast: at most sum(sample) rows of three numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    texts = texts.groupBy("doc_id", "toxic", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        model = learned(table["text"].combine_chunks(), table["toxic"].to_numpy() > 0, table["weight"].to_numpy())
        return pa.table({"model": pa.array([model.astype(np.float32).tobytes()], pa.binary())})

    model = texts.select("doc_id", "text", "toxic", "weight", F.lit(0).alias("all")).groupBy("all").applyInArrow(fit, "model binary").first()
    model = np.frombuffer(model[0], np.float32) if model else np.append(np.zeros(SLOTS), -12.0).astype(np.float32)
    return spark.sparkContext.broadcast(model)


def scored(model: Broadcast, threshold: float = THRESHOLD) -> Column:
    """struct(score, sentences): a text's score, and start, end and score of each sentence at or over the threshold.

    Starts and ends count code points. Null and empty texts, and those without words, score 0.
    """
    one = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            scores, found = [], []
            for part in slices(pa.RecordBatch.from_arrays([batch], ["text"]), "text", STEP_BYTES):
                data, bounds = text_bytes(part["text"])
                total, bad = np.zeros(len(part)), [[] for _ in range(len(part))]
                for first, last, text, sentence, slot in sentences(data, bounds):
                    z = np.bincount(sentence, model.value[slot], len(text)) + model.value[-1]
                    total += np.bincount(text, softplus(z), len(part))
                    chance = 1 / (1 + np.exp(-z))
                    for i in np.flatnonzero(chance >= threshold).tolist():
                        begin = int(bounds[text[i]])
                        chars = [int(((data[begin:x] & 0xC0) != 0x80).sum()) for x in (first[i], last[i])]
                        bad[text[i]].append({"start": chars[0], "end": chars[1], "score": float(chance[i])})
                scores.append(-np.expm1(-total))
                found += bad
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(scores) if scores else []), pa.array(found, pa.list_(one))], ["score", "sentences"])

    return F.arrow_udf(frugal(score), "score double, sentences array<struct<start:long,end:long,score:double>>")("text")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """docs with score, predicted (1 if score >= threshold), held_out and the offending sentences, and all its columns
    but those of these names.

    Whole texts are scored, each row on its own (ties and repeated rows alike); held_out is true where
    crc32(doc_id as text) mod 4 is 2, and such rows are never learned from; a null doc_id is not held out. Without
    labels, or without toxic ones, all score near 0. An empty table gives no rows.
    """
    model = trained(spark, docs, labels, sample)
    out = docs.drop("score", "predicted", "held_out", "sentences", "_scored").withColumn("_scored", scored(model, threshold))
    return out.select(
        *[c for c in out.columns if c != "_scored"], F.col("_scored.score").alias("score"),
        (F.col("_scored.score") >= threshold).cast("int").alias("predicted"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), F.col("_scored.sentences").alias("sentences"))
