"""Benchmark decontamination: one Aho-Corasick automaton over normalised test questions and answers scans each text once.

A window is WINDOW consecutive words of an item, or all words of a shorter one. Each window of WINDOW words holds one of
the item's pieces, which are every PIECE-th run of PIECE words; pieces and short items are the automaton's patterns, so it
grows with the items' length and not with that of all their windows. Where a piece stands in a text, the windows of the
text that could hold it there are looked up among the items' windows by 64-bit hash. Hits are word numbers, which lead
back to places in the original text.

An automaton holds PART_BYTES of items; further ones take turns on a run of texts, so a task has one at a time. What is
broadcast is bounded by GROUP_PARTS of them: a larger benchmark is scanned for in rounds, each adding to the one before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.shared import slices, text_bytes, written
from navspan.llm.words import FOLDED, U, hashes_between, shingles, word_bounds

WINDOW, PIECE = 10, 5
PART_BYTES, GROUP_PARTS = 2 << 20, 32
#: Words of an item in one row: longer items are cut, so that every window is whole in one of the rows.
SEGMENT = 4096
#: Bytes of texts that wait for the automata to take turns.
RUN_BYTES = 16 << 20
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
VALUES = np.where(IS_WORD, FOLDED, U(0))
PLAIN = bytes(ord(" ") if not IS_WORD[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))
STATE = "runs array<struct<first:long,last:long>>, items array<string>"


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def joined(words: list[bytes]) -> str:
    """One character a byte, so that the automaton's places are bytes; a space on both sides of each word."""
    return f" {b' '.join(words).decode('latin-1')} "


def segments(benchmark: DataFrame, window: int = WINDOW, length: int = SEGMENT) -> DataFrame:
    """Rows (item, words): an item's normalised words joined by a space, in overlapping parts of bounded length."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = plain_words((text or "").encode())
                starts = range(0, max(1, len(words) - window + 1), length) if words else []
                parts = [b" ".join(words[s : s + length + window - 1]) for s in starts]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(parts), pa.string()), pa.array(parts, pa.binary())], ["item", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(cut, "item string, words binary")


class Index:
    """The automaton of some segments, and their windows."""

    def __init__(self, rows: list[tuple[str | None, bytes]], window: int, piece: int):
        self.window, self.piece = window, piece
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        numbers: dict[str, int] = {}
        self.lengths: list[int] = []
        self.whole: dict[int, list[int]] = {}  # of a short item's pattern: the segments
        self.pieces: list[bool] = []
        self.items = [item for item, _ in rows]
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

        def pattern(words: list[bytes]) -> int:
            text = joined(words)
            if text not in numbers:
                numbers[text] = len(numbers)
                self.automaton.add_word(text, numbers[text])
                self.lengths.append(len(words))
                self.pieces.append(False)
            return numbers[text]

        for place, (_, text) in enumerate(rows):
            words = text.split(b" ")
            if len(words) < window:
                self.whole.setdefault(pattern(words), []).append(place)
                continue
            for k in range(0, len(words) - piece + 1, piece):
                self.pieces[pattern(words[k : k + piece])] = True
            data = np.frombuffer(text, np.uint8)
            hashes.append(shingles(word_hashes(data)[0], window))
            owners.append(np.full(len(hashes[-1]), place))
        if numbers:
            self.automaton.make_automaton()
        self.any = bool(numbers)
        windows, owner = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(windows, kind="stable")
        self.windows, self.owner = windows[order], owner[order]

    def hits(self, text: str, own: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of words (first, last) of a text that windows cover, and the segments they are of. own: its bytes."""
        found = list(self.automaton.iter(text)) if self.any else []
        if not found:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
        last = np.searchsorted(spaces, [end for end, _ in found]) - 1
        runs, segments, seeds = [], set(), []
        for end, (_, k) in zip(last.tolist(), found, strict=True):
            if k in self.whole:
                runs.append((end - self.lengths[k] + 1, end))
                segments.update(self.whole[k])
            if self.pieces[k]:
                seeds.append(end - self.piece + 1)
        word = word_hashes(own)[0] if seeds else np.zeros(0)
        if len(word) >= self.window:
            starts = np.unique(np.array(seeds)[:, None] - np.arange(self.piece))
            starts = starts[(starts >= 0) & (starts <= len(word) - self.window)]
            hashes = shingles(word, self.window)[starts]
            low, high = (np.searchsorted(self.windows, hashes, side) for side in ("left", "right"))
            hit = low < high
            runs += [(s, s + self.window - 1) for s in starts[hit].tolist()]
            for a, b in sorted(set(zip(low[hit].tolist(), high[hit].tolist(), strict=True))):
                segments.update(self.owner[a:b].tolist())
        return runs, segments


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of one text."""
    starts, ends = word_bounds(data, np.array([0, len(data)]), IS_WORD)
    return hashes_between(data, starts, ends, VALUES), starts, ends


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


_held: dict[str, Index] = {}


def index_of(name: str, part: Broadcast, window: int, piece: int) -> Index:
    """The part's automaton; a task's process keeps the last one."""
    if name not in _held:
        _held.clear()
        _held[name] = Index(part.value, window, piece)
    return _held[name]


def scanned(rows: DataFrame, parts: dict[str, Broadcast], window: int, piece: int, last: bool) -> DataFrame:
    """rows (doc_id, text, runs, items) with what the parts add; the last time with n_words and spans, without text."""
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields = [("doc_id", pa.int64()), ("runs", run_type), ("items", pa.list_(pa.string()))]
    fields += [("n_words", pa.int64()), ("spans", span_type)] if last else [("text", pa.string())]

    def spans(runs: list[tuple[int, int]], own: np.ndarray) -> list[dict[str, int]]:
        """Code points, end exclusive, of runs of words."""
        if not runs:
            return []
        _, starts, ends = word_hashes(own)
        points = np.append(0, np.cumsum((own & 0xC0) != 0x80))
        return [{"start": int(points[starts[a]]), "end": int(points[ends[b]])} for a, b in runs]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                data, bounds = text_bytes(part["text"])
                whole = data.tobytes()
                words = [plain_words(whole[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                n_words, texts = [len(w) for w in words], [joined(w) if w else "" for w in words]
                runs = [[(r["first"], r["last"]) for r in x] for x in part["runs"].to_pylist()]
                items = [set(x) for x in part["items"].to_pylist()]
                for name, told in parts.items():
                    index = index_of(name, told, window, piece)
                    for i, text in enumerate(texts):
                        if text:
                            more, segments = index.hits(text, data[bounds[i] : bounds[i + 1]])
                            runs[i] += more
                            items[i].update(x for k in segments if (x := index.items[k]) is not None)
                runs = [merged(x) for x in runs]
                columns = [part["doc_id"], pa.array([[{"first": a, "last": b} for a, b in x] for x in runs], run_type), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                if last:
                    columns += [pa.array(n_words, pa.int64()), pa.array([spans(x, data[bounds[i] : bounds[i + 1]]) for i, x in enumerate(runs)], span_type)]
                else:
                    columns.append(part["text"].cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    schema = f"doc_id long, {STATE}, " + ("n_words long, spans array<struct<start:long,end:long>>" if last else "text string")
    return rows.select("doc_id", "text", "runs", "items").mapInArrow(scan, schema)


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, piece: int = PIECE, part_bytes: int = PART_BYTES, group: int = GROUP_PARTS
) -> DataFrame:
    """What of a benchmark (item_id, text) each row of docs (doc_id, text) holds.

    One row per row of docs: doc_id, n_words, n_hit (words inside a window's occurrence), items (item_ids of occurring
    windows as text, sorted, each once) and spans (start and end, in code points of the original text, of each run of hit
    words). Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z as a-z. Texts that are null or empty have no words,
    and items without words no windows. Items of one id count as one; words of an item without an id are hit, but it is
    not listed. Rows that repeat are each scanned; an empty benchmark hits nothing, an empty table gives no rows; other
    columns are ignored. `window` is at least twice `piece` less one, so that each window holds a whole piece.
    """
    if window < 2 * piece - 1:
        raise ValueError(f"a window of {window} words need not hold a whole piece of {piece}")
    items = written(spark, segments(benchmark, window).distinct(), "segments")
    n_bytes = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n_parts = max(1, -(-n_bytes // part_bytes))
    items = items.withColumn("part", F.pmod(F.xxhash64("item", "words"), F.lit(n_parts)))
    rows = docs.select("doc_id", "text", F.array().cast("array<struct<first:long,last:long>>").alias("runs"), F.array().cast("array<string>").alias("items"))
    for at in range(0, n_parts, group):
        # Bounded: about part_bytes a part, and a group of parts.
        parts = {uuid.uuid4().hex: spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in items.where(F.col("part") == k).select("item", "words").collect()]) for k in range(at, min(n_parts, at + group))}
        last = at + group >= n_parts
        rows = scanned(rows, parts, window, piece, last)
        rows = rows if last else written(spark, rows, "scanned")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return rows.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans")
