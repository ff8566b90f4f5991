"""Hierarchical multi-length packing: documents go to tiers of context sizes, each tier is packed into windows of
its size, gaps of long windows are filled from shorter tiers, and windows are dealt into balanced step groups.

Each task packs the documents of its own part of the scan, a buffer at a time, so nothing is shuffled and memory is
bounded by the buffer and the longest text. Tier sizes are powers of two: only the last window of a task is padded.
"""

from __future__ import annotations

import heapq
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from navspan.llm.shared import frugal, slices, text_bytes
from navspan.llm.words import FOLDED, IS_WORD, SPACES, bounds_in, hashes_between, mixed, sorted_distinct, steps, word_bounds

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16 * 2048
BUFFER_TOKENS = 1 << 20
#: Bytes of text that a step of tokenizing holds, unless one text is longer.
STEP_BYTES = 1 << 20
#: Pieces of text whose ids a Python worker remembers (some 30 bytes each); beyond that it starts anew.
MEMORY = 2_000_000
#: Kinds of bytes: white space, Latin letters, points and commas, others. Letters with accents are two bytes, the
#: first one 0xC3; of these, 0x97 and 0xB7 are signs.
SPACE, LETTER, POINT, OTHER = range(4)
KIND = np.full(256, OTHER, np.int8)
KIND[SPACES] = SPACE
KIND[[*range(65, 91), *range(97, 123), 0xC3]] = LETTER
KIND[[0x2C, 0x2E]] = POINT
ACCENT = np.zeros(256, bool)
ACCENT[0x80:0xC0] = True
ACCENT[[0x97, 0xB7]] = False


class WordIds:
    """Token ids of whole texts from the ids of their pieces, each piece tokenized once.

    The tokenizer never joins across white space, nor a run of letters with one of points and commas. Chunks between
    white space that hold nothing else are cut into such runs, whose case does not matter; others stay whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Two tables, sorted by hash, of where a piece's ids stand in `flat`: one large, one with the latest."""
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of each piece; number -1: unknown."""
        first, count = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64)
        for known, places, counts in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                first[hit], count[hit] = places[at[hit]], counts[at[hit]]
        return first, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.int32), np.array([len(x) for x in found], np.int64)

    def encode_stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of letters, many at once: the last id of each ends a word."""
        ids, _ = self.encode([" ".join(stems[i : i + 500]) for i in range(0, len(stems), 500)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(stems) else self.encode(stems)

    def learn(self, hashes: np.ndarray, texts: list[str], stems: np.ndarray) -> None:
        order = np.concatenate([np.flatnonzero(stems), np.flatnonzero(~stems)])
        texts = [texts[i] for i in order.tolist()]
        n = int(stems.sum())
        found = self.encode_stems(texts[:n]), self.encode(texts[n:])
        ids, counts = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        new = hashes[order], self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)
        which = 0 if len(self.tables[1][0]) > 1 << 16 else 1
        merged = [np.concatenate(x) for x in (zip(*self.tables, new, strict=True) if which == 0 else zip(self.tables[1], new, strict=True))]
        order = np.argsort(merged[0], kind="stable")
        self.tables[which] = tuple(x[order] for x in merged)
        if which == 0:
            self.tables[1] = tuple(x[:0] for x in merged)

    def texts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 bounds of the texts in them."""
        out, firsts, counts = [], [], []
        for at, end in steps(data, IS_WORD):
            starts, ends, hashes, stems = pieces(data[at:end], bounds_in(bounds, at, end))
            if not len(starts):
                continue
            if sum(len(t[0]) for t in self.tables) > MEMORY:
                self.forget()
            distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
            first, count = self.places(distinct)
            new = np.flatnonzero(count < 0)
            if len(new):
                raw = data[at:end].tobytes()
                texts = [raw[s:e].decode() for s, e in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)]
                self.learn(distinct[new], texts, stems[where[new]])
                first[new], count[new] = self.places(distinct[new])
            n = count[which]
            skipped = np.cumsum(n) - n
            out.append(self.flat[np.repeat(first[which] - skipped, n) + np.arange(int(n.sum()))])
            firsts.append(starts + at)
            counts.append(n)
        if not out:
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(out), before[np.searchsorted(np.concatenate(firsts), bounds)]


def pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """First byte, end and hash of each piece, and whether it is a run of plain letters."""
    starts, ends = word_bounds(data, bounds)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), np.zeros(0, bool)
    kind = KIND[data]
    accents = np.flatnonzero(ACCENT[data[1:]] & (data[:-1] == 0xC3)) + 1
    kind[accents] = LETTER
    # 0xC3 not followed by a letter's second byte is none.
    lead = np.flatnonzero(data == 0xC3)
    kind[lead[~np.isin(lead + 1, accents, assume_unique=True)]] = OTHER
    others = np.concatenate([[0], np.cumsum(kind == OTHER)])
    plain = others[starts] == others[ends]
    turns = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != SPACE) & (kind[:-1] != SPACE)) + 1
    turns = turns[plain[np.searchsorted(starts, turns, "right") - 1]]
    cut = sorted_distinct(np.concatenate([starts, turns]))
    chunk = np.searchsorted(starts, cut, "right") - 1
    end = np.minimum(ends[chunk], np.append(cut[1:], len(data)))
    hashes = hashes_between(data, cut, end, FOLDED)
    upper = np.flatnonzero((data >= 65) & (data <= 90))
    piece = np.searchsorted(cut, upper, "right") - 1
    upper, piece = upper[~plain[chunk[piece]]], piece[~plain[chunk[piece]]]
    np.add.at(hashes, piece, mixed(((upper - cut[piece]) * 256 + data[upper]).astype(np.uint64)))
    return cut, end, hashes, plain[chunk] & (kind[cut] == LETTER)


def tier_of(n: int, tiers: tuple[int, ...]) -> int:
    return next(t for t in tiers if n <= t)


def windows(items: list[tuple[int, int, int]], tiers: tuple[int, ...] = TIERS, last: bool = True) -> tuple[list, list]:
    """Windows (size, items) of items (length, key, start), and the items that are left where it isn't the last call.

    Every window is full; only what remains at the very end is cut into ever smaller tiers, then one short window.
    """
    longest, smallest = tiers[-1], tiers[0]
    full, pools = [], {t: [] for t in tiers}
    for n, key, start in items:
        whole = n // longest * longest
        full += [(longest, [(longest, key, start + i)]) for i in range(0, whole, longest)]
        if n > whole:
            pools[tier_of(n - whole, tiers)].append((n - whole, key, start + whole))
    for pool in pools.values():
        pool.sort()
    left: list[tuple[int, int, int]] = []
    for t in reversed(tiers):
        sources = [pools[s] for s in reversed(tiers) if s < t] or [pools[t]]
        while pools[t]:
            held = [pools[t].pop()]
            gap = t - held[0][0]
            for pool in sources:
                while gap and (i := bisect_right(pool, (gap, float("inf"), 0))):
                    held.append(pool.pop(i - 1))
                    gap -= held[-1][0]
            if gap and (pool := next((p for p in [*sources, pools[t]] if p), None)):
                # Whole items are larger than the gap, unless only the tier's own are left: cut.
                while gap and pool:
                    n, key, start = pool.pop(0)
                    held.append((min(n, gap), key, start))
                    if n > gap:
                        insort(pools[tier_of(n - gap, tiers)], (n - gap, key, start + gap))
                    gap -= held[-1][0]
                    pool = pool or pools[t]
            if gap:
                left = held
            else:
                full.append((t, held))
    if not last:
        return full, left
    while left:
        total = sum(n for n, _, _ in left)
        size = next((t for t in reversed(tiers) if t <= total), total)
        held, room = [], size
        while room:
            n, key, start = left.pop(0)
            held.append((min(n, room), key, start))
            if n > room:
                left.insert(0, (n - room, key, start + room))
            room -= held[-1][0]
        full.append((size if size >= smallest else longest, held))
    return full, []


def dealt(sizes: list[int], step_tokens: int) -> list[int]:
    """Step group of each window: the largest first, always to the group with the fewest tokens."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, out[i] = heapq.heappop(groups)
        heapq.heappush(groups, (load + sizes[i], out[i]))
    return out


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (doc_id, text) in windows of the tiers' sizes; `tokenizer` is a file's path.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens (the
    window's size, padding included), step_id, and with keep_ids the ids. A null or empty text is the end id alone;
    rows that repeat, also in doc_id, are packed each; ties keep the order of the scan; an empty table gives no rows;
    other columns are ignored. The same file splits give the same windows.
    """
    fields = [("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_id")]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_id long"
    if keep_ids:
        fields, schema = [*fields, ("ids", pa.list_(pa.int32()))], schema + ", ids array<int>"
    fields = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, tuple] = {}
        items: list[tuple[int, int, int]] = []
        sequences = steps = total = key = 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal items, sequences, steps, total
            full, items = windows(items, tiers, last)
            total = sum(n for n, _, _ in items)
            group = dealt([size for size, _ in full], step_tokens)
            rows = []
            for (size, pieces), g in zip(full, group, strict=True):
                at = 0
                for n, k, start in pieces:
                    doc_id, ids = held[k]
                    part = ids[start : start + n]
                    rows.append((doc_id, start, n, zlib.crc32(part.astype("<u4").tobytes()), len(ids), base + sequences, at, size, base + steps + g, *([part] if keep_ids else [])))
                    at += n
                sequences += 1
            steps += max(group, default=-1) + 1
            kept = {k for _, k, _ in items}
            for k in [k for k in held if k not in kept]:
                del held[k]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                ids, bounds = words.texts(*text_bytes(part["text"]))
                for doc_id, a, b in zip(part["doc_id"].to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    held[key] = doc_id, np.append(ids[a:b], np.int32(end_id))
                    items.append((int(b - a) + 1, key, 0))
                    total += int(b - a) + 1
                    key += 1
                if total >= BUFFER_TOKENS:
                    yield flush(False)
        yield flush(True)

    return docs.select("doc_id", "text").mapInArrow(frugal(run), schema)


_LOADED: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    """Loaded once in a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
