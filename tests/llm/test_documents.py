"""Operators on documents against plain code, on small tables with every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from navspan.llm import licenses, lines, mixing, naming, packing, personal, setjoin, toxicity
from navspan.llm.queries import QUERIES
from navspan.llm.shared import runs, slices, text_bytes, written
from navspan.llm.words import shingles, sorted_distinct, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_rows():
    """Nulls, empty and blank texts, copies, near copies, one long text, repeated rows and a repeated doc_id."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]
    passage = draw.choices(vocabulary, k=60)
    texts = []
    for i in range(60):
        own = draw.choices(vocabulary, k=draw.choice([3, 8, 30, 120, 300]))
        texts.append(own if i % 4 else own[: len(own) // 2] + passage + own[len(own) // 2 :])
    for i in range(20):
        copy = list(texts[i * 2])
        copy[draw.randrange(len(copy))] = "changed"
        texts.append(copy if i % 3 else [w.upper() for w in texts[i * 2]])
    texts += [texts[7]] * 6 + [texts[7][:-1] + [f"end{k}"] for k in range(9)]
    texts = [re.sub("(.{70}) ", "\\1\n", " ".join(t)) for t in texts]
    texts += ["", " \t\n", None, "one", "a b c", "A  b\tc", "x " * 9000, "über Straße ŝ 日本語 " * 5, "tail.", "tail,"]
    rows = [(i, t, "en", draw.choice(["s1", "s2", None, "é"]), len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (5, "another text of document five", "en", "s2", 1), (None, "no id", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in ("text_key", "rows", "hash", "n", "bits", "size", "copies", "lines", "score", "dropped"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert packing.pack(none, TOKENIZER).count() == 0
    assert mixing.mix(spark, none).count() == 0
    assert naming.duplicates(spark, none).count() == 0
    assert setjoin.jaccard_join(spark, none).count() == 0
    assert lines.dropped_lines(spark, none).count() == 0
    assert lines.deduplicated(spark, none).count() == 0
    assert licenses.scan(none).count() == 0
    assert personal.personal_data(none).count() == 0
    assert toxicity.toxicity(spark, none, labels).count() == 0


@given(st.lists(st.text(alphabet=" \t\nabAB.,é日", max_size=30), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words(texts):
    hashes, bounds = words(*text_bytes(pa.array(texts, pa.string())), fold=True)
    found = [WORD.findall(t.translate(LOW)) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in found]
    known = {}
    for h, w in zip(hashes.tolist(), [w for ws in found for w in ws], strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    for a, b, w in zip(bounds[:-1], bounds[1:], found, strict=True):
        runs_ = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
        assert len(sorted_distinct(shingles(hashes[a:b], 3))) == len(runs_)


def test_slices_and_runs():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "c", "d"]})
    assert [len(s) for s in slices(batch, "text", 12)] == [2, 1, 2]
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": list(range(len(k)))}) for k in ([1, 1, 2], [2], [], [2, 3])]
    assert [(t["k"].to_pylist()) for t in runs(iter(batches), ["k"])] == [[1, 1], [2, 2, 2], [3]]


# ---- packing

def tokens_of(text):
    return tokens_of.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


tokens_of.tokenizer = Tokenizer.from_file(TOKENIZER)


@given(st.lists(st.text(max_size=40) | st.sampled_from(["İ ΣΑΣ don't I'll", "x<|endoftext|>y", "É÷×Ã́ .,", "..the.,. 12,45", "Ã", "\x00 a\x1cb\xa0c"]), max_size=6))
@settings(max_examples=80, deadline=None)
def test_ids_are_the_tokenizers(texts):
    ids, bounds = packing._words(TOKENIZER).texts(*text_bytes(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [tokens_of(t)[:-1] for t in texts]


@given(st.lists(st.integers(1, 700), max_size=60))
@settings(max_examples=80, deadline=None)
def test_windows(lengths):
    items = [(n, k, 0) for k, n in enumerate(lengths)]
    full, left = packing.windows(items, (16, 32, 64), last=False)
    assert all(sum(n for n, _, _ in held) == size for size, held in full)
    rest, none = packing.windows(left, (16, 32, 64))
    assert not none and sum(size - sum(n for n, _, _ in held) for size, held in rest) < 64
    pieces = sorted((k, start, n) for _, held in full + rest for n, k, start in held)
    assert [(k, s + n) for k, s, n in pieces if (k, s + n) not in {(a, b) for a, b, _ in pieces}] == [(k, n) for k, n in enumerate(lengths)]
    assert sum(n for _, _, n in pieces) == sum(lengths)


def test_packing(docs, rows):
    pieces = packing.pack(docs, TOKENIZER, keep_ids=True).collect()
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(tokens_of(text))
    windows = defaultdict(list)
    covered = Counter()
    for p in pieces:
        assert any(p["ids"] == t[p["start"] : p["start"] + p["length"]] and len(t) == p["doc_tokens"] for t in want[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        windows[p["sequence_id"], p["sequence_tokens"]].append((p["offset"], p["length"]))
        covered[p["doc_id"]] += p["length"]
    assert covered == {k: sum(map(len, v)) for k, v in want.items()}
    for (_, size), held in windows.items():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= size <= 2048 and (size == 2048 or at == size)


def test_steps_are_balanced():
    sizes = [2048] * 30 + [1024] * 20 + [512] * 50 + [256] * 8
    loads = Counter()
    for size, group in zip(sizes, packing.dealt(sizes, 16384), strict=True):
        loads[group] += size
    assert max(loads.values()) - min(loads.values()) <= 512


# ---- mixing

def targets(sizes, weights, share, most):
    """Shares by weight, cut at the cap, what is over dealt out again by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    out, open_, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += rest * weight[s] / total
        rest = sum(max(0.0, out[s] - most * sizes[s]) for s in open_)
        for s in list(open_):
            if out[s] >= most * sizes[s]:
                out[s] = most * sizes[s]
                open_.discard(s)
    return out


@pytest.mark.parametrize("group", [4096, 4])
def test_mixing(spark, docs, rows, group, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", group)
    monkeypatch.setattr(mixing, "FAN", 2)
    found = [r.asDict() for r in mixing.mix(spark, docs).collect()]
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"] * r["rows"]
    assert sum(r["rows"] for r in found) == len(rows)
    largest = {s: max(len(WORD.findall(t or "")) for _, t, _, x, _ in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= 3 * largest[s] for s in sizes)
    again = [r.asDict() for r in mixing.mix(spark, docs.repartition(3, "lang")).collect()]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text_key"], r["source"] or "")
    assert sorted(found, key=key) == sorted(again, key=key)


@given(st.lists(st.tuples(st.integers(1, 50), st.floats(0.01, 0.99)), min_size=1, max_size=40), st.integers(0, 1000))
@settings(max_examples=80, deadline=None)
def test_rounding_keeps_the_words(items, seed):
    size, part = (np.array(x, np.float64) for x in zip(*items, strict=True))
    chosen, rest = mixing.settle(np.arange(len(items), dtype=np.uint64), size, part, seed)
    assert len(rest) <= 1 and len(set(chosen)) == len(chosen)
    assert size[chosen].sum() + sum(size[i] * p for i, p in rest) == pytest.approx((size * part).sum(), abs=1e-6)


def test_rounding_keeps_the_chances():
    size, part = np.array([5.0, 3.0, 2.0, 7.0]), np.array([0.3, 0.6, 0.5, 0.2])
    hits = np.zeros(4)
    for seed in range(4000):
        chosen, rest = mixing.settle(np.arange(4, dtype=np.uint64), size, part, seed * 7919)
        hits[chosen] += 1
        for i, p in rest:
            hits[i] += p
    assert np.abs(hits / 4000 - part).max() < 0.03


# ---- exact dedup

@pytest.mark.parametrize("block, bits", [(naming.BLOCK, 64), (3, 64), (5, 6)])
def test_naming(spark, docs, rows, block, bits):
    """With few hash bits most contents share a hash, and ranks alone tell them apart."""
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    some = rows if block == naming.BLOCK else [r for r in rows if len(r[1] or "") < 400]
    chosen = docs if block == naming.BLOCK else docs.where("length(coalesce(text, '')) < 400")
    groups = defaultdict(list)
    for doc_id, text, *_ in some:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0))
    found = naming.duplicates(spark, chosen, block, bits).collect()
    assert sum(r["rows"] for r in found) == len(some)
    sha = {hashlib.sha256(p.encode()).hexdigest(): p for p in groups}
    for r in found:
        group = groups[sha[r["text_sha256"]]]
        best = min(group)
        assert r["group_size"] == len(group) and r["keep_id"] == (None if best[1] else best[2])
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == dict.fromkeys(sha, 1)


# ---- n-gram Jaccard join

def brute_components(rows, size, percent):
    sets, parent = [], {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, text, *_ in rows:
        w = WORD.findall((text or "").translate(LOW))
        sets.append((doc_id, {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
        if doc_id is not None:
            parent[doc_id] = doc_id
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and (a == b or 100 * len(x & y) >= percent * len(x | y)):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return sorted((str(d), len(s), str(None if d is None else root(d))) for d, s in sets)


@pytest.mark.parametrize("frequent, block", [(setjoin.FREQUENT, setjoin.BLOCK), (2, 2), (10**9, 3)])
def test_jaccard_join(spark, docs, rows, frequent, block, monkeypatch):
    """Whatever the order of the numbers and the size of the blocks, the links are those of all pairs."""
    monkeypatch.setattr(setjoin, "FREQUENT", frequent)
    monkeypatch.setattr(setjoin, "FREQUENT_HERE", 2)
    monkeypatch.setattr(setjoin, "BLOCK", block)
    found = setjoin.jaccard_join(spark, docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == brute_components(rows, 5, 75)


def test_jaccard_chains(spark):
    """Sets of 12 words of which neighbours share 11: links of one long chain, that no two distant ones have."""
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 40)), "en", "s", 0) for i in range(30)]
    found = setjoin.jaccard_join(spark, spark.createDataFrame(rows, DOCS))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found.collect()) == brute_components(rows, 5, 75)


def test_jaccard_texts_of_one_doc_id(spark):
    """Several different texts of one size under one doc_id, each with a near copy under another."""
    rows = []
    for i in range(12):
        for k in range(3):
            text = [f"w{i}x{k}x{j}" for j in range(60)]
            rows += [(i, " ".join(text), "en", "s", 0), (100 + 3 * i + k, " ".join(text[:-1] + ["changed"]), "en", "s", 0)]
    found = setjoin.jaccard_join(spark, spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == brute_components(rows, 5, 75)


def test_jaccard_rows_grow_with_members(spark, monkeypatch):
    """Near copies of a text that is not there itself: whatever pairs there are, no step hands on more rows than it has members."""
    base, sizes = [f"w{j}" for j in range(60)], {}
    rows = [(i, " ".join(f"x{i}" if j in (i % 60, (7 * i + 30) % 60) else w for j, w in enumerate(base)), "en", "s", 0) for i in range(1, 60)]

    def counted(session, df, name):
        out = written(session, df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(setjoin, "written", counted)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    found = setjoin.jaccard_join(spark, spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == brute_components(rows, 5, 75)
    assert max(sizes["more"]) < len(rows) and sizes["left"][0] <= sizes["members"][0]


def test_ties_are_a_forest():
    """Of the pairs of one component, as many as tie it; a pair is compared in the first tile that both rows carry."""
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 1, 2, 3, 100)]
    p, q = (np.array(x) for x in zip(*combinations(range(5), 2), strict=True))
    assert list(setjoin.tied(p, q, [9, 9, 5, 3, 1], sets, 75)) == [(0, 2), (0, 3)]
    assert setjoin.apart(np.array([0, 0, 1]), np.array([1, 2, 2]), 7, [[3, 7], [3, 7, 8], [5, 7]]).tolist() == [False, True, True]


@given(st.lists(st.tuples(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.integers(0, 40)), min_size=1, max_size=5))
@settings(max_examples=50, deadline=None)
def test_signatures_bound_the_overlap(sets):
    for numbers, change in sets:
        x = sorted_distinct(np.array(sorted(numbers), np.uint64))
        y = sorted_distinct(np.concatenate([x[change:], np.arange(change * 3, dtype=np.uint64)]))
        if not len(y):
            continue
        differ = setjoin.differing([setjoin.signature(x)], [setjoin.signature(y)])[0]
        assert differ <= len(np.setxor1d(x, y))


# ---- lines

def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return len(b) - len(a) <= 1 and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


@given(st.text(alphabet="abc", min_size=1, max_size=40), st.integers(0, 40), st.sampled_from("x ab"), st.sampled_from("cid"), st.sampled_from([1, 20]))
@settings(max_examples=40, deadline=None)
def test_one_edit_is_found(spark, line, at, char, kind, least):
    other = line[:at] + {"c": char + line[at + 1 :], "i": char + line[at:], "d": line[at + 1 :]}[kind]
    docs = spark.createDataFrame([(1, line), (2, other)], "doc_id long, text string").coalesce(1)
    found = lines.dropped_lines(spark, docs, least).count()
    other = other.strip()
    assert found == int(bool(other) and (other == line or min(len(other), len(line)) >= least and one_edit(line, other)))


def test_lines(spark, docs, rows):
    key = {text: k for text, k in docs.select("text", F.xxhash64("text")).collect()}
    places = sorted({((d is not None, d or 0), key[t], i, x.strip(" \t\r\v\f"), d, t) for d, t, *_ in rows for i, x in enumerate((t or "").split("\n"))}, key=lambda p: p[:3])
    first, want = {}, defaultdict(list)
    for at, k, i, line, doc_id, text in places:
        if line:
            near = [p for x, p in first.items() if x == line or one_edit(x, line)]
            if near and min(near) < (at, k, i):
                want[doc_id, text].append(i)
            first.setdefault(line, (at, k, i))
    for r in lines.deduplicated(spark, docs).select("doc_id", "lang", "text", "dropped", "n_lines").collect():
        text = next(t for d, t, *_ in rows if d == r["doc_id"] and kept(t, want[r["doc_id"], t]) == r["text"] and want[r["doc_id"], t] == r["dropped"])
        assert r["n_lines"] == (len(text.split("\n")) if text else 0)
    assert sum(map(len, want.values())) > 20


def test_line_query_returns_texts(spark, sf_dir):
    """The query's text is the document's without the lines that it lists."""
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op7_line_dedup"](spark, sf_dir).collect()
    for r in found:
        gone = [int(i) for i in r["dropped"].split(",") if i]
        assert r["text"] == kept(texts[r["doc_id"]], gone) and r["n_dropped"] == len(gone)
    assert len(found) == len(texts) and any(r["n_dropped"] for r in found)


def kept(text, gone):
    return text if not gone else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


# ---- licenses

def test_licenses(spark, docs, rows):
    long = " ".join(licenses.NOTICES["GPL-3.0"][1].split())
    texts = ["some words here Released under the MIT license, and more", "Copyright. all rights reserved", long, long.replace("either", "any"), long[:60], "under the terms of the", "x " * 500 + licenses.NOTICES["BSD"][0] + " y" * 500]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)] + [(1001, texts[1])], "doc_id long, text string")
    found = licenses.scan(docs.select("doc_id", "text").union(more)).collect()

    def shingles_(t, width=5):
        w = re.findall("[a-z0-9]+", (t or "").translate(LOW))
        width = min(width, len(w))
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()

    templates = [(name, i, shingles_(t)) for name, notices in licenses.NOTICES.items() for i, t in enumerate(notices)]
    want = Counter()
    for doc_id, text in [(d, t) for d, t, *_ in rows] + [(r["doc_id"], r["text"]) for r in more.collect()]:
        for name, i, x in templates:
            own = shingles_(text, len(next(iter(x))))
            if 100 * len(own & x) >= 75 * len(x):
                want[doc_id, name, i, len(own & x), len(x)] += 1
    assert Counter(tuple(r) for r in found) == want and len(want) >= 6


def test_short_templates_stand_anywhere(spark):
    """Templates of one to four words, within and at the ends of long texts, at even and odd places."""
    notices = {"reserved": ["All rights reserved.", "Copyright. All rights reserved."], "short": ["Unlicense", "Public domain"], "MIT": licenses.NOTICES["MIT"]}
    much = "some words of a long text " * 80
    texts = [much + "All rights reserved.", much + "and all rights, reserved", "(c) copyright; ALL RIGHTS RESERVED! " + much, much + "public\ndomain " + much, much + "unlicense", "all rights are reserved", "overall rights reserved public domains unlicensed", much + "Released under the MIT License. All rights reserved.", "unlicense"]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), notices).collect()
    ones = [(0, "reserved", 0), (1, "reserved", 0), (2, "reserved", 0), (2, "reserved", 1), (3, "short", 1), (4, "short", 0), (7, "MIT", 0), (7, "reserved", 0), (8, "short", 0)]
    assert sorted(tuple(r) for r in found) == sorted((*x, 1, 1) for x in ones)


def test_bands_seldom_miss_alike():
    """Templates of four pairs at odd places, of random hashes: no more than 1 in 20,000 shares no band with its windows."""
    assert licenses.BANDS >= 5 and len({m >> 61 for m in licenses.MASKS}) == licenses.BANDS
    n = 400_000
    pairs = np.random.default_rng(1).integers(-(2**63), 2**63, (n, 6), np.int64)
    missed = np.ones(n, bool)
    for mask in licenses.MASKS:
        h = pairs ^ np.int64(mask)
        own, before, after = h[:, 1:5].min(axis=1), h[:, :4].min(axis=1), h[:, 2:].min(axis=1)
        missed &= (own != before) & (own != after)
    assert missed.sum() <= n / 20_000


# ---- personal data

PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def luhn(d):
    return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, good) in PATTERNS.items() for m in re.finditer(p, text or "") if good(m[0])]


def personal_rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r["doc_id"]: r for r in personal.personal_data(df).collect()}


def test_base_spans(spark, rows):
    draw = random.Random(3)
    texts = ["".join(draw.choice(["a", "b.c", "@", "1", "2.3", ".", "255", "256", "4", " ", "-", "+1", "(5)", "é", "😀", "_", "0", "4111111111111111", "a@b.co", "1.2.3.4", "+49 30 1234567"]) for _ in range(40)) for _ in range(400)]
    texts += ["", None, "4111 1111 1111 1111", "x@y.z_a@b.c", "01.002.3.255 1.2.3.0256 1.2.3.4.5.6.7.8", "7" * 5000, "a" * 5000 + "@b", "1." * 3000, "+1 " * 900, "a@b.c " * 700]
    found = personal_rows(spark, texts)
    for i, text in enumerate(texts):
        assert [(s["kind"], s["start"], s["end"]) for s in found[i]["base"]] == base_spans(text), text
        assert {tuple(s) for s in found[i]["base"]} <= {tuple(s) for s in found[i]["found"]}


def test_added_spans(spark):
    texts = {
        "Konto: DE89 3704 0044 0532 0130 00.": [("iban", 7, 34)],
        "Konto: DE88 3704 0044 0532 0130 00.": [],
        "SSN 123-45-6789": [("ssn", 4, 15)],
        "part 123-45-6789": [],
        "call +1 (269) 555-3296 4524132264652876 now": [("card", 23, 39), ("phone", 5, 22)],
        "4465758382889437 4465758382889437": [("card", 0, 16), ("card", 17, 33)],
    }
    found = personal_rows(spark, texts)
    for i, (text, want) in enumerate(texts.items()):
        assert [(s["kind"], s["start"], s["end"]) for s in found[i]["found"]] == want, text


def test_context_moves_the_score(spark):
    found = personal_rows(spark, ["credit card 4111111111111111", "4111111111111111", "sample order no 4111111111111111"])
    scores = [found[i]["found"][0]["score"] for i in range(3)]
    assert scores[0] > scores[1] > scores[2]


# ---- toxicity

def toxic_corpus(n=1200):
    draw = random.Random(11)
    clean = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 6))) for _ in range(800)]
    bad = ["zorg", "zorgling", "quvak", "quvakor"]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(draw.choices(clean, k=9)) for _ in range(draw.randint(1, 25))]
        toxic = i % 7 == 0
        if toxic:
            at = draw.randrange(len(sentences))
            sentences[at] = "ö " + sentences[at] + " " + draw.choice(bad) + " " + draw.choice(clean)
        rows.append((i, ". ".join(sentences) + ".", "en", "s", 0))
        if i % 5:
            labels.append((i, None, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    rows += [(5000, "", "en", "s", 0), (5001, None, "en", "s", 0), (None, "ö abc zorg abc.", "en", "s", 0), (5002, "abc def " * 30000 + ". zorg", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(9)).repartition(6)
    labels += [(1, None, None), (0, None, 0), (None, None, 1)]
    found = {r["doc_id"]: r for r in toxicity.toxicity(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(found) == len(rows) and "lang" in found[1].asDict()
    texts = {r[0]: r[1] for r in rows}
    for held in (False, True):
        part = [i for i in range(1200) if found[i]["held_out"] == held]
        right = sum(found[i]["predicted"] == (i % 7 == 0) for i in part)
        assert right >= 0.97 * len(part)
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(1200))
    for i in range(0, 1200, 7):
        if found[i]["predicted"]:
            bad = [texts[i][s["start"] : s["end"]] for s in found[i]["sentences"]]
            assert not bad or any("zorg" in s or "quvak" in s for s in bad)
    assert found[5000]["score"] == found[5001]["score"] == 0 and found[None]["predicted"] == 1 and not found[None]["held_out"]
    assert sum(bool(found[i]["sentences"]) for i in range(0, 1200, 7)) > 140


def plain_features(sentence):
    """Words, stems and pairs, as strings."""
    w = re.findall(r"[0-9a-z']+", sentence.lower())
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)), *(f"{x[:n]}|{n}" for x in w for n in toxicity.STEMS if len(x) > n)}


def plain_model(texts, toxic, weight):
    """Noisy-or over sentences by plain loops: weights by feature, the bias, and each text's sentences' features."""
    bags = [[plain_features(s) for s in re.split(r"[.!?\n]", t) if re.search(r"[0-9A-Za-z']", s)] for t in texts]
    share = sum(toxic) / len(toxic)
    seen, bad = Counter(), Counter()
    for bag, label in zip(bags, toxic, strict=True):
        for f in set().union(*bag):
            seen[f] += 1
            bad[f] += label
    told = sorted(f for f in seen if abs(bad[f] - share * seen[f]) > toxicity.LEAST * math.sqrt(share * (1 - share) * seen[f]))
    weight = [x / sum(weight) for x in weight]
    share = sum(x for x, label in zip(weight, toxic, strict=True) if label)
    values = {**dict.fromkeys(told, 0.0), None: math.log(share * len(toxic) / sum(map(len, bags)))}
    moment, spread = dict.fromkeys(values, 0.0), dict.fromkeys(values, 0.0)
    for k in range(1, toxicity.ROUNDS + 1):
        grad = {f: toxicity.DECAY * x / len(toxic) if f is not None else 0.0 for f, x in values.items()}
        for bag, label, x in zip(bags, toxic, weight, strict=True):
            chances = [1 / (1 + math.exp(-values[None] - sum(values.get(f, 0) for f in s))) for s in bag]
            none = math.prod(1 - c for c in chances)
            for s, c in zip(bag, chances, strict=True):
                # Of -log(1 - none) or -log(none), by the sentence's sum of weights.
                slope = x * c * (-none / (1 - none) if label else 1)
                for f in [None, *s]:
                    if f in grad:
                        grad[f] += slope
        for f, g in grad.items():
            moment[f] = 0.9 * moment[f] + 0.1 * g
            spread[f] = 0.99 * spread[f] + 0.01 * g * g
            values[f] -= toxicity.RATE * moment[f] / (1 - 0.9**k) / (math.sqrt(spread[f] / (1 - 0.99**k)) + 1e-7)
    return values, bags


def test_noisy_or_against_plain_loops(spark):
    """Training and scores, held against loops over strings: every text's score and every sentence at the threshold."""
    rows, _ = toxic_corpus(200)
    texts, toxic = [t.replace("ö", "oe") for _, t, *_ in rows], [i % 7 == 0 for i in range(len(rows))]
    weight = [1.0 + i % 3 for i in range(len(rows))]
    values, bags = plain_model(texts, toxic, weight)
    model = toxicity.learned(pa.array(texts), np.array(toxic), np.array(weight))
    assert (model[:-1] != 0).sum() == len(values) - 1 >= 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = docs.select("doc_id", toxicity.scored(spark.sparkContext.broadcast(model)).alias("s")).select("doc_id", "s.*").collect()
    for r in found:
        chances = [1 / (1 + math.exp(-values[None] - sum(values.get(f, 0) for f in s))) for s in bags[r["doc_id"]]]
        assert r["score"] == pytest.approx(1 - math.prod(1 - c for c in chances), abs=1e-6)
        assert [s["score"] for s in r["sentences"]] == pytest.approx([c for c in chances if c >= toxicity.THRESHOLD], abs=1e-6)
    assert sum(bool(r["sentences"]) for r in found) >= 20


def test_one_text_of_a_doc_id_is_learned(spark):
    """A doc_id with many texts adds one of them to the sample, whatever their order."""
    taken = []
    rows = [(8, f"zorg text {i}.") for i in range(300)] + [(i, "abc.") for i in range(20) if i != 8]
    labels = spark.createDataFrame([(i, 1, int(i == 8)) for i in range(20)], "doc_id long, quality int, toxic int")
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string")
        taken.append(toxicity.trained(spark, docs, labels).value.tobytes())
    assert taken[0] == taken[1]


def test_held_out_labels_are_not_learned(spark):
    """Labels of held-out rows only: nothing to learn from."""
    rows = [(i, "zorg all day.", "en", "s", 0) for i in range(50)]
    labels = [(i, 1, 1) for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(spark, docs, labels).where("predicted = 1").count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("pipeline", "op5_embedding_near_dedup", "op8_html_extraction", "op12_centroid_clustering", "op13_collocations")])
def test_queries_run_on_whole_tables(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # queries with a row for each document
    got = df.select("doc_id").distinct().count()
    assert got == n if name != "op1_license_scan" else 0 < got < n
