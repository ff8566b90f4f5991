"""Decontamination, clustering and collocations against plain code, with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from navspan.llm import collocations, leaks, lloyd

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LEAK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leak_words(text):
    return LEAK_WORD.findall((text or "").translate(LOW))


def leak_tables():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdeé", k=draw.randint(1, 5))) for _ in range(60)]
    say = lambda n: draw.choices(vocabulary, k=n)
    items = [(i, " ".join(say(draw.choice([10, 11, 14, 15, 30, 80])))) for i in range(20)]
    items += [(20, "Solely this"), (21, "unheard"), (22, ""), (23, None), (24, " ., "), (24, " ".join(say(12))), (None, items[3][1] + " " + " ".join(say(9)))]
    items += [(25, items[0][1]), (25, items[0][1]), (26, " ".join(["a"] * 25)), (27, " ".join(say(9))), (28, " ".join(say(5))), (100, items[1][1])]
    rows = []
    for i in range(120):
        words = say(draw.choice([0, 3, 20, 200]))
        for _ in range(draw.randint(0, 3)):
            item = leak_words(draw.choice(items)[1])
            a = draw.randint(0, max(0, len(item) - 8))
            at = draw.randint(0, len(words))
            words[at:at] = item[a : a + draw.randint(4, 40)]
        words = [w.upper() if draw.random() < 0.1 else w for w in words]
        rows.append((i, "".join(w + draw.choice([" ", ", ", "\n", "—\x07 ", " 🙂! "]) for w in words), "en", "s", 0))
    rows += [(200, None, None, None, None), (201, "", "", "", 0), (5, "unheard", "en", "s", 0), rows[1], rows[1], (None, "UNHEARD of; solely\x00this", None, None, None), (202, "a " * 4000, "en", "s", 0)]
    return rows, items


def brute_leaks(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = leak_words(text)
        n = min(10, len(words))
        for j in range(len(words) - n + 1) if n else ():
            windows[tuple(words[j : j + n])].add(item)
    out = []
    for doc_id, text, *_ in rows:
        words, hit, found = leak_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if tuple(words[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(words[j : j + n])]
        out.append((str(doc_id), len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out)


@pytest.mark.parametrize("part_bytes, group", [(1 << 20, 32), (1000, 32), (1000, 2)])
def test_contaminated(spark, part_bytes, group):
    rows, items = leak_tables()
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumn("runs", F.lit(1)).withColumn("items", F.lit("x")).withColumn("n_words", F.lit("y"))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)).withColumn("part", F.lit(2))
    found = leaks.contaminated(spark, docs, benchmark, part_bytes=part_bytes, group=group).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in found) == brute_leaks(rows, items)
    # Spans are whole words of the original text, as many as were hit.
    texts = defaultdict(set)
    for doc_id, text, *_ in rows:
        texts[doc_id].add(text)
    for r in found:
        assert any(sum(len(leak_words(t[s.start : s.end])) for s in r.spans) == r.n_hit for t in texts[r.doc_id] if t is not None or not r.spans) or not r.n_words


def test_long_items_are_cut(spark):
    words = [f"w{i}" for i in range(50)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "one two")], "item_id long, text string")
    parts = [(r["item"], bytes(r["words"]).decode().split()) for r in leaks.segments(benchmark, 10, 16).collect()]
    assert all(len(w) <= 25 for _, w in parts) and ("2", ["one", "two"]) in parts
    held = {tuple(w[j : j + 10]) for i, w in parts if i == "1" for j in range(len(w) - 9)}
    assert held == {tuple(words[j : j + 10]) for j in range(41)}


def test_empty_benchmark(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in leaks.contaminated(spark, docs, none).collect()] == [(1, 2, 0, [], [])]
    assert leaks.contaminated(spark, docs.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        leaks.contaminated(spark, docs, none, window=8)


def brute_lloyd(rows, k, rounds, dimensions):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and None not in v and all(map(math.isfinite, v))]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((x - m) ** 2 for x, m in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, members in groups.items():
            centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return sorted((str(i), *reversed(nearest(v))) for i, v in kept), centroids


def cluster_rows():
    draw = random.Random(8)
    rows = [(i, [draw.choice([-1.5, -0.1, 0.0, 0.3, 2.0]) + draw.random() / 9 for _ in range(6)]) for i in range(150)]
    rows += [(i + 500, rows[i][1]) for i in range(20)] + [rows[0], rows[0]]
    rows += [(None, rows[4][1]), (None, None), (900, None), (901, []), (902, [1.0] * 5), (903, [1.0] * 7), (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (905, [float("nan")] * 6), (906, [float("inf")] + [0.0] * 5), (907, [100_000.0] + [-100_000.0] * 5)]
    return rows


@pytest.mark.parametrize("k, rounds, block", [(5, 4, 2), (5, 0, 4), (300, 2, 6), (1, 3, 1)])
def test_clusters(spark, k, rounds, block):
    rows = cluster_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for name in ("row", "vector", "block", "slice", "cluster", "distance"):
        vectors = vectors.withColumn(name, F.lit("x"))
    found, centroids = lloyd.clusters(spark, vectors, k, rounds, dimensions=6, block=block)
    want, middle = brute_lloyd(rows, k, rounds, 6)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want
    assert centroids.tolist() == middle


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    found, centroids = lloyd.clusters(spark, none)
    assert found.count() == 0 and len(centroids) == 0
    far = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        lloyd.clusters(spark, far)


def brute_collocations(rows, support, longest, top):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for j in range(len(words) - size + 1):
                    counts[lang, tuple(words[j : j + size])] += 1
    frequent = {k: c for k, c in counts.items() if c >= support}
    inner = set()
    for (lang, words), c in frequent.items():
        for size in range(2, len(words)):
            for j in range(len(words) - size + 1):
                if c >= frequent[lang, words[j : j + size]]:
                    inner.add((lang, words[j : j + size]))
    out = defaultdict(list)
    for (lang, words), a in frequent.items():
        if len(words) > 1 and (lang, words) not in inner:
            score, k = min((1000 * a * n[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words)))
            out[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], n[lang]))
    return sorted((lang, i, p.decode(), -a, l, r, n, -s) for lang, found in out.items() for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:top], 1))


def collocation_rows():
    draw = random.Random(2)
    rows = []
    for i in range(200):
        lang = draw.choice(["en", "en", "en", "é", None, "und", ""])
        words = draw.choices(["new", "york", "city", "of", "the", "the", "é", "日本", "x" * 50, "fox"], k=draw.choice([0, 4, 40, 300]))
        rows.append((i, "".join(w.upper() * (draw.random() < 0.2) or w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \r\n"]) for w in words), lang, "s", 0))
    rows += [rows[5], rows[5], (900, None, "en", None, None), (901, None, None, None, None), (902, "", "empty", None, None), (903, "a a " * 3000, "aa", None, None), (903, "b " * 500, "aa", None, None)]
    return rows


@pytest.mark.parametrize("support, longest, top, run_bytes", [(8, 5, 10_000, 1 << 25), (8, 5, 7, 2000), (40, 5, 10_000, 500), (3, 2, 50, 4000), (10**9, 5, 10, 4000), (30, 3, 10_000, 1)])
def test_collocations(spark, support, longest, top, run_bytes):
    rows = collocation_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in ("words", "total", "count", "slot", "of", "n", "a", "size"):
        docs = docs.withColumn(name, F.lit("x"))
    found = collocations.collocations(spark, docs, support, longest, top, run_bytes=run_bytes)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, support, longest, top)


def test_full_map_of_phrases(spark, monkeypatch):
    """Where every slot of the map is taken, more is counted and nothing changes."""
    monkeypatch.setattr(collocations, "phrase_map", lambda keys: collocations.np.full(collocations.MAP_BITS // 8, 255, "uint8"))
    rows = collocation_rows()
    found = collocations.collocations(spark, spark.createDataFrame(rows, DOCS).repartition(5), 40, run_bytes=2000)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, 40, 5, 2000)


def test_shards_hand_on_sets(spark):
    """A shard makes a row for each language and block at most, however many phrases it has, and loses none of them."""
    texts = [" ".join(f"w{i}" for i in range(k, k + 6000)) for k in (0, 3000)]
    docs = spark.createDataFrame([("en", t, sum(map(len, texts))) for t in texts], "lang string, text string, total long").coalesce(1)
    rows = collocations.local_phrases(docs, (1, 2), 1, None, 0, 1 << 25)
    blocks = rows.where("block is not null").collect()
    assert len(blocks) <= collocations.BLOCKS
    keys = collocations.np.concatenate([collocations.np.frombuffer(r.keys, "int64") for r in blocks])
    assert len(keys) == len(set(keys.tolist())) == 9000 + 8999
    counted = collocations.counted_phrases(docs, (1, 2), 2, collocations.np.full(collocations.MAP_BITS // 8, 255, "uint8"), 1 << 25)
    assert counted.count() <= 2 * collocations.BLOCKS
    found = collocations.summed(counted, 2).collect()
    assert sorted(r.text for r in found if r.text) == sorted(f"w{i}" for i in range(3000, 6000))
    assert len(found) == 3000 + 2999 and {r["count"] for r in found} == {2}


def test_no_documents(spark):
    assert collocations.collocations(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_counts_beyond_64_bits(spark):
    """Products of counts pass 64 bits; the score is floored exactly."""
    a, n, l, r = 3_000_000_001, 10**14 + 7, 3_000_000_019, 3_000_000_003
    row = spark.createDataFrame([(a, l, r, n)], "a long, l long, r long, n long")
    assert row.select(collocations.score_of(1000)).first()[0] == 1000 * a * n // (l * r)
