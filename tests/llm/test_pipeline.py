"""The pipeline's stages against plain code, each on what the one before kept."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from navspan.llm import stages as stages_of_library
from navspan.llm.shared import written
from test_documents import TOKENIZER, WORD, brute_components, odd_rows, tokens_of, toxic_corpus

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, over a corpus with every odd case."""
    folder = tmp_path_factory.mktemp("sf")
    rows, labels = toxic_corpus(700)
    odd = [(None if i is None else i + 10_000, *rest) for i, *rest in odd_rows()]
    spark.createDataFrame(rows + odd, DOCS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(spark, stage(spark, docs, str(folder)), "stage")
        out[name] = [tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()], docs.columns, after.columns
        docs = after
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    assert all(before == after for name, (_, _, before, after) in stages.items() if name != "packing")


def test_toxic_documents_go(stages):
    before, after, *_ = stages["toxicity"]
    gone = Counter(before) - Counter(after)
    assert not Counter(after) - Counter(before)
    toxic = [r for r in before if re.search("zorg|quvak", r[1] or "")]
    assert len([r for r in toxic if r in gone]) >= 0.97 * len(toxic)
    assert len([r for r in gone if r not in toxic]) <= 2


def test_exact_copies_go(stages):
    before, after, *_ = stages["exact dedup"]
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert Counter(plain(r[1]) for r in after) == dict.fromkeys({plain(r[1]) for r in before}, 1)
    assert not Counter(after) - Counter(before)


def text_numbers(rows):
    """Each (doc_id, text) by a number in the order of doc_id, as documents of their own."""
    texts = sorted({(r[0], r[1] or "") for r in rows if r[0] is not None})
    return {t: i for i, t in enumerate(texts)}


def test_near_copies_go(stages):
    """One text of each group stays, in each of its rows that differ; none that is near to nothing goes."""
    before, after, *_ = stages["n-gram Jaccard join"]
    number = text_numbers(before)
    components = {int(i): c for i, _, c in brute_components([(i, text) for (_, text), i in number.items()], 5, 75)}
    kept = Counter(components[number[r[0], r[1] or ""]] for r in after if r[0] is not None)
    assert kept == dict.fromkeys(components.values(), 1)
    assert [r for r in after if r[0] is None] == [r for r in before if r[0] is None]


def test_texts_of_one_doc_id(spark):
    """Doc 5 has texts A and B, doc 3 a near copy of A, doc 7 two unrelated texts: B and both of doc 7 stay."""
    text = {x: " ".join(f"{x}{i}" for i in range(40)) for x in "ABCD"}
    near = text["A"].replace("A39", "other")
    docs = spark.createDataFrame([(5, text["A"], "en", "s", 1), (5, text["B"], "en", "s", 1), (3, near, "en", "s", 1), (7, text["C"], "en", "s", 1), (7, text["D"], "en", "s", 1)], DOCS)
    found = stages_of_library.distinct_sets(spark, docs, "")
    assert sorted((r.doc_id, r.text[0]) for r in found.collect()) in ([(3, "A"), (5, "B"), (7, "C"), (7, "D")], [(5, "A"), (5, "B"), (7, "C"), (7, "D")])


def test_other_columns_pass(spark, tmp_path):
    """Columns that operators use themselves, through all stages but the last, with their values."""
    rows, labels = toxic_corpus(300)
    names = ("d", "k", "score", "predicted", "held_out", "sentences", "copies", "_from", "_scored", "rows", "_copy", "text_key", "kept", "number", "their_copies", "key_doc_id", "may_go", "gone", "copy")
    docs = spark.createDataFrame(rows + rows[:20] + [(rows[0][0], "another text of this document", "en", "s", 0)], DOCS)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string"), F.col("text")))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given = {tuple(r) for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == columns
        after = [tuple(r) for r in docs.collect()]
        assert set(after) <= given and after, name


def test_mix_repeats_documents(stages):
    before, after, *_ = stages["mixing sources to target weights"]
    assert set(after) <= set(before)
    assert all(n <= 2 * Counter(before)[r] for r, n in Counter(after).items())
    size = lambda rows: sum(len(WORD.findall(r[1] or "")) for r in rows)
    assert abs(size(after) - 1.5 * size(before)) < 0.1 * size(before)


def test_packing_holds_all_tokens(stages):
    before, after, _, columns = stages["packing"]
    at = columns.index("length")
    assert sum(r[at] for r in after) == sum(len(tokens_of(r[1])) for r in before)


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert TOKENIZER
