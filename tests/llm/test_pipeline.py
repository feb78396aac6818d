"""The pipeline's stages against plain Python, and its contract."""

import hashlib
import random

import public_tokenizers
import pytest

import corpus_pipeline
from ledgerloom.llm import language_id, mixing, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(tmp_path_factory, spark):
    rng = random.Random(12)
    letters = {"aa": "abcde", "bb": "fghij"}
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(sorted(letters))
        words = ["".join(rng.choice(letters[lang]) for _ in range(rng.randint(3, 7))) for _ in range(rng.randint(10, 40))]
        toxic = i % 8 == 0
        words += ["vilest", "rotter"] * toxic
        rows.append((i, " ".join(words), lang, rng.choice(["s", "t", None]), 0))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[1 + i][1], "aa", "s", 0) for i in range(20)] + [(2000, None, None, None, None), (2001, "123", "aa", "s", 3), (None, "abcab bcade", None, None, None)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    known = {r.doc_id: r for r in docs.collect()}
    one = corpus_pipeline.language(spark, docs, tables)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == set(known) - {2000, 2001}
    two = corpus_pipeline.clean(spark, docs, tables)
    gone = set(known) - {r.doc_id for r in two.collect()}
    assert gone == {i for i in range(400) if i % 8 == 0} | {1000 + i for i in range(20) if (1 + i) % 8 == 0}
    three = corpus_pipeline.distinct(spark, docs, tables)
    assert {r.doc_id for r in three.collect()} == set(known) - {1000 + i for i in range(20)}
    four = corpus_pipeline.mixed(spark, docs, tables)
    assert four.columns == docs.columns
    assert four.count() == sum(r.mixed.copies for r in mixing.mix(docs, queries.WEIGHTS).collect())
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in corpus_pipeline.encoded(spark, docs, tables).collect():
        text = known[r.doc_id].text or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    kept = {r.doc_id for r in rows}
    assert rows and not kept & {2000, 2001} and not any(i is not None and i < 400 and i % 8 == 0 for i in kept) and not any(i is not None and i >= 1000 for i in kept)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    assert language_id.UNKNOWN == "und"


def test_stages_of_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, tables)
        assert found.count() == 0 and (name == "encoded" or found.columns == docs.columns)
