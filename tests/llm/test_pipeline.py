"""The pipeline against its operators, stage by stage."""

import cases
import pytest
from test_op4 import brute

import corpus_pipeline
from newspipe.llm import language, leaks, surrogates
from newspipe.llm.queries import SURROGATE_KEY


def test_stages(spark, sf_dir):
    """Each stage keeps what its operator, asked by itself, says is to be kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    one = stages["language"](spark, docs, sf_dir).cache()
    assert one.columns == docs.columns
    known = language.identify(docs).filter("lang_pred <> 'und'")
    assert ids(one) == ids(known)
    two = stages["near_duplicates"](spark, one, sf_dir).cache()
    assert two.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in one.select("doc_id", "text").collect()]
    alone = {d for (d, _), (_, root) in zip(rows, brute(rows, 80), strict=True) if d == root}
    assert ids(two) == alone and two.count() == len(alone)
    three = stages["decontamination"](spark, two, sf_dir).cache()
    assert three.columns == docs.columns
    assert ids(three) == ids(two) - ids(leaks.find_leaks(two, bench))
    four = stages["personal_data"](spark, three, sf_dir).cache()
    assert four.columns == docs.columns
    texts = {r.doc_id: r.text for r in three.collect()}
    for r in four.collect():
        assert r.text == surrogates.replaced(SURROGATE_KEY.encode(), texts[r.doc_id])[0]
        assert r.n_chars == len(r.text)
    five = stages["packing"](spark, four, sf_dir)
    assert ids(five) == ids(four)
    for df in (one, two, three, four):
        df.unpersist()


@pytest.mark.parametrize("rows", [[], cases.ROWS])
def test_awkward_documents(spark, tmp_path, rows):
    docs = cases.documents(spark, rows)
    more = [(100 + i, "some english words to learn from " * 3, "en", "s", 1) for i in range(8)] if rows else []
    names = "doc_id long, text string, lang string, source string, n_chars long"
    docs = docs.unionByName(spark.createDataFrame(more, names), allowMissingColumns=True)
    folder = cases.saved(docs, tmp_path, "documents")
    cases.saved(spark.createDataFrame([(1, None)], "item_id long, text string"), tmp_path, "benchmark")
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:7] == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
    assert (got.count() > 0) == bool(rows)
