import random

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gleanery.checks.base import table
from gleanery.llm import common, langid, quality, simhash

from .test_secrets import masked

SF = "/root/testdata/sf0.001"


def test_stages_against_their_operators(spark):
    """Each stage's rows follow from its operator's own results on the rows before, recomputed here row by row."""
    docs = table(spark, SF, "documents")
    words = max((r.text for r in docs.where("lang = 'en'").collect()), key=len).split()
    random.Random(0).shuffle(words)
    planted = " ".join(words) + " password = 'hunter22222' and more"
    docs = docs.unionByName(spark.createDataFrame([(10**6, planted, "en", "src1", len(planted))], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "good_quality", "simhash_dedup", "without_secrets", "packed"]

    def run(name, rows):
        out = corpus_pipeline.written(stages[name](spark, rows, SF), name)
        if name != "packed":
            assert out.columns == docs.columns
        return out

    model, known = langid.train(docs), {r.doc_id: r for r in docs.collect()}
    clear = run("language", docs)
    want = {i for i, r in known.items() for lang, score in [model.predict(r.text)] if lang != "und" and score >= langid.MARGIN}
    assert {r.doc_id for r in clear.collect()} == want and len(want) > 0.9 * len(known)

    good = run("good_quality", clear)
    trained = quality.train(clear, table(spark, SF, "labels"))
    assert {r.doc_id for r in good.collect()} == {
        r.doc_id for r in quality.with_quality(clear, trained, "q").where("q.accepted").collect()
    }
    unique = run("simhash_dedup", good)
    groups = simhash.near_duplicates(good).where("doc_id = component_id")
    assert {r.doc_id for r in unique.collect()} == {r.doc_id for r in groups.collect()}

    clean = run("without_secrets", unique)
    before = {r.doc_id: r.text for r in unique.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert after == {i: (masked(t), len(masked(t))) for i, t in before.items()}
    assert after[10**6][0] == planted.replace("password = 'hunter22222", "[SECRET]")

    pieces = run("packed", clean)
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t, _ in after.values())
    assert pieces.agg(F.sum("length")).first()[0] == want
    assert corpus_pipeline.run(spark, SF).columns == pieces.columns


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs, name, stage):
    found = stage(spark, odd_docs, SF)
    if name != "packed":
        assert found.columns == odd_docs.columns
    assert 0 < found.count()
    assert stage(spark, no_docs, SF).count() == 0


def test_near_duplicates_broadcast_no_exploded_side(spark, monkeypatch):
    plans = []

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.written(df, label)

    monkeypatch.setattr("gleanery.llm.simhash.written", recorded)
    monkeypatch.setattr("gleanery.llm.components.written", recorded)
    docs = table(spark, SF, "documents").where("doc_id < 40")
    assert 0 < corpus_pipeline.simhash_dedup(spark, docs, SF).count() <= docs.count()
    for key in ("cell", "centre"):
        assert any(f"SortMergeJoin [{key}#" in plan for plan in plans)
        assert not any(f"BroadcastHashJoin [{key}#" in plan for plan in plans)
