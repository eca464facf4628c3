import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from gleanery.checks.base import table
from gleanery.llm import langid, quality
from gleanery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    rows = QUERIES["op3_compression_langid"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(langs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 0.25 < len(held) / len(rows) < 0.42
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.accepted for r in rows]) > 0.97


def test_held_out_documents_teach_nothing(spark):
    docs = table(spark, SF, "documents")
    wrong = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 'xx' ELSE lang END AS lang")
    assert langid.train(wrong).dictionaries == langid.train(docs).dictionaries


def test_dictionaries_and_sizes_by_plain_calls(spark):
    """Dictionaries made anew in plain Python, and every size by the library itself."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").limit(400).toPandas()
    model = langid.train(spark.createDataFrame(docs))
    ids = spark.createDataFrame(docs[["doc_id"]]).select("doc_id", langid.held_out(F.col("doc_id")).alias("held"), F.xxhash64("doc_id").alias("hash"))
    known = {r.doc_id: r for r in ids.collect()}
    first = {}
    for r in docs.sort_values("doc_id").itertuples():
        if r.lang and r.text and any(c.isalpha() for c in r.text) and not known[r.doc_id].held:
            first.setdefault((r.lang, r.text), r.doc_id)
    for lang, content in model.dictionaries.items():
        texts = sorted((known[i].hash, i, t) for (x, t), i in first.items() if x == lang)[: langid.SAMPLED_DOCS]
        words = [langid.letters(t) for _, _, t in texts]
        share = next(n for n in range(1 << 16, -1, -1) if sum(min(len(w), n) + 1 for w in words) <= langid.DICTIONARY_BYTES)
        assert content == b" ".join(w[:share] for w in words)
    for r in docs.head(60).itertuples():
        words = langid.letters(r.text or "")
        for lang, content in model.dictionaries.items():
            options = zstandard.ZstdCompressionParameters.from_level(langid.LEVEL, source_size=langid.BLOCK_BYTES, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
            plain = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=options)
            size = sum(len(plain.compress(words[i : i + langid.BLOCK_BYTES])) for i in range(0, len(words), langid.BLOCK_BYTES))
            assert model.sizes(words)[lang] == size


def test_no_text_takes_the_place_of_others(spark):
    """One very long text, many copies and many empty ones, none of which keeps the others out."""
    rows = [(i, f"word{i} " * 50, "aa") for i in range(60)]
    rows += [(1000 + i, "", "aa") for i in range(200)] + [(2000 + i, "12 34", "aa") for i in range(200)] + [(3000 + i, "copies " * 9, "aa") for i in range(200)]
    rows += [(4000 + i, "0 " * 40_000 + "very long " * 30_000, "aa") for i in range(3)] + [(5000 + i, None, "bb") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    (content,) = langid.train(docs).dictionaries.values()
    assert len(content) <= langid.DICTIONARY_BYTES
    kinds = {w for w in content.split() if w.startswith(b"word")}
    assert len(kinds) >= langid.SAMPLED_DOCS - 3 or content.count(b"copies") <= 9
    same = langid.train(docs.unionByName(docs).repartition(7))
    assert same.dictionaries == {"aa": content}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i % 3}") for i in range(40)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.train(docs)


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = langid.train(table(spark, SF, "documents"))
    found = langid.with_language(odd_docs, model, "found")
    assert found.columns == [*odd_docs.columns, "found"] and found.count() == odd_docs.count()
    rows = {r.doc_id: r.found for r in found.collect()}
    for i in (4, 5, 6, 7):
        assert (rows[i].lang_pred, rows[i].score, rows[i].accepted) == ("und", 0.0, False)
    assert rows[8].lang_pred == "en" and rows[8].accepted
    # A text as long as the first stretch of the long one, and the whole, say the same.
    assert langid.with_language(odd_docs, langid.train(no_docs), "text_").where("text_.lang_pred <> 'und'").count() == 0
    assert langid.with_language(no_docs, model, "found").count() == 0


def test_ties_and_single_language():
    same = langid.Model({"b": b"the same content " * 9, "a": b"the same content " * 9})
    assert same.predict("the same") == ("b", 0.0)
    assert langid.Model({"x": b"the same content"}).predict("words") == ("x", 1.0)


def test_quality_of_unseen_labels(spark):
    """Trained without the labels of a third of the documents, judged on these."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels.where("doc_id % 3 <> 1"))
    unseen = labels.where("doc_id % 3 = 1").join(quality.with_quality(docs, model, "found"), "doc_id").collect()
    good = [r.found.accepted for r in unseen if r.quality == 1]
    bad = [r.found.accepted for r in unseen if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2
    assert all(0 <= s <= 1 for r in unseen for s in (r.found.score, r.found.text_score, r.found.page_score))


def test_views_teach_each_other():
    """Labels are few; the second view is right on the pool rows of which the first can say nothing, and the other way round."""
    rng = np.random.default_rng(0)

    def rows(n):
        y = rng.integers(0, 2, n)
        text = np.where(rng.random(n) < 0.6, 2 * y - 1, 0)[:, None] * np.ones((1, 2)) + rng.normal(0, 0.1, (n, 2))
        page = np.where(rng.random(n) < 0.6, 2 * y - 1, 0)[:, None] * np.ones((1, 3)) + rng.normal(0, 0.1, (n, 3))
        return [text, page], y.astype(float)

    views, y = rows(260)
    pool, _ = rows(2000)
    test, want = rows(1000)
    model = quality.cotrain(views, y, pool)
    both, text, page = ((s >= 0.5) == (want == 1) for s in model.scores(*test))
    assert both.mean() > 0.88 and both.mean() > text.mean() and both.mean() > page.mean()


def test_all_unlabelled_documents_teach(spark):
    """Sure texts of a source without labels come after the first 8,000 unlabelled ids by hash."""
    rng = random.Random(1)

    def good():
        return " ".join(rng.choice(["tree", "river", "walks", "over"]) for _ in range(30))

    ids = [r.id for r in spark.range(1000, 10500).orderBy(F.xxhash64("id")).collect()]
    rows = [(i, "", "s0") for i in ids[:9200]] + [(i, good(), "rare") for i in ids[9200:]]
    labels = []
    for i in range(600):
        quality_of, clear = i % 2, i % 4 < 2
        text = "" if not clear else good() if quality_of else "BUY!! NOW!! " * rng.randrange(1, 9)
        rows.append((i, text, "s1" if rng.random() < (0.7 if quality_of else 0.3) else "s0"))
        labels.append((i, quality_of))
    docs = spark.createDataFrame([(i, t, "en", s, 100) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    found = quality.with_quality(docs, model, "q").groupBy("source").agg(F.avg("q.page_score").alias("score")).collect()
    scores = {r.source: r.score for r in found}
    assert scores["rare"] > 0.8 > scores["s1"]


def test_quality_without_a_model(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id bigint, quality int")
    model = quality.train(odd_docs, labels)
    assert model is None
    found = quality.with_quality(odd_docs, model, "Root")
    assert found.where("Root.accepted AND Root.score IS NULL").count() == odd_docs.count()
    assert quality.train(no_docs, labels) is None


def test_quality_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(0)
    good = [(i, " ".join(rng.choice(["tree", "river", "walks", "over"]) for _ in range(30)), 1) for i in range(100, 300)]
    bad = [(i, "BUY!! NOW!! " * rng.randrange(1, 9), 0) for i in range(300, 400)]
    more = spark.createDataFrame([(i, t, "en", "s", len(t), "a", 1, b"", "") for i, t, _ in good + bad], odd_docs.schema)
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id bigint, quality int")
    docs = odd_docs.unionByName(more)
    model = quality.train(docs, labels)
    found = quality.with_quality(docs, model, "found")
    assert found.columns == [*docs.columns, "found"] and found.where("found.score IS NULL").count() == 0
    accepted = {r.doc_id: r.found.accepted for r in found.where("doc_id >= 100").collect()}
    assert np.mean([accepted[i] == (q == 1) for i, _, q in good + bad]) > 0.97
    assert found.count() == docs.count() and quality.with_quality(no_docs, model, "found").count() == 0
