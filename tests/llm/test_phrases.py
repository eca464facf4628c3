import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gleanery.llm import phrases
from gleanery.llm.queries import ORACLES, QUERIES

from .conftest import SCHEMA

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least=30, top=2000):
    counts, totals = {}, Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            own = counts.setdefault(lang or "und", Counter())
            own.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        inside = Counter()
        for p, f in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], f)
        kept = []
        for p, a in frequent.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def some_docs(n=400, seed=1):
    rng, words = random.Random(seed), ["Sun", "moon", "é", "日本", "the", "of", "A", "z-z", "x" * 90]
    docs = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", "]) for _ in range(rng.randrange(30)))
        docs.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return docs + [("en", "sun moon sun moon sun moon"), ("fr", ""), ("fr", None)]


def found(spark, docs, **options):
    rows = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    return sorted(tuple(r) for r in phrases.collocations(rows, **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("shards", [1, 3])
def test_against_counting_all(spark, shards):
    docs = some_docs()
    assert found(spark, docs, least=6, shards=shards, block=500) == brute(docs, 6)


def test_a_small_filter_only_costs_work(spark):
    docs = some_docs(150, 2)
    assert found(spark, docs, least=4, top=5, cells=64) == brute(docs, 4, 5)


class Poor(phrases.Splitter):
    """With the first seed, most words have the same hash."""

    def __init__(self, seed):
        super().__init__(seed)
        self.seed = seed

    def words(self, lang, text, other=False):
        hashes, at = super().words(lang, text, other)
        return (hashes if other or self.seed else np.minimum(hashes, np.uint64(1 << 61))), at


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    """Hashes that fall together make the words be counted with others."""
    seeds, coded = [], phrases._coded
    monkeypatch.setattr(phrases, "_coded", lambda docs, shards, seed, *rest: (seeds.append(seed), coded(docs, shards, seed, *rest))[1])
    docs = some_docs(60, 3)
    assert found(spark, docs, least=4, splitter=Poor) == brute(docs, 4) and seeds == [0, 1]


def test_splitter():
    splitter = phrases.Splitter(0)
    texts = [b"", b" ", b"a", b"A  b\tc", b".a.b!", b"x" * 5000 + b" y", "é 日本, Ü".encode(), b"ab ba", b"a a a"]
    known = {}
    for text in texts:
        want = [None if w == phrases.BREAK else w for w in text.translate(phrases.FOLDED).replace(phrases.BREAK, b" \xff ").split()]
        hashes, starts = splitter.words("en", text)
        assert len(hashes) == len(want) and [h == 0 for h in hashes.tolist()] == [w is None for w in want]
        for word, value, start in zip(want, hashes.tolist(), starts.tolist()):
            assert word is None or text.translate(phrases.FOLDED)[start:].startswith(word) and known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    assert not set(splitter.words("de", b"a b")[0].tolist()) & set(splitter.words("en", b"a b")[0].tolist())


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.lang, r.text) for r in odd_docs.collect()]
    got = phrases.collocations(odd_docs)
    assert got.columns == COLUMNS and sorted(tuple(r) for r in got.collect()) == brute(docs) != []
    assert phrases.collocations(no_docs).count() == 0
    clash = odd_docs.limit(0).withColumnRenamed("FP", "hash").withColumnRenamed("root", "words")
    assert phrases.collocations(clash).count() == 0


def test_query(spark):
    query = QUERIES["op12_itemset_phrases"](spark, SF)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = db.execute(ORACLES["op12_itemset_phrases"])
    names = [c[0] for c in cursor.description]
    rows = sorted(tuple(r) for r in query.select(*names).collect())
    assert rows == sorted(cursor.fetchall())
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in query.select(*COLUMNS).collect()) == brute(docs)
    assert SCHEMA.startswith("doc_id")
